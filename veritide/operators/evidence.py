"""Evidence chains, reconciliation with tolerance, and lookups in registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritide.functions.parse import canonical_name


def chain_audit(results: DataFrame, candidates: DataFrame, observations: DataFrame, links: DataFrame, inventories: DataFrame, scopes: DataFrame) -> DataFrame:
    """(result_id, codes, status): every accepted result must lead to a candidate, an observation, a link, a complete inventory and an accepted scope.

    Keys: results.candidate_id, candidates.observation_id, observations.link_id, links.inventory_id, inventories.scope_id.
    """
    renamed = lambda df, p: df.select(*(F.col(c).alias(f"{p}_{c}") for c in df.columns))
    c, o, k, i, s = renamed(candidates, "c"), renamed(observations, "o"), renamed(links, "k"), renamed(inventories, "i"), renamed(scopes, "s")
    j = (
        results.join(c, results["candidate_id"] == c["c_candidate_id"], "left").join(o, F.col("c_observation_id") == F.col("o_observation_id"), "left").join(k, F.col("o_link_id") == F.col("k_link_id"), "left")
        .join(i, F.col("k_inventory_id") == F.col("i_inventory_id"), "left").join(s, F.col("i_scope_id") == F.col("s_scope_id"), "left")
    )
    checks = [
        (F.col("c_candidate_id").isNull(), "missing_candidate"), (F.col("c_candidate_id").isNotNull() & (~F.col("c_home_goals").eqNullSafe(F.col("home_goals")) | ~F.col("c_away_goals").eqNullSafe(F.col("away_goals"))), "score_mismatch"),
        (F.col("o_observation_id").isNull(), "missing_observation"), (F.col("k_link_id").isNull(), "missing_link"), (F.col("k_fixture_id").isNotNull() & (F.col("k_fixture_id") != F.col("fixture_id")), "link_mismatch"),
        (F.col("i_inventory_id").isNull(), "missing_inventory"), (~F.col("i_complete"), "incomplete_inventory"), (F.col("s_scope_id").isNull() | ~F.coalesce("s_accepted", F.lit(False)), "missing_accepted_scope"),
    ]
    codes = F.array_compact(F.array(*(F.when(x, code) for x, code in checks)))
    return j.select("result_id", codes.alias("codes"), F.when(F.size(codes) == 0, "passed").otherwise("failed").alias("status"))


def tolerance_match(left: DataFrame, right: DataFrame, on: list[str], minutes: int, home: str = "home_team", away: str = "away_team", kickoff: str = "kickoff_at", left_id: str = "fixture_id", right_id: str = "match_id") -> DataFrame:
    """(left_id, right_id, status): one candidate by slate and number, kickoff within minutes, names equal once canonical.

    Several candidates are ambiguous whatever they are, so the right side is a count and one row for each slate and number before it is joined: no pairs are made.
    """
    one = F.struct(F.col(right_id).alias("r"), F.col(kickoff).alias("k"), canonical_name(home, True).alias("h"), canonical_name(away, True).alias("a"))
    r = right.groupBy(*on).agg(F.count(right_id).alias("_n"), F.min(F.when(F.col(right_id).isNotNull(), one)).alias("_c"))
    l = left.select(*on, left_id, F.col(kickoff).alias("_lk"), canonical_name(home, True).alias("_lh"), canonical_name(away, True).alias("_la"))
    seen = l.join(r, on, "left")
    rows = seen.groupBy(left_id).agg(F.sum("_n").alias("_all"), F.min(F.struct("_c", "_lk", "_lh", "_la")).alias("_p"), F.max(F.when(F.col("_n") > 0, F.struct("_c", "_lk", "_lh", "_la"))).alias("_q"))
    p = F.coalesce("_q", "_p")
    n = F.coalesce("_all", F.lit(0))
    late = F.abs(F.unix_timestamp(p["_lk"]) - F.unix_timestamp(p["_c"]["k"])) > minutes * 60
    status = F.when(n == 0, "missing").when(n > 1, "rejected:ambiguous").when(late, "rejected:kickoff").when((p["_lh"] != p["_c"]["h"]) | (p["_la"] != p["_c"]["a"]), "rejected:team_names").otherwise("accepted")
    return rows.select(left_id, status.alias("status"), F.when(status == "accepted", p["_c"]["r"]).alias(right_id))


def resolve(df: DataFrame, registry: DataFrame, aliases: DataFrame, ident: str, name: str) -> DataFrame:
    """profile_id and resolution of each row: by id; an alias that names another id is a conflict; an unknown id stays unregistered; without an id by alias.

    Registry and aliases are dimensions of some thousands of rows; Spark broadcasts them by their size.
    """
    a = aliases.select(canonical_name("alias").alias("_alias"), F.col("profile_id").alias("_by_alias"))
    r = registry.select(F.col("profile_id").alias("_by_id")).distinct()
    j = df.withColumn("_name", canonical_name(name)).join(r, F.col(ident) == F.col("_by_id"), "left").join(a, F.col("_name") == F.col("_alias"), "left")
    status = (
        F.when(F.col("_by_id").isNotNull() & F.col("_by_alias").isNotNull() & (F.col("_by_alias") != F.col("_by_id")), "conflict").when(F.col("_by_id").isNotNull(), "by_id").when(F.col(ident).isNotNull(), "unregistered")
        .when(F.col("_by_alias").isNotNull(), "by_alias").otherwise("unregistered")
    )
    pick = F.when(status == "by_id", F.col("_by_id")).when(status == "by_alias", F.col("_by_alias"))
    return j.withColumn("resolution", status).withColumn("profile_id", pick).drop("_name", "_alias", "_by_alias", "_by_id")


def lookup(df: DataFrame, by_id: DataFrame, by_name: DataFrame, ident: str, name: str, value: str, unknown: str) -> DataFrame:
    """value by id, else by name, else unknown."""
    a, b = by_id.select(F.col("key").alias("_i"), F.col(value).alias("_vi")), by_name.select(F.col("key").alias("_n"), F.col(value).alias("_vn"))
    return df.join(a, F.col(ident) == F.col("_i"), "left").join(b, F.col(name) == F.col("_n"), "left").withColumn(value, F.coalesce("_vi", "_vn", F.lit(unknown))).drop("_i", "_n", "_vi", "_vn")


def feed_triage(feed: DataFrame, wanted: DataFrame, fixture: str = "fixture_id") -> DataFrame:
    """(fixture, status): exactly one feed row each; 5 and 6 are cancelled, other than 4 not finished."""
    g = feed.groupBy(fixture).agg(F.count("*").alias("_n"), F.min("status_code").alias("_s"))
    j = wanted.select(fixture).distinct().join(g, fixture, "left")
    return j.select(fixture, F.when(F.col("_n").isNull(), "fixture_missing").when(F.col("_n") > 1, "fixture_duplicate").when(F.col("_s").isin(5, 6), "cancelled").when(F.coalesce("_s", F.lit(-1)) != 4, "not_finished").otherwise("finished").alias("status"))


def differences(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys in one frame only, with the side."""
    x, y = a.select(*keys).distinct(), b.select(*keys).distinct()
    return x.join(y, keys, "left_anti").withColumn("side", F.lit("left")).unionByName(y.join(x, keys, "left_anti").withColumn("side", F.lit("right")))


def disjoint(a: DataFrame, b: DataFrame, key: str) -> bool:
    """Whether no key is in both frames."""
    return a.select(key).intersect(b.select(key)).isEmpty()


def staleness(signals: DataFrame, now: Column, limits: DataFrame) -> DataFrame:
    """(signal, age, status): failed where older than the failure limit or never seen, in_future where later than now, else warning or ok."""
    last = signals.groupBy("signal").agg(F.max("ts").alias("last"))
    j = limits.join(last, "signal", "left").withColumn("age", F.unix_timestamp(now) - F.unix_timestamp("last"))
    return j.select("signal", "age", F.when(F.col("last").isNull() | (F.col("age") > F.col("fail_after")), "failed").when(F.col("age") < 0, "in_future").when(F.col("age") > F.col("warn_after"), "warning").otherwise("ok").alias("status"))


def clock_drift(checks: DataFrame, observed: str, server: str, limit: int, critical: Column, recent: Column) -> DataFrame:
    """drift in seconds and status: over the limit critical or a warning by kind, else ok where a recent check exists."""
    d = F.abs(F.unix_timestamp(observed) - F.unix_timestamp(server))
    return checks.withColumn("drift", d).withColumn("status", F.when(d > limit, F.when(critical, "critical").otherwise("stale_warning")).when(d.isNull() & ~recent, "stale_warning").otherwise("ok"))
