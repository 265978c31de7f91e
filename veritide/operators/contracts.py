"""Data contracts: declared expectations, and what breaks them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, expectations: dict[str, Column], key: str) -> DataFrame:
    """(key, code) for each broken expectation. An expectation that is null is broken."""
    codes = F.array_compact(F.array(*(F.when(~F.coalesce(e, F.lit(False)), code) for code, e in expectations.items())))
    return df.select(key, F.explode(codes).alias("code"))


def split(df: DataFrame, expectations: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined with an array of reasons)."""
    codes = F.array_compact(F.array(*(F.when(~F.coalesce(e, F.lit(False)), code) for code, e in expectations.items())))
    marked = df.withColumn("reasons", codes)
    return marked.where(F.size("reasons") == 0).drop("reasons"), marked.where(F.size("reasons") > 0)


def one_of(name: str, *values: str) -> Column:
    return F.col(name).isin(*values)


def is_sha256(name: str) -> Column:
    return F.col(name).rlike("^[0-9a-f]{64}$")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def alias_conflicts(aliases: DataFrame, alias: str, target: str) -> DataFrame:
    """Aliases that name more than one target."""
    return aliases.groupBy(alias).agg(F.count_distinct(target).alias("n_targets")).where("n_targets > 1")


def unsupported(df: DataFrame, kind: str, supported: tuple[str, ...]) -> DataFrame:
    """Rows of unknown type: kept apart, not dropped."""
    return df.where(~F.col(kind).isin(*supported))


def eligible_fixtures(fixtures: DataFrame, events: DataFrame, key: str, scope: str = "result_scope", flag: str = "result_eligible") -> DataFrame:
    """Eligible fixtures over regular time that no failure event points at."""
    failed = events.where(F.col("status") == "failed").select(F.get_json_object("details", "$.fixture_record_id").alias(key)).where(F.col(key).isNotNull()).distinct()
    return fixtures.where(F.col(flag) & (F.col(scope) == "regular_time_90")).join(failed, key, "left_anti")


#: Flags (research_only, backfill, strict_backtest_eligible, cutoff_eligible) of each kind of record.
FLAGS = {"historical": (True, True, False, False), "model_artifact": (True, True, False, False), "shadow_event": (True, False, False, False)}


def flag_contract(kind: str = "research_kind") -> Column:
    names = ("research_only", "backfill", "strict_backtest_eligible", "cutoff_eligible")
    ok = [(F.col(kind) == k) & reduce(lambda a, b: a & b, (F.col(n) == v for n, v in zip(names, vs, strict=True))) for k, vs in FLAGS.items()]
    return reduce(lambda a, b: a | b, ok)


RANK = {"observation_only": 0, "low": 1, "medium": 2, "high": 3}


def rank(name: str | Column) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    return F.try_element_at(F.create_map(*(F.lit(x) for p in RANK.items() for x in p)), c)


#: Fields that a prediction under a policy must have.
POLICY_FIELDS = (
    "competition_type", "market_evidence_tier", "evaluation_group", "classification_status", "registry_version", "registry_file_sha256", "registry_canonical_sha256", "raw_confidence_label", "competition_confidence_cap",
    "confidence_label", "confidence_reasons", "risk_flags",
)


def shadow_policy() -> dict[str, Column]:
    """Expectations of every prediction with a policy_version; older ones have no policy to keep."""
    raw, cap, final = (rank(c) for c in ("raw_confidence_label", "competition_confidence_cap", "confidence_label"))
    tier, status = F.col("market_evidence_tier"), F.col("status")
    named = raw.isNotNull() & cap.isNotNull() & final.isNotNull()
    rules = {
        "incomplete_policy_fields": reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in POLICY_FIELDS)),
        "invalid_registry_sha256": is_sha256("registry_file_sha256") & is_sha256("registry_canonical_sha256"),
        "invalid_confidence_label": named,
        "confidence_exceeds_cap": ~named | (final <= F.least(raw, cap)),
        "tier_c_cap_above_low": ~tier.eqNullSafe("C") | ~F.coalesce(cap > RANK["low"], F.lit(False)),
        "tier_d_not_abstained": ~tier.eqNullSafe("D") | (F.col("competition_confidence_cap").eqNullSafe("observation_only") & F.col("confidence_label").eqNullSafe("observation_only") & status.eqNullSafe("abstained")),
        "provisional_above_medium": ~F.col("classification_status").eqNullSafe("provisional") | ~F.coalesce(final > RANK["medium"], F.lit(False)),
        "published_without_identity": ~status.eqNullSafe("published") | (F.coalesce(F.trim("identity_record_id"), F.lit("")) != ""),
    }
    old = F.coalesce(F.trim("policy_version"), F.lit("")) == ""
    return {code: old | F.coalesce(ok, F.lit(False)) for code, ok in rules.items()}


#: What a competition profile may say.
TIERS, CLASSIFICATIONS = ("A", "B", "C"), ("confirmed", "provisional")


def registry_contract(types: tuple[str, ...], statuses: tuple[str, ...] = CLASSIFICATIONS) -> dict[str, Column]:
    """Expectations of a competition profile: competition_id, competition_type, market_evidence_tier, classification_status, confidence_cap, canonical_name, evaluation_group, classification_reason, name_aliases."""
    filled = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return {
        "competition_id": F.col("competition_id").rlike("^[0-9]+$"), "competition_type": one_of("competition_type", *types), "market_evidence_tier": one_of("market_evidence_tier", *TIERS),
        "classification_or_confidence": one_of("classification_status", *statuses) & rank("confidence_cap").isNotNull(), "profile_metadata": filled("canonical_name") & filled("evaluation_group") & filled("classification_reason"),
        "tier_c_cap_above_low": ~F.col("market_evidence_tier").eqNullSafe("C") | (rank("confidence_cap") <= RANK["low"]), "name_aliases": F.size("name_aliases") > 0,
    }


def policy_contract() -> dict[str, Column]:
    """Expectations of a confidence policy (structs high and medium with bookmakers, gap, dispersion; a struct gate): high asks no less than medium, and shares lie in 0 to 1."""
    share = lambda c: F.col(c).between(0, 1)
    return {
        "thresholds_not_monotone": (F.col("high.bookmakers") >= F.col("medium.bookmakers")) & (F.col("high.gap") >= F.col("medium.gap")) & (F.col("high.dispersion") <= F.col("medium.dispersion")),
        "bookmakers_out_of_range": F.col("medium.bookmakers") >= 1,
        "share_out_of_range": reduce(lambda a, b: a & b, (share(f"{k}.{f}") for k in ("high", "medium") for f in ("gap", "dispersion"))),
        "gate_out_of_range": (F.col("gate.fixtures") > 0) & (F.col("gate.days") > 0),
    }


def replay(stored: DataFrame, recomputed: DataFrame, key: str, fields: list[str], checks: dict[str, Column] | None = None) -> DataFrame:
    """(key, mismatches): stored fields that a recomputation from stored features doesn't give, and codes of checks that a stored row fails, such as its own id or the order of its times."""
    b = recomputed.select(key, F.struct(*fields).alias("_new"))
    codes = [F.when(~F.col(f).eqNullSafe(F.col(f"_new.{f}")), f) for f in fields] + [F.when(~F.coalesce(c, F.lit(False)), code) for code, c in (checks or {}).items()]
    return stored.join(b, key, "left").select(key, F.array_compact(F.array(*codes)).alias("mismatches")).where(F.size("mismatches") > 0)


def assessment_checks(kind: str, parts: list[str], effective: str, assessed: str, cutoff: str) -> dict[str, Column]:
    """Checks for replay(): the record id follows from its parts, and it was assessed from the policy's start on and not before its cutoff."""
    from veritide.functions.ids import stable_id

    return {"record_id": F.col("record_id") == stable_id(kind, *parts), "assessed_before_effective": F.col(assessed) >= F.col(effective), "assessed_before_cutoff": F.col(assessed) >= F.col(cutoff)}


def live_only(events: DataFrame, details: str = "details") -> DataFrame:
    """Events that come from live capture, not from a later reprocessing."""
    return events.where(F.coalesce(F.get_json_object(details, "$.reprocessed"), F.lit("false")) != "true")


def batch_assessment(batches: DataFrame, core: tuple[str, ...] = ("ouzhi", "yazhi", "daxiao"), least: int = 3) -> DataFrame:
    """strict, data_complete, model_strict_eligible and reasons from a map of market results and batch flags."""
    of = lambda m: F.try_element_at("market_results", F.lit(m))
    reasons = [F.when(~F.col("core_market_complete"), "core_market_incomplete"), F.when(F.col("identity_conflict"), "identity_conflict"), F.when(F.col("first_seen"), "first_seen_after_window")]
    complete = F.lit(True)
    inside = F.lit(True)
    for m in core:
        good = F.coalesce((of(m)["valid_bookmaker_rows"] >= least) & (of(m)["normalization_status"] == "accepted"), F.lit(False))
        clock = F.coalesce(of(m)["clock_ok"] & of(m)["observed_at"].between(F.col("window_start"), F.col("window_end")), F.lit(False))
        complete, inside = complete & good, inside & clock
        reasons += [F.when(~good, f"insufficient_normalized_rows:{m}"), F.when(~clock, f"outside_window_or_clock:{m}")]
    strict = F.col("core_market_complete") & ~F.col("identity_conflict") & ~F.col("first_seen") & inside
    return batches.select("*", strict.alias("strict"), complete.alias("data_complete"), (strict & complete).alias("model_strict_eligible"), F.array_sort(F.array_compact(F.array(*reasons))).alias("ineligibility_reasons"))


#: Prices that a complete row has, opening and current, by market.
COMPLETE = {"ouzhi": ("home", "draw", "away"), "yazhi": ("home", "line", "away"), "daxiao": ("over", "line", "under")}


def complete_row(market: str = "market") -> Column:
    per = [(F.col(market) == m) & reduce(lambda a, b: a & b, (F.col(f"{side}_{k}").isNotNull() for side in ("opening", "current") for k in keys)) for m, keys in COMPLETE.items()]
    return F.coalesce(reduce(lambda a, b: a | b, per), F.lit(False))


def dataset_contract(df: DataFrame, key: str, group: str, expected: dict[str, int]) -> DataFrame:
    """Observed against expected counts of a pinned dataset; one row for each group, one for the whole."""
    spark = df.sparkSession
    want = spark.createDataFrame(list(expected.items()), "grp string, expected long")
    have = df.groupBy(F.col(group).cast("string").alias("grp")).agg(F.count("*").alias("n"), F.count_distinct(key).alias("n_keys"))
    return want.join(have, "grp", "full").select("grp", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("n_keys", F.lit(0)).alias("n_keys")).withColumn("ok", (F.col("n") == F.col("expected")) & (F.col("n_keys") == F.col("n")))
