"""Counts and rates for reports. Dimensions are unpivoted, so that one aggregation serves them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritide.operators import score


def ratio(part: Column, whole: Column, places: int = 6) -> Column:
    """Rounded share; null without a denominator."""
    return F.round(part / F.nullif(whole.cast("double"), F.lit(0.0)), places)


def by_dimensions(df: DataFrame, dimensions: dict[str, Column], measures: list[Column], unknown: str = "unknown", overall: bool = True) -> DataFrame:
    """(dimension, value, measures): a row for each value of each dimension, and one overall."""
    parts = [F.struct(F.lit(k).alias("dimension"), F.coalesce(v.cast("string"), F.lit(unknown)).alias("value")) for k, v in dimensions.items()]
    if overall:
        parts.append(F.struct(F.lit("overall").alias("dimension"), F.lit("all").alias("value")))
    return df.select("*", F.explode(F.array(*parts)).alias("_d")).groupBy("_d.dimension", "_d.value").agg(*measures)


def coverage(df: DataFrame, dimensions: list[str]) -> DataFrame:
    """Records by each dimension."""
    return by_dimensions(df, {d: F.col(d) for d in dimensions}, [F.count("*").alias("n")], overall=False)


def status_counts(df: DataFrame, kind: str, status: str, fixture: str) -> DataFrame:
    return df.groupBy(kind, status).agg(F.count("*").alias("n"), F.count_distinct(fixture).alias("fixtures"))


def pivot_status(df: DataFrame, keys: list[str], status: str, values: list[str]) -> DataFrame:
    """Counts of each status beside each other, and the success rate of the first."""
    cols = [F.count_if(F.col(status) == v).alias(v) for v in values]
    return df.groupBy(*keys).agg(F.count("*").alias("total"), *cols).withColumn("success_rate", ratio(F.col(values[0]), F.col("total")))


def evaluation_stats(df: DataFrame, keys: list[str], fixture: str, cutoff: str, method: str, manual: tuple[str, ...], available: Column | None = None, confirmed: str = "confirmed_at") -> DataFrame:
    """Automatic evaluation: distinct fixtures, and the days that their cutoffs span."""
    rows = df.where(~F.col(method).isin(*manual))
    if available is not None:
        rows = rows.where(F.col(confirmed) <= available)
    return rows.groupBy(*keys).agg(F.count_distinct(fixture).alias("fixtures"), F.round((F.unix_timestamp(F.max(cutoff)) - F.unix_timestamp(F.min(cutoff))) / 86400, 6).alias("span_days"))


def risk_metrics(df: DataFrame, keys: list[str], action: str = "proposed_action", hit: str = "hit") -> DataFrame:
    """What a guardrail flags, against what was wrong."""
    wrong, flagged, keep = F.col(hit) == 0, F.col(action).isin("caution", "downgrade", "abstain"), F.col(action) == "keep"
    g = df.groupBy(*keys).agg(
        F.count("*").alias("fixtures"), F.count_if(wrong).alias("wrong"), F.count_if(flagged).alias("flagged"), F.count_if(flagged & wrong).alias("flagged_wrong"), F.count_if(flagged & ~wrong).alias("false_warnings"),
        F.count_if(keep).alias("kept"), F.count_if(keep & wrong).alias("kept_wrong"), F.count_if(F.col(action) == "abstain").alias("abstained"), F.count_if((F.col(action) == "abstain") & wrong).alias("abstained_wrong"), F.count_if((F.col(action) == "downgrade") & wrong).alias("downgraded_wrong"),
    )
    rates = {"capture_rate": ratio(F.col("flagged_wrong"), F.col("wrong"), 10), "flagged_error_rate": ratio(F.col("flagged_wrong"), F.col("flagged"), 10), "keep_error_rate": ratio(F.col("kept_wrong"), F.col("kept"), 10)}
    return g.withColumns(rates).withColumn("lift", F.round(F.col("flagged_error_rate") - F.col("keep_error_rate"), 10))


def distribution(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, n, least, median, most), exact: no group is gathered or sorted as a whole. Groups without a value have n 0."""
    found = score.order_statistics(df, keys, value, score.MIDDLE).withColumn("median", ((F.col("_below") + F.col("_above")) / 2).cast("double"))
    named = found.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "n", "least", "median", "most")
    j = df.select(*keys).distinct().join(named, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], "left")
    return j.select(*keys, F.coalesce("n", F.lit(0).cast("long")).alias("n"), "least", "median", "most")


def normalization_quality(rows: DataFrame, snapshot: str, bookmaker: str, complete: Column, source_time: str, line_error: str) -> DataFrame:
    """Counts and reasons of a snapshot's normalisation; it is rejected only without bookmaker rows."""
    g = rows.groupBy(snapshot).agg(
        F.count_distinct(F.when(complete, F.col(bookmaker))).alias("valid_bookmakers"), F.count_if(F.col("row_role") == "bookmaker").alias("bookmaker_rows"), F.count(source_time).alias("timed_rows"), F.count(line_error).alias("line_failures")
    )
    reasons = F.array_compact(F.array(F.when(F.col("bookmaker_rows") == 0, "no_bookmaker_rows"), F.when(F.col("line_failures") > 0, "line_parse_failures"), F.when(F.col("timed_rows") < F.col("bookmaker_rows"), "missing_source_times")))
    return g.withColumn("quality_reasons", reasons).withColumn("status", F.when(F.col("bookmaker_rows") == 0, "rejected").otherwise("accepted"))


def market_quality(rows: DataFrame, keys: list[str], market: str, counted: tuple[str, ...] = ("yazhi", "daxiao")) -> DataFrame:
    """Snapshots, rows, parse and time coverage by keys and market, and over all keys ('all') by market."""
    lines = F.when(F.col(market).isin(*counted), F.col("row_count"))
    g = rows.groupBy(*keys, market).agg(F.count("*").alias("snapshots"), F.sum("row_count").alias("n_rows"), F.sum(lines).alias("_lines"), F.sum(F.when(lines.isNotNull(), F.col("line_failures"))).alias("_bad"), F.sum("timed_rows").alias("_timed"))
    total = g.groupBy(market).agg(*(F.sum(c).alias(c) for c in ("snapshots", "n_rows", "_lines", "_bad", "_timed"))).select(*(F.lit("all").alias(k) for k in keys), market, "snapshots", "n_rows", "_lines", "_bad", "_timed")
    both = g.select(*(F.col(k).cast("string").alias(k) for k in keys), market, "snapshots", "n_rows", "_lines", "_bad", "_timed").unionByName(total)
    return both.select(*keys, market, "snapshots", "n_rows", ratio(F.col("_lines") - F.col("_bad"), F.col("_lines")).alias("parse_success_rate"), ratio(F.col("_timed"), F.col("n_rows")).alias("time_coverage"))


def eligibility_breakdown(df: DataFrame, keys: list[str], reasons: str, collection: str = "collection_not_eligible") -> DataFrame:
    """Batches, eligible ones, data-complete ones (no reason but the collection one), and counts by reason as a map."""
    complete = F.forall(reasons, lambda r: r == collection)
    g = df.groupBy(*keys).agg(F.count("*").alias("batches"), F.count_if(F.size(reasons) == 0).alias("eligible"), F.count_if(complete).alias("data_complete"))
    per = df.select(*keys, F.explode(reasons).alias("reason")).groupBy(*keys, "reason").agg(F.count("*").alias("n"))
    maps = per.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("reason", "n")))).alias("reason_counts"))
    return g.join(maps, keys, "left")


def result_coverage(fixtures: DataFrame, candidates: DataFrame, verified: DataFrame, conflicts: DataFrame, excluded: DataFrame, start: Column, end: Column, fixture: str = "fixture_id") -> DataFrame:
    """One row: fixtures that kicked off in [start - 24h, end - 24h) without exclusions, candidates within 24 hours, verified without conflicts."""
    day = F.expr("INTERVAL 24 HOURS")
    cohort = fixtures.where((F.col("kickoff_at") >= start - day) & (F.col("kickoff_at") < end - day)).join(excluded.select(fixture).distinct(), fixture, "left_anti")
    first = candidates.groupBy(fixture).agg(F.min("observed_at").alias("_seen"))
    good = verified.join(conflicts.select(fixture).distinct(), fixture, "left_anti").select(fixture).distinct().withColumn("_verified", F.lit(True))
    j = cohort.join(first, fixture, "left").join(good, fixture, "left")
    n = j.agg(F.count("*").alias("fixtures"), F.count_if(F.col("_seen") <= F.col("kickoff_at") + day).alias("candidates"), F.count("_verified").alias("verified"))
    return n.withColumns({"candidate_rate": ratio(F.col("candidates"), F.col("fixtures")), "verified_rate": ratio(F.col("verified"), F.col("fixtures"))})


def inventory_complete(pages: DataFrame, batch: str = "batch_id") -> DataFrame:
    """(batch, complete): all pages fetched and none failed."""
    g = pages.groupBy(batch).agg(F.count_distinct("page").alias("fetched"), F.max("total_pages").alias("total_pages"), F.bool_and("ok").alias("_ok"))
    return g.select(batch, "fetched", "total_pages", ((F.col("fetched") == F.col("total_pages")) & F.col("_ok")).alias("complete"))


def histogram(df: DataFrame, reasons: str) -> DataFrame:
    return df.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def daily_report(events: DataFrame, at: str = "occurred_at", zone: str = "Asia/Shanghai", kind: str = "event_type", status: str = "status", competition: str = "competition", cutoff: str = "cutoff", origin: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rates, counts) of every local day of live events, all days at once.

    rates: day, discovery_full, http_acquisition, parser and result_candidate success rates, null without attempts.
    counts: day, section (event, market, cutoff), name, status, n: all events by type, market captures by competition, snapshot batches by cutoff.
    origin: column that reads 'reprocess' for events of a later reprocessing, which don't count.
    """
    live = events if origin is None else events.where(~F.coalesce(F.col(origin) == "reprocess", F.lit(False)))
    rows = live.withColumn("day", F.to_date(F.from_utc_timestamp(F.col(at), zone)))
    of = lambda k, *s: F.count_if((F.col(kind) == k) & F.col(status).isin(*s))
    pairs = {"discovery_full": ("discovery_poll", "full", "partial"), "http_acquisition": ("http_request", "success", "failure"), "parser": ("parser", "success", "failure"), "result_candidate": ("result_candidate", "success", "missing")}
    rates = rows.groupBy("day").agg(F.count("*").alias("events"), *(ratio(of(k, good), of(k, good, bad)).alias(f"{name}_rate") for name, (k, good, bad) in pairs.items()))
    cell = lambda section, name: F.struct(F.lit(section).alias("section"), F.coalesce(name, F.lit("unknown")).alias("name"))
    cells = F.array_compact(F.array(cell("event", F.col(kind)), F.when(F.col(kind) == "market_capture", cell("market", F.col(competition))), F.when(F.col(kind) == "snapshot_batch", cell("cutoff", F.col(cutoff)))))
    counts = rows.select("day", F.col(status).alias("status"), F.explode(cells).alias("_c")).groupBy("day", "_c.section", "_c.name", "status").agg(F.count("*").alias("n"))
    return rates, counts


def window_report(counts: DataFrame, start: Column, end: Column) -> DataFrame:
    """Sums of daily counts over the days from start to before end, by section, name and status, with the days seen."""
    return counts.where((F.col("day") >= start) & (F.col("day") < end)).groupBy("section", "name", "status").agg(F.sum("n").alias("n"), F.count_distinct("day").alias("days"))


def forward_metrics(assessed: DataFrame, measures: list[Column], target: str = "target", update: str = "market_update_status", action: str = "proposed_action", mature: str = "sample_maturity", rule_map: str = "rule_evaluations", legacy: str = "legacy_analysis_flow") -> DataFrame:
    """(dimension, value, measures) of assessed rows by target, market update, action, sample maturity, by each rule with its state, and overall; one aggregation."""
    cell = lambda name, value: F.struct(F.lit(name).alias("dimension"), value.alias("value"))
    flat = F.array(
        cell("by_target", F.col(target)), cell("by_market_update_status", F.coalesce(F.col(update), F.lit(legacy))), cell("by_action", F.col(action)), cell("by_sample_maturity", F.coalesce(F.col(mature), F.lit(legacy))), cell("overall", F.lit("all")),
    )
    ruled = F.transform(F.map_entries(rule_map), lambda e: F.struct(F.lit("by_rule").alias("dimension"), F.concat_ws("|", e["key"], e["value"]).alias("value")))
    return assessed.select("*", F.explode(F.concat(flat, ruled)).alias("_d")).groupBy("_d.dimension", "_d.value").agg(*measures)
