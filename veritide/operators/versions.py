"""Current versions, de-duplication, conflicts and supersession.

Every choice ends in a total order: pass an id as the last order column. DESC puts nulls first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _desc(names: list[str]) -> list[Column]:
    return [F.col(n).desc_nulls_first() for n in names]


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by the order columns."""
    return top_k(df, keys, order, 1)


def top_k(df: DataFrame, keys: list[str], order: list[str], k: int) -> DataFrame:
    """The last k rows of each key. Spark prunes within tasks before it shuffles (window group limit)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_desc(order)))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def current_derivation(df: DataFrame, keys: list[str], version: str, at: str, record: str, accepted: Column) -> DataFrame:
    """The highest accepted version of each key, then the latest."""
    return latest(df.where(accepted), keys, [version, at, record])


def active(df: DataFrame, keys: list[str], start: str, end: str, now: Column, order: list[str], status: Column | None = None) -> DataFrame:
    """Of rows active at `now` (start <= now < end, an open end may be null) the last of each key."""
    live = (F.col(start) <= now) & (F.col(end).isNull() | (F.col(end) > now))
    return latest(df.where(live & status if status is not None else live), keys, order)


def eligible_batch(df: DataFrame, keys: list[str], clocks: list[str], completed: str, record: str, eligible: Column) -> DataFrame:
    """The best eligible batch by core_observed_at (the greatest of the market clocks), completion and id."""
    return latest(df.where(eligible).withColumn("core_observed_at", F.greatest(*clocks)), keys, ["core_observed_at", completed, record])


def deduplicate(df: DataFrame, keys: list[str], signature: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(kept, conflicts): a key with one distinct signature keeps its first row by order; one with more is dropped and reported."""
    # sort_array(collect_set) would hold a key's rows; min and max over structs tell as much
    sign = F.struct(*signature)
    w = Window.partitionBy(*keys)
    marked = df.withColumn("_same", F.min(sign).over(w).eqNullSafe(F.max(sign).over(w))).withColumn("_rank", F.row_number().over(w.orderBy(*order)))
    kept = marked.where("_same and _rank = 1").drop("_same", "_rank")
    conflicts = df.groupBy(*keys).agg(F.count_distinct(sign).alias("signatures")).where("signatures > 1")
    return kept, conflicts


def unstable(df: DataFrame, keys: list[str], member: str, signature: list[str]) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded): members of a key with more than one signature are excluded with all their rows."""
    excluded = df.groupBy(*keys, member).agg(F.count_distinct(F.struct(*signature)).alias("signatures")).where("signatures > 1")
    return df.join(excluded.select(*keys, member), [*keys, member], "left_anti"), excluded


def first_response(df: DataFrame, keys: list[str], content: list[str], order: list[str]) -> DataFrame:
    """Rows whose content is new within the key: the first by order of each content hash."""
    hashed = df.withColumn("response_hash", F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in content)), 256))
    rank = F.row_number().over(Window.partitionBy(*keys, "response_hash").orderBy(*order))
    return hashed.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def trajectory(df: DataFrame, keys: list[str], at: str, values: list[str]) -> DataFrame:
    """Observations, span in seconds and range of each value."""
    ranges = [(F.max(v) - F.min(v)).alias(f"{v}_range") for v in values]
    return df.groupBy(*keys).agg(F.count("*").alias("observation_count"), (F.unix_timestamp(F.max(at)) - F.unix_timestamp(F.min(at))).alias("span_seconds"), *ranges)


def series_states(df: DataFrame, keys: list[str], at: str, record: str, value: str, deviation: str, tolerance: float = 0.0025, floor: float = 0.03, count: int = 3, span: int = 1800) -> DataFrame:
    """States of each key's series: unchanged_confirmed, persistent_dissent, one_off_spike; n and span tell what they rest on."""
    w = Window.partitionBy(*keys).orderBy(at, record)
    bend = F.abs(F.col(value) - (F.lag(value).over(w) + F.lead(value).over(w)) / 2)
    seen = df.withColumn("_bend", bend)
    sums = seen.groupBy(*keys).agg(
        F.count("*").alias("n"),
        (F.unix_timestamp(F.max(at)) - F.unix_timestamp(F.min(at))).alias("span"),
        (F.max(value) - F.min(value)).alias("_range"),
        F.min(F.abs(deviation)).alias("_least"),
        F.count_if(F.col(deviation) > 0).alias("_up"),
        F.abs(F.min_by(value, F.struct(at, record)) - F.max_by(value, F.struct(at, record))).alias("_ends"),
        F.max("_bend").alias("_spike"),
    )
    enough = (F.col("n") >= count) & (F.col("span") >= span)
    states = F.array_compact(
        F.array(
            F.when(enough & (F.col("_range") <= tolerance), "unchanged_confirmed"),
            F.when(enough & (F.col("_least") >= floor) & (F.col("_up").isin(0) | (F.col("_up") == F.col("n"))), "persistent_dissent"),
            F.when(enough & (F.col("n") >= 3) & (F.col("_ends") <= tolerance) & (F.col("_spike") >= floor), "one_off_spike"),
        )
    )
    return sums.select(*keys, "n", "span", states.alias("states"))


def unanimous(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys whose rows agree on the values; nulls count as a value."""
    v = F.struct(*values)
    return df.groupBy(*keys).agg(F.count_distinct(v).alias("_n"), F.min(v).alias("_v")).where("_n = 1").select(*keys, "_v.*")


def not_superseded(df: DataFrame, record: str, supersedes: str, accepted: Column) -> DataFrame:
    """Rows that no accepted row replaces."""
    replaced = df.where(accepted & F.col(supersedes).isNotNull()).select(F.col(supersedes).alias(record)).distinct()
    return df.join(replaced, record, "left_anti")


def without(df: DataFrame, excluded: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key no exclusion names (conflicts, invalidated fixtures)."""
    return df.join(excluded.select(*keys).distinct(), keys, "left_anti")


def retry_merge(df: DataFrame, batch: str, completed: str, record: str) -> DataFrame:
    """One assessment of each batch: the latest completed, ties to the greatest id."""
    return latest(df, [batch], [completed, record])


def canonical_observation(df: DataFrame, keys: list[str], fields: list[str], order: list[str]) -> DataFrame:
    """Rows with the fields that differ from the key's best row: the one with most fields filled, then the first."""
    score = sum((F.when(F.col(f).isNotNull() & (F.trim(F.col(f).cast("string")) != ""), 1).otherwise(0) for f in fields), F.lit(0))
    w = Window.partitionBy(*keys).orderBy(F.col("_score").desc(), *order)
    best = F.first(F.struct(*fields)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    marked = df.withColumn("_score", score).withColumn("_best", best)
    differ = F.array_compact(F.array(*(F.when(F.col(f).isNotNull() & ~F.col(f).eqNullSafe(F.col(f"_best.{f}")), f) for f in fields)))
    return marked.withColumn("mismatches", differ).drop("_score", "_best")


def latest_valid(df: DataFrame, keys: list[str], required: list[str], at: str, seen: str) -> DataFrame:
    """The latest row of each key with all required fields and no decoding trouble; the first seen wins ties."""
    from veritide.functions.parse import text_quality

    texts = [f.name for f in df.schema if f.name in required and f.dataType.simpleString() == "string"]
    ok = F.size(text_quality(*texts)) == 0 if texts else F.lit(True)
    for f in required:
        ok = ok & F.col(f).isNotNull()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(at).desc(), F.col(seen).asc()))
    return df.where(ok).withColumn("_rank", rank).where("_rank = 1").drop("_rank")
