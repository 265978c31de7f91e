"""Seeded orders that any SQL engine can repeat, ranked without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BITS = 60


def seeded(seed: int | str, *parts: str | Column) -> Column:
    """A 60-bit hash of the seed and the parts: the leading 15 hex digits of an MD5. Null parts read '-'."""
    texts = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("-")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *texts)), 1, 15), 16, 10).cast("long")


def leading(h: Column, buckets: int) -> Column:
    """Bucket of a seeded hash by its leading bits, so that bucket order is hash order. buckets: a power of 2."""
    if buckets < 1 or buckets & (buckets - 1):
        raise ValueError("the number of buckets must be a power of 2")
    return F.shiftright(h, HASH_BITS - (buckets.bit_length() - 1)).cast("int")


def source_key(source: str) -> Column:
    """A key for any source that sorts by code point, null last: equal for nulls, and never null itself."""
    return F.coalesce(F.concat(F.lit("0"), F.col(source)), F.lit("1"))


def offsets(counts: DataFrame, group: str, bucket: str, n: str) -> DataFrame:
    """Adds before (sum of n over the group's earlier buckets) and total to a table of bucket counts."""
    by = Window.partitionBy(group)
    run = by.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumns({"before": F.coalesce(F.sum(n).over(run), F.lit(0)), "total": F.sum(n).over(by)})
