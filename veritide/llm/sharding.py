"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source; the fractional rank
(2 * rank - 1) / (2 * rows of the source) spreads every source evenly over (0, 1). Sorted by it and
cut into equal pieces, every shard holds each source in the proportion of the whole, and row counts
of shards differ by one at most (law `rows`).

No rank needs a single task: a source is ranked in hash buckets whose offsets are sums of a small
table of bucket counts, so one source with a third of all rows is spread like any other. Buckets
of the final order are ranges of the fractional rank; the rows before a range follow from the rows
of each source alone.

Defined results: a null text has 8 bytes and CRC 0; a null source is a source of its own; rows
with null or repeated ids are ranked like others, in an order that their texts give too (equal rows can trade places, with equal results);
an empty table gives an empty result. Columns beyond id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritide.llm.ranks import leading, offsets, seeded, source_key


def interleave(docs: DataFrame, shards: int = 24, seed: int = 1, buckets: int = 1024, pieces: int = 4096, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of docs."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        source_key(source_col).alias("src"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        seeded(seed, id_col, F.md5(text)).alias("h"),
    ).withColumn("bucket", leading(F.col("h"), buckets))
    counts = offsets(rows.groupBy("src", "bucket").agg(F.count("*").alias("n")), "src", "bucket", "n")
    sources = counts.groupBy("src").agg(F.max("total").alias("n"))

    tie = ("doc_id", "text_crc32", "size")
    in_bucket = F.row_number().over(Window.partitionBy("src", "bucket").orderBy("h", *tie))
    ranked = (
        rows.withColumn("rank", in_bucket.cast("long"))
        .join(counts.select("src", "bucket", "before", "total"), ["src", "bucket"])
        .withColumn("odd", 2 * (F.col("rank") + F.col("before")) - 1)
        .withColumn("frac", F.col("odd") / (2 * F.col("total")))
        .withColumn("piece", F.expr(f"(odd * {pieces}L) div (2 * total)"))
    )
    # the rows of a source with (2r - 1) / (2n) < piece / pieces; at most `pieces` rows, so small enough to broadcast
    before = F.expr(f"(2 * n * piece + {pieces}L - 1) div (2 * {pieces}L)")
    starts = (
        sources.select("n", F.explode(F.expr(f"sequence(0L, {pieces}L - 1)")).alias("piece"))
        .groupBy("piece")
        .agg(F.sum(before).alias("start"), F.sum("n").alias("all_rows"))
    )
    within = F.row_number().over(Window.partitionBy("piece").orderBy("frac", "src", "h", *tie))
    placed = ranked.withColumn("within", within).join(F.broadcast(starts), "piece").withColumn("pos", F.col("start") + F.col("within") - 1)
    cut = placed.withColumn("shard", F.expr(f"(pos * {shards}L) div all_rows"))
    return cut.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.expr(f"pos - (shard * all_rows + {shards}L - 1) div {shards}L").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    return interleave(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: CRC-32 in SQL: its table of 256 steps from the polynomial, then one step for each byte.
OP1_SQL = """
WITH RECURSIVE t(i, c, k) AS (
  SELECT range AS i, range AS c, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM t WHERE k < 8
), tab AS (SELECT list(c ORDER BY i) AS s FROM t WHERE k = 8
), d AS (
  SELECT doc_id, coalesce('0' || source, '1') AS src, coalesce(text, '') AS txt,
    ('0x' || substr(md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(txt)), 1, 15))::BIGINT AS h
  FROM documents
), b AS (
  SELECT d.*, CAST(octet_length(encode(txt)) + 8 AS BIGINT) AS size,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(txt)), '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda c, y: xor(c >> 8, tab.s[(xor(c, y) & 255) + 1]))) AS text_crc32
  FROM d, tab
), r AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY src ORDER BY h, doc_id, text_crc32, size) - 1) / (2 * count(*) OVER (PARTITION BY src))::DOUBLE AS frac,
    count(*) OVER () AS n
  FROM b
), p AS (SELECT *, row_number() OVER (ORDER BY frac, src, h, doc_id, text_crc32, size) - 1 AS pos FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(pos * 24 // n AS INTEGER) AS shard,
  CAST(pos - ((pos * 24 // n) * n + 23) // 24 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM p
"""
