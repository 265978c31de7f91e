"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Targets come from water-filling: sources share the mix by weight, none above `limit` times its
size. Each source is a stream of passes over its documents, permuted by a seeded hash and cut into
blocks by its leading bits; the mix takes the stream up to the target, documents whole, the last
one if at least half of it fits. A source's quota is the number of blocks the mix enters.

The tree starts with all quotas at one node. A node splits its output shards in two, and its blocks
by a draw without replacement (the blocks with the least seeded hashes go left), so the quotas of
the left child are multivariate hypergeometric and all quotas stay exact. At the leaves each shard
has a quota of each source and draws that many blocks, disjoint and in permuted order, and its rows are
shuffled by a seeded key of each copy. The tree works on quotas only: at most `limit` * `blocks` units for a
source, whatever its rows. plan() reads the texts once and shuffles ids, sizes and hashes; mix() deals the whole rows to their
shards and sorts them there.

Defined results: a null text has no words; a null source is a source of its own, last by code
point; rows with a null or repeated id are mixed like others, as their order comes from the text too (equal rows can trade places); an empty
table, or one without words, takes nothing. `keep` names the columns to carry; others are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritide.llm.ranks import leading, offsets, seeded, source_key
from veritide.llm.shared import columns, unused

WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, share: float, limit: int, weights: tuple[int, ...]) -> DataFrame:
    """Adds target to a table (src, total): weights repeat over the sources in order of src."""
    rank = F.row_number().over(Window.orderBy("src")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    by = Window.orderBy("ratio", "src")
    return (
        sizes.withColumn("w", weight.cast("long"))
        .withColumn("cap", limit * F.col("total"))
        .withColumn("ratio", F.col("cap") / F.col("w"))
        .withColumn("capped", F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open", F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (share * F.sum("total").over(Window.partitionBy()) - F.col("capped")) / F.col("open"))
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("w") * F.max("level").over(Window.partitionBy())))
        .select("src", "target")
    )


def split_quotas(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """(shard, src, quota) for 2**levels shards from (src, quota)."""
    nodes = quotas.select(F.lit(0).alias("node"), "src", "quota")
    for level in range(levels):
        units = nodes.where("quota > 0").select("node", "src", F.explode(F.sequence(F.lit(1), F.col("quota").cast("int"))).alias("unit"))
        drawn = units.withColumn("rank", F.row_number().over(Window.partitionBy("node").orderBy(seeded(f"{seed}:{level}", "node", "src", "unit"), "src", "unit")))
        halved = drawn.withColumn("left", 2 * F.col("rank") <= F.count("*").over(Window.partitionBy("node")) + F.col("node") % 2)
        sums = halved.groupBy("node", "src").agg(F.count_if("left").alias("l"), F.count_if(~F.col("left")).alias("r"))
        nodes = sums.select("src", F.explode(F.array(F.struct((2 * F.col("node")).alias("node"), F.col("l").alias("quota")), F.struct((2 * F.col("node") + 1).alias("node"), F.col("r").alias("quota")))).alias("x")).select("x.node", "src", "x.quota")
    return nodes.where("quota > 0").select(F.col("node").alias("shard"), "src", "quota")


def _size(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _label(id_col: str, text_col: str) -> Column:
    """What the seeded orders of a row are drawn from: its id and its text, so that rows without ids of their own are spread too."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.coalesce(F.md5(F.col(text_col)), F.lit("-")))


def plan(docs: DataFrame, keep: list[str], share: float = 1.5, limit: int = 2, weights: tuple[int, ...] = (3, 1, 2), levels: int = 4, blocks: int = 256, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """keep, and size, source_size, target, taken, copies: for each copy taken its shard and its order_key there."""
    rows = docs.select(
        F.struct(*keep).alias("kept"),
        source_key(source_col).alias("src"),
        _size(text_col).alias("size"),
        _label(id_col, text_col).alias("label"),
        F.struct(F.col(id_col).alias("id"), F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("crc")).alias("tie"),
    ).withColumn("h", seeded(seed, "label")).withColumn("block", leading(F.col("h"), blocks))

    sums = offsets(rows.groupBy("src", "block").agg(F.sum("size").alias("words")), "src", "block", "words")
    sums = sums.withColumn("at", F.row_number().over(Window.partitionBy("src").orderBy("block")) - 1)
    sizes = sums.groupBy("src").agg(F.max("total").alias("total"), F.count("*").alias("n"))
    wanted = targets(sizes, share, limit, weights)
    stream = sums.join(wanted, "src")
    entered = [F.count_if(p * F.col("total") + F.col("before") < F.col("target")) for p in range(limit)]
    shards = split_quotas(stream.groupBy("src").agg(reduce(Column.__add__, entered).alias("quota")), levels, seed)
    ends = F.sum("quota").over(Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))
    ranges = shards.withColumn("end", ends).withColumn("start", F.col("end") - F.col("quota"))
    drawn = ranges.select("src", "shard", F.explode(F.expr("sequence(start, end - 1)")).alias("unit"))
    placed = drawn.join(sizes.select("src", "n"), "src").groupBy("src", (F.col("unit") % F.col("n")).alias("at")).agg(
        *(F.max(F.when(F.expr("unit div n") == p, F.col("shard"))).alias(f"shard{p}") for p in range(limit))
    )
    table = stream.join(placed, ["src", "at"], "left").select("src", "block", "before", "total", "target", *(f"shard{p}" for p in range(limit)))

    run = Window.partitionBy("src", "block").orderBy("h", "tie").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("within", F.sum("size").over(run) - F.col("size")).join(table, ["src", "block"])
    start = [p * F.col("total") + F.col("before") + F.col("within") for p in range(limit)]
    takes = [(s < F.col("target")) & (2 * s + F.col("size") <= 2 * F.col("target")) for s in start]
    key = lambda p: seeded(f"{seed}:copy{p}", "label")
    copies = F.array_compact(F.array(*(F.when(t, F.struct(F.col(f"shard{p}").alias("shard"), key(p).alias("order_key"))) for p, t in enumerate(takes))))
    return found.withColumn("copies", copies).select(
        "kept.*",
        "size",
        F.col("total").alias("source_size"),
        "target",
        (F.col("size") * F.size("copies")).alias("taken"),
        "copies",
    )


def mix(docs: DataFrame, shards: bool = False, levels: int = 4, **options) -> DataFrame:
    """docs as the mix takes them: a row for each copy, dealt to the output shards and shuffled there; with `shards` also columns mix_shard and mix_key (after underscores where docs has such a column).

    Partitions hold the shards one after the other, each in the order of its keys: written as it is, the table is in the order of the mix.
    """
    keyed = docs.select(F.struct(*columns(docs)).alias("row_in"), *(F.col(c).alias(f"mix_{c}") for c in ("doc_id", "text", "source")))
    found = plan(keyed, ["row_in"], levels=levels, id_col="mix_doc_id", text_col="mix_text", source_col="mix_source", **options)
    dealt = found.select("row_in", F.explode("copies").alias("c")).select("row_in", F.col("c.shard").alias("mix_shard"), F.col("c.order_key").alias("mix_key"))
    # a shard is spread over several partitions by the leading bits of its keys: no task holds a whole one
    each = 1 << (int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) >> levels).bit_length()
    part = F.col("mix_shard") * each + leading(F.col("mix_key"), each)
    shuffled = dealt.repartitionById(each << levels, part.cast("int")).sortWithinPartitions("mix_key")
    own = [F.col(c).alias(unused(docs, c)) for c in ("mix_shard", "mix_key")] if shards else []
    return shuffled.select("row_in.*", *own)


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    found = plan(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
    copy = lambda k, field: F.get("copies", F.lit(k))[field]
    return found.select("doc_id", "size", "source_size", "target", "taken", copy(0, "shard").alias("shard"), copy(0, "order_key").alias("order_key"), copy(1, "shard").alias("shard_again"), copy(1, "order_key").alias("order_key_again"))


def _tree_sql(levels: int, seed: int) -> str:
    text = "node0 AS (SELECT 0 AS node, src, quota FROM quotas)"
    for k in range(levels):
        text += f""", unit{k} AS (
  SELECT node, src, unit, ('0x' || substr(md5('{seed}:{k}:' || node || ':' || src || ':' || unit), 1, 15))::BIGINT AS h
  FROM (SELECT node, src, unnest(range(1, quota + 1)) AS unit FROM node{k} WHERE quota > 0)
), left{k} AS (
  SELECT *, 2 * row_number() OVER (PARTITION BY node ORDER BY h, src, unit) <= count(*) OVER (PARTITION BY node) + node % 2 AS l FROM unit{k}
), node{k + 1} AS (
  SELECT 2 * node AS node, src, count(*) FILTER (WHERE l) AS quota FROM left{k} GROUP BY node, src
  UNION ALL SELECT 2 * node + 1, src, count(*) FILTER (WHERE NOT l) FROM left{k} GROUP BY node, src
)"""
    return text


OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce('0' || source, '1') AS src,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(md5(text), '-') AS label, ('0x' || substr(md5('1:' || label), 1, 15))::BIGINT AS h
  FROM documents
), e AS (SELECT *, h >> 52 AS block FROM d
), sums AS (
  SELECT src, block, sum(size)::BIGINT AS words, (sum(sum(size)) OVER (PARTITION BY src ORDER BY block) - sum(size))::BIGINT AS before,
    (sum(sum(size)) OVER (PARTITION BY src))::BIGINT AS total, row_number() OVER (PARTITION BY src ORDER BY block) - 1 AS place, count(*) OVER (PARTITION BY src) AS n
  FROM e GROUP BY src, block
), w AS (
  SELECT src, total, [3, 1, 2][(row_number() OVER (ORDER BY src) - 1) % 3 + 1] AS w FROM (SELECT DISTINCT src, total FROM sums)
), l AS (
  SELECT *, (1.5::DOUBLE * (sum(total) OVER ())::BIGINT - (coalesce(sum(2 * total) OVER (ORDER BY (2 * total)::DOUBLE / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT)
    / (sum(w) OVER (ORDER BY (2 * total)::DOUBLE / w, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
  FROM w
), t AS (SELECT src, least((2 * total)::DOUBLE, w * max(level) OVER ()) AS target FROM l
), stream AS (SELECT sums.*, target FROM sums JOIN t USING (src)
), quotas AS (SELECT src, count(*) FILTER (WHERE before < target) + count(*) FILTER (WHERE total + before < target) AS quota FROM stream GROUP BY src
), {_tree_sql(4, 1)}, ranges AS (
  SELECT node AS shard, src, quota, (sum(quota) OVER (PARTITION BY src ORDER BY node))::BIGINT AS stop FROM node4 WHERE quota > 0
), drawn AS (SELECT src, shard, unnest(range(stop - quota, stop)) AS unit FROM ranges
), f AS (
  SELECT e.*, before, total, target, place, n, (sum(size) OVER (PARTITION BY src, block ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING))::BIGINT - size + before AS start
  FROM e JOIN stream USING (src, block)
), g AS (
  SELECT *, start < target AND 2 * start + size <= 2 * target AS one, total + start < target AND 2 * (total + start) + size <= 2 * target AS two FROM f
)
SELECT doc_id, size, total AS source_size, target, size * (one::INT + two::INT)::BIGINT AS taken,
  CAST(CASE WHEN one THEN a.shard END AS INTEGER) AS shard, CASE WHEN one THEN ('0x' || substr(md5('1:copy0:' || label), 1, 15))::BIGINT END AS order_key,
  CAST(CASE WHEN two THEN b.shard END AS INTEGER) AS shard_again, CASE WHEN two THEN ('0x' || substr(md5('1:copy1:' || label), 1, 15))::BIGINT END AS order_key_again
FROM g LEFT JOIN drawn a ON a.src = g.src AND a.unit = g.place LEFT JOIN drawn b ON b.src = g.src AND b.unit = g.n + g.place
"""
