"""Exact top-k search by inner product over norm buckets.

Vectors are ordered by length with a range partitioning and packed into buckets of at most BUCKET
neighbours; a range also orders by row, so one length that a third of all rows has makes many buckets.
Queries are packed into blocks of about QUERIES rows. The longest bucket gives each query a first
bound, the score of its k-th best there. A bucket then meets a block of queries only if its greatest length
times a query's length reaches that query's bound; buckets that fall short are not shuffled for the block at all.

Blocks and the buckets left are dealt to tasks, which go through theirs from the longest on while
the bounds rise. For each query and bucket the local cosine threshold, bound / (query's length x
bucket's greatest length), decides how candidates are pruned:
* above 1 the bucket is passed over;
* up to STEEP only lengths prune: the first rows of the bucket, as long as length x length reaches the bound, are multiplied with all such queries at once;
* above STEEP coordinates prune: each of the query's FOCUS largest coordinates allows a candidate's an interval only, and candidates in all intervals are multiplied.
Products are exact: in doubles where lengths show that no sum can reach 2 ** 53, else in whole numbers.
A score beyond a long is an error. Each task keeps the k best of a query, and a last ranking picks from those.

Defined results: components become floor(scale * x). Vectors that are null, or hold a component that is null or not
finite (also once scaled), take no part. Vectors meet those of their own number of components only; empty ones score 0
with each other. Ties go to the smaller vec_id, nulls last. A row never meets itself, but rows that repeat its
vec_id or its vector do count. A null vec_id makes a candidate and no query. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritide.llm.shared import cut

BUCKET, QUERIES, CHUNK = 2048, 4096, 512
#: Buckets that a task goes through for a block of queries, about: what it gets at once stays below BUCKET * SERIES vectors.
SERIES = 64
STEEP, FOCUS = 0.8, 4
#: Bounds from lengths are in doubles; so much they are widened.
SLACK = 1e-9
NONE = np.iinfo(np.int64).min


def finite(vector: Column, scale: float) -> Column:
    """Whether a vector takes part: it is there, and so are its components, and they are finite, also once scaled."""
    ok = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < float("inf")))
    return F.coalesce(ok, F.lit(False))


def vectors(rows: DataFrame, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """(row, vec_id, dim, norm, x): scaled vectors as bytes of doubles, with a number for each row. Written once, so row numbers stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [np.floor(scale * np.asarray(v, np.float64)) for v in batch.column(1).to_pylist()]
            cols = [pa.array([len(v) for v in x], pa.int32()), pa.array([float(np.linalg.norm(v)) for v in x], pa.float64()), pa.array([v.tobytes() for v in x], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["vec_id", "dim", "norm", "x"])

    good = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")).where(finite(F.col("v"), scale))
    made = good.mapInArrow(run, "vec_id long, dim int, norm double, x binary")
    return cut(made.withColumn("row", F.monotonically_increasing_id()), "vectors")


def narrow(x: np.ndarray) -> bytes:
    """Whole numbers in 2 or 4 bytes each where they fit, else as doubles."""
    most = np.abs(x).max(initial=0)
    return x.astype("<i2" if most < 2**15 else "<i4" if most < 2**31 else "<f8").tobytes()


def wide(data: bytes, n: int, dim: int) -> np.ndarray:
    width = len(data) // (n * dim) if dim else 8
    return np.frombuffer(data, {2: "<i2", 4: "<i4", 8: "<f8"}[width]).reshape(n, dim).astype(np.float64)


BUCKETS = "dim int, hi double, ids array<long>, rows array<long>, norms array<double>, data binary"


def buckets(found: DataFrame, n: int) -> DataFrame:
    """Vectors from the longest on, BUCKET in a row at most, which all have one number of components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim, held = None, []

        def packed() -> pa.RecordBatch:
            ids, rows, norms, xs = zip(*held, strict=True)
            data = narrow(np.frombuffer(b"".join(xs), np.float64))
            cols = [[dim], [norms[0]], [ids], [rows], [norms], [data]]
            kinds = [pa.int32(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["dim", "hi", "ids", "rows", "norms", "data"])

        for batch in batches:
            for d, *vector in zip(*(batch.column(c).to_pylist() for c in ("dim", "vec_id", "row", "norm", "x")), strict=True):
                if held and (d != dim or len(held) == BUCKET):
                    yield packed()
                    held = []
                dim = d
                held.append(vector)
        if held:
            yield packed()

    order = ["dim", F.desc("norm"), "row"]
    parts = max(1, -(-n // (8 * BUCKET)))
    packed = found.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, BUCKETS)
    return cut(packed.withColumn("bucket", F.monotonically_increasing_id()), "buckets")


class Search:
    """The k best candidates of a block of queries, among the buckets offered."""

    def __init__(self, k: int, rows: list, ids: list, norms: list, x: np.ndarray, bounds: list | None):
        self.k, self.ids, self.x = k, ids, x
        self.rows, self.norms = np.array(rows, np.int64), np.array(norms, np.float64)
        self.bound = np.full(len(rows), NONE) if bounds is None else np.array([NONE if b is None else b for b in bounds], np.int64)
        self.best = [np.zeros(0, np.int64) for _ in range(4)]  # query, score, whether the id is null, id

    def offer(self, hi: float, ids: np.ndarray, null: np.ndarray, rows: np.ndarray, norms: np.ndarray, x: np.ndarray) -> None:
        bound, most = self.bound.astype(np.float64), self.norms * hi
        positive = (self.bound > 0) & (most > 0)
        cosine = np.where(positive, bound / np.where(most > 0, most, 1), -1.0) * (1 - SLACK)
        live = (self.bound <= 0) | (most * (1 + SLACK) >= bound)
        # from which length on a candidate can reach the bound
        least = np.where(positive, bound / np.where(self.norms > 0, self.norms, 1), 0.0) * (1 - SLACK)
        first = np.searchsorted(-norms, -least, side="right")
        place = np.argsort(rows)
        at = np.minimum(np.searchsorted(rows[place], self.rows), len(rows) - 1)
        own = np.where(rows[place[at]] == self.rows, place[at], -1)
        exact = self.norms.max(initial=0) * hi < 2**53
        found = []
        flat = np.flatnonzero(live & (cosine <= STEEP))
        for i in range(0, len(flat), CHUNK):
            chunk = flat[i : i + CHUNK]
            m = int(first[chunk].max(initial=0))
            scores = products(self.x[chunk], x[:m], exact)
            among = np.flatnonzero((own[chunk] >= 0) & (own[chunk] < m))
            scores[among, own[chunk][among]] = NONE
            limit = np.maximum(self.bound[chunk], NONE + 1)
            full = np.flatnonzero((scores >= limit[:, None]).sum(axis=1) > 4 * self.k)
            if len(full):
                limit[full] = np.maximum(limit[full], np.partition(scores[full], m - self.k, axis=1)[:, m - self.k])
            q, c = np.nonzero(scores >= limit[:, None])
            found.append((chunk[q], scores[q, c], c))
        steep = np.flatnonzero(live & (cosine > STEEP))
        unit = x / np.where(norms > 0, norms, 1)[:, None] if len(steep) else x
        for q in steep:
            c = self.focused(q, unit[: first[q]], min(cosine[q], 1.0))
            c = c[c != own[q]]
            scores = products(self.x[q : q + 1], x[c], exact)[0]
            keep = scores >= self.bound[q]
            found.append((np.full(keep.sum(), q), scores[keep], c[keep]))
        if found:
            q, s, c = (np.concatenate(part) for part in zip(*found, strict=True))
            self.merge(q, s, null[c], ids[c])

    def focused(self, q: int, unit: np.ndarray, cosine: float) -> np.ndarray:
        """Candidates whose coordinates leave a cosine of so much possible."""
        mine = self.x[q] / self.norms[q]
        keep = np.ones(len(unit), bool)
        for f in np.argsort(-np.abs(mine))[:FOCUS]:
            y = min(1.0, max(-1.0, mine[f]))
            spread = np.sqrt((1 - cosine * cosine) * (1 - y * y)) + SLACK
            low, high = -1.0 if -y >= cosine else y * cosine - spread, 1.0 if y >= cosine else y * cosine + spread
            keep &= (unit[:, f] >= low - SLACK) & (unit[:, f] <= high + SLACK)
        return np.flatnonzero(keep)

    def merge(self, q: np.ndarray, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        q, score, null, ids = (np.concatenate(both) for both in zip(self.best, (q, score, null, ids), strict=True))
        order = np.lexsort((ids, null, -score, q))
        q = q[order]
        starts = np.searchsorted(q, q)
        keep = np.arange(len(q)) - starts < self.k
        order, q = order[keep], q[keep]
        self.best = [q, score[order], null[order], ids[order]]
        last = np.flatnonzero(np.arange(len(q)) - np.searchsorted(q, q) == self.k - 1)
        self.bound[q[last]] = np.maximum(self.bound[q[last]], self.best[1][last])


def products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of rows that hold whole numbers, as longs."""
    if exact:
        return (a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    found = whole(a).astype(object).dot(whole(b).astype(object).T)
    if any(not -(2**63) < v < 2**63 for v in np.ravel(found)):
        raise OverflowError("an inner product is beyond a long")
    return found.astype(np.int64)


TASK = "block long, stripe int, kind int, far double, dim int, q_rows array<long>, q_ids array<long>, q_norms array<double>, q_x array<binary>, bounds array<long>, ids array<long>, rows array<long>, norms array<double>, data binary"


def searched(tasks: DataFrame, k: int) -> DataFrame:
    """(row, query_id, vec_id, score): the k best of each block and stripe. Rows of one come together, the block first and then buckets from the longest on."""

    def results(s: Search | None) -> Iterator[pa.RecordBatch]:
        if s is not None and len(s.best[0]):
            q, score, null, ids = s.best
            cols = [pa.array(s.rows[q]), pa.array([s.ids[i] for i in q], pa.int64()), pa.array(ids, mask=null.astype(bool)), pa.array(score)]
            yield pa.RecordBatch.from_arrays(cols, ["row", "query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = None
        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: batch.column(name)[i] for name in batch.schema.names}
                py, dim = (lambda name, r=r: r[name].as_py()), r["dim"].as_py()
                if py("kind") == 0:
                    yield from results(search)
                    x = np.frombuffer(b"".join(py("q_x")), np.float64).reshape(len(r["q_rows"]), dim)
                    search = Search(k, py("q_rows"), py("q_ids"), py("q_norms"), x, py("bounds"))
                else:
                    ids, n = r["ids"].values, len(r["ids"])
                    null = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                    search.offer(-py("far"), ids.fill_null(0).to_numpy(), null, r["rows"].values.to_numpy(), r["norms"].values.to_numpy(), wide(py("data"), n, dim))
        yield from results(search)

    return tasks.mapInArrow(run, "row long, query_id long, vec_id long, score long")


def _dealt(blocks: DataFrame, found: DataFrame, parts: int, k: int) -> DataFrame:
    """blocks: with stripe and bounds; found: buckets with the block and stripe that they go to."""
    empty = lambda kind: F.lit(None).cast(kind)
    q = blocks.select("block", "stripe", F.lit(0).alias("kind"), F.lit(0.0).alias("far"), "dim", "q_rows", "q_ids", "q_norms", "q_x", "bounds", *(empty(t).alias(c) for c, t in (("ids", "array<long>"), ("rows", "array<long>"), ("norms", "array<double>"), ("data", "binary"))))
    c = found.select("block", "stripe", F.lit(1).alias("kind"), (-F.col("hi")).alias("far"), "dim", *(empty(t).alias(c) for c, t in (("q_rows", "array<long>"), ("q_ids", "array<long>"), ("q_norms", "array<double>"), ("q_x", "array<binary>"), ("bounds", "array<long>"))), "ids", "rows", "norms", "data")
    key = ["block", "stripe"]
    return searched(q.union(c).repartition(parts, *key).sortWithinPartitions(*key, "kind", "far"), k)


def top_k(rows: DataFrame, is_query: Column, k: int = 10, scale: float = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the greatest inner products for each query row. is_query: a condition on vec_id."""
    if k < 1:
        raise ValueError("k must be 1 or more")
    found = vectors(rows, scale, id_col, vector_col)
    asked = found.where(F.coalesce(is_query, F.lit(False)))
    n, n_asked = found.count(), asked.count()
    packed = buckets(found, n)
    groups = max(1, -(-n_asked // QUERIES))
    member = F.struct("row", "vec_id", "norm", "x")
    # a group has QUERIES rows on average, as rows are dealt by a hash of their own number
    blocks = asked.groupBy("dim", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("part")).agg(F.collect_list(member).alias("m"))
    blocks = blocks.select(F.xxhash64("dim", "part").alias("block"), "dim", F.col("m.row").alias("q_rows"), F.col("m.vec_id").alias("q_ids"), F.col("m.norm").alias("q_norms"), F.col("m.x").alias("q_x"))
    blocks = cut(blocks, "blocks")

    none = F.lit(None).cast("array<long>")
    longest = packed.groupBy("dim").agg(F.max_by("bucket", F.struct("hi", "bucket")).alias("bucket"))
    seeds = packed.join(longest.select("bucket"), "bucket", "left_semi")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = _dealt(blocks.select("*", F.lit(0).alias("stripe"), none.alias("bounds")), blocks.select("block", "dim").join(seeds, "dim").withColumn("stripe", F.lit(0)), max(1, min(parts, groups)), k)
    kth = first.groupBy("row").agg(F.sort_array(F.collect_list("score")).alias("s")).where(F.size("s") == k).select("row", F.col("s")[0].alias("bound"))
    each = blocks.select("block", F.explode(F.arrays_zip("q_rows", "q_norms")).alias("q")).select("block", F.col("q.q_rows").alias("row"), F.col("q.q_norms").alias("norm"))
    reach = F.when((F.col("bound") > 0) & (F.col("norm") > 0), F.col("bound") / F.col("norm") * (1 - SLACK)).otherwise(0.0)
    bounds = each.join(kth, "row", "left").groupBy("block").agg(F.min(reach).alias("need"), F.map_from_entries(F.collect_list(F.struct("row", "bound"))).alias("of"))
    known = cut(blocks.join(bounds, "block").select("*", F.transform("q_rows", lambda r: F.col("of")[r]).alias("bounds")).drop("of"), "bounded")

    stripes = max(1, -(-n // (BUCKET * SERIES)), -(-2 * parts // groups) if n > BUCKET else 1)
    striped = known.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    placed = packed.withColumn("stripe", F.pmod(F.xxhash64("bucket"), F.lit(stripes)).cast("int"))
    met = placed.join(striped.select("block", "stripe", "dim", "need"), ["dim", "stripe"]).where(F.col("hi") >= F.col("need"))
    best = _dealt(striped, met, max(parts, min(groups * stripes, 1 << 16)), k)
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op12_exact_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, p.vec_id AS vec_id, CAST(list_inner_product(q.x, p.x) AS BIGINT) AS score
  FROM v q JOIN v p ON q.vec_id % 100 = 0 AND q.vec_id <> p.vec_id AND len(q.x) = len(p.x)
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
