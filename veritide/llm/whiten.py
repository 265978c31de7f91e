"""Whitening of embeddings over distinct vectors that are weighted by how often they occur.

Entries become whole numbers x = floor(scale * c) + base. Identical x vectors are one row with a
weight, their count or one. All fitting is over these rows:
1. Sums: S of each dimension, and n, the sum of the weights.
2. Weighted centred GEMM: z = x - round(S / n), and for each batch of rows (w * z)' z. Batches multiply in doubles where no
   sum can reach 2 ** 53, else in whole numbers, and their totals add up as decimals, so n * n * V = n * sum(w z z') - r r', with
   r = S - n * round(S / n), is exact and V is rounded once: it depends neither on order nor on partitions.
3. Eigenvectors of V on the driver, where a matrix of dimension x dimension is all there is.
4. Each distinct vector is whitened once and joined back to the rows that have it; a vector that a third of all
   rows has is one row on its side of that join, and adaptive execution splits the other side.
5. The covariance of what was whitened, as a check.

Defined results: vectors that are null, or hold an entry that is null or not finite, are left out, as are empty ones. Vectors of
different numbers of entries are fitted apart. Components without variance (an eigenvalue below what rounding leaves of zero) have
a null whitened value; identity_error is over the others, null if there are none. Where all vectors are equal explained is null. deviation is null where it is beyond a long, deviation_exact
always has it. Repeated rows and null ids stay. An entry with |scale * c| of 2 ** 62 or more is an error. An empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritide.llm.shared import cut

TOTAL = "dim int, i int, j int, total decimal(38,0)"


def whole(vector: Column, scale: float, base: int) -> Column:
    def entry(c: Column) -> Column:
        v = F.lit(float(scale)) * c.cast("double")
        return F.when(F.abs(v) < 2.0**62, F.floor(v) + F.lit(base).cast("long")).when(F.abs(v) < float("inf"), F.raise_error(F.lit("an entry is beyond a long")).cast("long"))

    return F.transform(vector, entry)


def finite(vector: Column) -> Column:
    ok = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(ok & (F.size(vector) > 0), F.lit(False))


def by_dim(batch: pa.RecordBatch, column: str = "x") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, places, matrix) for the rows of each number of entries."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield int(dim), at, flat[np.repeat(sizes == dim, sizes)].reshape(len(at), dim)


def gram(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    """(w * z)' z in exact whole numbers, as Python's."""
    most = int(np.abs(z).max(initial=0)) ** 2 * int(w.sum())
    if most < 2**53:
        return ((z.T * w).astype(np.float64) @ z.astype(np.float64)).astype(np.int64).astype(object)
    z = z.astype(object)
    return (z.T * w.astype(object)).dot(z)


def _totals(distinct: DataFrame, of: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> list:
    """Exact sums over all rows of a matrix that `of` makes of the vectors of a batch: (dim, i, j, total), as many as a matrix has entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            w = batch.column("w").to_numpy()
            for dim, at, x in by_dim(batch):
                sums[dim] = sums.get(dim, 0) + of(dim, x, w[at])
        for dim, m in sums.items():
            i, j = (a.ravel().astype(np.int32) for a in np.indices(m.shape))
            keep = i <= j if m.shape[0] > 1 else j >= 0
            totals = pa.array([Decimal(int(v)) for v in m.ravel()[keep]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(totals), dim, np.int32)), pa.array(i[keep]), pa.array(j[keep]), totals], ["dim", "i", "j", "total"])

    return distinct.mapInArrow(run, TOTAL).groupBy("dim", "i", "j").agg(F.sum("total").cast("decimal(38,0)").alias("total")).collect()


def fit(distinct: DataFrame, components: int) -> dict[int, dict]:
    """For each number of entries: n, centre (whole), rest (S - n * centre), values and vectors of the components, trace.

    Over rows (x, w). What reaches the driver has dimension x (dimension + 1) / 2 numbers.
    """
    first: dict[int, dict[int, int]] = {}

    def weighed(dim: int, x: np.ndarray, w: np.ndarray) -> np.ndarray:
        safe = int(np.abs(x).max()) * int(w.sum()) < 2**63
        return np.array([[int(w.sum()), *(x.T @ w if safe else x.astype(object).T.dot(w.astype(object)))]], object)

    for r in _totals(distinct, weighed):
        first.setdefault(r.dim, {})[r.j] = int(r.total)
    model = {}
    for dim, sums in first.items():
        n = sums[0]
        centre = [(2 * sums[j + 1] + n) // (2 * n) for j in range(dim)]
        model[dim] = {"n": n, "centre": np.array(centre, np.int64), "rest": [sums[j + 1] - n * centre[j] for j in range(dim)]}
    centres = {dim: m["centre"] for dim, m in model.items()}
    grams = {dim: np.zeros((dim, dim), object) for dim in model}
    for r in _totals(distinct, lambda dim, x, w: gram(x - centres[dim], w)):
        grams[r.dim][r.i, r.j] = grams[r.dim][r.j, r.i] = int(r.total)
    for dim, m in model.items():
        n, rest = m["n"], m["rest"]
        v = np.array([[(n * grams[dim][i, j] - rest[i] * rest[j]) / (n * n) for j in range(dim)] for i in range(dim)])
        values, vectors = np.linalg.eigh(v)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
        trace = sum(n * grams[dim][i, i] - rest[i] ** 2 for i in range(dim)) / (n * n)
        held = values > 16 * dim * np.finfo(float).eps * max(values[0], 0)
        m |= {"values": values, "vectors": vectors * signs, "trace": trace, "held": held, "mean": np.array([r / n for r in rest])}
    return model


def _whitened(distinct: DataFrame, model: dict[int, dict]) -> DataFrame:
    """(x, w, deviation, y) for each distinct vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deviation, y = [None] * batch.num_rows, [None] * batch.num_rows
            for dim, at, x in by_dim(batch):
                m = model[dim]
                z = x - m["centre"]
                safe = (int(np.abs(z).max()) * m["n"] + max(map(abs, m["rest"]))) ** 2 * dim < 2**63
                away = z * m["n"] - np.array(m["rest"], np.int64) if safe else z.astype(object) * m["n"] - np.array(m["rest"], object)
                keep = m["held"]
                found = (z - m["mean"]) @ (m["vectors"][:, keep] / np.sqrt(m["values"][keep]))
                full = np.full((len(at), len(keep)), None, object)
                full[:, keep] = found
                for place, d, row in zip(at, (away * away).sum(axis=1), full.tolist(), strict=True):
                    deviation[place], y[place] = Decimal(int(d)), row
            cols = [batch.column("x"), batch.column("w"), pa.array(deviation, pa.decimal128(38, 0)), pa.array(y, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(cols, ["x", "w", "deviation", "y"])

    return cut(distinct.mapInArrow(run, "x array<long>, w long, deviation decimal(38,0), y array<double>"), "whitened")


def identity_error(found: DataFrame, model: dict[int, dict]) -> float | None:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    held = {dim: np.flatnonzero(m["held"]) for dim, m in model.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            w, sizes = batch.column("w").to_numpy(), np.diff(batch.column("x").offsets.to_numpy())
            for dim in np.unique(sizes):
                at = sizes == dim
                y = np.array(batch.column("y").filter(pa.array(at)).to_pylist(), np.float64)[:, held[int(dim)]]
                y = np.hstack([np.ones((len(y), 1)), y])
                sums[int(dim)] = sums.get(int(dim), 0) + (y.T * w[at]) @ y
        for dim, m in sums.items():
            i, j = (a.ravel().astype(np.int32) for a in np.indices(m.shape))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, dim, np.int32)), pa.array(i), pa.array(j), pa.array(m.ravel())], ["dim", "i", "j", "total"])

    sums = {dim: np.zeros((1 + len(h), 1 + len(h))) for dim, h in held.items()}
    for r in found.mapInArrow(run, "dim int, i int, j int, total double").groupBy("dim", "i", "j").agg(F.sum("total").alias("total")).collect():
        sums[r.dim][r.i, r.j] = r.total
    worst = []
    for dim, s in sums.items():
        if len(held[dim]):
            mean = s[0, 1:] / s[0, 0]
            worst.append(np.abs(s[1:, 1:] / s[0, 0] - np.outer(mean, mean) - np.eye(len(held[dim]))).max())
    return float(max(worst)) if worst else None


def whiten(rows: DataFrame, components: int = 32, scale: float = 64, base: int = 1_000_000, weights: str = "counts", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, deviation_exact, whitened, explained, identity_error): a row for each component of each row that takes part.

    weights: "counts" fits all rows, "one" each distinct vector once.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights must be 'counts' or 'one'")
    vector = F.col(f"`{vector_col}`")
    # named apart first, so that no column of the table can clash
    kept = rows.where(finite(vector)).select(F.col(f"`{id_col}`").alias("vec_id"), whole(vector, scale, base).alias("x"))
    weight = F.count("*") if weights == "counts" else F.lit(1).cast("long")
    distinct = cut(kept.groupBy("x").agg(weight.alias("w")), "distinct")
    model = fit(distinct, components)
    found = _whitened(distinct, model)
    error = identity_error(found, model)
    schema = "dim int, component int, n long, explained double"
    parts = [(dim, c + 1, m["n"], float(e / m["trace"]) if m["trace"] > 0 else None) for dim, m in model.items() for c, e in enumerate(m["values"])]
    spark = rows.sparkSession
    named = spark.createDataFrame(parts, schema) if parts else spark.createDataFrame([], schema)
    each = kept.join(found.drop("w"), "x").select("vec_id", F.size("x").alias("dim"), F.col("deviation").alias("deviation_exact"), F.posexplode("y").alias("pos", "whitened"))
    at = each.withColumn("component", F.col("pos") + 1).join(F.broadcast(named), ["dim", "component"])  # 32 rows for each number of entries
    fits = F.col("deviation_exact").try_cast("long")
    return at.select("vec_id", "component", "n", fits.alias("deviation"), "whitened", "explained", F.lit(error).cast("double").alias("identity_error"), "deviation_exact")


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
