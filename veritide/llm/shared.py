"""Storage shared by driver and executors, and connected components of an edge table."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a sieve, 2 MB of them in at most 262,144 rows: the bound of what is broadcast.
SIEVE_BITS = 24


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where it is unset a temporary one serves on a local master; a cluster's hosts don't share such a folder, so that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="veritide-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def shared_path(spark: SparkSession) -> str:
    """The shared folder as a path that Python can open: it must be a mount that all hosts have."""
    url = urlparse(shared_dir(spark))
    if url.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped models need a mounted spark.checkpoint.dir, not {url.scheme}://")
    return url.path


def cut(df: DataFrame, name: str = "part") -> DataFrame:
    """Write df to the shared folder and read it back: short lineage, and nothing is computed twice.

    Plain Parquet instead of checkpoint(), which runs the last stage twice.
    """
    path = f"{shared_dir(df.sparkSession)}/veritide/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.cut_path = path
    return found


def trimmed(run: Callable) -> Callable:
    """A function for mapInArrow that gives back to the system what it has freed when it ends: its worker stays, for other tasks."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return task


def forget(df: DataFrame) -> None:
    """Delete what cut() wrote, when nothing will read it again."""
    jvm, path = df.sparkSession._jvm, df.cut_path
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def columns(df: DataFrame) -> list[Column]:
    """All columns, whatever their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def unused(df: DataFrame, name: str) -> str:
    """name, or that with underscores before it, so that df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def sieve(ids: DataFrame, col: str) -> DataFrame:
    """Bits of hashed ids as rows (_sieve_slot, _sieve_bits): at most 2 ** (SIEVE_BITS - 6) rows, however many ids there are."""
    placed = ids.select(F.pmod(F.xxhash64(F.col(col).cast("long")), F.lit(1 << SIEVE_BITS)).alias("p"))
    return placed.groupBy(F.expr("p >> 6").alias("_sieve_slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("_sieve_bits"))


def sifted(df: DataFrame, col: str, bits: DataFrame, held: bool) -> DataFrame:
    """Rows of df whose col may be among the ids of a sieve (held), or surely isn't. Nulls surely aren't.

    The bits are broadcast, so df isn't shuffled. With more ids than bits most rows may be held: what
    follows must be right for any rows, and then does the work that it would do without a sieve.
    """
    place = F.pmod(F.xxhash64(F.col(f"`{col}`").cast("long")), F.lit(1 << SIEVE_BITS))
    slot, word = unused(df, "sieve_slot"), unused(df, "sieve_bits")
    named = bits.select(F.col("_sieve_slot").alias(slot), F.col("_sieve_bits").alias(word))
    joined = df.join(F.broadcast(named), F.when(F.col(f"`{col}`").isNotNull(), F.shiftright(place, 6)) == F.col(slot), "left")
    bit = F.call_function("shiftrightunsigned", F.col(word), F.pmod(place, F.lit(64)).cast("int"))
    may = F.coalesce(bit.bitwiseAND(F.lit(1).cast("long")) == 1, F.lit(False))
    return joined.where(may if held else ~may).select(*columns(df))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge table of longs: rows (node, root), root the least node.

    Alternates large-star and small-star steps until the edges are stars. Each node's
    minimum is pre-aggregated and written, so that it is joined back by a join of its own, whose large
    partitions adaptive execution splits: the edges of a hub need not stay in one task. Nodes without an
    edge to another node are not returned; an empty table gives an empty table.
    """
    pairs = edges.where(F.col(a) != F.col(b))
    e = cut(pairs.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges")
    while True:
        # done when no node has two smaller neighbours, or a smaller and a greater one: then all are stars about their least node
        ends = e.select(F.col("hi").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("lo", F.lit(0), F.lit(1)))
        if ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up > 0 and down > 0)").isEmpty():
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        both = e.select(F.col("hi").alias("n"), F.col("lo").alias("nb")).union(e.select("lo", "hi"))
        first = cut(both.groupBy("n").agg(F.min("nb").alias("m")).select("n", F.least("n", "m").alias("m")), "least")
        large = cut(both.join(first, "n").where("nb > n").select(F.col("nb").alias("hi"), F.col("m").alias("lo")).distinct(), "large")
        second = cut(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        small = large.join(second, "hi").select(
            F.explode(F.array(F.struct(F.col("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")
        )
        new = cut(small.select("e.hi", "e.lo").where("hi != lo").distinct(), "edges")
        for done in (e, first, large, second):
            forget(done)
        e = new
