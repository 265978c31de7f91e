"""Tables that a job writes and reads again, for results that must not change between two uses and for short lineage, and rows that are dealt by keys once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def folder(spark: SparkSession) -> str:
    """A new folder that all hosts see: below spark.checkpoint.dir, or a temporary one where that is unset and the master is local."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        import tempfile

        base = "file://" + tempfile.mkdtemp(prefix="veritide-")
    return f"{base.rstrip('/')}/tables/{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """df dealt by keys in one shuffle that all uses share: what is grouped or joined by these keys (and more) shuffles no rows again.

    Each use would else shuffle the columns that it needs, a different set each time. A condition that always holds, and that can't move below the shuffle, names all columns.
    """
    return df.repartition(*keys).where(F.rand(0) < F.abs(F.xxhash64(*df.columns) % 2) + 2)
