import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as e
from veritide import job_queries, record_queries  # noqa: F401  register their queries
from veritide.queries import QUERIES, SQL

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for name in TABLES:
        c.sql(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return c


def rows(df: pd.DataFrame) -> list:
    out = []
    for r in df[sorted(df.columns)].itertuples(index=False):
        out.append(tuple("-" if pd.api.types.is_scalar(v) and pd.isna(v) else f"{float(v):.7g}" if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "iufb" else str(v).removesuffix(" 00:00:00") for v in r))
    return sorted(out)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA).toPandas()
    if name in SQL:
        want = duck.sql(SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got)


def test_entry_and_registry(spark):
    assert e.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES) <= set(e.queries())
