"""Sharding and mixing: laws, exact quotas, and equality with SQL."""

import zlib
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from veritide.llm import decontaminate, mixing, quality_rules, sharding
from veritide.llm.registry import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got, want = QUERIES[name](spark, DATA).toPandas(), c.sql(SQL[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    text = lambda df: sorted(tuple("-" if pd.isna(v) else f"{float(v):.9g}" if not isinstance(v, str) else v for v in r) for r in df[cols].itertuples(index=False))
    assert text(got) == text(want)


def many(spark, sizes):
    rows = [(i * 100 + k, " ".join(["w"] * (1 + (i + k) % 7)), s) for k, (s, n) in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_shards_match_the_mixture(spark):
    docs = many(spark, [("hot", 400), ("b", 100), ("c", 37), (None, 5)])
    got = sharding.interleave(docs, shards=7).collect()
    n = len(got)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and all(sorted(v) == list(range(len(v))) for v in by.values()) and n == 542
    src = {r["doc_id"]: r["source"] for r in docs.collect()}
    per = Counter((r["shard"], src[r["doc_id"]]) for r in got)
    for (_, s), k in per.items():
        whole = sum(1 for x in src.values() if x == s)
        assert abs(k - whole / 7) <= 2
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.interleave(docs.repartition(5), shards=7).collect()}
    assert again == {(r["doc_id"], r["shard"], r["slot"]) for r in got}


def test_sharding_of_odd_rows(spark, odd, empty):
    got = sharding.interleave(odd, shards=3).collect()
    assert len(got) == odd.count() and {r["law"] for r in got} == {"rows"}
    texts = Counter((len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in odd.collect())
    assert Counter((r["size"], r["text_crc32"]) for r in got) == texts
    assert sharding.interleave(empty).count() == 0


def fill(sizes, weights, share, limit):
    """Water-filling by resharing the excess until nothing is above its cap."""
    total, open_, target = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        w = sum(weights[i] for i in open_)
        rest = total - sum(target[i] for i in range(len(sizes)) if i not in open_)
        over = {i for i in open_ if rest * weights[i] / w > limit * sizes[i]}
        if not over:
            for i in open_:
                target[i] = rest * weights[i] / w
            return target
        for i in over:
            target[i] = limit * sizes[i]
        open_ -= over
    return target


def test_targets_and_takes(spark):
    docs = many(spark, [("a", 300), ("b", 40), ("c", 60), ("d", 5), (None, 80)])
    got = mixing.plan(docs, ["doc_id", "source"], blocks=16).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"]) and r["taken"] == r["size"] * len(r["copies"])
    order = ["a", "b", "c", "d", None]
    want = fill([sizes[s] for s in order], [3, 1, 2, 3, 1], 1.5, 2)
    assert [target[s] for s in order] == pytest.approx(want) and all(abs(taken[s] - target[s]) <= 7 for s in order)
    assert {(r["doc_id"], tuple(r["copies"])) for r in mixing.plan(docs.repartition(6), ["doc_id"], blocks=16).collect()} == {(r["doc_id"], tuple(r["copies"])) for r in got}


def test_tree_keeps_quotas_exact(spark):
    quotas = {"a": 37, "b": 5, "c": 1, "d": 0}
    got = mixing.split_quotas(spark.createDataFrame(list(quotas.items()), "src string, quota int"), 3, 9).collect()
    by_src, by_shard = Counter(), Counter()
    for r in got:
        by_src[r["src"]] += r["quota"]
        by_shard[r["shard"]] += r["quota"]
    assert by_src == {k: v for k, v in quotas.items() if v} and len(by_shard) == 8 and max(by_shard.values()) - min(by_shard.values()) <= 1


def test_mixing_of_odd_rows(spark, odd, empty):
    got = mixing.mix(odd)
    assert got.columns == odd.columns and got.count() <= 2 * odd.count()
    assert mixing.mix(empty).count() == 0 and mixing.plan(empty, ["doc_id"]).count() == 0
    blank = odd.where("text is null")
    assert sum(r["taken"] for r in mixing.plan(blank, ["doc_id"]).collect()) == 0


def test_shards_of_the_mix_are_shuffled(spark):
    """Rows leave mix() shard by shard in the order of their keys, each shard whole, and that order is not the input's."""
    docs = many(spark, [("a", 300), ("b", 80), (None, 60)])
    rows = mixing.mix(docs, shards=True, levels=2, blocks=16).collect()
    assert [(r["mix_shard"], r["mix_key"]) for r in rows] == sorted((r["mix_shard"], r["mix_key"]) for r in rows) and {r["mix_shard"] for r in rows} == {0, 1, 2, 3}
    plan = mixing.plan(docs, ["doc_id"], levels=2, blocks=16).collect()
    assert Counter((r["doc_id"], r["mix_shard"], r["mix_key"]) for r in rows) == Counter((p["doc_id"], *c) for p in plan for c in p["copies"])
    first = [r["doc_id"] for r in rows if r["mix_shard"] == 0]
    assert len(first) > 20 and first != sorted(first)


def test_rows_without_ids_are_spread(spark):
    """A third of all rows with a null id: their order comes from their texts, so they lie in many buckets, and totals hold."""
    docs = spark.createDataFrame([(i if i % 3 else None, f"w{i} " * (i % 5), "s") for i in range(900)], "doc_id long, text string, source string")
    got = mixing.plan(docs, ["doc_id"], blocks=16).where("doc_id is null")
    assert got.select(F.explode("copies.shard").alias("s")).distinct().count() > 8
    assert len({r["slot"] for r in sharding.interleave(docs, shards=1).collect()}) == 900


def test_quality_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (99, 1), (None, 0), (2, None)], "doc_id long, quality int")
    got = quality_rules.judge(odd, labels)
    assert got.count() == odd.count() and got.where("kept").count() <= 1 and quality_rules.judge(empty, labels).count() == 0
    assert got.where("doc_id = 3").first()["base_failed"]


def test_features_equal_brute_force():
    import random
    import re

    rng = random.Random(4)
    for _ in range(400):
        t = "".join(rng.choices(["a ", "b ", "é ", "#% ", "\n", "\t", "x", "<a|b> ", "a b c ", "\x1c", " "], k=rng.randint(0, 40)))
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        twice = {g for g, n in Counter(grams).items() if n > 1}
        covered = {i + k for i, g in enumerate(grams) if g in twice for k in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), len(lines))
        assert quality_rules.features(t.encode()) == want, t


def test_cutoffs_hold_the_risk(spark):
    """A rule that good documents break too often gets no cutoff; one that only bad ones break does."""
    rows = [(i, "s", 100, 500, 5 if i % 3 else 400, 0, 0, 10, 1) for i in range(3000)] + [(i, "s", 100, 500, 0, 0 if i < 5900 else 9, 0, 10, int(i < 5900)) for i in range(3000, 6000)]
    df = spark.createDataFrame(rows, "doc_id int, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, quality int")
    got = {r["rule"]: r["cutoff"] for r in quality_rules.thresholds(df, F.col("quality") == 1, "stratum", 0.05, 0.05).collect()}
    assert "symbols" not in got and got["dup_lines"] == 0.2
    few = quality_rules.thresholds(df.limit(50), F.col("quality") == 1, "stratum", 0.05, 0.05)
    assert few.count() == 0


def test_binomial_tail(spark):
    from math import comb, exp

    df = spark.createDataFrame([(k, n) for n in (1, 10, 300) for k in (0, 1, 2, 5) if k <= n], "k long, n long").withColumn("t", quality_rules.log_binomial_tail("k", "n", 0.05))
    for r in df.collect():
        want = sum(comb(r["n"], i) * 0.05**i * 0.95 ** (r["n"] - i) for i in range(r["k"] + 1))
        assert exp(r["t"]) == pytest.approx(1.0 if r["k"] >= 0.05 * r["n"] else want)


def test_masks_have_one_length():
    assert len(set(map(len, decontaminate.MASKS))) == 1
