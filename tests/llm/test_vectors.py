"""Whitening, exact top-k search and conversation repair against brute force."""

import hashlib
import random
import sys
import zlib
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from veritide.llm import dialogue as C, topk as T, whiten as W

DATA = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, x long, w int, row int, `a.b` int"
INF, NAN = float("inf"), float("nan")


def odd_vectors(spark):
    rows = [(0, [0.5, -0.25, 1.0]), (0, [0.5, -0.25, 1.0]), (100, [3.0, 0.1, -7.5]), (1, [0.5, -0.25, 1.0]), (2, [0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (3, None), (4, [1.0, None, 2.0]), (5, [INF, 0.0, 0.0]), (200, [NAN, 0.0, 0.0])]
    rows += [(300, [1.0, 2.0]), (6, [2.0, -1.0]), (7, [])]
    return spark.createDataFrame([(i, v, 0, 1, 2, 3, 4) for i, v in rows], VECTORS)


def brute_whitening(vectors, weights="counts", components=32):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0) if weights == "one" else x
    n, s = len(fit), [int(v) for v in fit.sum(axis=0)]
    centred = fit - fit.mean(axis=0)
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    deviation = [sum((n * int(a) - b) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    return n, deviation, (x - fit.mean(axis=0)) @ u / np.sqrt(e), e / np.trace(v)


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_whitening_equals_brute_force(spark, weights):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 8)).astype(np.float32) * np.arange(1, 9, dtype=np.float32)
    vectors = np.concatenate([vectors, np.repeat(vectors[:1], 200, axis=0)])  # one vector is a third of all
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = W.whiten(rows, components=5, weights=weights).orderBy("vec_id", "component").collect()
    n, deviation, white, explained = brute_whitening(vectors, weights, 5)
    assert len(got) == 5 * len(vectors) and {r.n for r in got} == {n}
    assert [r.deviation for r in got[::5]] == deviation == [int(r.deviation_exact) for r in got[::5]]
    mine = np.array([r.whitened for r in got]).reshape(-1, 5)
    signs = np.sign((mine * white).sum(axis=0))
    assert np.allclose(mine, white * signs, rtol=1e-9, atol=1e-9)
    assert np.allclose([r.explained for r in got[:5]], explained, rtol=1e-9) and got[0].identity_error < 1e-9


def test_whitening_of_the_table(spark):
    got = W.op11_embedding_whitening(spark, DATA)
    assert got.count() == 32 * spark.read.parquet(f"{DATA}/embeddings.parquet").count()
    assert got.agg(F.max("identity_error")).first()[0] < 1e-9


def test_whitening_of_large_entries_is_exact(spark):
    vectors = [[1e12, 3.0], [-1e12, 5.0], [7e11, 1.0], [7e11, 1.0]]
    rows = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    n, deviation, white, _ = brute_whitening(vectors)
    got = W.whiten(rows).where("component = 1").orderBy("vec_id").collect()
    assert [int(r.deviation_exact) for r in got] == deviation and all(r.deviation is None or r.deviation == d for r, d in zip(got, deviation, strict=True))
    assert any(r.deviation is None for r in got) and np.allclose(np.abs([r.whitened for r in got]), np.abs(white[:, 0]))


def test_whitening_of_odd_rows(spark):
    got = W.whiten(odd_vectors(spark)).collect()
    assert sorted({r.vec_id for r in got if r.vec_id is not None}) == [0, 1, 2, 6, 100, 300] and any(r.vec_id is None for r in got)
    assert sum(r.vec_id == 0 for r in got) == 6 and {r.n for r in got if r.vec_id in (6, 300)} == {2}
    second = [r for r in got if r.vec_id in (6, 300) and r.component == 2]  # two vectors have one component
    assert len(second) == 2 and all(r.whitened is None for r in second)
    assert all(r.identity_error < 1e-9 for r in got)
    none = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert {(r.whitened, r.explained, r.deviation, r.identity_error) for r in W.whiten(none).collect()} == {(None, None, 0, None)}
    assert W.whiten(odd_vectors(spark).where("false")).count() == 0
    with pytest.raises(ValueError):
        W.whiten(none, weights="many")


def brute_top(vectors, asked, k, scale=1024):
    x = [[int(np.floor(scale * float(c))) for c in v] for v in vectors]
    found = []
    for q in asked:
        scores = sorted((-sum(a * b for a, b in zip(x[q], x[p], strict=True)), p) for p in range(len(x)) if p != q and len(x[p]) == len(x[q]))
        found += [(q, i + 1, p, -s) for i, (s, p) in enumerate(scores[:k])]
    return sorted(found)


def top(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("shape", ["lengths", "one length", "copies"])
def test_top_k_equals_brute_force(spark, monkeypatch, shape):
    monkeypatch.setattr(T, "BUCKET", 64)
    monkeypatch.setattr(T, "QUERIES", 10)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 6)).astype(np.float32)
    if shape == "lengths":
        x *= rng.pareto(1.0, size=(900, 1)).astype(np.float32)
    elif shape == "one length":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    else:  # a third copies of one vector, and near ones
        x[::3] = x[0]
        x[1::3] = x[1] + 0.01 * x[1::3]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = T.top_k(rows, F.col("vec_id") % 20 == 0, k=7)
    assert top(got) == brute_top(x, range(0, 900, 20), 7)


def test_both_ways_of_pruning_are_taken_and_right():
    rng = np.random.default_rng(1)
    x = rng.integers(-50, 50, (300, 5)).astype(float)
    x[:100] = x[0] + rng.integers(-2, 3, (100, 5))
    norms = np.linalg.norm(x, axis=1)
    order = np.argsort(-norms)
    x, norms, ids = x[order], norms[order], order.astype(np.int64)
    s = T.Search(3, [1000 + i for i in range(50)], list(range(50)), norms[:50].tolist(), x[:50], None)
    calls = []
    focused = s.focused
    s.focused = lambda q, *a: calls.append(q) or focused(q, *a)
    for at in range(0, 300, 30):
        part = slice(at, at + 30)
        s.offer(norms[at], ids[part], np.zeros(len(ids[part]), np.int64), ids[part], norms[part], x[part])
    assert calls
    for q in range(50):
        mine = s.best[0] == q
        want = sorted((-int(x[q] @ x[p]), int(ids[p])) for p in range(300))[:3]
        assert [(-a, b) for a, b in zip(s.best[1][mine].tolist(), s.best[3][mine].tolist(), strict=True)] == want


def test_short_buckets_do_not_travel(spark, monkeypatch):
    monkeypatch.setattr(T, "BUCKET", 50)
    x = [[100.0 + i / 100, 100.0] for i in range(50)] + [[0.01, 0.02 * (i % 7)] for i in range(2000)]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    dealt = []
    monkeypatch.setattr(T, "_dealt", lambda blocks, found, *a, f=T._dealt: dealt.append(found.count()) or f(blocks, found, *a))
    assert len(top(T.top_k(rows, F.col("vec_id") == 10, k=5))) == 5
    assert dealt == [1, 1]  # of 41 buckets


def test_top_k_of_large_numbers_and_odd_rows(spark):
    rows = spark.createDataFrame([(0, [2.0e5, 1.0]), (1, [1.5e5, -3.0]), (2, [1.0e5, 0.5])], "vec_id long, embedding array<double>")
    assert top(T.top_k(rows, F.col("vec_id") == 0)) == brute_top([[2.0e5, 1.0], [1.5e5, -3.0], [1.0e5, 0.5]], [0], 10)
    got = top(T.top_k(odd_vectors(spark).fillna({"vec_id": -1}), F.col("vec_id") % 100 == 0))
    assert sum(r[0] == 0 for r in got) == 10  # two rows with id 0 ask, and are found by each other
    assert {r[2] for r in got if r[0] == 0} == {0, 1, 2, 100, -1} and [r[2] for r in got if r[0] == 300] == [6]
    null = T.top_k(odd_vectors(spark), F.col("vec_id") == 100).collect()
    assert sum(r.vec_id is None for r in null) == 1
    assert T.top_k(odd_vectors(spark).where("false"), F.col("vec_id") % 100 == 0).count() == 0


def brute_repair(rows):
    """rows: (turn, role, text) after damage. The result row by a recursion from the end."""
    sys.setrecursionlimit(50_000)
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()
    rows = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), digest(x[1], x[2])))
    seen, marks, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\v\f\r")
        fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
        seen.add((role, text))
        marks.append(fault)
        if fault is not None:
            counts[fault] += 1
    turns = [t for t, _, _ in rows if t is not None]

    @cache
    def rest(i, state, inserts=0):
        ways = []
        if inserts < 3:
            role = "assistant" if state == "u" else "user"
            ways.append((3, "I", f"{role}:", i, role[0], inserts + 1))
        if i == len(rows):
            ways.append((0, "", None, None, None, 0)) if state in ("", "a") else None
        else:
            _, role, text = rows[i]
            ways.append((4, "D", None, i + 1, state, 0))
            if marks[i] not in (0, 1):
                cut, follows = 3 * (marks[i] == 2), "assistant" if state == "u" else "user"
                if role[:1] == follows[0] or role[:1] == "s" and state == "":
                    ways.append((cut, "K", f"{role}:{text}", i + 1, role[0], 0))
                ways.append((3 + cut, "R", f"{follows}:{text}", i + 1, follows[0], 0))
        found = []
        for cost, letter, line, at, to, n in ways:
            c, audit, lines = (0, "", ()) if at is None else rest(at, to, n)
            found.append((cost + c, letter + audit, ((line,) if line is not None else ()) + lines))
        return min(found, default=(10**9, "", ()))

    cost, audit, lines = rest(0, "")
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


CONVERSATIONS = "conv_id long, turn long, role string, text string, key string, row int, `a.b` int"


def results(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("segment", [3, C.SEGMENT])
def test_repair_equals_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(C, "SEGMENT", segment)
    rng = random.Random(4)
    rows = []
    for conv in range(150):
        for turn in range(rng.choice([1, 2, 5, 12, 30])):
            rows.append((conv, rng.choice([None, turn, turn, turn, turn + 2]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "sys"]), rng.choice(["a.", "b!", "c? \n", "d", "", " \t", "e.", f"{turn}.", f"x{turn}.", f"y {turn}!"])))
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], CONVERSATIONS)
    got = {int(r.key[1:]): tuple(r)[1:] for r in C.repair(df).collect()}
    for conv in range(150):
        assert got[conv] == brute_repair([r[1:] for r in rows if r[0] == conv]), conv


def test_one_long_conversation_is_spread(spark, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT", 50)
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["a.", f"b{t}", f"c{t}.", f"d{t}!"])) for t in range(900)]
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], CONVERSATIONS)
    marks = C.marked(C.named(df, "conv_id", "turn", "role", "text")).withColumns({"row": F.monotonically_increasing_id(), "duplicate": F.lit(False)})
    assert C.segments(marks, 4).select("part").distinct().count() > 1
    (got,) = C.repair(df).collect()
    assert tuple(got)[1:] == brute_repair([r[1:] for r in rows])


def test_audits_in_order_also_with_equal_hashes(monkeypatch):
    for modulus in (C.MODULUS, 2):  # with 2, most hashes collide
        monkeypatch.setattr(C, "MODULUS", modulus)
        rng, tree, spelled = random.Random(3), C.Audits(), [""]
        for _ in range(300):
            parent, letter = rng.choice([len(spelled) - 1, rng.randrange(len(spelled))]), rng.choice("DK")
            tree.add(parent, letter)
            spelled.append(spelled[parent] + letter)
        for _ in range(3000):
            x, y = rng.randrange(300), rng.randrange(300)
            assert tree.less(x, y) == (spelled[x] < spelled[y])
        assert all(tree.spelled(i) == s for i, s in enumerate(spelled))


def test_query_on_odd_conversations(spark):
    rows = [(c, t, r, x) for c in (1, 2, None) for t, r, x in [(None, None, "a."), (0, "system", None), (1, "user", "b."), (1, "user", "b."), (2, "assistant", "c " * 50_000), (3, "user", ""), (4, "assistant", "ß.")]]
    rows += [(c, 0, "user", "x.") for c in range(3, 60)]
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], CONVERSATIONS)
    damaged: dict = {}
    for c, t, r, x in rows:
        part = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", " " if x is None else x
        x = "" if part == 1 else "".join(ch for ch in x if ch not in ".!?") if part == 2 else x
        damaged.setdefault(c, []).extend([(t, "user" if part == 4 else r, x)] * (0 if part == 0 else 2 if part == 3 else 1))
    found = C.damage(df)
    assert sorted(map(str, found.collect())) == sorted(f"Row(conv_id={c}, turn={t}, role={r!r}, text={x!r})" for c, d in damaged.items() for t, r, x in d)
    got = {r.key: tuple(r)[1:] for r in C.repair(found).collect()}
    assert got == {"-" if c is None else f"={c}": brute_repair(d) for c, d in damaged.items() if d}
    assert [] in damaged.values() and C.repair(df.where("false")).count() == 0


def test_query_of_the_table(spark):
    got = results(C.op13_conversation_repair(spark, DATA))
    assert len(got) == spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id").distinct().count()
