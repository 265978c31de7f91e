"""SimHash near-duplicates and decontamination against brute force."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from veritide.llm import decontaminate as D
from veritide.llm import shared, simhash as S

DATA = "/root/testdata/sf0.001/documents.parquet"


def brute_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, d):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    a = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= d):
            x, y = find(i), find(int(j))
            parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def test_fingerprints_equal_brute_force(spark):
    docs = spark.read.parquet(DATA)
    got = {r["id"]: r["fp"] % 2**64 for r in S.fingerprints(docs).collect()}
    assert got == {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs.collect()}


def test_spark_hash_is_the_same(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("a b c", 42)


def test_components_equal_brute_force(spark):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(250):  # chains, crowded grid cells and far pairs
        fps.append(rng.choice(fps) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    for _ in range(60):
        fps.append(fps[3] ^ (1 << rng.randrange(4)) ^ (1 << rng.randrange(64)))
    fps = sorted(set(fps))
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    for d in (0, 1, 2):
        links = S.links(spark.createDataFrame(signed, "fp long"), d)
        root = {r["node"]: r["root"] for r in shared.components(links).collect()}
        want = brute_components(fps, d)
        mine = [root.get(s[0], s[0]) for s in signed]
        groups = lambda labels: {tuple(i for i, x in enumerate(labels) if x == y) for y in set(labels)}
        assert groups(mine) == groups(want), d


def test_odd_rows(spark, odd, empty):
    got = [(r["doc_id"], r["fp"], r["component_id"]) for r in S.near_duplicates(odd).collect()]
    assert len(got) == odd.count() and sum(d == 1 for d, _, _ in got) == 2
    assert all(c == 2 for d, f, c in got if f == 0)  # null, empty and blank texts are one group: ids 2, 3, 6 and a null id
    assert S.near_duplicates(empty).count() == 0 and S.keep_one(empty).count() == 0
    kept = S.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [1, 2, 4, 5, 7] and kept.where("doc_id is null").count() == 2


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    base = [[word() for _ in range(300)] for _ in range(12)]
    rows = []
    for i, words in enumerate(base):
        rows.append((10 * i, " ".join(words)))
        for k in range(1, 4):
            w = list(words)
            for j in rng.sample(range(300), k):
                w[j] = word()
            rows.append((10 * i + k, " ".join(w)))
    passage = [word() for _ in range(60)]  # shared by documents that are no copies
    rows += [(1000 + i, " ".join([word() for _ in range(150)] + passage + [word() for _ in range(150)])) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r["doc_id"] for r in S.keep_one(docs, similarity=0.8).collect())
    assert got == sorted([10 * i for i in range(12)] + [1000 + i for i in range(20)])


def brute_contaminated(docs, items, masks, overlap=13, similarity=0.8):
    span = len(masks[0])
    tok = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for d, text in docs:
        w = tok(text)
        for i, item in items:
            v = tok(item)
            size = min(overlap, len(v))
            for p in range(len(w) - span + 1):
                for j in range(len(v) - span + 1):
                    for m in masks:
                        if all(w[p + k] == v[j + k] for k, c in enumerate(m) if c == "1"):
                            shift = p - j
                            ok = [s for s in range(max(j + span - size, 0), min(j, len(v) - size) + 1) if sum(0 <= s + k + shift < len(w) and w[s + k + shift] == v[s + k] for k in range(size)) >= -(-similarity * size // 1)]
                            if ok:
                                n, a, b = out.get((d, i), (0, 10**9, -1))
                                out[d, i] = (n + 1, min(a, max(min(ok) + shift, 0)), max(b, max(ok) + shift + size - 1))
    return out


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(30)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, text(n)) for i, n in enumerate((11, 12, 13, 20, 35, 5))]
    docs = []
    for k in range(40):
        i, item = items[k % 6]
        w = list(item)
        for _ in range(k % 4):
            w[rng.randrange(len(w))] = "Other"
        docs.append((k, " ".join(text(rng.choice((0, 3, 300))) + w + text(4))))
    docs += [(100, None), (101, ""), (102, " ".join(text(600)))]
    mk = lambda rows, n: spark.createDataFrame(rows, f"{n} long, text string")
    b = [(i, " ".join(w).upper()) for i, w in items] + [(9, None)]
    masks = ("11101100111", "11011011011", "10111011101")
    want = brute_contaminated(docs, b, masks)
    for rows in (200_000, 7):  # one broadcast, and a sieve
        got = D.contaminated(mk(docs, "doc_id"), mk(b, "item_id"), masks=masks, block_rows=rows, whole=False)
        assert {(r["doc_id"], r["item_id"]): (r["n_seeds"], r["first_token"], r["last_token"]) for r in got.collect()} == want
    assert len(want) > 15


def test_decontamination_of_odd_rows(spark, odd, empty):
    b = spark.createDataFrame([(1, "the cat sat on the mat and looked at the dog by the door")], "item_id long, text string")
    kept = D.decontaminate(odd, b)
    assert kept.columns == odd.columns and kept.where("doc_id = 1").count() == 0 and kept.count() == odd.count() - 2
    assert D.decontaminate(empty, b).count() == 0 and D.decontaminate(odd, b.limit(0)).count() == odd.count()


def test_sieve_splits_rows_and_misses_no_id(spark):
    from veritide.llm.shared import sieve, sifted

    docs = spark.createDataFrame([(i, f"t{i}") for i in range(2000)] + [(None, "none")], "doc_id long, text string")
    lost = docs.where("doc_id % 7 = 0").select("doc_id")
    bits = sieve(lost, "doc_id")
    held, rest = (sifted(docs, "doc_id", bits, held=h) for h in (True, False))
    assert held.columns == docs.columns
    assert held.count() + rest.count() == docs.count()
    assert not rest.where("doc_id % 7 = 0").count() and rest.where("doc_id is null").count() == 1
    nothing = sieve(lost.limit(0), "doc_id")
    assert not sifted(docs, "doc_id", nothing, held=True).count() and sifted(docs, "doc_id", nothing, held=False).count() == docs.count()


def test_copies_of_an_original_with_any_id(spark):
    """Copies resemble their original and not each other: one document stays, wherever the original's id lies."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    rows, last = [], -1
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    for n, place in ((20, "last"), (20, "middle"), (300, "last")):
        base = [word() for _ in range(300)]
        group = []
        for _ in range(n):
            w = list(base)
            for j in rng.sample(range(300), rng.randint(4, 6)):
                w[j] = word()
            group.append(w)
        assert all(len(shingles(w) & shingles(base)) >= 0.8 * len(shingles(w) | shingles(base)) for w in group)
        group.insert(n if place == "last" else n // 2, base)
        rows += [(last + 1 + k, " ".join(w)) for k, w in enumerate(group)]
        last += len(group)
    edges, parent = [], list(range(len(rows)))
    sets = [shingles(t.split()) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                edges.append((i, j))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in edges:
        x, y = find(i), find(j)
        parent[max(x, y)] = min(x, y)
    want = sorted({find(i) for i in range(len(rows))})
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r["doc_id"] for r in S.keep_one(docs).collect())
    # a class sketch finds a pair at 0.8 with probability 0.99: few may miss all of them, with fixed hashes always the same
    assert len(want) == 3 and set(want) <= set(got) and len(got) <= len(want) + 6


def test_no_pair_of_a_bucket_is_lost(spark):
    """In a chain of texts in one bucket each is like its neighbours alone."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    words, rows = [word() for _ in range(400)], []
    for k in range(12):
        rows.append((100 - k if k % 2 else k, " ".join(words)))
        words[30 * k : 30 * k + 25] = [word() for _ in range(25)]
    pairs = S.similar_links(spark.createDataFrame(rows, "doc_id long, text string"))
    root = {r["node"]: r["root"] for r in shared.components(pairs).collect()}
    assert len(root) == 11 and set(root.values()) == {min(i for i, _ in rows)}


def test_masks_leave_no_two_substitutions():
    hit = lambda masks, n, bad: any(all(p + k not in bad for k, c in enumerate(m) if c == "1") for m in masks for p in range(n - len(m) + 1))
    for n in (11, 12, 13):
        pairs = [(i, j) for i in range(n) for j in range(i)]
        assert all(hit(D.MASKS, n, p) for p in pairs)


def test_contamination_without_masks(spark):
    """All overlaps that the definition has, however they are found, and exact copies of items too short for it."""
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(200)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, text(n)) for i, n in enumerate((11, 12, 13, 15, 16, 17, 20, 10, 6, 2))]
    docs = []
    for i, item in items:
        for k in range(24):
            w = list(item)
            for j in rng.sample(range(len(w)), min(len(w), k % 4 + len(w) // 16)):
                w[j] = "other"
            a, b = (rng.choice((0, 5, 280)), rng.choice((0, 4))) if k < 18 else (0, 0)
            docs.append((len(docs), text(a) + (w if k < 18 else item[k % 3 : len(item) - k // 3 % 2]) + text(b)))

    def held(w, v):
        if len(v) < 11:
            return any(w[p : p + len(v)] == v for p in range(len(w) - len(v) + 1))
        size = min(13, len(v))
        return any(sum(0 <= s + k + shift < len(w) and w[s + k + shift] == v[s + k] for k in range(size)) >= -(-8 * size // 10) for shift in range(-len(v), len(w)) for s in range(len(v) - size + 1))

    want = {(d, i) for d, w in docs for i, v in items if held(w, v)}
    d = spark.createDataFrame([(k, " ".join(w)) for k, w in docs] + [(900, None), (901, "")], "doc_id long, text string")
    b = spark.createDataFrame([(i, " ".join(v)) for i, v in items] + [(50, None), (51, "")], "item_id long, text string")
    for rows in (200_000, 7):
        got = D.contaminated(d, b, block_rows=rows).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert {r["doc_id"] for r in D.decontaminate(d, b).collect()} == {k for k, _ in docs} - {k for k, _ in want} | {900, 901}


def test_component_ids_of_the_query_equal_brute_force(spark):
    """component_id of all rows: the least id over links of 2 bits, with large groups of copies and of near copies, null and repeated ids."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    texts = [" ".join(word() for _ in range(rng.choice((2, 4, 30)))) for _ in range(150)]
    texts += [texts[0]] * 400 + [f"{texts[40]} {word()}" for _ in range(60)] + [None, ""]
    rows = [(rng.randrange(5000) if i % 50 else None, t) for i, t in enumerate(texts)]
    got = S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    fps = sorted({brute_fingerprint(t) for _, t in rows})
    root = dict(zip(fps, brute_components(fps, 2), strict=True))
    least = {}
    for i, t in rows:
        r = root[brute_fingerprint(t)]
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=key) == sorted(((i, least[root[brute_fingerprint(t)]]) for i, t in rows), key=key)


def test_different_texts_with_one_id_stay(spark):
    rng = random.Random(10)
    text = lambda: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(60))
    a, b, c, d = (text() for _ in range(4))
    rows = [(1, a), (1, b), (2, c), (1, a.upper()), (3, b), (3, d), (2, c), (2, c), (None, a), (None, a)]
    for _ in range(2):
        got = [(r["doc_id"], r["text"].lower()) for r in S.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
        assert sorted(t for i, t in got if i is not None) == sorted([a, b, c, d]) and sum(i is None for i, _ in got) == 2
        rng.shuffle(rows)


def test_links_between_different_texts_have_recall(spark):
    """Of all pairs with a similarity of 0.8 or more at least nine tenths are in one component, and nothing else is linked."""
    rng = random.Random(13)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    rows, sets = [], []
    for i in range(120):
        base = [word() for _ in range(rng.randint(80, 300))]
        for _ in range(rng.randint(1, 6)):
            w = list(base)
            for j in rng.sample(range(len(w)), rng.randint(0, len(w) // 45)):
                w[j] = word()
            rows.append((len(rows), " ".join(w)))
            sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)})
    pairs = [(i, j) for i in range(len(rows)) for j in range(max(0, i - 6), i) if (n := len(sets[i] & sets[j])) >= 0.8 * (len(sets[i]) + len(sets[j]) - n)]
    edges = S.similar_links(spark.createDataFrame(rows, "doc_id long, text string"))
    root = {r["node"]: r["root"] for r in shared.components(edges).collect()}
    assert sum(root.get(i, i) == root.get(j, j) for i, j in pairs) >= 0.97 * len(pairs)
    for r in edges.collect():
        x, y = sets[r["a"]], sets[r["b"]]
        assert len(x & y) >= 0.8 * len(x | y)


def test_documents_of_one_passage_are_not_paired(spark):
    """Short texts around a common passage share buckets; the exact join pairs none of them, and finds a similar pair among them."""
    rng = random.Random(14)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    passage = [word() for _ in range(60)]
    rows = [(i, [word() for _ in range(20)] + passage + [word() for _ in range(20)]) for i in range(200)]
    rows.append((200, rows[7][1][:3] + [word()] + rows[7][1][4:]))
    texts = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    sets = texts.rdd.map(lambda r: (r["doc_id"], [int(x) for b in S.shingle_hashes(r["text"].encode(), 5) for x in b.view(np.int64)])).toDF("id long, set array<long>")
    members = texts.select(F.col("doc_id").alias("rep"), F.col("doc_id").alias("root"))
    assert {tuple(sorted((r["a"], r["b"]))) for r in S._rare(members.withColumn("very", F.lit(True)), sets, 0.8).collect()} == {(7, 200)}
    assert sorted(r["doc_id"] for r in S.keep_one(texts).collect()) == list(range(200))


def test_sieve_leaves_clashing_names_alone(spark):
    docs = spark.createDataFrame([(1, 2, 3), (2, 3, 4)], "doc_id long, _sieve_slot long, sieve_bits long")
    bits = shared.sieve(docs.where("doc_id = 1").select("doc_id"), "doc_id")
    assert [tuple(r) for r in shared.sifted(docs, "doc_id", bits, held=True).collect()] == [(1, 2, 3)]


def test_pairs_left_by_the_hub_are_found(spark):
    """In a bucket, all pairs of similar documents of different components come out, whatever their distance from the hub."""
    rng = random.Random(15)
    base = list(range(100))
    sets = {0: set(base)}
    for i in range(1, 120):
        drop = rng.sample(base, rng.choice((3, 8, 10, 14, 20, 45)))
        sets[i] = set(base) - set(drop) | {1000 * (i // 2) + k for k in range(len(drop) if i % 3 else 2)}
    jac = lambda x, y: len(x & y) / len(x | y)
    held = spark.createDataFrame([(i, sorted(v)) for i, v in sets.items()], "id long, set array<long>")
    pairs = spark.createDataFrame([(i, 0) for i in range(1, 120)], "a long, b long")
    scored = S._similar(pairs, held, 0.8)
    assert {(r["a"], round(r["j"], 9), r["ok"]) for r in scored.collect()} == {(i, round(jac(sets[i], sets[0]), 9), jac(sets[i], sets[0]) >= 0.8) for i in range(1, 120)}
    root = {i: 0 if jac(sets[i], sets[0]) >= 0.8 else i for i in sets}
    members = spark.createDataFrame([(7, i, 1, r) for i, r in root.items()], "band long, rep long, weight long, root long")
    got = {tuple(sorted((r["a"], r["b"]))) for r in S._rest(members, scored, held, 0.8).collect()}
    want = {(i, j) for i in sets for j in sets if i < j and root[i] != root[j] and jac(sets[i], sets[j]) >= 0.8}
    assert want and want <= got


def test_few_pairs_are_left_in_a_group_around_the_threshold(spark, monkeypatch):
    """Copies of one text with a few words substituted from a list, many just below the similarity to it: last, only documents are paired that have a rare difference from it in common."""
    counted = []
    rest = S._rest
    monkeypatch.setattr(S, "_rest", lambda *a: counted.append(shared.cut(rest(*a), "counted")) or counted[-1])
    for n in (150, 450):
        rng = random.Random(7)
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        others = [f"x{i}" for i in range(40)]
        texts = []
        for _ in range(n):
            words = list(base)
            for i in rng.sample(range(300), rng.randint(3, 8)):
                words[i] = rng.choice(others)
            texts.append(" ".join(words))
        docs = spark.createDataFrame(list(enumerate([" ".join(base), *texts])), "doc_id long, text string")
        kept = {r["doc_id"] for r in S.keep_one(docs).collect()}
        sets = [set(np.concatenate(list(S.shingle_hashes(t.encode(), 5))).tolist()) for t in [" ".join(base), *texts]]
        root = list(range(len(sets)))

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for i in range(len(sets)):
            for j in range(i):
                if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                    root[max(find(i), find(j))] = min(find(i), find(j))
        assert kept == {i for i in range(len(sets)) if find(i) == i}
    pairs = [c.select(F.least("a", "b"), F.greatest("a", "b")).distinct().count() / (n * (n - 1) / 2) for c, n in zip(counted, (150, 450), strict=True)]
    assert len(pairs) == 2 and max(pairs) < 0.05 and counted[1].count() < 0.05 * 450 * 449 / 2


def test_names_with_dots_and_clashes_go_through_the_stages(spark, odd):
    from veritide.llm.langid import keep_known
    from veritide.llm.mixing import mix

    docs = odd.select("*", F.lit(1).alias("a.b"), F.lit(2).alias("mix_shard"), F.lit(3).alias("row_in"), F.lit(4).alias("c`d"))
    for stage in (keep_known, S.keep_one, mix):
        assert stage(docs).columns == docs.columns and stage(docs).count() > 0
    assert mix(docs, shards=True).columns == [*docs.columns, "_mix_shard", "mix_key"]
    bench = spark.createDataFrame([(1, "the cat sat on the mat and looked at the dog by the door")], "item_id long, text string")
    assert D.decontaminate(docs, bench).columns == docs.columns
