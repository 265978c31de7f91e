"""Benchmark decontamination with spaced seeds.

Texts become lower-case runs of letters and digits. Fixed masks select some tokens of every window
of `span` tokens and ignore the rest, so a substituted token at an ignored place does not hide a
match. Windows of benchmark items are hashed under each mask into a table; every window of every
document probes it. Around each hit the aligned texts are compared: a document is contaminated by
an item if some `overlap` aligned tokens that contain the hit are equal in at least `similarity` of
the places. Items shorter than `overlap` are compared over their whole length; items of fewer than
`span` tokens have no window and match nothing, unless `whole` is set.

The masks have six of eleven tokens and leave no two places of a window that one of them does not ignore
together, so every overlap of 11 to 13 tokens with up to 2 substitutions is hit. `whole` adds what no window inside both texts shows: overlaps that begin or end outside a
document, and exact copies of items of fewer than `span` tokens.

A seed table of up to `block_rows` rows is broadcast, counted first. A larger one is not: a sieve of its keys
of fixed size is broadcast, lets few windows of documents through, and these are joined with the
table by key. Either way documents are read once and not shuffled.

Defined results: null and empty texts have no tokens; repeated rows add up their hits; rows with a
null id are reported under null and stay in the table. Tokens of an overlap that lie outside a document count
as places of it, before the first (never below 0) or after the last. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritide.llm.shared import columns, cut, sieve, sifted

TOKEN = r"[\p{L}\p{N}]+"
#: Windows of a text that are handled together.
PIECE = 256
#: Any two places are ignored together by a mask, so none of 2 substitutions is in the way. No six masks of 6 tokens can do that.
MASKS = ("01010011101", "10100001111", "11110010010", "11101100100", "10110111000", "01001101011", "00011110110")


def tokens(text: str) -> Column:
    """Hashes of the tokens of a text column; null for null."""
    return F.transform(F.regexp_extract_all(F.lower(F.col(text)), F.lit(TOKEN), F.lit(0)), lambda w: F.xxhash64(w))


def _windows(rows: DataFrame, masks: tuple[str, ...], overlap: int) -> DataFrame:
    """Adds start (of a window of tokens), key (its hash under a mask), near (the row's tokens around it) and from (where they begin in near).

    rows has an array column h, which is cut into pieces first, so that a long text is never copied
    for each of its windows. The generators are outer ones: for inner ones Spark infers filters
    that compute h once more.
    """
    span = len(masks[0])
    reach = overlap - span  # tokens that a comparison may need on either side of a window
    padded = F.concat(F.array_repeat(F.lit(None).cast("long"), reach), F.col("h"))
    pieces = F.when(F.size("h") >= span, F.transform(F.sequence(F.lit(0), F.size("h") - span, F.lit(PIECE)), lambda s: F.slice(padded, s + 1, F.lit(PIECE + span + 2 * reach - 1))))
    others = [c for c in rows.columns if c != "h"]
    cut_up = rows.select(*others, F.posexplode_outer(pieces).alias("piece", "near"))
    at = F.when(F.col("near").isNotNull(), F.sequence(F.lit(0), F.least(F.lit(PIECE - 1), F.size("near") - reach - span)))
    opened = cut_up.select(*others, "piece", "near", F.explode_outer(at).alias("from"))
    keys = [F.xxhash64(F.lit(k), *(F.get("near", F.col("from") + reach + i) for i, c in enumerate(mask) if c == "1")) for k, mask in enumerate(masks)]
    hashed = opened.select("*", F.explode_outer(F.when(F.col("from").isNotNull(), F.array(*keys))).alias("key"))
    return hashed.select(*others, (F.col("piece") * PIECE + F.col("from")).alias("start"), "key", "near", "from")


def seeds(benchmark: DataFrame, masks: tuple[str, ...], overlap: int, id_col: str, text_col: str) -> DataFrame:
    """(key, item_id, item_at, item_n, item_near): windows of items, and the tokens from overlap - span before to as many after them."""
    items = benchmark.select(F.col(id_col).alias("item_id"), tokens(text_col).alias("h")).where("h is not null").withColumn("item_n", F.size("h"))
    near = F.slice("near", F.col("from") + 1, F.lit(2 * overlap - len(masks[0])))
    return _windows(items, masks, overlap).where("key is not null").select("key", "item_id", F.col("start").alias("item_at"), "item_n", near.alias("item_near")).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, overlap: int = 13, similarity: float = 0.8, block_rows: int = 200_000, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", whole: bool = True) -> DataFrame:
    """(doc_id, item_id, n_seeds, first_token, last_token): verified seed hits (of short items: places), and the tokens their overlaps span."""
    span = len(masks[0])
    reach = overlap - span
    if len(set(map(len, masks))) != 1 or reach < 0:
        raise ValueError("masks must have one length, not above overlap")
    table = cut(seeds(benchmark, masks, overlap, item_id_col, item_text_col), "seeds")
    words = docs.select(F.col(id_col).alias("doc_id"), tokens(text_col).alias("h"))
    outside = reach if whole else 0  # places before and after a document
    beyond = F.array_repeat(F.lit(None).cast("long"), outside)
    probes = _windows(words.withColumn("h", F.concat(beyond, "h", beyond)) if whole else words, masks, overlap)
    size = F.least(F.lit(overlap), F.col("item_n"))
    if table.count() <= block_rows:
        met = probes.join(F.broadcast(table), "key")
    else:
        met = sifted(probes, "key", cut(sieve(table, "key"), "seed-bits"), held=True).join(table, "key")
    # overlaps of `size` item tokens around the hit, by their start in the item
    starts = F.sequence(F.greatest(F.col("item_at") + span - size, F.lit(0)), F.least(F.col("item_at"), F.col("item_n") - size))
    equal = F.transform("item_near", lambda x, i: F.get("near", F.col("from") + i).eqNullSafe(x).cast("int"))
    aligned = met.select("doc_id", "item_id", "item_at", (F.col("start") - outside - F.col("item_at")).alias("shift"), size.alias("size"), starts.alias("starts"), equal.alias("equal"))
    same = lambda s: F.aggregate(F.slice("equal", s - F.col("item_at") + reach + 1, F.col("size")), F.lit(0), lambda a, x: a + x)
    good = F.filter("starts", lambda s: same(s) >= F.ceil(F.lit(similarity) * F.col("size")))
    hits = aligned.select("doc_id", "item_id", "shift", "size", good.alias("good"))
    # hits that are not verified go after the sums: a filter here would move into the join and out of its compiled stage
    ok, first, last = F.size("good") > 0, F.greatest(F.array_min("good") + F.col("shift"), F.lit(0)), F.array_max("good") + F.col("shift") + F.col("size") - 1
    sums = hits.groupBy("doc_id", "item_id").agg(
        F.count_if(ok).alias("n_seeds"), F.min(F.when(ok, first)).cast("long").alias("first_token"), F.max(F.when(ok, last)).cast("long").alias("last_token")
    )
    found = sums.where("n_seeds > 0")
    if whole:
        items = benchmark.select(F.col(item_id_col).alias("item_id"), tokens(item_text_col).alias("h"))
        for places in _copied(words, items.where(F.size("h").between(1, span - 1)), block_rows):
            found = found.unionByName(places)
    return found


def _copied(words: DataFrame, items: DataFrame, block_rows: int) -> list[DataFrame]:
    """Places of a document that hold all tokens of an item, for items of few tokens, in tables like that of contaminated(); none without such items."""
    table = cut(items.select("item_id", F.size("h").alias("n"), F.xxhash64(F.size("h"), "h").alias("key")).distinct(), "short-items")
    counts = {r["n"]: r["count"] for r in table.groupBy("n").count().collect()}
    out = []
    for n, count in sorted(counts.items()):
        at = F.when(F.size("h") >= n, F.transform(F.sequence(F.lit(0), F.size("h") - n), lambda i: F.struct(i.alias("at"), F.xxhash64(F.lit(n), F.slice("h", i + 1, n)).alias("key"))))  # noqa: B023
        places = words.select("doc_id", F.explode_outer(at).alias("p")).select("doc_id", "p.at", "p.key")
        part = table.where(F.col("n") == n)
        met = places.join(F.broadcast(part), "key") if count <= block_rows else sifted(places, "key", cut(sieve(part, "key"), "short-bits"), held=True).join(part, "key")
        out.append(met.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_seeds"), F.min("at").cast("long").alias("first_token"), (F.max("at") + n - 1).cast("long").alias("last_token")))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the documents that contaminated() reports; of two rows with one id both go.

    Documents are joined with the ids of the reported ones, of which a sieve is broadcast: only what may be one of them is shuffled.
    """
    bad = cut(contaminated(docs, benchmark, **options).select("doc_id").where("doc_id is not null").distinct(), "contaminated")
    bits = cut(sieve(bad, "doc_id"), "contaminated-bits")
    return sifted(docs, "doc_id", bits, held=False).unionByName(sifted(docs, "doc_id", bits, held=True).join(bad, "doc_id", "left_anti").select(*columns(docs)))


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    read = spark.read.parquet
    return contaminated(read(f"{sf_dir}/documents.parquet"), read(f"{sf_dir}/benchmark.parquet"))


def _mask_sql(words: str, at: str) -> str:
    parts = ["concat_ws(' ', '{}', {})".format(k, ", ".join(f"{words}[{at} + {i + 1}]" for i, c in enumerate(m) if c == "1")) for k, m in enumerate(MASKS)]
    return f"unnest([{', '.join(parts)}])"


OP8_SQL = f"""
WITH i AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM benchmark WHERE text IS NOT NULL
), d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents WHERE text IS NOT NULL
), iw AS (SELECT item_id, w, unnest(range(len(w) - 10)) AS j FROM i
), ik AS (SELECT DISTINCT item_id, w, j, {_mask_sql('w', 'j')} AS key FROM iw
), o AS (SELECT doc_id, [NULL, NULL] || w || [NULL, NULL] AS w FROM d
), dw AS (SELECT doc_id, w, unnest(range(len(w) - 10)) AS p FROM o
), dk AS (SELECT doc_id, p - 2 AS p, {_mask_sql('w', 'p')} AS key FROM dw
), h AS (
  SELECT doc_id, item_id, p - j AS shift, j, least(13, len(ik.w)) AS size, ik.w AS iw FROM dk JOIN ik USING (key)
), s AS (
  SELECT h.*, d.w AS dw, unnest(range(greatest(j + 11 - size, 0), least(j, len(iw) - size) + 1)) AS s, row_number() OVER () AS hit FROM h JOIN d USING (doc_id)
), g AS (
  SELECT *, len(list_filter(range(size), lambda k: s + k + shift >= 0 AND dw[s + k + shift + 1] = iw[s + k + 1])) >= ceil(0.8 * size) AS good FROM s
), short AS (SELECT DISTINCT item_id, len(w) AS n, w FROM i WHERE len(w) BETWEEN 1 AND 10
), place AS (SELECT doc_id, n, w, unnest(range(len(w) - n + 1)) AS p FROM d, (SELECT DISTINCT n FROM short)
), copy AS (SELECT doc_id, item_id, p, short.n FROM place JOIN short ON short.n = place.n AND short.w = place.w[p + 1:p + place.n])
SELECT doc_id, item_id, count(DISTINCT hit) AS n_seeds, CAST(min(greatest(s + shift, 0)) AS BIGINT) AS first_token, CAST(max(s + shift + size - 1) AS BIGINT) AS last_token
FROM g WHERE good GROUP BY doc_id, item_id
UNION ALL SELECT doc_id, item_id, count(*), CAST(min(p) AS BIGINT), CAST(max(p + n - 1) AS BIGINT) FROM copy GROUP BY doc_id, item_id
"""
