"""Quality rules with risk-controlled thresholds.

Each rule rejects documents whose feature is above a cutoff. Cutoffs are chosen on labelled
documents, for every stratum by itself: a cutoff may be used if the exact binomial test shows that it
rejects less than `risk` of good documents, that is, if the Clopper-Pearson upper bound of the
false rejection rate lies at or below `risk`. Tests of a rule in a stratum run from the mildest
cutoff to the strictest and stop at the first failure (fixed-sequence testing, which needs no
further correction); the error `alpha` is divided by the number of rules and strata (Bonferroni),
so with probability 1 - alpha no chosen cutoff anywhere breaks its limit. The risk of all rules
together is at most the sum of theirs, so each gets `risk` / rules. A stratum with too few
labelled documents for a proof gets no cutoff and loses nothing.

Counts for the tests cover all labelled documents; one row for each stratum, rule and cutoff is left
of them, and only cutoffs are joined back. Features are counted once and kept in the shared folder.

Defined results: a null or empty text has no words and fails the base rule. A null stratum is one
of its own. Labels without a document, null labels and null ids are not used; a document with
several labels counts once for each. Repeated rows are judged alike. Without labels every document
that passes the base rule is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritide.llm.shared import cut

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 3


def features(text: bytes | None) -> tuple[int, int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated windows, and lines with a word."""
    text = text or b""
    words = text.split()  # bytes: ASCII white space only
    inside = b"".join(words)
    chars = len(inside) if inside.isascii() else len(inside.decode("utf-8", "replace"))
    symbols = len(inside) - len(inside.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    n = len(words)
    repeated = 0
    if n > WINDOW:
        first: dict = {}
        ids = np.fromiter((first.setdefault(w, len(first)) for w in words), np.int64, n)
        keys = ids[:-2]
        for shift in (1, 2):  # numbers for windows, made dense again after each step so that they can't overflow
            keys = np.unique(keys * len(first) + ids[shift : n - 2 + shift], return_inverse=True)[1]
        twice = np.bincount(keys)[keys] > 1
        covered = np.zeros(n, bool)
        for shift in range(WINDOW):
            covered[shift : n - 2 + shift] |= twice
        repeated = int(covered.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


def measure(docs: DataFrame, keep: list[str | Column], text_col: str = "text") -> DataFrame:
    """keep, the five counts and n_lines for each row of docs."""
    kept = docs.select(*keep)
    names = [*kept.columns, *COUNTS, "n_lines"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([features(x.as_py()) for x in batch.column(batch.num_columns - 1)], np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(rows[:, i]) for i in range(6))], names)

    schema = kept.schema
    for name in names[len(schema) :]:
        schema = schema.add(name, "long")
    return docs.select(*keep, F.col(text_col).cast("binary").alias("_text_of_row")).mapInArrow(run, schema)


#: A rule's value and its cutoffs from the mildest to the strictest.
RULES: dict[str, tuple[Column | str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05)),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "repeat_words": ("n_repeat_words / greatest(n_words, 1)", (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1)),
    "long_words": ("word_chars / greatest(n_words, 1)", (40.0, 30.0, 20.0, 15.0, 12.0, 10.0, 9.0, 8.0)),
    "short_words": ("-word_chars / greatest(n_words, 1)", (-1.5, -2.0, -2.5, -3.0, -3.5, -4.0, -4.5, -5.0)),
}


def log_binomial_tail(k: str, n: str, p: float) -> Column:
    """log P(X <= k) for X binomial(n, p), summed in logarithms; 0 (no proof) at once where k / n is p or more."""
    step = (
        f"aggregate(sequence(1L, {k}), named_struct('t', {n} * ln(1 - {p}D), 's', {n} * ln(1 - {p}D)), "
        f"(a, i) -> named_struct('t', a.t + ln(({n} - i + 1) / i) + ln({p}D / (1 - {p}D)), "
        f"'s', greatest(a.s, a.t + ln(({n} - i + 1) / i) + ln({p}D / (1 - {p}D))) + ln(1 + exp(-abs(a.s - (a.t + ln(({n} - i + 1) / i) + ln({p}D / (1 - {p}D))))))), a -> a.s)"
    )
    return F.expr(f"CASE WHEN {k} >= {p}D * {n} THEN 0D WHEN {k} = 0 THEN {n} * ln(1 - {p}D) ELSE {step} END")


def thresholds(measured: DataFrame, good: Column, stratum: str, risk: float, alpha: float, rules: dict = RULES) -> DataFrame:
    """(stratum, rule, cutoff): the strictest cutoff proved for each rule and stratum. measured: labelled documents."""
    counts = []
    for name, (value, cutoffs) in rules.items():
        counts += [F.count_if(F.expr(value) > c).alias(f"{name}_{i}") for i, c in enumerate(cutoffs)]
    wide = measured.where(good).groupBy(F.col(stratum).alias("stratum")).agg(F.count("*").alias("n"), *counts)
    tests = F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(i).alias("i"), F.lit(c).alias("cutoff"), F.col(f"{name}_{i}").alias("k")) for name, (_, cs) in rules.items() for i, c in enumerate(cs)))
    each = risk / len(rules)
    tested = (
        wide.withColumn("strata", F.count("*").over(Window.partitionBy()))
        .select("stratum", "n", "strata", F.explode(tests).alias("t"))
        .select("stratum", "n", "strata", "t.*")
        .withColumn("proved", log_binomial_tail("k", "n", each) <= F.log(F.lit(alpha) / (len(rules) * F.col("strata"))))
    )
    before = Window.partitionBy("stratum", "rule").orderBy("i")
    unbroken = tested.withColumn("ok", F.min(F.col("proved").cast("int")).over(before) == 1).where("ok")
    return unbroken.groupBy("stratum", "rule").agg(F.max_by("cutoff", "i").alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang", risk: float = 0.05, alpha: float = 0.05, min_words: int = 50, max_repeat_percent: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the counts, base_failed, kept) for each row of docs. labels: (doc_id, quality), good is 1."""
    rows = cut(measure(docs, [F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col(stratum_col)), F.lit("")).alias("stratum")], text_col), "features")
    rows = rows.withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
    labelled = rows.where("not base_failed").join(labels.select(F.col(id_col).alias("doc_id"), "quality"), "doc_id")
    chosen = thresholds(labelled, F.col("quality") == 1, "stratum", risk, alpha)
    cutoffs = chosen.groupBy("stratum").agg(*(F.max(F.when(F.col("rule") == name, F.col("cutoff"))).alias(f"max_{name}") for name in RULES))
    breaks = [F.coalesce(F.expr(value) > F.col(f"max_{name}"), F.lit(False)) for name, (value, _) in RULES.items()]
    broken = breaks[0]
    for b in breaks[1:]:
        broken = broken | b
    found = rows.join(cutoffs, "stratum", "left")
    return found.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & ~broken).alias("kept"))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    read = spark.read.parquet
    return judge(read(f"{sf_dir}/documents.parquet"), read(f"{sf_dir}/labels.parquet"))


def _op10_sql() -> str:
    k = 0
    picks, tests = [], []
    for name, (value, cutoffs) in RULES.items():
        for i, c in enumerate(cutoffs):
            picks.append(f"count(*) FILTER (WHERE {value} > {c}) AS k{k}")
            tests.append(f"SELECT stratum, n, strata, '{name}' AS rule, {i} AS i, {c}::DOUBLE AS cutoff, k{k} AS k FROM wide")
            k += 1
    p = 0.05 / len(RULES)
    limits = ", ".join(f"max(cutoff) FILTER (WHERE rule = '{n}' AND i = top) AS max_{n}" for n in RULES)
    broken = " OR ".join(f"coalesce({value} > max_{n}, false)" for n, (value, _) in RULES.items())
    return f"""
WITH d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS stratum, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), dup AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1
), rep AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM dup, (SELECT unnest([0, 1, 2]) AS o) GROUP BY doc_id
), ln AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
), m AS (
  SELECT doc_id, stratum, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN ln USING (doc_id)
), f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
), wide AS (
  SELECT stratum, count(*) AS n, count(*) OVER () AS strata, {", ".join(picks)}
  FROM f JOIN labels USING (doc_id) WHERE NOT base_failed AND quality = 1 GROUP BY stratum
), tests AS ({" UNION ALL ".join(tests)}
), tested AS (
  SELECT *, CASE WHEN k >= {p} * n THEN 1 ELSE list_sum(list_transform(range(k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln(1 - {p})))) END
    <= 0.05 / ({len(RULES)} * strata) AS proved FROM tests
), unbroken AS (SELECT *, min(proved::INT) OVER (PARTITION BY stratum, rule ORDER BY i) AS ok FROM tested
), top AS (SELECT *, max(i) OVER (PARTITION BY stratum, rule) AS top FROM unbroken WHERE ok = 1
), cutoffs AS (SELECT stratum, {limits} FROM top GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({broken}) AS kept
FROM f LEFT JOIN cutoffs USING (stratum)
"""


OP10_SQL = _op10_sql()
