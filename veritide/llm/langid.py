"""Language identification with hyperdimensional profiles.

Every letter has a random vector of signs, drawn from a generator seeded by its code point. A
trigram binds its letters' vectors, permuted by their place (rotated twice, once, not at all), by
elementwise product. A text's profile is the bundle (sum) of its trigrams' vectors, and a language's
prototype the bundle of the unit profiles of its training texts. A text gets the language whose
prototype has the greatest cosine with its profile; ties go to the first in code point order.

Prototypes are summed on Spark: a task adds up its texts, and one row for each task, language and
dimension is aggregated. What reaches the driver is one vector for each language; more than
`max_languages` labels are an error, as labels are then no languages.

Defined results: texts are lower-cased, runs of other characters than letters become one space, and
a space stands at both ends, so every text with a letter has a trigram. Null texts and texts
without letters are `und` with score 0, as is every text where nothing could be learned. Rows with
a null label teach nothing. Repeated rows and null ids are predicted like others. Scores are
cosines, negative ones 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from veritide.llm.shared import columns, trimmed

DIMENSIONS, UNKNOWN = 1024, "und"
#: Texts are handled in groups of so many code points, longer ones in pieces of that many; and so many rows at once.
PIECE, ROWS = 1 << 18, 512
#: Trigram vectors kept in a worker, a byte for each dimension, and those that are multiplied at once.
KEPT, STEP = 1 << 15, 1 << 12


class Encoder:
    """Turns texts into unit profiles."""

    def __init__(self, dimensions: int = DIMENSIONS) -> None:
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self.bound: dict[int, int] = {}
        self.vectors = np.zeros((256, dimensions), np.int8)
        self.known = np.zeros(0x110000, np.int8)  # of code points: 1 letter, 2 other, 0 not seen yet

    def _letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            self.letters[point] = np.random.default_rng(point).integers(0, 2, self.dimensions, dtype=np.int8) * 2 - 1
        return self.letters[point]

    def _rows(self, keys: np.ndarray) -> np.ndarray:
        if len(self.bound) + len(keys) > KEPT:
            self.bound.clear()
        found = np.empty(len(keys), np.int64)
        for i, key in enumerate(keys.tolist()):
            at = self.bound.get(key)
            if at is None:
                at = self.bound[key] = len(self.bound)
                if at >= len(self.vectors):
                    self.vectors = np.concatenate((self.vectors, np.zeros_like(self.vectors)))
                a, b, c = key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF
                self.vectors[at] = np.roll(self._letter(a), 2) * np.roll(self._letter(b), 1) * self._letter(c)
            found[i] = at
        return self.vectors[found]

    def _pieces(self, text: str) -> Iterator[np.ndarray]:
        """Code points of the letters, with single spaces between and around, in pieces; each begins with the last two points of the one before, so all trigrams are in one."""
        lowered, carried = text.lower(), np.array([32], np.uint32)
        for i in range(0, len(lowered), PIECE):
            points = np.frombuffer(lowered[i : i + PIECE].encode("utf-32-le", "surrogatepass"), "<u4")
            kind = self.known[points]
            if (kind == 0).any():
                for p in np.unique(points[kind == 0]).tolist():
                    self.known[p] = 1 if chr(p).isalpha() else 2
                kind = self.known[points]
            last = np.array([32] * (i + PIECE >= len(lowered)), np.uint32)
            points = np.concatenate((carried, np.where(kind == 1, points, np.uint32(32)), last))
            points = points[np.concatenate(([True], (points[1:] != 32) | (points[:-1] != 32)))]
            yield points
            carried = points[-2:]

    def _bundle(self, group: list[tuple[int, np.ndarray]], sums: np.ndarray) -> None:
        """Adds the trigram vectors of (row, trigrams) to the rows of sums."""
        keys = np.concatenate([k for _, k in group])
        found, place = np.unique(keys, return_inverse=True)
        rows = np.repeat(np.arange(len(group)), [len(k) for _, k in group])
        for i in range(0, len(found), STEP):
            inside = (place >= i) & (place < i + STEP)
            width = min(STEP, len(found) - i)
            counts = np.bincount(rows[inside] * width + place[inside] - i, minlength=len(group) * width).reshape(len(group), width)
            np.add.at(sums, [r for r, _ in group], counts.astype(np.float32) @ self._rows(found[i : i + width]).astype(np.float32))

    def profiles(self, texts: list[str | None]) -> np.ndarray:
        """A row for each text: its profile with length 1, or zeros."""
        sums, group, held = np.zeros((len(texts), self.dimensions), np.float32), [], 0
        for row, text in enumerate(texts):
            for p in self._pieces(text or ""):
                if len(p) < 3:
                    continue
                q = p.astype(np.int64)
                group.append((row, q[:-2] << 42 | q[1:-1] << 21 | q[2:]))
                held += len(q)
                if held >= PIECE or len(group) >= 64:
                    self._bundle(group, sums)
                    group, held = [], 0
        if group:
            self._bundle(group, sums)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        sums /= np.where(length > 0, length, 1)
        return sums


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, ROWS):
        yield batch.slice(i, ROWS)


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS, max_languages: int = 1000) -> dict[str, np.ndarray]:
    """Prototype of each language, of length 1, from all rows with a text and a label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sums = Encoder(dimensions), {}
        for batch in (part for whole in batches for part in slices(whole)):
            langs = np.array(batch.column(0).to_pylist(), object)
            vectors = encoder.profiles(batch.column(1).to_pylist())
            for lang in sorted(set(langs)):
                sums[lang] = sums.get(lang, 0) + vectors[langs == lang].sum(axis=0, dtype=np.float64)
        for lang, total in sums.items():
            # rounded to a fixed grid, so that the order in which tasks are added does not matter
            yield pa.RecordBatch.from_pydict({"lang": [lang] * dimensions, "dim": np.arange(dimensions, dtype=np.int32), "x": np.rint(total * 2**24).astype(np.int64)})

    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string"), text_col)
    parts = rows.mapInArrow(trimmed(run), "lang string, dim int, x long").groupBy("lang", "dim").agg(F.sum("x").alias("x"))
    found = parts.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "x"))).alias("v")).limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} labels: not languages")
    out = {r["lang"]: np.array([v["x"] for v in r["v"]], float) for r in found}
    return {k: (v / np.linalg.norm(v)).astype(np.float32) for k, v in sorted(out.items()) if v.any()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: list[str | Column], text_col: str = "text", dimensions: int = DIMENSIONS, inside: bool = False) -> DataFrame:
    """keep, lang_pred and score for each row of docs. inside: keep is one struct that has the text, which then doesn't travel twice."""
    kept = docs.select(*keep)
    names, langs = kept.columns, sorted(prototypes)
    matrix = np.array([prototypes[k] for k in langs], np.float32).reshape(len(langs), dimensions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(dimensions)
        for batch in (part for whole in batches for part in slices(whole)):
            texts = batch.column(0).field(text_col) if inside else batch.column(batch.num_columns - 1)
            vectors = encoder.profiles(texts.to_pylist())
            own = vectors.any(axis=1)
            if langs:
                cosines = vectors @ matrix.T
                best = cosines.argmax(axis=1)
                score = np.clip(cosines[np.arange(len(best)), best], 0, 1).astype(float)
            else:
                own[:], best, score = False, np.zeros(len(own), int), np.zeros(len(own))
            found = [langs[b] if x else UNKNOWN for b, x in zip(best.tolist(), own.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(found, pa.string()), pa.array(np.where(own, np.round(score, 6), 0.0))], [*names, "lang_pred", "score"])

    schema = StructType([*kept.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    rows = kept if inside else docs.select(*keep, F.col(text_col).cast("string").alias("_text_of_row"))
    return rows.mapInArrow(trimmed(run), schema)


def held_out(id_col: str, parts: int = 3, part: int = 1) -> Column:
    """Whether a row is kept from learning: the CRC-32 of its id as text, modulo parts. Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def least_score(docs: DataFrame, prototypes: dict[str, np.ndarray], share: float = 0.2) -> float:
    """share of the median score of labelled documents that were held out; 0 if there are none. Scores are counted by their first three places, at most 1001 rows."""
    rows = docs.where(held_out("doc_id") & F.col("lang").isNotNull())
    counts = predict(rows, prototypes, []).where(F.col("lang_pred") != UNKNOWN).groupBy(F.round("score", 3).alias("score")).count().orderBy("score").collect()
    half, seen = sum(r["count"] for r in counts) / 2, 0
    for r in counts:
        seen += r["count"]
        if seen >= half:
            return share * r["score"]
    return 0.0


def keep_known(docs: DataFrame, min_score: float | None = None, short: int = 64) -> DataFrame:
    """docs without those whose language cannot be told: no letters, or a cosine of min_score or less with the best prototype.

    Without min_score that is least_score: texts of unknown languages and random letters have cosines of up
    to a fifth of those of learned languages. Texts of fewer than `short` letters have few trigrams
    and lower cosines, which grow with the root of their number, and so does the least score for them.
    """
    prototypes = learn(docs.where(~held_out("doc_id")))
    least = least_score(docs, prototypes) if min_score is None else min_score
    found = predict(docs, prototypes, [F.struct(*columns(docs)).alias("row_in")], inside=True)
    if min_score is not None:
        known = F.col("score") > least
    else:
        letters = F.length(F.regexp_replace("row_in.text", r"[^\p{L}]+", " "))
        known = F.when(F.col("score") > least, True).otherwise(F.col("score") > least * F.sqrt(F.least(letters, F.lit(short)) / short))
    return found.where((F.col("lang_pred") != UNKNOWN) & known).select("row_in.*")


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prototypes = learn(docs.where(~held_out("doc_id")))
    return predict(docs, prototypes, ["doc_id", held_out("doc_id").alias("held_out")])
