"""Personal data by boosted trees over candidate spans.

Base rules give spans that always stay. High-recall generators propose more, which may overlap:
spelled-out addresses, numbers in other formats, long tokens. Boosted trees score a candidate by
its format (lengths, shares of digits and letters, groups, check digits, octets, entropy) and context
(words that tell of a kind, digits and signs within AROUND code points on its line); a candidate is redacted if its score passes its kind's threshold and it
overlaps no base span and no candidate with a better score.

Training takes the candidates of all documents. Positive are base spans, also rewritten into the formats that
base rules miss, and tokens that are assigned to a name such as `token` or `key`; negative are other
candidates and base spans with a broken check. The trees learn from two thirds of them: tasks add up gradients by
node, feature and bin, and a level is grown from the sums, which are whole numbers and so don't depend on partitions. Bins come from
counts of all values. Thresholds come from the other third, which the trees don't see: of all its rows,
counted by score, the least score from which `precision` is reached; a kind without `least` positives there gets no candidate accepted.

Spans are (kind, start, end) in code points, end exclusive. Defined results: a null text counts as
empty. Empty tables and tables without candidates train no trees, and base spans alone remain.
Repeated rows and null ids are searched like others. Base rules run in time linear in the text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritide.llm.ranks import seeded
from veritide.llm.shared import cut, forget, trimmed

BASE_KINDS, SECRET = ("email", "ip", "card", "phone"), "secret"
KINDS = (*BASE_KINDS, SECRET)
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits is tried from its first digit only: from later ones the outcome is the same
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base rules' spans by kind as listed, then start."""
    out = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append(("email", start, end))
        else:
            end = max(end, at + 1)
        at = text.find("@", max(at + 1, end if m else 0))
    if any(c in text for c in "0123456789"):
        out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p := part.lstrip("0")) < 4 and int(p or "0") < 256 for part in m[0].split("."))]
        out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


_AT, _DOT = r"(?:@|\x20?[\[(]at[\])]\x20?|\x20at\x20)", r"(?:\.|\x20?[\[(]dot[\])]\x20?|\x20dot\x20)"
GENERATORS = (
    ("email", re.compile(rf"[A-Za-z0-9._%+-]{{1,64}}{_AT}[A-Za-z0-9-]{{1,64}}(?:{_DOT}[A-Za-z0-9-]{{2,64}}){{1,4}}")),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){2,5}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{2,6}(?:[\x20._/-]{0,2}[0-9]{2,6}){2,6}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])(?:\+|\(|00)?[0-9]{1,4}\)?(?:[\x20./-]{0,2}\(?[0-9]{2,5}\)?){1,5}(?![0-9])")),
    (SECRET, re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,200}(?![A-Za-z0-9_-])")),
)
LEAST_DIGITS = {"email": 0, "ip": 3, "card": 12, "phone": 7, SECRET: 1}
MOST_DIGITS = {"card": 19, "phone": 15}
#: Candidates that are scored together.
GROUP = 4096
#: Context: code points on either side that features look at, and words there that tell of a kind.
AROUND = 24
CUES = tuple(re.compile(p, re.IGNORECASE) for p in (r"mail|contact|write\x20to", r"\bip\b|address|host|server|network", r"card|visa|credit|payment|account", r"phone|\btel|\bcall|mobile|\bfax", r"version|\bv\.?\x20?$|release|isbn|doi"))
#: Names whose assigned tokens are positive in training; not a feature.
NAMES = re.compile(r"(?:token|key|secret|password|passwd)[\x20\"']{0,2}[=:][\x20\"']{0,2}$", re.IGNORECASE)
HINT = re.compile(r"[0-9@]|[\[(]at[\])]|\x20at\x20[A-Za-z0-9-]+\x20dot\x20")


def candidates(text: str) -> list[tuple[str, int, int]]:
    if not HINT.search(text):
        return []
    return [(kind, *m.span()) for kind, pattern in GENERATORS for m in pattern.finditer(text) if LEAST_DIGITS[kind] <= len(_digits(m[0])) <= MOST_DIGITS.get(kind, 1000)]


def describe(text: str, kind: str, start: int, end: int) -> list[float]:
    """Features of a candidate."""
    s = text[start:end]
    digits, groups = _digits(s), re.findall(r"[0-9]+", s)
    before, after = text[start - 1 : start] if start else "", text[end : end + 1]
    letters = sum(c.isalpha() for c in s)
    left, right = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    near = left.rsplit("\n", 1)[-1] + " " + right.split("\n", 1)[0]
    entropy = -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())
    return [
        *(float(kind == k) for k in KINDS),
        len(s), len(digits), len(digits) / len(s), letters / len(s), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        float(s[0] == "+"), float("@" in s), float(bool(re.search(r"\bat\b", s))), float(bool(re.search(r"\bdot\b", s))), s.count("."), s.count("-") + s.count(" "),
        float(len(digits) > 1 and luhn(digits)), float(max((int(g[:6]) for g in groups), default=0) < 256), entropy, len(set(s)) / len(s),
        float(before.isalnum()), float(after.isalnum()), float(before in ("'", '"', "=", ":") and before != ""), float(after in ("'", '"') and after != ""),
        float(bool(re.fullmatch(r"[0-9a-fA-F]+", s))), float(s != s.lower() and s != s.upper()),
        *(float(bool(cue.search(near))) for cue in CUES), float(bool(re.search(r"[=:]\W{0,3}$", left))),
        len(_digits(left)), len(_digits(right)), float(left[-1:].isspace() or not left), float(right[:1].isspace() or not right),
    ]


class Taken:
    """Places of a text that spans cover: a byte for each, so that any number of spans takes time and memory in proportion to the text."""

    def __init__(self, length: int, spans: list[tuple[str, int, int]] = ()) -> None:
        self.places = bytearray(length)
        for s in spans:
            self.add(s)

    def add(self, span: tuple[str, int, int]) -> None:
        self.places[span[1] : span[2]] = b"\1" * (span[2] - span[1])

    def __contains__(self, span: tuple[str, int, int]) -> bool:
        return self.places.find(1, span[1], span[2]) >= 0


def _variants(kind: str, s: str) -> list[tuple[str, int]]:
    """Rewritten forms of a base span and whether they are still personal data."""
    if kind == "email":
        local, _, domain = s.partition("@")
        return [(f"{local} at {domain.replace('.', ' dot ')}", 1), (f"{local}[at]{domain.replace('.', '[dot]')}", 1)]
    d = _digits(s)
    if kind == "card":
        broken = d[:-1] + str((int(d[-1]) + 5) % 10)
        return [(".".join(d[i : i + 4] for i in range(0, len(d), 4)), 1), ("  ".join(d[i : i + 4] for i in range(0, len(d), 4)), 1), (broken, 0), (".".join(broken[i : i + 4] for i in range(0, len(d), 4)), 0)]
    if kind == "phone" and len(d) >= 10:
        return [(f"({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}", 1), (f"{d[-10:-7]}-{d[-7:-4]}-{d[-4:]}", 1), (d[-7:], 0), (f"{d[-4:]}-{d[:2]}-{d[2:4]}", 0)]
    if kind == "ip":
        return [(s + "9" * 3, 0), (s.rsplit(".", 1)[0], 0)]
    return []


def each_example(text: str) -> Iterator[tuple[int, list[float]]]:
    """(label, features) of the candidates of a text, as weak rules see them."""
    base = base_spans(text)
    for kind, start, end in base:
        yield 1, describe(text, kind, start, end)
        for variant, label in _variants(kind, text[start:end]):
            at = min(AROUND, start)
            other = text[start - at : start] + variant + text[end : end + AROUND]
            yield label, describe(other, kind, at, at + len(variant))
    covered = Taken(len(text), base)
    for c in candidates(text):
        if c not in covered:
            yield int(c[0] == SECRET and bool(NAMES.search(text[max(0, c[1] - 24) : c[1]]))), describe(text, *c)


def examples(text: str) -> list[tuple[int, list[float]]]:
    return list(each_example(text))


#: Trees see a feature in steps of 1 / STEPS, rounded up, at most MOST of them, in at most BINS bins; sums count in units of 1 / UNIT.
STEPS, MOST, BINS, UNIT = 256, 65_535, 32, 1 << 30
#: Levels of a unit of log odds in which scores are counted for the thresholds.
LEVELS = 256
#: Rows of a partition that trees learn from.
PART = 100_000
#: A split sends rows beyond its value right: feature, value, bin.
Split = tuple[int, float, int]


def _descend(n: int, splits: dict[int, Split | None], depth: int, beyond: Callable[[Split], np.ndarray]) -> np.ndarray:
    """The node of each of n rows at a depth, numbered from the left."""
    node = np.zeros(n, np.int16)
    for level in range(depth):
        new = 2 * node
        for i in range(2**level):
            if split := splits[2**level - 1 + i]:
                new += (node == i) & beyond(split)
        node = new
    return node


def _share(log_odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-log_odds))


class Trees:
    """Gradient-boosted regression trees on the logistic loss, grown level by level over binned features."""

    def __init__(self, prior: float, depth: int = 3) -> None:
        self.prior, self.depth, self.trees = prior, depth, []

    def _log_odds(self, n: int, beyond: Callable[[Split], np.ndarray]) -> np.ndarray:
        score = np.full(n, self.prior)
        for splits, values in self.trees:
            score += values[_descend(n, splits, self.depth, beyond)]
        return score

    def predict(self, x: np.ndarray) -> np.ndarray:
        return _share(self._log_odds(len(x), lambda s: x[:, s[0]] > s[1]))

    def log_odds(self, codes: np.ndarray) -> np.ndarray:
        """codes: bins, a row for each feature."""
        return self._log_odds(codes.shape[1], lambda s: codes[s[0]] > s[2])


def _packed(x: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values of one length."""
    x, width = np.ascontiguousarray(x), x.shape[1] * x.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.arange(len(x) + 1, dtype=np.int32) * np.int32(width)), pa.py_buffer(x)])


def _unpacked(column: pa.Array, dtype: type) -> np.ndarray:
    """What _packed() took, with a row for each feature."""
    if not len(column):
        return np.zeros((0, 0), dtype)
    column = column.cast(pa.binary())
    first = int(np.frombuffer(column.buffers()[1], np.int32)[column.offset])
    width = len(column[0].as_py()) // np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(column.buffers()[2], dtype, len(column) * width, first).reshape(len(column), width).T)


def _example_rows(docs: DataFrame, seed: int, id_col: str, text_col: str) -> DataFrame:
    """(fold, label, x): a row for each example of all documents; the trees don't see fold true."""
    key = seeded(seed, id_col, F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    hinted = docs.where(F.col(text_col).rlike(HINT.pattern)).select(F.col(text_col).alias("text"), key.alias("key"))  # no other text has an example

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = ((t.as_py(), k.as_py()) for batch in batches for t, k in zip(batch.column(0), batch.column(1), strict=True))
        rows = ((int(hashlib.md5(f"{k}:{i}".encode()).hexdigest()[:8], 16) % 3 == 0, label, x) for t, k in texts for i, (label, x) in enumerate(each_example(t)))
        while part := list(islice(rows, GROUP)):
            folds, labels, x = zip(*part, strict=True)
            steps = np.minimum(np.ceil(np.array(x) * STEPS), MOST).astype(np.uint16)
            yield pa.RecordBatch.from_arrays([pa.array(folds, pa.bool_()), pa.array(labels, pa.int64()), _packed(steps)], ["fold", "label", "x"])

    return hinted.mapInArrow(trimmed(run), "fold boolean, label long, x binary")


def _edges(rows: DataFrame) -> list[np.ndarray]:
    """Bounds of each feature's bins, in steps: all its values but the last if these are few, else quantiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for j, values in enumerate(_unpacked(batch.column(0), np.uint16)):
                found, n = np.unique(values, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), j), pa.int64()), pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))], ["feature", "step", "n"])

    counted = rows.select("x").mapInArrow(run, "feature long, step long, n long").groupBy("feature", "step").agg(F.sum("n").alias("n")).toArrow()
    feature, step, n = (counted[c].to_numpy() for c in ("feature", "step", "n"))
    out = []
    for j in range(int(feature.max()) + 1):
        order = np.argsort(step[feature == j])
        values, upto = step[feature == j][order], n[feature == j][order].cumsum()
        few = len(values) <= BINS
        out.append(values[:-1] if few else np.setdiff1d(values[np.searchsorted(upto * BINS, upto[-1] * np.arange(1, BINS))], values[-1:]))
    return out


def _binned(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = np.stack([np.searchsorted(e, v).astype(np.uint8) for e, v in zip(edges, _unpacked(batch.column(2), np.uint16), strict=True)], axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _packed(codes)], ["fold", "label", "x"])

    return rows.mapInArrow(run, "fold boolean, label long, x binary")


def _sums(rows: DataFrame, trees: Trees, splits: dict[int, Split | None], level: int, features: int) -> np.ndarray:
    """Gradients and second derivatives of all rows by node of the level, feature and bin, in whole units."""
    shape = (2, 2**level, features, BINS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(shape, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = _unpacked(batch.column(1), np.uint8)
            p = _share(trees.log_odds(codes))
            parts = np.rint((p - batch.column(0).to_numpy()) * UNIT), np.rint(p * (1 - p) * UNIT)
            at = _descend(len(p), splits, level, lambda s: codes[s[0]] > s[2]) * BINS
            for j, own in enumerate(codes):
                for k, part in enumerate(parts):
                    sums[k, :, j] += np.bincount(at + own, part, 2**level * BINS).astype(np.int64).reshape(-1, BINS)
        g, h = sums.reshape(2, -1)
        held = np.flatnonzero((g != 0) | (h != 0))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (held, g[held], h[held])], ["cell", "g", "h"])

    found = rows.select("label", "x").mapInArrow(run, "cell long, g long, h long").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    out = np.zeros((2, math.prod(shape[1:])))
    out[:, found["cell"].to_numpy()] = found["g"].to_numpy() / UNIT, found["h"].to_numpy() / UNIT
    return out.reshape(shape)


def boost(rows: DataFrame, edges: list[np.ndarray], share: float, rounds: int = 40, depth: int = 3, rate: float = 0.3, least: float = 2.0) -> Trees:
    """Trees from all rows (label, x: bins); share: of them, with label 1."""
    share = min(max(share, 1e-3), 1 - 1e-3)
    trees = Trees(math.log(share / (1 - share)), depth)
    for _ in range(rounds):
        splits, values = {}, []
        for level in range(depth):
            for i, (g, h) in enumerate(_sums(rows, trees, splits, level, len(edges)).cumsum(axis=3).swapaxes(0, 1)):
                gain = g[:, :-1] ** 2 / (h[:, :-1] + 1) + (g[:, -1:] - g[:, :-1]) ** 2 / (h[:, -1:] - h[:, :-1] + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                gain[(h[:, :-1] < least) | (h[:, -1:] - h[:, :-1] < least)] = 0
                j, k = np.unravel_index(gain.argmax(), gain.shape)
                found = gain[j, k] > 1e-6
                splits[2**level - 1 + i] = (int(j), float(edges[j][k]) / STEPS, int(k)) if found else None
                if level == depth - 1:
                    left = (g[j, k], h[j, k]) if found else (g[0, -1], h[0, -1])
                    values += [rate * -left[0] / (left[1] + 1), rate * -(g[0, -1] - left[0]) / (h[0, -1] - left[1] + 1)]
        trees.trees.append((splits, np.array(values)))
    return trees


def calibrate(rows: DataFrame, trees: Trees, precision: float, least: int) -> dict[str, float]:
    """The least score of each kind, at a level, from which the precision of all better scores of rows is reached; 2 if there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = _unpacked(batch.column(1), np.uint8)
                kind = codes[: len(KINDS)].argmax(axis=0)
                level = np.floor(trees.log_odds(codes) * LEVELS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(level), batch.column(0)], ["kind", "level", "label"])

    found = rows.select("label", "x").mapInArrow(run, "kind long, level long, label long").groupBy("kind", "level").agg(F.sum("label").alias("hits"), F.count("*").alias("n")).toArrow()
    kind, level, hits, n = (found[c].to_numpy() for c in ("kind", "level", "hits", "n"))
    out = {}
    for k, name in enumerate(KINDS):
        own = np.flatnonzero(kind == k)
        own = own[np.argsort(-level[own])]
        hit, all_ = hits[own].cumsum(), n[own].cumsum()
        good = np.flatnonzero((hit >= least) & (hit >= precision * all_))
        out[name] = float(_share(level[own[good[-1]]] / LEVELS)) if len(good) else 2.0
    return out


def train(docs: DataFrame, precision: float = 0.97, least: int = 20, seed: int = 1, rounds: int = 40, id_col: str = "doc_id", text_col: str = "text") -> tuple[Trees | None, dict[str, float]]:
    """Trees and thresholds from all docs."""
    rows = cut(_example_rows(docs, seed, id_col, text_col), "pii-examples")
    counts = {r["fold"]: (r["n"], r["hits"]) for r in rows.groupBy("fold").agg(F.count("*").alias("n"), F.sum("label").alias("hits")).collect()}
    n, hits = (sum(c[i] for c in counts.values()) for i in (0, 1))
    if len(counts) < 2 or hits in (0, n):
        forget(rows)
        return None, {}
    edges = _edges(rows.where("not fold"))
    binned = _binned(rows, edges)
    seen, held = (cut(binned.where(F.col("fold") == f).coalesce(-(-counts[f][0] // PART)), "pii-bins") for f in (False, True))
    forget(rows)
    trees = boost(seen, edges, counts[False][1] / counts[False][0], rounds)
    thresholds = calibrate(held, trees, precision, least)
    forget(seen)
    forget(held)
    return trees, thresholds


def find(text: str, trees: Trees | None, thresholds: dict[str, float]) -> tuple[list, list]:
    """Base spans, and all spans: by kind as listed, then start."""
    base = base_spans(text)
    found = candidates(text) if trees else []
    chosen: list = []
    if found:
        taken = Taken(len(text), base)
        more = [c for c in found if c not in taken]
        for i in range(0, len(more), GROUP):  # features of so many candidates are held at once
            part = more[i : i + GROUP]
            scores = trees.predict(np.array([describe(text, *c) for c in part]))
            chosen += [(s, c) for s, c in zip(scores.tolist(), part, strict=True) if s >= thresholds[c[0]]]
        ranked, chosen = sorted(chosen, key=lambda z: (-z[0], z[1][1], z[1])), []
        for _, c in ranked:
            if c not in taken:
                taken.add(c)
                chosen.append(c)
    return base, sorted(base + chosen, key=lambda c: (KINDS.index(c[0]), c[1]))


def detect(docs: DataFrame, trees: Trees | None, thresholds: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans): arrays of (kind, first, stop) for each row of docs."""
    span = pa.struct([("kind", pa.string()), ("first", pa.int64()), ("stop", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [find(x.as_py() or "", trees, thresholds) for x in batch.column(1)]
            cols = [pa.array([[dict(zip(("kind", "first", "stop"), c, strict=True)) for c in r[k]] for r in rows], pa.list_(span)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", "base", "spans"])

    kind = "array<struct<kind:string,first:bigint,stop:bigint>>"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, base {kind}, spans {kind}")


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """text with each span replaced by its kind; of overlapping spans the first rules."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda c: (c[1], -c[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def op5_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = detect(docs, *train(docs))
    joined = lambda name: F.array_join(F.transform(name, lambda c: F.concat_ws(":", c["kind"], c["first"], c["stop"])), ",")
    kinds = F.transform("base", lambda c: c["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
