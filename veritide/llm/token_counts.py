"""Token counts by dynamic programming over prefixes, for byte-level BPE with word ends.

Adjacent tokens can follow each other in a BPE encoding if and only if no merge crosses their border
while either is being built. So the encoding of a prefix ends in the one token that is compatible
with the last token of the shorter prefix before it, and the count of every prefix follows from
the counts of shorter ones. One pass over a word gives the exact count of each of its prefixes, in
time linear in its length; a text's counts are running sums over its words. Truncation and budget
questions (`longest`) read these counts and encode nothing again.

Words, the special strings and the merges come from the tokenizer file; counts equal the
tokenizers library's without added special tokens. Characters beyond Latin letters are normalised
and split by the library's own steps, since these follow its Unicode tables.

Defined results: a null text counts as empty: 0 bytes, 0 tokens. Rows with null or repeated ids are
counted like others. Texts are never cut or truncated, whatever their length.
"""

from __future__ import annotations

import json
import re
import sys
import types
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words a worker remembers; the memory is emptied when full.
REMEMBERED = 500_000
#: Longer words and prefixes are worked out anew, so that memory is linear in a word.
REMEMBERED_LENGTH = 64
END = "</w>"


def byte_letters() -> list[str]:
    """The printable letter that byte-level BPE writes for each byte: its own where Latin-1 prints it, else one from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class PrefixCounter:
    """Exact token counts of words and texts at every prefix."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != END:
            raise ValueError("a BPE model with word ends is needed")
        self.rank = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.vocab = model["vocab"]
        self.longest_token = max(map(len, self.vocab))
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(split)
        self.special = re.compile("|".join(sorted((re.escape(t["content"]) for t in spec["added_tokens"]), key=len, reverse=True)) or r"(?!)")
        self.plain = re.compile("[^\t-\r\x20-\x7e\xa1-įı-ɏ]")  # a character that needs the library's Unicode steps
        self.letters = byte_letters()
        self.spines: dict[str, tuple | None] = {}
        self.after: dict[str, dict[str, bool]] = {}
        self.pairs = 0  # in self.after
        self.states: dict[str, tuple[str, int]] = {}
        self.ends = {t[: -len(END)]: t for t in self.vocab if t.endswith(END) and len(t) > len(END)}
        self.words: dict[str, int] = {}
        self.chunks: dict[str, int] = {}

    def _spine(self, token: str) -> tuple | None:
        """The token's right and left edges while it is built, as (symbol, rank of the merge that takes it in); None if BPE never builds it."""
        if token not in self.spines:
            body, end = (token[: -len(END)], END) if token.endswith(END) and len(token) > len(END) else (token, "")
            parts: list = [(c, None) for c in body]
            parts[-1] = (parts[-1][0] + end, None)
            while len(parts) > 1:
                ranks = [self.rank.get((a[0], b[0]), 1 << 60) for a, b in zip(parts, parts[1:], strict=False)]
                k = min(ranks)
                if k == 1 << 60:
                    break
                i = ranks.index(k)
                parts[i : i + 2] = [(parts[i][0] + parts[i + 1][0], (k, parts[i], parts[i + 1]))]
            self.spines[token] = None
            if len(parts) == 1:
                sides = []
                for side in (2, 1):
                    edge, node, taken = [], parts[0], 1 << 60
                    while True:
                        edge.append((node[0], taken))
                        if node[1] is None:
                            break
                        taken, node = node[1][0], node[1][side]
                    sides.append(edge)
                self.spines[token] = tuple(sides)
        return self.spines[token]

    def _compatible(self, a: str, b: str) -> bool:
        """Whether no merge crosses the border of a and b. Of equal merges the left one comes first."""
        right, left = self._spine(a)[0], self._spine(b)[1]
        return not any((k := self.rank.get((x, y))) is not None and k < tx and k <= ty for x, tx in right for y, ty in left)

    def _follows(self, a: str, b: str) -> bool:
        found = self.after.get(a, {}).get(b)
        if found is None:
            if self.pairs >= 2 * REMEMBERED:
                self.after.clear()
                self.pairs = 0
            self.pairs += 1
            known = self.after.setdefault(a, {})
            found = known[b] = self._spine(b) is not None and (not a or self._compatible(a, b))
        return found

    def _inner(self, word: str) -> tuple[list[str], list[int]]:
        """For each i the last token and the count of word[:i], no word ending there. Short prefixes that words share are worked out once."""
        states, vocab, after = self.states, self.vocab, self.after
        if len(states) > 2 * REMEMBERED:
            states.clear()
        last, count = [""], [0]
        for i in range(1, len(word) + 1):
            prefix = word[:i] if i <= REMEMBERED_LENGTH else None
            state = states.get(prefix) if prefix else None
            if state is None:
                for j in range(max(0, i - self.longest_token), i):
                    token = word[j:i]
                    if token in vocab:
                        before = last[j]
                        known = after.get(before)
                        ok = known.get(token) if known is not None else None
                        if ok is None:
                            ok = self._follows(before, token)
                        if ok:
                            state = (token, count[j] + 1)
                            if prefix:
                                states[prefix] = state
                            break
                else:
                    raise ValueError(f"no token ends {word[:i]!r}")
            last.append(state[0])
            count.append(state[1])
        return last, count

    def _ending(self, word: str, i: int, last: list[str], count: list[int]) -> int:
        """Count of word[:i] as a whole word."""
        for j in range(max(0, i - self.longest_token), i):
            token = self.ends.get(word[j:i])
            if token and self._follows(last[j], token):
                return count[j] + 1
        raise ValueError(f"no token ends {word[:i]!r}")

    def word_prefixes(self, word: str) -> list[int]:
        """Counts of word[:i] as a whole word for i = 0, 1, ..., over byte letters."""
        last, count = self._inner(word)
        return [0, *(self._ending(word, i, last, count) for i in range(1, len(word) + 1))]

    def word_count(self, word: str) -> int:
        found = self.words.get(word)
        if found is None:
            found = self._ending(word, len(word), *self._inner(word[:-1]))
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            if len(word) <= REMEMBERED_LENGTH:
                self.words[word] = found
        return found

    def _bytes(self, word: str) -> str:
        return "".join(map(self.letters.__getitem__, word.encode()))

    def _chunk(self, chunk: str) -> int:
        if len(self.chunks) >= REMEMBERED:
            self.chunks.clear()
        found = sum(self.word_count(self._bytes(w)) for w in self.split.findall(chunk))
        if len(chunk) <= REMEMBERED_LENGTH:
            self.chunks[chunk] = found
        return found

    def count(self, text: str | None) -> int:
        """Tokens of the whole text."""
        if not text:
            return 0
        if self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self.count, parts))
        if self.plain.search(text):
            pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return sum(self.word_count(w) for w, _ in pieces)
        known, total = self.chunks.get, 0
        for chunk in text.lower().split():
            n = known(chunk)
            total += self._chunk(chunk) if n is None else n
        return total

    def pieces(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, word) of the words of a normalised text without special strings."""
        return [(a, b, text[a:b]) for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _inside(self, word: str) -> list[int]:
        """Counts of word[:i] by code point; a prefix of a contraction splits into other words."""
        if word[:1] == "'" and len(word) > 1:
            return [sum(self.word_count(self._bytes(w)) for w in self.split.findall(word[:i])) for i in range(len(word) + 1)]
        counts, at = self.word_prefixes(self._bytes(word)), [0]
        for c in word:
            at.append(at[-1] + len(c.encode()))
        return [counts[i] for i in at]

    def prefixes(self, text: str) -> list[int]:
        """Counts of text[:i] for i = 0, 1, ..., for a normalised text without special strings."""
        out, total = [0] * (len(text) + 1), 0
        done = 0
        for a, b, word in self.pieces(text):
            out[done : a + 1] = [total] * (a + 1 - done)
            inside = self._inside(word)
            out[a : b + 1] = [total + n for n in inside]
            total, done = total + inside[-1], b
        out[done:] = [total] * (len(text) + 1 - done)
        return out

    def longest(self, text: str, limit: int) -> int:
        """The longest i for which text[:i], of a normalised text without special strings, has at most limit tokens."""
        total = 0
        for a, b, word in self.pieces(text):
            n = self.word_count(self._bytes(word))
            if total + n > limit:
                return a + max(i for i, c in enumerate(self._inside(word)) if total + c <= limit)
            total += n
        return len(text)


def kept_counter(path: str) -> PrefixCounter:
    """The counter of this Python process: workers that serve several tasks remember their words."""
    kept = sys.modules.setdefault("_veritide_kept", types.ModuleType("_veritide_kept"))
    found = vars(kept).setdefault("counters", {})
    if path not in found:
        found[path] = PrefixCounter(path)
    return found[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept_counter(path)
        for batch in batches:
            counts = pa.array([counter.count(x.as_py()) for x in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), counts], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, normal_text, counts): the exact token count of every prefix of each normalised text without special strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(path)
        for batch in batches:
            texts = [counter.library.normalizer.normalize_str(counter.special.sub(" ", x.as_py() or "")) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(map(counter.prefixes, texts), pa.list_(pa.int32()))], ["doc_id", "normal_text", "counts"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, normal_text string, counts array<int>")


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
