"""Interpolated modified Kneser-Ney language model of any order, counted on Spark and scored from mapped files.

Tokens are white-space words in lower case (A-Z) and one end for each text; a text begins with
order - 1 start tokens. Counting takes two passes over the texts:
1. Words: tasks add up 64-bit hashes of their words; each shard of hashes is sorted and written. Ids count
   from the frequent words on (by powers of 2, then by hash), so most ids are small and pack well.
2. N-grams: tasks add up id tuples. Then one shuffle for each order, from the highest down: a shard
   sums its n-grams, writes them, and passes on what the order below needs: for each n-gram without its first
   word one more left neighbour, and for each without its last word the number of times it went on,
   and with how many words once, twice and more often.

Nothing is pruned. N-grams are dealt to shards by their context, and those of a context of frequent
words by their last word too, so no word or word pair is gathered in one task. The number of shards follows
from the size of the texts: a shard has about SHARD_BYTES / 6 tokens up to EVEN shards (34 GB), and then grows along with their number. Between tasks
n-grams travel as sorted runs, packed and compressed.

A shard is stored as sorted hash arrays: 64-bit hashes in order, as an index of their leading bits and the next 32 bits, and
for each the place of its counts in a table of the shard's distinct counts, all in one file. Workers map the last MAPS files that
they needed, without keeping them open, and search them; pages are shared by all workers of a host and dropped when memory is short. An n-gram that
was not seen is taken for a seen one with a probability of about 2 ** -29.

Discounts D1, D2, D3+ of each order come from counts of counts, of the highest order by occurrences and of the others by
left neighbours (Kneser-Ney); each order is interpolated with the one below, the last with a uniform
share over all known words and the unknown one.

Defined results: a null text is empty and has the end token only. Rows with null ids are trained
on. Repeated rows count as often as they stand. Without training rows every word is unknown, with
probability 1. More than 2 ** 32 - 2 distinct words are an error. Files lie in the shared folder; a task that runs again writes the same file again
and renames it into place, so lost executors lose nothing.
"""

from __future__ import annotations

import json
import math
import mmap
import os
import uuid
from collections import Counter, OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritide.llm.shared import shared_path, trimmed

#: Bytes of text for each shard; tokens that are added up together; words that a task counts before it tells them.
SHARD_BYTES, BUFFER, REMEMBERED = 8 << 20, 1 << 20, 200_000
#: Rows of a context in one shard before it is split, and the most words that are listed as frequent.
SPLIT, FREQUENT = 1 << 18, 1 << 20
#: N-grams in a bucket of a stored shard, on average at most.
BUCKET = 16
#: Stored shards of which a worker holds a map, and shards of SHARD_BYTES before they grow along with the texts.
MAPS, EVEN = 4096, 4096
#: Rows that are hashed or dealt together, so that what this needs besides its result is small.
PIECE = 1 << 16
END = b"\n"  # never part of a word
LOW = np.uint64(0xFFFFFFFF)
SHUFFLED = "shard int, level int, data binary"


def tokens(text: bytes | None) -> list[bytes]:
    words = (text or b"").lower().split()  # bytes: ASCII case and ASCII white space only
    words.append(END)
    return words


def digests(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Each 64-bit number scattered over all of them, one to one."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def by_piece(f, cols: list[np.ndarray]) -> np.ndarray:
    """f of columns, a piece of these after the other."""
    return np.concatenate([f([c[i : i + PIECE] for c in cols]) for i in range(0, max(1, len(cols[0])), PIECE)])


def narrow(x: np.ndarray) -> np.ndarray:
    """The same whole numbers from 0 on, in 32 bits where they fit."""
    return x.astype(np.uint32) if x.max(initial=0) <= LOW else x.astype(np.uint64)


def hashed(cols: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of the id tuples in columns."""
    h = np.full(len(cols[0]), len(cols), np.uint64)
    for c in cols:
        h = mixed(h + c + np.uint64(1))
    return h


def runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts keys, and where distinct ones begin in it."""
    order = np.argsort(key)
    key = key[order]
    return order, np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)


def numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rank of each key among the distinct ones, and a place of each of these."""
    order, first = runs(key)
    rank = np.empty(len(key), np.min_scalar_type(len(key)))
    rank[order] = np.repeat(np.arange(len(first), dtype=rank.dtype), np.diff(first, append=len(key)))
    return rank, order[first]


def coded(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """numbered() of tuples of numbers, most of which are below 8: these need no sorting."""
    small = reduce(np.logical_and, (v < 8 for v in values))
    key = reduce(np.bitwise_or, (v.astype(np.int64) << 3 * i for i, v in enumerate(values)))
    rest = np.flatnonzero(~small)
    if len(rest):
        key[rest] = 8 ** len(values) + numbered(hashed([v[rest].astype(np.uint64) for v in values]))[0].astype(np.int64)
    code = (np.cumsum(np.bincount(key) > 0) - 1)[key] if len(key) else key
    first = np.zeros(int(code.max(initial=-1)) + 1, np.int64)
    first[code] = np.arange(len(code))
    return code, first


def grouped(cols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts tuples of ids, and where distinct ones begin in it."""
    key = cols[0].astype(np.uint64)
    for i, c in enumerate(cols[1:]):
        if i:
            key = numbered(key)[0].astype(np.uint64)
        key = key << np.uint64(32) | c.astype(np.uint64)
    return runs(key)


def by_shard(shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts rows by shard and keeps their order in it, and the edges of shards."""
    order = np.argsort(shard.astype(np.min_scalar_type(int(shard.max(initial=0)))), kind="stable")  # by radix for up to 65,536 shards
    found = shard[order]
    return order, np.concatenate((np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))), [len(order)])) if len(order) else np.zeros(1, np.int64)


def packed(cols: list[np.ndarray], values: list[np.ndarray] = ()) -> bytes:
    """Columns of 64-bit numbers as bytes; small if the first ascends. Values, of which few are distinct, are a column of codes and a table.

    Byte planes are stored one after the other, without leading ones of zeros.
    """
    code, first = coded(values) if len(values) else (None, np.zeros(0, np.int64))
    cols = [np.diff(cols[0], prepend=cols[0].dtype.type(0)), *cols[1:], *([code] if code is not None else [])]
    parts = [np.array([len(cols[0]), len(first), len(values)], "<u8").tobytes(), *(v[first].astype("<u8").tobytes() for v in values)]
    for c in cols:
        width = (int(c.max(initial=0)).bit_length() + 7) // 8
        parts += [bytes([width]), c.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width].tobytes()]
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(data: bytes) -> list[np.ndarray]:
    """The columns and then the values of packed(), but the first in 32 bits where they fit."""
    raw = np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True), np.uint8)
    n, distinct, width_of_table = (int(x) for x in raw[:24].view("<u8"))
    at = 24 + 8 * distinct * width_of_table
    table, cols = raw[24:at].view("<u8").reshape(width_of_table, distinct), []
    while at < len(raw):
        width = int(raw[at])
        planes = np.zeros((4 if width <= 4 else 8, n), np.uint8)
        planes[:width] = raw[at + 1 : at + 1 + width * n].reshape(width, n)
        cols.append(np.ascontiguousarray(planes.T).view(f"<u{len(planes)}").ravel())
        at += 1 + width * n
    cols[0] = np.cumsum(cols[0], dtype=np.uint64)
    return cols if not width_of_table else [*cols[:-1], *(narrow(t)[cols[-1]] for t in table)]


def dealt(shard: np.ndarray, cols: list[np.ndarray], values: list[np.ndarray], level: int, most: int) -> Iterator[pa.RecordBatch]:
    """Rows of SHUFFLED: for each shard the packed columns and values of its rows, in batches of about `most` bytes."""
    order, edges = by_shard(shard)
    names, blobs, size = [], [], 0
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        own = order[a:b]
        names.append(int(shard[own[0]]))
        blobs.append(packed([c[own] for c in cols], [v[own] for v in values]))
        size += len(blobs[-1])
        if size > most:
            yield _rows(names, level, blobs)
            names, blobs, size = [], [], 0
    if names:
        yield _rows(names, level, blobs)


def _rows(shards: list[int], level: int, blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array([level] * len(shards), pa.int32()), pa.array(blobs, pa.binary())], ["shard", "level", "data"])


def save(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Writes arrays to one file, whole or not at all: the length of a description, that, and the arrays at multiples of 64 bytes."""
    temporary, at, told = f"{path}.{uuid.uuid4().hex}", 0, {}
    for name, array in arrays.items():
        told[name] = (array.dtype.str, array.shape, at)
        at += -(-array.nbytes // 64) * 64
    head = json.dumps(told).encode()
    with open(temporary, "wb") as f:
        f.write(len(head).to_bytes(8, "little") + head)
        base = -(-(8 + len(head)) // 64) * 64
        for name, array in arrays.items():
            f.seek(base + told[name][2])
            f.write(np.ascontiguousarray(array).data)
        f.truncate(base + at)
    os.replace(temporary, path)


def mapped(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped. The map keeps no open file, so their number is bounded by what is remembered alone."""
    with open(path, "rb") as f:
        data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False)
    length = int.from_bytes(data[:8], "little")
    base = -(-(8 + length) // 64) * 64
    return {name: np.frombuffer(data, dtype, int(np.prod(shape)), base + at).reshape(shape) for name, (dtype, shape, at) in json.loads(data[8 : 8 + length]).items()}


class Remembered:
    """The last MAPS things that were made, by name."""

    def __init__(self, make) -> None:
        self.make, self.held = make, OrderedDict()

    def __getitem__(self, name):
        if name in self.held:
            self.held.move_to_end(name)
        else:
            self.held[name] = self.make(name)
            if len(self.held) > MAPS:
                self.held.popitem(last=False)
        return self.held[name]


class Shard:
    """A stored shard: counts by hash. `derive` makes the columns that are looked up from the shard's distinct counts, once."""

    def __init__(self, path: str, derive=lambda rows: rows) -> None:
        self.there = os.path.exists(path)
        if self.there:
            self.starts, self.low, self.codes, rows = mapped(path).values()
            self.rows = derive(np.concatenate((rows, np.zeros_like(rows[:1]))))  # the last is for hashes that aren't there
            self.bits = (len(self.starts) - 1).bit_length() - 1
            self.steps = int(np.diff(self.starts).max()).bit_length()

    @staticmethod
    def write(path: str, hashes: np.ndarray, values: list[np.ndarray]) -> None:
        order = np.argsort(hashes)
        hashes, n = hashes[order], len(hashes)
        bits = max(0, (n // BUCKET).bit_length())
        low = (hashes << np.uint64(bits)) >> np.uint64(32)
        starts = np.searchsorted(hashes >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)) if bits else np.array([0, n])
        code, first = coded(values)
        save(path, {
            "starts": starts.astype(np.uint32), "low": low.astype(np.uint32), "codes": code[order].astype(np.min_scalar_type(max(0, len(first) - 1))),
            "rows": np.stack([v[first] for v in values], axis=1).astype(np.int64),
        })

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of counts, or what derive made of them; those of zeros where a hash isn't there."""
        low = ((hashes << np.uint64(self.bits)) >> np.uint64(32)).astype(np.uint32)
        bucket = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        at, end = self.starts[bucket].astype(np.int64), self.starts[bucket + 1].astype(np.int64)
        for step in reversed(range(self.steps)):  # all before `at` are less
            last = at + ((1 << step) - 1)
            less = self.low.take(last, mode="clip") < low
            less &= last < end
            at += less.astype(np.int64) << step
        hit = (at < end) & (self.low.take(at, mode="clip") == low)
        return self.rows.take(np.where(hit, self.codes.take(at, mode="clip"), len(self.rows) - 1), axis=0)


def power(counts: np.ndarray) -> np.ndarray:
    """The number of bits of each count."""
    return np.frexp(counts.astype(float))[1].astype(np.int64)


class Words:
    """Ids and counts of words, by mapped arrays. Unknown words have id -1 and count 0."""

    def __init__(self, folder: str, more=None) -> None:
        """Mapped too: bases, by shard and power of the count the first id, -1 for shards without words. more: gives further columns of ids."""
        self.look, self.folder, self.bases = more, folder, mapped(f"{folder}/bases")["bases"]
        self.shift = np.uint64(64 - (len(self.bases) - 1).bit_length())
        self.shards = Remembered(lambda s: tuple(mapped(f"{folder}/words-{s}").values()))
        self.ids, self.counts, self.more = np.zeros(0, np.int64), np.zeros(0, np.int64), None

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of words by their hashes, which ascend: each shard is searched in its order."""
        shard = (keys >> self.shift).astype(np.int64) if self.shift < 64 else np.zeros(len(keys), np.int64)
        ids, counts = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        edges = np.flatnonzero(np.diff(shard, prepend=-1, append=len(self.bases)))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            s = int(shard[a])
            if self.bases[s, 0] < 0:
                continue
            stored, n, ranks = self.shards[s]
            place = np.minimum(np.searchsorted(stored, keys[a:b]), len(stored) - 1)
            own = np.flatnonzero(stored[place] == keys[a:b])
            place, own = place[own], own + a
            counts[own] = n[place]
            ids[own] = self.bases[s, power(counts[own])] + ranks[place]
        return ids, counts

    def places(self, words: list[bytes]) -> np.ndarray:
        """Where ids, counts and more of the words are in self.ids, self.counts and self.more, which hold the distinct ones."""
        keys, found = np.unique(digests(words), return_inverse=True)
        self.ids, self.counts = self.find(keys)
        self.more = self.look(self.ids) if self.look else None
        return found


def _texts(batch: pa.RecordBatch, column: int, most: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """Rows of a batch in groups of about `most` tokens: token counts by row, and all tokens."""
    sizes, words = [], []
    for x in batch.column(column):
        own = tokens(x.as_py())
        sizes.append(len(own))
        words += own
        if len(words) >= most:
            yield sizes, words
            sizes, words = [], []
    if sizes:
        yield sizes, words


def _before(ids: np.ndarray, starts: np.ndarray, first: int) -> np.ndarray:
    """Each token's predecessor, `first` at the starts of texts."""
    out = np.concatenate((np.array([first], ids.dtype), ids[:-1]))
    out[starts] = first
    return out


@dataclass
class Dealing:
    """Which shard an n-gram belongs to: that of its context, and if all words of that are frequent, one of several by its last word."""

    shards: int  # a power of 2
    words: np.ndarray  # ids of frequent words in order, and the start
    counts: np.ndarray

    def often(self, ids: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.words, ids), len(self.words) - 1)
        return np.where(self.words[place] == ids, self.counts[place], 0)

    def shard(self, cols: list[np.ndarray]) -> np.ndarray:
        pieces = np.minimum.reduce([self.often(c) for c in cols[:-1]]) // SPLIT
        h = hashed(cols[:-1])
        split = np.flatnonzero(pieces > 1)
        if len(split):
            h[split] = mixed(h[split] + mixed(cols[-1][split] + np.uint64(7)) % pieces[split].astype(np.uint64))
        return (h % np.uint64(self.shards)).astype(np.int32)


@dataclass
class Model:
    """Where the arrays are, and the few numbers that all words share."""

    folder: str
    order: int
    size: int  # distinct words
    train_tokens: int
    dealing: Dealing
    discounts: list[tuple[float, float, float]]  # by level from 1
    neighbours: int  # distinct left neighbours, over all words
    low_mass: float


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of things counted 1, 2, 3 and 4 times; 0.5, 1, 1.5 where these say nothing."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    out = []
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] and y else k / 2
        out.append(min(max(d, 0.0), float(k)) if d > 0 else k / 2)
    return tuple(out)


def _count_words(shards: int):
    """A task that tells the hashes and counts of its words."""
    shift = 64 - (shards - 1).bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Counter[bytes] = Counter()

        def give() -> Iterator[pa.RecordBatch]:
            keys, counts = digests(list(known)), np.fromiter(known.values(), np.uint64, len(known))
            known.clear()
            order = np.argsort(keys)
            keys = keys[order]
            yield from dealt((keys >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(keys), np.int64), [keys], [counts[order]], 0, BUFFER)

        for batch in batches:
            for x in batch.column(0):
                known.update(tokens(x.as_py()))
                if len(known) >= REMEMBERED:
                    yield from give()
        if known:
            yield from give()

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> tuple[int | None, list[np.ndarray], list[bytes]]:
    """The shard of a partition, the columns of its rows, and what tasks before have told. Each column is put together and its runs are freed before the next."""
    shard, runs, told = None, [], []
    for batch in batches:
        for s, level, data in zip(*(batch.column(i) for i in range(3)), strict=True):
            if level.as_py() < 0:
                told.append((s.as_py(), level.as_py(), data.as_py()))
            else:
                shard = s.as_py()
                runs.append(unpacked(data.as_py()))
    for r in runs:
        r.reverse()
    return shard, [np.concatenate([r.pop() for r in runs]) for _ in range(len(runs[0]) if runs else 0)], told


def _write_words(folder: str, split: int):
    """A task that writes a shard of words; tells (kind, n, rank): the words of each power of 2 (-1 - power), occurrences (-100), and frequent words (power, count, rank in it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, cols, _ = _gathered(batches)
        if shard is not None:
            order, first = runs(cols[0])
            keys, counts = cols[0][order[first]], np.add.reduceat(cols[1][order].astype(np.int64), first)
            bits = power(counts)
            order, edges = by_shard(bits)
            ranks = np.empty(len(keys), np.uint32)
            for at in np.split(order, edges[1:-1]):
                ranks[at] = np.arange(len(at))
            save(f"{folder}/words-{shard}", {"keys": keys, "counts": counts.astype(np.min_scalar_type(int(counts.max()))), "ranks": ranks})
            often = np.flatnonzero(counts >= split)
            rows = [(shard, -1 - k, int(n), 0) for k, n in enumerate(np.bincount(bits)) if n] + [(shard, -100, int(counts.sum()), 0)] + [(shard, int(bits[i]), int(counts[i]), int(ranks[i])) for i in often]
            yield pa.RecordBatch.from_pylist([dict(zip(("shard", "kind", "n", "rank"), r, strict=True)) for r in rows], pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("n", pa.int64()), ("rank", pa.int64())]))

    return run


def _count_grams(folder: str, order: int, size: int, dealing: Dealing):
    """A task that tells its n-grams and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, start, held, n = Words(folder), size, [], 0

        def give() -> Iterator[pa.RecordBatch]:
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            held.clear()
            by, first = grouped(cols)
            counts, by = np.diff(first, append=len(by)).astype(np.uint64), by[first]
            cols = [c[by] for c in cols]  # what came before is freed
            yield from _deal_grams(cols, [counts], dealing)

        for batch in batches:
            for sizes, own in _texts(batch, 0, 1 << 18):
                at = vocabulary.places(own)
                cols = [vocabulary.ids[at].astype(np.uint32)]
                begins = np.cumsum([0, *sizes[:-1]])
                for _ in range(order - 1):
                    cols.insert(0, _before(cols[0], begins, start))
                held.append(cols)
                n += len(own)
                if n >= BUFFER:
                    yield from give()
                    n = 0
        if held:
            yield from give()

    return run


def _deal_grams(cols: list[np.ndarray], values: list[np.ndarray], dealing: Dealing) -> Iterator[pa.RecordBatch]:
    """Sorted n-grams with their values, as rows of SHUFFLED. Columns of a row: two first ids together, further ids, values."""
    key = cols[0].astype(np.uint64) << np.uint64(32) | cols[1] if len(cols) > 1 else cols[0].astype(np.uint64)
    shard = by_piece(dealing.shard, cols) if len(cols) > 1 else (mixed(key >> np.uint64(12)) % np.uint64(dealing.shards)).astype(np.int32)
    yield from dealt(shard, [key, *cols[2:]], values, len(cols), BUFFER)


def _write_grams(folder: str, level: int, dealing: Dealing):
    """A task that sums and writes a shard of the n-grams of a level, and tells the level below and the counts of counts.

    Values of a row: the count of an n-gram and, but for the highest level, what stands of it as a
    context: how often it goes on, and with how many words once, twice and more often.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, cols, told = _gathered(batches)
        for s, k, data in told:
            yield _rows([s], k, [data])
        if shard is None:
            return
        key = cols.pop(0)
        ids = [(key >> np.uint64(32)).astype(np.uint32), (key & LOW).astype(np.uint32), *cols[: level - 2]] if level > 1 else [key.astype(np.uint32)]
        values = cols[max(0, level - 2) :]
        del key, cols  # here and below: what isn't needed is freed, as a shard is held once for each core of a host
        by, first = grouped(ids)
        for c, own in enumerate(values):
            values[c] = narrow(np.add.reduceat(own[by], first, dtype=np.int64))
        by = by[first]
        for c, own in enumerate(ids):
            ids[c] = own[by]
        del by, first, own
        Shard.write(f"{folder}/grams{level}-{shard}", by_piece(hashed, ids), values)
        n = values[0]
        counts = [*((n == c).sum() for c in (1, 2, 3, 4)), (n > 2).sum(), n.sum(), len(n)]
        yield _rows([shard], -level, [",".join(map(str, map(int, counts))).encode()])
        if level == 1:
            return
        kind, seen = np.uint64 if n.sum() > LOW else np.uint32, np.flatnonzero(n > 0)
        begin = np.flatnonzero(np.concatenate(([True], reduce(np.logical_or, (c[1:] != c[:-1] for c in ids[:-1])))))
        ahead = [np.add.reduceat(x, begin, dtype=kind) for x in (n, n == 1, n == 2, n > 2)]
        below = [np.concatenate((suffix[seen], context[begin])) for suffix, context in zip(ids[1:], ids[:-1], strict=True)]
        one, none = np.ones(len(seen), kind), np.zeros(len(seen), kind)
        more = [np.concatenate((one, np.zeros(len(begin), kind))), *(np.concatenate((none, a)) for a in ahead)]
        del ids, values, n, seen, begin, ahead, one, none
        by, first = grouped(below)
        for c, own in enumerate(more):
            more[c] = np.add.reduceat(own[by], first, dtype=kind)
        by = by[first]
        for c, own in enumerate(below):
            below[c] = own[by]
        del by, first, own
        yield from _deal_grams(below, more, dealing)

    return run


def shards_for(size: int) -> float:
    """How many shards texts of so many bytes need: one for SHARD_BYTES up to EVEN shards, from there on shards grow along with their number."""
    n = size / SHARD_BYTES
    return n if n <= EVEN else EVEN * math.sqrt(n / EVEN)


def train(spark: SparkSession, docs: DataFrame, order: int = 3, text_col: str = "text") -> Model:
    """Counts docs, writes the arrays to a new folder below spark.checkpoint.dir."""
    if order < 2:
        raise ValueError("the order must be 2 or more")
    folder = f"{shared_path(spark)}/veritide/lm-{uuid.uuid4().hex}"
    os.makedirs(folder, exist_ok=True)
    rows = docs.select(F.col(text_col).cast("binary").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = 1 << max(3, int(shards_for(size)).bit_length())
    deal = lambda df: df.repartitionById(shards, F.col("shard"))

    split = max(SPLIT, size // FREQUENT)  # at most FREQUENT words stand as often
    counted = deal(rows.mapInArrow(trimmed(_count_words(shards)), SHUFFLED))
    stored = counted.mapInArrow(trimmed(_write_words(folder, split)), "shard int, kind int, n long, rank long").toArrow()
    shard, kind, n, rank = (stored[c].to_numpy() for c in ("shard", "kind", "n", "rank"))
    sizes, by_power, often, total = np.zeros((shards, 64), np.int64), (kind < 0) & (kind > -100), kind >= 0, int(n[kind == -100].sum())
    sizes[shard[by_power], -1 - kind[by_power]] = n[by_power]
    size_of_all = int(sizes.sum())
    if size_of_all >= 2**32 - 1:
        raise ValueError("more than 2 ** 32 - 2 distinct words")
    down = sizes[:, ::-1].T.ravel()  # from the greatest power on, all shards of a power together
    bases = np.ascontiguousarray((np.cumsum(down) - down).reshape(64, shards).T[:, ::-1])
    bases[sizes.sum(axis=1) == 0] = -1
    save(f"{folder}/bases", {"bases": bases})
    texts = int(Words(folder).find(digests([END]))[1][0])
    ids, counts = np.append(bases[shard[often], kind[often]] + rank[often], size_of_all), np.append(n[often], texts)
    by_id = np.argsort(ids)
    dealing = Dealing(shards, ids[by_id].astype(np.uint64), counts[by_id])

    grams = rows.mapInArrow(trimmed(_count_grams(folder, order, size_of_all, dealing)), SHUFFLED)
    for level in range(order, 0, -1):
        grams = deal(grams).mapInArrow(trimmed(_write_grams(folder, level, dealing)), SHUFFLED)
    told = F.split(F.col("data").cast("string"), ",")  # natively: another Python function would double the workers of this stage
    sums = grams.groupBy("level").agg(*(F.sum(told[i].cast("long")).alias(x) for i, x in enumerate("abcdefg"))).collect()
    by_level = {-r["level"]: r for r in sums}
    found = [discounts([by_level[k][x] if k in by_level else 0 for x in "abcd"]) for k in range(1, order + 1)]
    low = by_level.get(1)
    mass = sum(d * low[x] for d, x in zip(found[0], "abe", strict=True)) / low["f"] if low and low["f"] else 1.0
    return Model(folder, order, size_of_all, total, dealing, found, low["f"] if low else 0, mass)


def score(docs: DataFrame, model: Model, keep: list[str | Column], text_col: str = "text") -> DataFrame:
    """keep, n_tokens, n_known, train_tokens, base_score, score for each row of docs."""
    kept = docs.select(*keep)
    names = [*kept.columns, "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stored = Remembered(lambda name: Shard(f"{model.folder}/grams{name[0]}-{name[1]}", derive[name[0] - 1]))
        size, total, order = model.size, model.train_tokens, model.order

        def derived(level: int):
            """Of the counts of an n-gram: what its discount leaves, how often it goes on as a context, and the share that is left to the order below there."""
            left, right = np.array((0.0, *model.discounts[level - 1])), np.array(model.discounts[level]) if level < order else None

            def run(rows: np.ndarray) -> np.ndarray:
                own = np.maximum(rows[:, 0] - left[np.minimum(rows[:, 0], 3)], 0)
                if right is None:
                    return own[:, None]
                return np.stack((own, rows[:, 1].astype(float), np.where(rows[:, 1] > 0, (rows[:, 2:] @ right) / np.maximum(rows[:, 1], 1), 1.0)), axis=1)

            return run

        derive = [derived(level) for level in range(1, order + 1)]
        nothing = [d(np.zeros((1, 5 if k + 1 < order else 1), np.int64)) for k, d in enumerate(derive)]

        def find(cols: list[np.ndarray], known: np.ndarray) -> np.ndarray:
            """derived() of n-grams of known words, of nothing for others."""
            level = len(cols)
            out = np.repeat(nothing[level - 1], len(known), axis=0)
            own = np.flatnonzero(known)
            cols = [c[own] for c in cols]
            shard = by_piece(model.dealing.shard, cols) if level > 1 else (mixed(cols[0] >> np.uint64(12)) % np.uint64(model.dealing.shards)).astype(np.int64)
            by, edges = by_shard(shard)
            hashes, own = by_piece(hashed, cols)[by], own[by]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                found = stored[level, int(shard[by[a]])]
                if found.there:
                    out[own[a:b]] = found.find(hashes[a:b])
            return out

        vocabulary = Words(model.folder, lambda ids: find([ids.astype(np.uint64)], ids >= 0))
        begin = [find([np.array([size], np.uint64)] * k, np.array([True]))[0] for k in range(1, order)]  # contexts of start tokens alone

        for batch in batches:
            out: list[tuple] = []
            for sizes, own in _texts(batch, batch.num_columns - 1, 1 << 18):
                at = vocabulary.places(own)
                starts = np.cumsum([0, *sizes[:-1]])
                ids, counts = vocabulary.ids[at], vocabulary.counts[at]
                base = np.log10((counts + 0.1) / (total + 0.1 * (size + 1)))
                known = ids >= 0
                cols, held, found = [ids.astype(np.uint64)], known, vocabulary.more[at]
                p = found[:, 0] / max(1, model.neighbours) + model.low_mass / (size + 1)
                for level in range(2, order + 1):
                    context = np.concatenate((found[:1], found[:-1]))
                    context[starts] = begin[level - 2]
                    cols.insert(0, _before(cols[0], starts, size))
                    before = np.concatenate(([True], held[:-1]))
                    before[starts] = True
                    held = known & before
                    found = find(cols, held)
                    p = np.where(context[:, 1] > 0, found[:, 0] / np.maximum(context[:, 1], 1), 0.0) + context[:, 2] * p
                out += zip(sizes, np.add.reduceat(known.astype(np.int64), starts).tolist(), np.add.reduceat(base, starts).tolist(), np.add.reduceat(np.log10(p), starts).tolist(), strict=True)
            cols = list(zip(*out, strict=True)) or [()] * 4
            arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array([total] * len(out), pa.int64()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names)

    schema = kept.schema
    for name in names[len(schema) :]:
        schema = schema.add(name, "double" if name.endswith("score") else "long")
    return docs.select(*keep, F.col(text_col).cast("binary").alias("_text_of_row")).mapInArrow(trimmed(run), schema)


def held_out(id_col: str) -> Column:
    """Whether a row is kept from training: the CRC-32 of its id as text is a multiple of 10. Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def op6_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(spark, docs.where(~held_out("doc_id")))
    return score(docs, model, ["doc_id", held_out("doc_id").alias("held_out")])
