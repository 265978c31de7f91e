"""A data source of lines by byte range: of append-only files only what was added is read.

`spark.read.format("appended_lines")` plans its partitions from the list of files and from checkpoints: for each file the
bytes from its checkpoint to its end, in pieces of `piece` bytes. A piece is read from its first byte on, by the lines
that begin in it; the last of them may end beyond it. With `tasks`, a partition takes as many pieces as make its share of
the bytes, up to `piece` of them, so a log of many small files is read by few tasks. Checkpoints are for planning and
don't travel with tasks. Files are opened through pyarrow's file systems, so any store that these know can be read.
A file whose name ends in SEALED is compressed as a whole: it is one piece, and its bytes are those of its text.

Modes:
* lines: raw, file, start, stop (bytes), piece, place (from 1 within the piece), base (lines before the checkpoint), utf8.
* counts: file, piece, lines; only of files whose added bytes are more than one piece, so that lines of later pieces can be numbered.
* tails: file, size, raw: the line that ends at the checkpoint, and the size of the file now, null for a file that is gone.
A last line without a line end is not read: it is left for a later scan.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PIECE = 32 << 20
BATCH = 10_000
#: A piece counts as so many bytes more when pieces are dealt to partitions: what opening its file costs.
OPENING = 64 << 10
SEALED = ".zst"
SCHEMAS = {
    "lines": "raw string, file string, start long, stop long, piece int, place long, base long, utf8 boolean",
    "counts": "file string, piece int, lines long",
    "tails": "file string, size long, raw string",
}


class Piece(InputPartition):
    """Bytes start to stop of a file; first: whether a line begins at start for sure."""

    def __init__(self, file: str, start: int, stop: int, number: int, base: int, size: int | None):
        self.file, self.start, self.stop, self.number, self.base, self.size = file, start, stop, number, base, size


class Pieces(InputPartition):
    """Pieces that one task reads, in turn."""

    def __init__(self, pieces: list[Piece]):
        self.pieces = pieces


def together(pieces: list[Piece], tasks: int, most: int) -> list[Pieces]:
    """Pieces in their order, dealt to partitions of equal shares of the bytes: so many, or more of `most` bytes; a share may be exceeded by its last piece."""
    cost = lambda p: OPENING + p.stop - p.start
    share, at, found = min(most, -(-sum(map(cost, pieces)) // tasks)), 0, {}
    for p in pieces:
        found.setdefault(at // share, []).append(p)
        at += cost(p)
    return [*map(Pieces, found.values())]


def opened(file: str):
    fs, path = pafs.FileSystem.from_uri(file)
    return fs.open_input_file(path)


def listed(root: str) -> dict[str, int]:
    """Sizes of all files below a folder, or of one file; names that begin with _ or . are no data."""
    root = (root if "://" in root else f"file://{os.path.abspath(root)}").rstrip("/")
    fs, path = pafs.FileSystem.from_uri(root)
    head = root[: len(root) - len(path)]
    info = fs.get_file_info(path)
    found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True))
    below = lambda p: p[len(path) :].split("/") if not info.is_file else [""]
    return {f"{head}{f.path}": f.size for f in found if f.is_file and not any(part.startswith(("_", ".")) for part in below(f.path))}


def unsealed(file: str, start: int = 0) -> Iterator[bytes]:
    """The text of a sealed file from a byte on, in parts."""
    fs, path = pafs.FileSystem.from_uri(file)
    with fs.open_input_stream(path, compression="zstd") as f:
        while part := f.read(1 << 20):
            if start < len(part):
                yield part[start:]
            start = max(0, start - len(part))


def line_bytes(piece: Piece) -> Iterator[tuple[int, bytes]]:
    """(start, line without its end) of the lines that begin in a piece and do end."""
    if piece.file.endswith(SEALED):
        at, held = piece.start, []
        for part in unsealed(piece.file, at):
            *lines, rest = part.split(b"\n")
            for line in lines:
                line = b"".join([*held, line])
                held = []
                yield at, line
                at += len(line) + 1
            held.append(rest)
        return
    with opened(piece.file) as f:
        at = piece.start
        if piece.number:  # the line before may reach into this piece
            f.seek(at - 1)
            at -= 1
        else:
            f.seek(at)
        held = f.read(piece.stop - at)
        if piece.number:
            cut = held.find(b"\n")
            while cut < 0:
                if not (more := f.read(1 << 20)):
                    return
                at, held = at + len(held), more
                if at >= piece.stop:
                    return  # one line covers the piece; it belongs to an earlier one
                cut = held.find(b"\n")
            at, held = at + cut + 1, held[cut + 1 :]
        while True:
            *lines, rest = held.split(b"\n")
            for line in lines:
                if at >= piece.stop:
                    return
                yield at, line
                at += len(line) + 1
            if at >= piece.stop:
                return
            more = f.read(max(1 << 16, len(rest)))
            if not more:
                return
            held = rest + more


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, Any]):
        self.path, self.mode = options["path"], options.get("mode", "lines")
        self.piece, self.tasks = int(options.get("piece", PIECE)), int(options.get("tasks", 0))
        #: file: [offset, line, where the last line starts]
        self.done: dict[str, list[int]] = json.loads(options.get("checkpoints", "{}"))

    def __getstate__(self) -> dict[str, Any]:
        return self.__dict__ | {"done": {}}

    def partitions(self) -> list[Piece] | list[Pieces]:
        found = self.pieces() or [Piece("", 0, 0, 0, 0, None)]
        return together(found, self.tasks, self.piece) if self.tasks else found

    def pieces(self) -> list[Piece]:
        files, found = listed(self.path), []
        if self.mode == "tails":
            return [Piece(f, at[2], at[0], 0, 0, files.get(f)) for f, at in sorted(self.done.items())]
        for f, size in sorted(files.items()):
            offset, base, _ = self.done.get(f, (0, 0, 0))
            if f.endswith(SEALED):
                found += [Piece(f, offset, offset + size, 0, base, size)] * (self.mode == "lines")
                continue
            starts = range(offset, size, self.piece)
            if self.mode == "lines" or len(starts) > 1:
                found += [Piece(f, s, min(s + self.piece, size), i, base, size) for i, s in enumerate(starts)]
        return found

    def read(self, partition: Piece | Pieces) -> Iterator[tuple | pa.RecordBatch]:
        pieces = [p for p in (partition.pieces if isinstance(partition, Pieces) else [partition]) if p.file]
        if self.mode == "tails":
            yield from map(self.tail, pieces)
        elif self.mode == "counts":
            yield from ((p.file, p.number, sum(1 for _ in line_bytes(p))) for p in pieces)
        else:
            held: list[tuple[Piece, int, int, bytes]] = []
            for p in pieces:
                for place, (start, line) in enumerate(line_bytes(p), 1):
                    held.append((p, place, start, line))
                    if len(held) == BATCH:
                        yield self.batch(held)
                        held = []
            if held:
                yield self.batch(held)

    def tail(self, piece: Piece) -> tuple:
        raw = None
        if piece.size is not None and piece.file.endswith(SEALED):
            size, kept = 0, []
            for part in unsealed(piece.file):
                kept.append(part[max(0, piece.start - size) : max(0, piece.stop - size)])
                size += len(part)
            raw = b"".join(kept)
            return piece.file, size, raw[:-1].decode("utf-8", "replace") if size >= piece.stop and raw.endswith(b"\n") else None
        if piece.size is not None and piece.size >= piece.stop:
            with opened(piece.file) as f:
                f.seek(piece.start)
                raw = f.read(piece.stop - piece.start)
                raw = raw[:-1].decode("utf-8", "replace") if raw.endswith(b"\n") else None
        return piece.file, piece.size, raw

    def batch(self, held: list[tuple[Piece, int, int, bytes]]) -> pa.RecordBatch:
        pieces, places, starts, lines = zip(*held, strict=True)
        valid, texts = [True] * len(held), []
        for i, line in enumerate(lines):
            try:
                texts.append(line.decode("utf-8"))
            except UnicodeDecodeError:
                valid[i] = False
                texts.append(line.decode("utf-8", "replace"))
        cols = [
            pa.array(texts, pa.string()), pa.array([p.file for p in pieces], pa.string()), pa.array(starts, pa.int64()), pa.array([s + len(line) + 1 for s, line in zip(starts, lines, strict=True)], pa.int64()),
            pa.array([p.number for p in pieces], pa.int32()), pa.array(places, pa.int64()), pa.array([p.base for p in pieces], pa.int64()), pa.array(valid),
        ]
        return pa.RecordBatch.from_arrays(cols, ["raw", "file", "start", "stop", "piece", "place", "base", "utf8"])


class AppendedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "appended_lines"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("mode", "lines")]

    def reader(self, schema: Any) -> Reader:
        made = Reader(dict(self.options))
        self.options.pop("checkpoints", None)  # this object travels with the tasks
        return made


def done_of(checkpoints: DataFrame | None) -> dict[str, list[int]]:
    """Checkpoints (file, offset, line, last_start) on the driver: one row for each file, as planning goes by files."""
    return {} if checkpoints is None else {r["file"]: [r["offset"], r["line"], r["last_start"]] for r in checkpoints.select("file", "offset", "line", "last_start").collect()}


def appended(spark: SparkSession, path: str, mode: str = "lines", done: dict[str, list[int]] | None = None, piece: int = PIECE) -> DataFrame:
    """Lines, counts or tails of the files below path. done: for each file the bytes and lines that were read, and where the last of these lines starts."""
    spark.dataSource.register(AppendedLines)
    tasks = str(2 * spark.sparkContext.defaultParallelism)
    return spark.read.format("appended_lines").option("mode", mode).option("piece", str(piece)).option("tasks", tasks).option("checkpoints", json.dumps(done or {})).load(path)


def later_pieces(path: str, done: dict[str, list[int]], piece: int = PIECE) -> int:
    """How many pieces are not the first of their file: 0 if no file has more than `piece` new bytes."""
    return sum(max(0, -(-(size - done.get(f, (0,))[0]) // piece) - 1) for f, size in listed(path).items() if not f.endswith(SEALED))


def _writer(root: str, by: list[str], sealed: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that writes `value` of rows that come by folder, and returns how many files it made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = pafs.FileSystem.from_uri(root)
        here, out, torn, made = None, None, "", 0

        def done() -> None:
            out.close()
            fs.move(torn, f"{here}/lines.txt{SEALED if sealed else ''}")  # a task that runs again puts the same file there

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = [batch.column(c) for c in by], batch.column("value")
            new = np.zeros(batch.num_rows, bool)
            new[0] = True
            for k in keys:
                texts = k.cast(pa.string()).fill_null("").to_numpy(zero_copy_only=False)
                new[1:] |= texts[1:] != texts[:-1]
            starts = [*np.flatnonzero(new).tolist(), batch.num_rows]
            for i, j in zip(starts, starts[1:], strict=False):
                named = (f"{c}={'__HIVE_DEFAULT_PARTITION__' if (v := k[i].as_py()) is None else v}" for c, k in zip(by, keys, strict=True))
                if (folder := "/".join([top, *named])) != here:
                    if out:
                        done()
                    fs.create_dir(folder, recursive=True)
                    here, torn, made = folder, f"{folder}/_{uuid.uuid4().hex}", made + 1
                    out = fs.open_output_stream(torn, compression="zstd" if sealed else None)
                out.write("".join(f"{v or ''}\n" for v in values.slice(i, j - i).to_pylist()).encode())
        if out:
            done()
        yield pa.RecordBatch.from_pydict({"files": [made]})

    return run


def write(rows: DataFrame, by: list[str], order: list[str], out: str, sealed: bool = False) -> int:
    """Writes `value` as lines of one file for each folder `by` (name=value/...), in order, and returns how many there are. by: whole numbers; sealed: files are compressed.

    Spark's own writer takes far longer for each of many small files.
    """
    near = rows.repartition(*by).sortWithinPartitions(*by, *order).select("value", *by)
    return near.mapInArrow(_writer(out, by, sealed), "files long").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
