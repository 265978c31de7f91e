"""Repair of the structure of conversations: the cheapest edits, by dynamic programming over a persistent tree of audits.

A conversation's rows are gone through in order with one best way for each state of what has been kept: nothing, a system
row alone, ending in user, ending in assistant. A way's audit, the letters of its edits, is a node of a tree that
links to the way it goes on from, so ways share their prefixes. A node also knows its ancestors 1, 2, 4, ... steps back and
a rolling hash of its letters. Ways of equal cost are told apart by the longest common prefix of their audits: the ancestors
lead there by steps that halve, comparing hashes. That prefixes with equal hashes are equal is verified by
walking both back until they meet in one node; where they differ, the audits are compared letter by letter.

Rows are dealt by ranges of (conversation, order), so a conversation of a third of all rows is spread over many tasks, in segments of SEGMENT
rows at most. A segment that may go on from an earlier one is worked out for each state that it can begin in. A
conversation's segments are then put together: costs from the last to the first say which states the cheapest whole
ways pass, and from the first to the last the least audit of a segment is taken of those. What one conversation gathers there is
letters, as the result has one for each edit in one value anyway. Texts travel once, in order, past the audit,
into a running SHA-256.

Rows of a conversation are ordered by turn (nulls first), then role, then the SHA-256 of role and text; rows equal in all three
are equal. Each row's first fault counts: blank, duplicate (role and text seen earlier), truncated.

Defined results: null roles and texts are one space, so such a text is blank, and such a role fits nowhere until a row gets another. Null
conversation ids are one conversation. Ties between cheapest ways go to the least audit by ASCII. A conversation whose rows are all
deleted has the hash of the empty text. Repeated rows are duplicates. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritide.llm.shared import cut

SEGMENT = 1 << 14
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
RANGE_ROWS = 1 << 17
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
LEGAL = ("su", "ua", "au")
SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
MODULUS, BASE = (1 << 61) - 1, 1_000_003


class Audits:
    """Audits as a tree: node 0 is the empty one, each other node adds a letter to its parent."""

    def __init__(self):
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [()]
        self.equal: set[tuple[int, int]] = set()

    def add(self, parent: int, letter: str) -> int:
        up, node, k = [parent], parent, 0
        while k < len(self.up[node]):
            node = self.up[node][k]
            up.append(node)
            k += 1
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * BASE + ord(letter)) % MODULUS)
        self.up.append(tuple(up))
        return len(self.letter) - 1

    def back(self, node: int, depth: int) -> int:
        while (more := self.depth[node] - depth) > 0:
            node = self.up[node][more.bit_length() - 1]
        return node

    def same(self, x: int, y: int) -> bool:
        """Whether two audits of one depth are equal: back to where they meet, or to a pair that was found equal before."""
        way = []
        while x != y and (x, y) not in self.equal:
            if self.letter[x] != self.letter[y]:
                return False
            way.append((x, y))
            x, y = self.up[x][0], self.up[y][0]
        self.equal.update(way)
        return True

    def less(self, x: int, y: int) -> bool:
        """Whether audit x is before audit y; a prefix is before what it begins."""
        if x == y:
            return False
        depth = min(self.depth[x], self.depth[y])
        a, b = self.back(x, depth), self.back(y, depth)
        if self.hash[a] == self.hash[b]:
            if self.same(a, b):
                return self.depth[x] < self.depth[y]
            return self.spelled(x) < self.spelled(y)
        for k in range(len(self.up[a]) - 1, -1, -1):
            if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                a, b = self.up[a][k], self.up[b][k]
        if not self.same(self.up[a][0], self.up[b][0]):
            return self.spelled(x) < self.spelled(y)
        return self.letter[a] < self.letter[b]

    def spelled(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(letters))


class Ways:
    """The best way to each state, from one state at the start of a segment: (cost, node) or None."""

    def __init__(self, audits: Audits, start: int):
        self.audits, self.best = audits, [None] * 4
        self.best[start] = (0, 0)

    def offer(self, best: list, state: int, cost: int, parent: int, letter: str) -> None:
        old = best[state]
        if old is None or cost < old[0]:
            best[state] = (cost, self.audits.add(parent, letter))
        elif cost == old[0]:
            node = self.audits.add(parent, letter)
            if self.audits.less(node, old[1]):
                best[state] = (cost, node)

    def insert(self) -> None:
        best = self.best
        for state in (EMPTY, SYSTEM, ASSISTANT):
            if best[state] is not None:
                self.offer(best, USER, best[state][0] + INSERT, best[state][1], "I")
        if best[USER] is not None:
            self.offer(best, ASSISTANT, best[USER][0] + INSERT, best[USER][1], "I")

    def row(self, initial: str, unusable: bool, truncated: bool) -> None:
        self.insert()
        old, new = self.best, [None] * 4
        for state, way in enumerate(old):
            if way is None:
                continue
            cost, node = way
            self.offer(new, state, cost + DELETE, node, "D")
            if unusable:
                continue
            cost += TRUNCATED * truncated
            if initial == "s" and state == EMPTY:
                self.offer(new, SYSTEM, cost, node, "K")
            follows, role = (ASSISTANT, "a") if state == USER else (USER, "u")
            # a row that may be kept as it is isn't given the same role for a price
            self.offer(new, follows, *((cost, node, "K") if initial == role else (cost + REROLE, node, "R")))
        self.best = new


def marked(rows: DataFrame) -> DataFrame:
    """rows with blank, truncated and digest: what a row is by itself."""
    trimmed = F.expr(f"trim(TRAILING ({SPACE}) FROM text)")
    return rows.withColumns({
        "blank": trimmed == "",
        "truncated": ~F.substring(trimmed, -1, 1).isin(".", "!", "?"),
        "digest": F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)),
    })


def named(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(key, turn, role, text): key is never null and equal for null ids."""
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{conv_col}`").cast("string")), F.lit("-"))
    filled = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(" "))
    return rows.select(key.alias("key"), F.col(f"`{turn_col}`").cast("long").alias("turn"), filled(role_col).alias("role"), filled(text_col).alias("text"))


SEGMENTS = "key string, part int, seq int, blank long, duplicate long, truncated long, illegal long, first string, last string, first_turn long, last_turn long, turns long, ways array<struct<start:int,state:int,cost:long,audit:string>>"


class Segment:
    """Rows of a conversation in order; all: whether they may go on from earlier ones."""

    def __init__(self, key: str, seq: int, all_starts: bool):
        self.key, self.seq, self.audits, self.n = key, seq, Audits(), 0
        self.ways = {start: Ways(self.audits, start) for start in (range(4) if all_starts else (EMPTY,))}
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.first_turn = self.last_turn = None

    def row(self, turn: int | None, role: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        initial = role[:1]
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        self.first, self.last = initial if self.first is None else self.first, initial
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn, self.last_turn = turn if self.first_turn is None else self.first_turn, turn
        for ways in self.ways.values():
            ways.row(initial, blank or duplicate, truncated)
        self.n += 1

    def packed(self, part: int) -> dict:
        ways = [{"start": start, "state": state, "cost": way[0], "audit": self.audits.spelled(way[1])} for start, w in self.ways.items() for state, way in enumerate(w.best) if way is not None]
        return {"key": self.key, "part": part, "seq": self.seq, "ways": ways} | {k: getattr(self, k) for k in ("blank", "duplicate", "truncated", "illegal", "first", "last", "first_turn", "last_turn", "turns")}


SEGMENT_SCHEMA = pa.schema([
    ("key", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")), ("first", pa.string()), ("last", pa.string()),
    *((c, pa.int64()) for c in ("first_turn", "last_turn", "turns")), ("ways", pa.list_(pa.struct([("start", pa.int32()), ("state", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
])


def in_batches(rows: Iterable[dict], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def segments(rows: DataFrame, parts: int) -> DataFrame:
    """The segments of all conversations. rows: (key, turn, role, digest, row, blank, duplicate, truncated)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, now = TaskContext.get().partitionId(), None
        for batch in batches:
            for key, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "turn", "role", "blank", "duplicate", "truncated")), strict=True):
                if now is None or now.key != key:
                    if now is not None:
                        yield now.packed(part)
                    now = Segment(key, 0, all_starts=now is None)  # only a range's first conversation can have begun in an earlier range
                elif now.n == SEGMENT:
                    yield now.packed(part)
                    now = Segment(key, now.seq + 1, all_starts=True)
                now.row(*row)
        if now is not None:
            yield now.packed(part)

    order = ["key", "turn", "role", "digest", "row"]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(lambda batches: in_batches(made(batches), SEGMENT_SCHEMA), SEGMENTS)


def joined(found: list[dict]) -> tuple[int, str]:
    """(cost, audit) of the cheapest way through segments in order, the least audit of those."""
    end = Audits()
    after: list[dict[int, int]] = [{}]  # what the rest costs from each state, from the last on
    for state in range(4):
        last = Ways(end, state)
        last.insert()
        if costs := [last.best[s][0] for s in (EMPTY, ASSISTANT) if last.best[s] is not None]:
            after[0][state] = min(costs)
    for segment in reversed(found):
        rest: dict[int, int] = {}
        for w in segment["ways"]:
            if w["state"] in after[-1]:
                rest[w["start"]] = min(rest.get(w["start"], 1 << 62), w["cost"] + after[-1][w["state"]])
        after.append(rest)
    cost, state, audit = after[-1][EMPTY], EMPTY, []
    for segment, rest, whole in zip(found, after[-2::-1], after[:0:-1], strict=True):
        # audits of one segment take the same rows and end with one, so none begins another, and the least is the least of the whole
        fit = [(w["audit"], w["state"]) for w in segment["ways"] if w["start"] == state and w["state"] in rest and w["cost"] + rest[w["state"]] == whole[state]]
        letters, state = min(fit)
        audit.append(letters)
    if state in (SYSTEM, USER):
        audit.append("I" * (2 if state == SYSTEM else 1))
    return cost, "".join(audit)


FAULTS = ("blank", "duplicate", "truncated", "illegal")
RESULT = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
RESULT_SCHEMA = pa.schema([("key", pa.string()), *((c, pa.int64()) for c in ("gaps", *FAULTS, "cost")), ("audit", pa.string())])


def summed(found: list[dict]) -> dict:
    counts = {c: sum(s[c] for s in found) for c in FAULTS}
    turns, last, last_turn, first_turn = 0, None, None, None
    for s in found:
        counts["illegal"] += last is not None and last + s["first"] not in LEGAL
        last = s["last"]
        if s["turns"]:
            turns += s["turns"] - (s["first_turn"] == last_turn)
            first_turn, last_turn = s["first_turn"] if first_turn is None else first_turn, s["last_turn"]
    cost, audit = joined(found)
    return {"key": found[0]["key"], "gaps": last_turn - first_turn + 1 - turns if turns else 0, "cost": cost, "audit": audit} | counts


def together(found: DataFrame, parts: int) -> DataFrame:
    """A row for each conversation from its segments."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                if held and held[0]["key"] != r["key"]:
                    yield summed(held)
                    held = []
                held.append(r)
        if held:
            yield summed(held)

    order = ["key", "part", "seq"]
    return found.repartition(parts, "key").sortWithinPartitions(*order).mapInArrow(lambda batches: in_batches(made(batches), RESULT_SCHEMA), RESULT)


class Repaired:
    """Goes through a conversation's rows beside its audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.digest, self.lines = audit, 0, EMPTY, hashlib.sha256(), 0

    def line(self, role: bytes, text: bytes, state: int) -> None:
        if self.lines:
            self.digest.update(b"\n")
        for part in (role, b":", text):
            self.digest.update(part)
        self.lines, self.state = self.lines + 1, state

    def inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.line(*((b"assistant", b"", ASSISTANT) if self.state == USER else (b"user", b"", USER)))

    def row(self, role: bytes, text: bytes) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.line(role, text, {b"s": SYSTEM, b"u": USER, b"a": ASSISTANT}[role[:1]])
        elif edit == "R":
            self.line(*((b"assistant", text, ASSISTANT) if self.state == USER else (b"user", text, USER)))


def hashed(found: DataFrame, rows: DataFrame, parts: int) -> DataFrame:
    """found with repaired_sha256. rows: (key, turn, role, digest, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, held = None, None, []

        def ended() -> None:
            if now is not None:
                now.inserted()
                held.append((key, now.digest.hexdigest()))

        for batch in batches:
            for k, audit, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "audit", "role", "text")), strict=True):
                if audit is not None:
                    ended()
                    key, now = k, Repaired(audit)
                else:
                    now.row(role, text)
            if len(held) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], ["key", "repaired_sha256"])
                held = []
        ended()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], ["key", "repaired_sha256"])

    none = lambda kind: F.lit(None).cast(kind)
    heads = found.select("key", F.lit(0).alias("kind"), none("long").alias("turn"), none("string").alias("by"), none("binary").alias("digest"), "audit", none("binary").alias("role"), none("binary").alias("text"))
    each = rows.select("key", F.lit(1), "turn", "role", "digest", none("string"), F.col("role").cast("binary"), F.col("text").cast("binary"))
    order = ["key", "kind", "turn", "by", "digest"]
    hashes = heads.union(each).repartition(parts, "key").sortWithinPartitions(*order).select("key", "audit", "role", "text").mapInArrow(run, "key string, repaired_sha256 string")
    return found.join(hashes, "key")


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for each conversation with a row; see conversation_key() for key."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = marked(named(rows, conv_col, turn_col, role_col, text_col))
    marks = cut(each.drop("text").withColumn("row", F.monotonically_increasing_id()), "marks")
    # a text that a conversation repeats is one row on its side of the join, which splits the other side
    first = cut(marks.where("not blank").groupBy("key", "digest").agg(F.min(F.struct("turn", "row")).alias("first")), "first")
    seen = marks.join(first, ["key", "digest"], "left")
    duplicate = ~F.col("blank") & (F.struct("turn", "row") > F.col("first"))
    flags = seen.select("key", "turn", "role", "digest", "row", "blank", F.coalesce(duplicate, F.lit(False)).alias("duplicate"), "truncated")
    flags = cut(flags.withColumn("truncated", F.col("truncated") & ~F.col("blank") & ~F.col("duplicate")), "flags")
    wide = max(parts, -(-flags.count() // RANGE_ROWS))
    found = cut(together(segments(flags, wide), parts), "audits")
    return hashed(found, each, parts)


def conversation_key(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit("-"))


def damage(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults that their conversation and turn decide."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    part = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(F.col("part") == 1, "").when(F.col("part") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("part") == 4, "user").otherwise(F.col("role"))
    held = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), part.alias("part")).where("part != 0")
    changed = held.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("part") == 3, 2).otherwise(1).alias("times"))
    return changed.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("times")))).select("conv_id", "turn", "role", "text")


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    ids = rows.select("conv_id").distinct().withColumn("key", conversation_key(F.col("conv_id")))
    all_found = ids.join(repair(damage(rows)), "key", "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", *FAULTS, "cost")]
    return all_found.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _op13_sql() -> str:
    letters = lambda way, cost, letter, line: f"{{'c': {way}.c + {cost}, 'e': {way}.e || '{letter}', 't': {way}.t || {line}}}"
    inf = "{'c': 1000000000::BIGINT, 'e': '', 't': ''}"
    insert = lambda way, role: letters(way, INSERT, "I", f"chr(10) || '{role}:'")
    drop = lambda way: letters(way, DELETE, "D", "''")

    def take(way: str, initial: str, role: str) -> str:
        keep, change = letters(way, "cut", "K", "chr(10) || role || ':' || text"), letters(way, f"{REROLE} + cut", "R", f"chr(10) || '{role}:' || text")
        return f"CASE WHEN bad THEN {inf} WHEN ini = '{initial}' THEN {keep} ELSE {change} END"

    system = f"CASE WHEN bad OR ini <> 's' THEN {inf} ELSE {letters('z', 'cut', 'K', 'chr(10) || role || chr(58) || text')} END"
    least = lambda *ways: f"list_min([{', '.join(ways)}])"
    to_user = least("u", *(insert(w, "user") for w in "zsa"))
    return f"""
WITH RECURSIVE t(i, c, k) AS (
  SELECT range AS i, range AS c, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM t WHERE k < 8
), tab AS (SELECT list(c ORDER BY i) AS s FROM t WHERE k = 8
), k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
), h AS (
  SELECT k.*, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(key)), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda c, y: xor(c >> 8, tab.s[(xor(c, y) & 255) + 1]))) % 20 AS part
  FROM k, tab
), d AS (
  SELECT conv_id, turn, CASE WHEN part = 4 THEN 'user' ELSE role END AS role, CASE part WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM h, range(CASE WHEN part = 3 THEN 2 ELSE 1 END) WHERE part <> 0
), o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS i FROM d
), f AS (
  SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
    NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS open, substr(role, 1, 1) AS ini, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS ini_before
  FROM o
), g AS (SELECT *, blank OR seen AS bad, CASE WHEN open THEN {TRUNCATED} ELSE 0 END AS cut FROM f
), dp(conv_id, i, z, s, u, a) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, {{'c': 0::BIGINT, 'e': '', 't': ''}}, {inf}, {inf}, {inf} FROM g
  UNION ALL
  SELECT conv_id, i, {drop("z")}, {least(drop("s"), system)}, {least(drop("u"), take("z", "u", "user"), take("s", "u", "user"), take("a", "u", "user"))}, {least(drop("a"), take("u", "a", "assistant"))}
  FROM (
    SELECT conv_id, i, role, text, bad, cut, ini, z, s, u, {least("a", insert("u", "assistant"))} AS a
    FROM (SELECT dp.conv_id, g.i, g.role, g.text, g.bad, g.cut, g.ini, z, s, a, {to_user} AS u FROM dp JOIN g ON dp.conv_id IS NOT DISTINCT FROM g.conv_id AND g.i = dp.i + 1)
  )
), e AS (
  SELECT conv_id, {least("z", "a", insert("u", "assistant"))} AS best
  FROM (SELECT conv_id, i, z, a, {to_user} AS u FROM dp) JOIN (SELECT conv_id AS conv, max(i) AS i FROM g GROUP BY conv_id) n USING (i) WHERE n.conv IS NOT DISTINCT FROM conv_id
), c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(NOT blank AND seen) AS duplicate, count_if(NOT bad AND open) AS truncated,
    count_if(ini_before IS NOT NULL AND ini_before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM g GROUP BY conv_id
)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.e, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN c ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN e ON a.conv_id IS NOT DISTINCT FROM e.conv_id
"""


OP13_SQL = _op13_sql()
