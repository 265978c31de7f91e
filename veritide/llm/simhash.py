"""SimHash near-duplicates: segment-popcount grid for candidates, exact Hamming distance after it.

A 64-bit fingerprint is embedded as the bit counts of its segments. The Manhattan distance of two
embeddings is a lower bound of the Hamming distance of the fingerprints, so fingerprints within 2
bits lie within 2 in the grid, and then some grid point is at most 1 away from both. The range join
is made at such points: with 16 segments of 4 bits every fingerprint visits the at most 33 points around
it; who never meets another has no link, and two that meet alone are compared. Fuller points are
split by further segments: their fingerprints go on with 32 segments of 2 bits, and what is full
there with 64 of 1 bit, where the Manhattan distance is the Hamming distance. A point of these has
at most 65 fingerprints, each at most 1 bit away, which are linked to the least of them. So no group
of any size is ever paired out and no link is lost. All links are verified by their exact distance.

Defined results: null and empty texts have fingerprint zero, which links like any other. Rows
with a null id get the component of their fingerprint. Repeated rows stay, with equal results.
Copies share one fingerprint and are worked on once. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritide.llm.shared import columns, components, cut, sieve, sifted, trimmed, unused

SEED, BLOCK = 42, 1 << 16
#: Bits of a segment: coarse first, finer ones for grid points that are full. At 1 the bound is the distance itself.
WIDTHS = (4, 2, 1)
CLASS_BITS, LEAST = 4, 6
CLASSES = 1 << CLASS_BITS
#: Further hubs of a bucket whose documents the first did not bring together.
HUBS = 4


def shingle_hashes(text: bytes | None, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of the word shingles of UTF-8 text in blocks, repeats included. Fewer words are one shingle; no words give none."""
    words = (text or b"").lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops, digest = ends[-n:].tolist(), xxhash.xxh64_intdigest
    for i in range(0, n, BLOCK):
        yield np.array([digest(joined[s:e], SEED) for s, e in zip(starts[i : i + BLOCK], stops[i : i + BLOCK], strict=True)], dtype="<u8")


def simhash(blocks: Iterable[np.ndarray]) -> int:
    """Signed 64-bit fingerprint of hashes: a bit is 1 if it is set in over half of them."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in blocks:
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0]) if n else 0


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    return simhash(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): one row for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(x.as_py(), shingle) for x in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(trimmed(run), "id long, fp long")


def grid_points(fp: Column, width: int) -> Column:
    """The grid points at Manhattan distance 0 or 1 from the embedding of fp in segments of `width` bits, packed into longs; for 1 the words at most a bit away."""
    call, long = F.call_function, lambda n: F.lit(n).cast("long")
    if width == 1:
        return F.concat(F.array(fp), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: fp.bitwiseXOR(call("shiftleft", long(1), i))))
    slot, segments = width.bit_length(), F.sequence(F.lit(0), F.lit(64 // width - 1))  # bits for a count of 0 to width: 16 times 3, or 32 times 2
    count = lambda i: F.bit_count(call("shiftrightunsigned", fp, i * width).bitwiseAND(long(2**width - 1))).cast("long")
    own = F.aggregate(segments, long(0), lambda a, i: a.bitwiseOR(call("shiftleft", count(i), i * slot)))
    step = lambda i, up: call("shiftleft", count(i).bitwiseXOR(count(i) + (1 if up else -1)), i * slot)  # noqa: E731  what a count one higher or lower changes
    steps = F.flatten(F.transform(segments, lambda i: F.array(F.when(count(i) < width, step(i, True)), F.when(count(i) > 0, step(i, False)))))
    moves = F.concat(F.array(long(0)), F.array_compact(steps))
    return F.flatten(F.transform(F.array(own), lambda o: F.transform(moves, lambda x: o.bitwiseXOR(x))))  # own is worked out once


def links(fps: DataFrame, max_distance: int = 2) -> DataFrame:
    """Edges (a, b) over a column fp of distinct fingerprints, with the components of all pairs within max_distance (0 to 2) bits."""
    if max_distance not in (0, 1, 2):
        raise ValueError("max_distance must be 0, 1 or 2")
    if max_distance == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near, found = fps.repartition(parts), []
    for width in WIDTHS[:-1]:
        points = near.select("fp", F.explode(grid_points(F.col("fp"), width)).alias("point"))
        cells = points.groupBy("point").agg(F.count("*").alias("n"), F.min("fp").alias("b"), F.max("fp").alias("a")).where("n > 1")
        found.append(cells.where("n = 2").select("a", "b"))
        near = cut(points.join(cells.where("n > 2").select("point"), "point", "left_semi").select("fp").distinct(), "crowded")
    met = near.select("fp", F.explode(grid_points(F.col("fp"), 1)).alias("word")).groupBy("word").agg(F.collect_set("fp").alias("fps"))  # at most 65 each
    hub = F.array_min("fps") if max_distance == 2 else F.when(F.array_contains("fps", F.col("word")), F.col("word"))
    found.append(met.where(F.size("fps") > 1).select(F.explode("fps").alias("a"), hub.alias("b")).where("a != b"))
    pairs = reduce(DataFrame.union, found)
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): the least id that is reached over links, for each row of docs."""
    own = cut(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    each = cut(own.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    root = components(links(each.select("fp"), max_distance)).withColumnRenamed("node", "fp")
    rooted = cut(each.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    # written, so that these joins have no aggregation beneath and adaptive execution can split the copies of one fingerprint
    least = cut(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    found = cut(rooted.join(least, "root").select("fp", "component_id"), "found")
    return own.join(found, "fp").select(F.col("id").alias("doc_id"), "fp", "component_id")


def words_digest(text: bytes | None) -> bytes:
    """128-bit digest of the words of a text: equal for texts that differ in white space and ASCII case alone."""
    return xxhash.xxh128_digest(b" ".join((text or b"").lower().split()))


def sketch(text: bytes | None, shingle: int) -> tuple[bytes, int, list[int]]:
    """Digest of the words, fingerprint, and class sketches: for each class of hashes (by leading bits) a hash of its LEAST least ones."""
    blocks = list(shingle_hashes(text, shingle))
    own = np.unique(np.concatenate(blocks)) if blocks else np.zeros(0, "<u8")
    edges = np.searchsorted(own, np.arange(CLASSES, dtype=np.uint64) << np.uint64(64 - CLASS_BITS))
    bands = [xxhash.xxh64_intdigest(own[a : min(a + LEAST, b)].tobytes(), c) for c, (a, b) in enumerate(zip(edges, [*edges[1:], len(own)], strict=True)) if a < b]
    return words_digest(text), simhash(blocks), np.array(bands, np.uint64).view(np.int64).tolist()


def _node(id_col: str = "id", words: str = "words") -> Column:
    """The node of a row whose id stands for several different texts."""
    return F.xxhash64(F.lit("node"), F.col(id_col), F.col(words))


def _with_node(rows: DataFrame, node: str, id_col: str, text_col: str, mixed: DataFrame | None) -> DataFrame:
    """rows with a column node: the id, and for the ids in mixed a hash of id and words."""
    key = F.col(f"`{id_col}`").cast("long")
    if mixed is None:
        return rows.withColumn(node, key)
    ids = mixed.select(F.col("id").alias(unused(rows, "mixed_id")))
    among = key == F.col(ids.columns[0])
    digest = F.pandas_udf(lambda texts: texts.map(words_digest), "binary")
    words = unused(rows, "words_of_row")
    own = rows.join(ids, among, "left_semi").withColumn(words, digest(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")))
    return rows.join(ids, among, "left_anti").withColumn(node, key).unionByName(own.withColumn(node, F.xxhash64(F.lit("node"), key, F.col(words))).drop(words))


def sketches(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """(node, words, fp, bands) for each row with an id, and the ids that stand for several different texts, None without such ids.

    A row's node is its id. Rows that share an id and not the words are different documents: their
    nodes are hashes of id and words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(zip(*(sketch(x.as_py(), shingle) for x in batch.column(1)), strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int64()))], ["id", "words", "fp", "bands"])

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    own = cut(rows.mapInArrow(trimmed(run), "id long, words binary, fp long, bands array<long>"), "sketches")
    mixed = cut(own.select("id", F.xxhash64("words").alias("w")).groupBy("id").agg(F.min("w").alias("lo"), F.max("w").alias("hi")).where("lo < hi").select("id"), "mixed")
    if mixed.isEmpty():
        return own.withColumnRenamed("id", "node"), None
    flagged = own.join(mixed.withColumn("many", F.lit(True)), "id", "left")
    return flagged.select(F.when(F.col("many"), _node()).otherwise(F.col("id")).alias("node"), "words", "fp", "bands"), mixed


def similar_links(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, max_distance: int = 2, id_col: str = "doc_id", text_col: str = "text", own: tuple[DataFrame, DataFrame | None] | None = None) -> DataFrame:
    """Edges (a, b) of nodes, see sketches(): equal words, or a Jaccard similarity of word shingles of `similarity` or more.

    Equal texts are linked to the least node and go on as one. Candidates are fingerprints that the grid
    links, and documents of a bucket: those with one fingerprint, or that agree in a class sketch. Each of
    CLASSES classes of shingle hashes gives one, of its LEAST least hashes, so two texts with similarity J
    agree in a class with probability of about J ** LEAST (0.26 at 0.8, and in one class of 16 at least
    with 0.99). A bucket's documents are compared with a hub, the one that meets most others
    over all its buckets: of an original and its copies that is the original. Buckets that still have documents
    of several components are compared with HUBS more. Documents of buckets that are in several components even
    then are paired exactly: by the rarest of the differences that they have from one document near them, and those very far from it
    by their rarest shingles: any two similar
    sets share one among the first that make up 1 - similarity of either. Documents
    that merely share a common passage are not paired there, as its shingles come last. So no pair of a bucket
    is lost, and none needs all pairs of a bucket. All candidates are verified on their whole sets of
    shingles. Rows without an id take no part.
    """
    own = own or sketches(docs, shingle, id_col, text_col)
    return copies(own[0]).union(_unlike_links(docs, shingle, similarity, max_distance, id_col, text_col, *own))


def _distinct(own: DataFrame) -> DataFrame:
    return own.groupBy("words").agg(F.min("node").alias("rep"), F.min("fp").alias("fp"), F.min("bands").alias("bands"))


def copies(own: DataFrame) -> DataFrame:
    """Edges (a, b) from each node to the least node with equal words."""
    reps = cut(own.groupBy("words").agg(F.min("node").alias("b")), "words")
    return own.select(F.col("node").alias("a"), "words").join(reps, "words").where("a != b").select("a", "b")


def _unlike_links(docs: DataFrame, shingle: int, similarity: float, max_distance: int, id_col: str, text_col: str, own: DataFrame, mixed: DataFrame | None) -> DataFrame:
    """The edges of similar_links() between different texts."""
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    rows = _with_node(rows, "id", "doc", "text", mixed).select("id", F.col("text").cast("binary").alias("text"))
    one = cut(_distinct(own), "distinct")

    by_fp = one.groupBy("fp").agg(F.min("rep").alias("hub"))
    grid = links(by_fp.select("fp"), max_distance)
    hub = lambda side: by_fp.select(F.col("fp").alias(side), F.col("hub").alias(f"hub_{side}"))
    near = grid.join(hub("a"), "a").join(hub("b"), "b").select(F.col("hub_a").alias("a"), F.col("hub_b").alias("b"))
    buckets = one.select("rep", F.explode(F.array_append(F.coalesce("bands", F.array().cast("array<long>")), F.xxhash64("fp"))).alias("band"))
    sizes = buckets.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    crowded = cut(buckets.join(sizes, "band"), "buckets")
    weights = crowded.groupBy("rep").agg(F.sum("n").alias("weight"))
    live = cut(crowded.join(weights, "rep").select("band", "rep", "weight", F.col("rep").alias("root")), "members")
    hubs = cut(_hubs(live, 1), "hubs")
    ordered = lambda pairs: pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = cut(ordered(near.union(_met(live, hubs))), "candidates")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(np.concatenate(list(shingle_hashes(x.as_py(), shingle)) or [np.zeros(0, "<u8")])).view(np.int64) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["id", "set"])

    used = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    near_rows = sifted(rows, "id", sieve(used, "id"), held=True).join(used, "id", "left_semi")
    held = cut(near_rows.mapInArrow(trimmed(sets), "id long, set array<long>"), "sets")
    scored = cut(_similar(pairs, held, similarity), "scored")
    found = scored.where("ok").select("a", "b")
    for last in (False, True):
        live = cut(_rooted(live, found), "members")
        split = live.groupBy("band").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most").select("band")
        live = cut(live.join(split, "band", "left_semi"), "members")
        if live.isEmpty():
            return found
        pairs = _rest(live, scored, held, similarity) if last else _met(live, _hubs(live, HUBS))
        found = found.union(cut(_similar(cut(ordered(pairs), "candidates"), held, similarity).where("ok").select("a", "b"), "links"))
    return found


def _rooted(members: DataFrame, found: DataFrame) -> DataFrame:
    """members with the roots of the components of all links so far."""
    roots = components(found).select(F.col("node").alias("rep"), F.col("root").alias("least"))
    return members.join(roots, "rep", "left").select("band", "rep", "weight", F.coalesce("least", "rep").alias("root"))


def _hubs(members: DataFrame, n: int) -> DataFrame:
    """(band, rep): up to n hubs of each bucket, and one at least. Members are dealt to n parts by a hash."""
    part = F.pmod(F.xxhash64("rep", F.lit(n)), F.lit(n)).alias("part")
    return members.groupBy("band", part).agg(F.max_by("rep", F.struct("weight", -F.col("rep"))).alias("rep")).select("band", "rep")


def _rest(members: DataFrame, scored: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of different components of a bucket that may be similar.

    All members of a bucket are measured against one document, which may be any: the one that is the nearest to most of them of those that they were compared with. For near
    copies of one text that is the original, also in buckets that lack it. Members similar to it are linked to it. Jaccard distance is a metric, so one very far
    from it, by more than twice what similar ones may be apart, can't be similar to those; pairs with such a member come from _rare(), others from _apart().
    """
    both = scored.select(F.col("a").alias("rep"), F.col("b").alias("hub"), "j").union(scored.select("b", "a", "j"))
    nearest = both.groupBy("rep").agg(F.max_by("hub", F.struct("j", -F.col("hub"))).alias("hub"))
    votes = members.select("band", "rep").join(nearest, "rep").groupBy("band", "hub").agg(F.count("*").alias("n"))
    chosen = votes.groupBy("band").agg(F.max_by("hub", F.struct("n", -F.col("hub"))).alias("hub"))
    placed = cut(members.join(chosen, "band").where("rep != hub").select("rep", "root", "hub").distinct(), "placed")
    set_of = lambda name, col: held.select(F.col("id").alias(name), F.col("set").alias(col))
    sets = placed.join(set_of("rep", "x"), "rep").join(set_of("hub", "h"), "hub")
    each = sets.select("hub", "rep", "root", F.size("h").alias("size"), F.array_except("x", "h").alias("added"), F.array_except("h", "x").alias("lacking"))
    shared, union = F.col("size") - F.size("lacking"), F.col("size") + F.size("added")
    near, very = shared >= similarity * union, shared < (2 * similarity - 1) * union - 1e-9
    cost = similarity * F.size("added") + F.size("lacking")
    apart = cut(each.select("hub", "rep", "root", "size", near.alias("near"), very.alias("very"), cost.alias("cost"), F.concat("added", "lacking").alias("diff")), "apart")
    linked = apart.where("near").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    far = apart.where("not near").groupBy("rep").agg(F.min("root").alias("root"), F.max("very").alias("very"))
    return linked.union(_apart(apart.where("not very"), similarity)).union(_rare(far, held, similarity))


def _apart(apart: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of members of which a is not near and the two may be similar, by how they differ from one document.

    apart: hub, rep, root, size (shingles of the hub), near, diff (what differs), cost. With H shingles in the hub, and a document that has A others and lacks D of them, similarity s to the
    hub means s * A + D <= (1 - s) * H; the left side is its cost.
    Two documents of similarity s have (cost + cost - (1 - s) * H) / (1 + s) of these differences in common at least. If a is not near,
    its cost is above (1 - s) * H, so the other one has more than its own cost / (1 + s) of its differences in common with a, about half of them. So one of
    the rest and one more, the rarest, is a difference of a: what the whole group has in common brings no pairs.
    """
    hubs = apart.where("not near").select("hub").distinct()
    apart = apart.join(hubs, "hub", "left_semi")
    each = apart.select("hub", "rep", "near", F.explode("diff").alias("s"))
    # what no other member has, or none that is not near, can't be in common
    often = cut(each.groupBy("hub", "s").agg(F.count("*").alias("df"), F.count_if(~F.col("near")).alias("far")).where("df > 1 and far > 0").select("hub", "s", "df"), "often")
    shared = each.join(often, ["hub", "s"]).groupBy("hub", "rep").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("shared"))
    mine = cut(apart.drop("diff").join(shared, ["hub", "rep"]).withColumn("k", F.size("shared")), "shared")
    length = F.col("k") - F.floor(F.col("cost") / (1 + similarity) - 1e-9)
    own = lambda df, *names: df.select("hub", *(F.col(c).alias(n) for c, n in names), F.col("d.s").alias("s"))
    first = mine.where(length > 0).select("*", F.posexplode(F.slice("shared", F.lit(1), length.cast("int"))).alias("i", "d"))
    far = mine.where("not near").select("*", F.posexplode("shared").alias("i", "d"))
    met = own(far, ("rep", "a"), ("root", "root"), ("cost", "cost"), ("size", "size"), ("k", "k"), ("i", "i")).join(own(first, ("rep", "b"), ("root", "root_b"), ("cost", "cost_b"), ("k", "k_b"), ("i", "i_b")), ["hub", "s"])
    # where this is the first difference that the two have in common, no more are than what is left from here on
    enough = (1 + similarity) * F.least(F.col("k") - F.col("i"), F.col("k_b") - F.col("i_b")) + 1e-6 >= F.col("cost") + F.col("cost_b") - (1 - similarity) * F.col("size")
    return met.where((F.col("root") != F.col("root_b")) & enough).select("a", "b")


def _rare(docs: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of docs (rep, root, very) of different components, one of them very far at least, that share a rare shingle and may be similar: a prefix filter, from the rarest shingle on."""
    if docs.where("very").isEmpty():
        return docs.select(F.col("rep").alias("a"), F.col("rep").alias("b")).where("false")
    sets = held.join(docs, F.col("id") == F.col("rep")).select("id", "root", "very", F.size("set").alias("n"), "set")
    shingles = cut(sets.select("id", "root", "very", "n", F.explode("set").alias("s")), "shingles")
    often = cut(shingles.groupBy("s").agg(F.count("*").alias("df"), F.max("very").alias("one")).where("df > 1 and one").select("s", "df"), "often")
    # a document's shingles that no other has, or none that is very far, come first in its order, and cannot be shared
    mine = shingles.join(often, "s").groupBy("id").agg(F.first("root").alias("root"), F.first("very").alias("very"), F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "s"))).alias("shared"))
    length = F.col("n") - F.ceil(similarity * F.col("n")) + 1 - (F.col("n") - F.size("shared"))
    rare = cut(mine.where(length > 0).select("id", "root", "very", "n", F.explode(F.slice("shared", F.lit(1), length.cast("int"))).alias("x")).select("id", "root", "very", "n", "x.s"), "rare")
    other = rare.select("s", F.col("id").alias("b"), F.col("root").alias("root_b"), F.col("very").alias("very_b"), F.col("n").alias("n_b"))
    sized = (F.col("n") >= similarity * F.col("n_b")) & (F.col("n_b") >= similarity * F.col("n"))
    once = (F.col("id") > F.col("b")) | ~F.col("very_b")
    return rare.where("very").join(other, "s").where((F.col("id") != F.col("b")) & once & (F.col("root") != F.col("root_b")) & sized).select(F.col("id").alias("a"), "b")


def _met(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """Pairs (a, b) of a member and a hub of its bucket, of different components."""
    heads = members.join(hubs, ["band", "rep"], "left_semi").select("band", F.col("rep").alias("b"), F.col("root").alias("root_b"))
    return members.join(heads, "band").where("root != root_b").select(F.col("rep").alias("a"), "b")


def _similar(pairs: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """(a, b, j, ok): the Jaccard similarity of the pairs' sets of shingles, and whether it is enough."""
    both = pairs.join(held.select(F.col("id").alias("a"), F.col("set").alias("x")), "a").join(held.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")
    counts = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("shared"), (F.size("x") + F.size("y")).alias("sum"))
    union = F.col("sum") - F.col("shared")
    return counts.select("a", "b", F.when(union > 0, F.col("shared") / union).otherwise(1.0).alias("j"), (F.col("shared") >= similarity * union).alias("ok"))


def keep_one(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, max_distance: int = 2) -> DataFrame:
    """docs with one document of each group of similar_links: the one with the least doc_id. Rows without an id stay.

    Of rows with one id and equal words one stays, by the least hash of the whole row. Rows with one id and
    different words are different documents, and each stays or goes by itself.
    """
    own, mixed = sketches(docs, shingle, "doc_id", "text")
    if mixed is not None:
        own = cut(own, "nodes")
    same = copies(own).select(F.col("a").alias("node"))
    lost = cut(components(_unlike_links(docs, shingle, similarity, max_distance, "doc_id", "text", own, mixed)).select("node").union(same).distinct(), "lost")
    # of a component's copies that go, some are copies of what goes too: all copies of a text but one go by `same`
    bits = cut(sieve(lost, "node"), "lost-bits")
    node = unused(docs, "node_of_row")
    rows, gone = _with_node(docs, node, "doc_id", "text", mixed), lost.select(F.col("node").alias(node))
    kept = sifted(rows, node, bits, held=False).unionByName(sifted(rows, node, bits, held=True).join(gone, node, "left_anti"))
    again = cut(own.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select(F.col("node").alias(node)), "repeated")  # rows that repeat an id: seldom any
    if again.isEmpty():
        return kept.select(*columns(docs))
    whole = F.struct(*columns(docs))
    first = kept.join(again, node, "left_semi").groupBy(node).agg(F.min_by(whole, F.sha2(F.to_json(whole), 256)).alias("row_in"))
    return kept.join(again, node, "left_anti").select(*columns(docs)).unionByName(first.select("row_in.*"))


def op7_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
