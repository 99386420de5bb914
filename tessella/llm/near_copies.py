"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, and what these link.

Candidates come from three indexes, and every link is confirmed by counting both sets' common elements. Two find most links:

* The multi-index hashing of `simhash`, over fingerprints of five-word shingles: all pairs within two bits.
* Bands of minima. At similarity 0.8 fingerprints of 64 bits are some nine bits apart, further than small balls reach, so
  SimHash alone finds a few hundredths of such pairs. Each set is also entered under BANDS hashes of ROWS minima each;
  a pair of similarity s meets in one of them with probability 1 - (1 - s^ROWS)^BANDS: 0.9996 at 0.8, more above.

The third leaves none out. Of two sets that similar each holds at least four fifths of the other's elements, so under any
common order of the elements their first n - ceil(0.8 n) + 1 (of n) share one. Each set is entered under those, and all pairs
in a cell that the first two did not link, directly or by others, are compared. The order puts elements last that a sample of
documents holds often; the sample changes only the work, never the result.

Each distinct set is one node, however many documents have it.

Groups: only components are wanted, and a group of thousands would make pairs with its square. So of the first two indexes the
members of cells of up to SMALL are all compared; in a larger cell each of ROUNDS rounds compares all members with one of another
component (drawn anew for each cell and round, so a member meets as many as it has large cells), and members that are known to
be linked by then are not compared again. In the third, cells of one component are done; while the others hold more than FEW pairs a node, rounds compare with drawn members, then (after ROUNDS, or
sooner: once a round leaves more than MOST of these pairs) every pair of two components is compared.

Disk: sketches are kept with the nodes, and texts move only for sets named by a pair that sizes and sketches leave. Most sets
that share an element with another share little else, so in the third index sketches stand beside the entries, and a pair that
they tell apart is never made.

Joins of tables that grow with the documents are sort-merge joins by hint, whatever Spark takes their files to weigh; only the
drawn members and the open cells, at most one row for each SMALL entries, may be broadcast.

Cases: null and empty texts have the same, empty, set; fewer words than a shingle give one shingle of them all; repeated
rows are documents like any other; null doc_id: such rows get a component, like others; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm import simhash, storage
from tessella.llm.components import components

WIDTH = 5
BANDS, ROWS = 20, 5
ROUNDS, SMALL, FEW, MOST = 3, 32, 20, 0.9
SAMPLE, OFTEN, LISTED = 10_000, 3, 50_000
BLOCK = 1 << 16
PLACES = 1 << 19
_random = np.random.default_rng(WIDTH)
MULTIPLIERS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTES = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MULTIPLIER = np.uint64(0xD1342543DE82EF95)
#: Powers of the multiplier and of its inverse.
UP, DOWN = (np.multiply.accumulate(np.append(np.uint64(1), np.full(BLOCK, by, np.uint64))) for by in (MULTIPLIER, np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))))
MIX = _random.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each shingle of a text's words, in their order: polynomials over random values of the bytes, all
    from one running sum. Long texts are read in blocks; a shingle longer than a block is hashed alone."""
    joined = b" ".join((text or "").encode().translate(simhash.LOWER).split())
    if not joined:
        return np.empty(0, np.uint64)
    data = np.frombuffer(joined, np.uint8)
    space = np.flatnonzero(data == 32)
    begins, ends = np.concatenate(([0], space + 1)), np.append(space, len(data))
    width = min(WIDTH, len(begins))
    begins, ends = begins[: len(begins) - width + 1], ends[width - 1 :]
    out, k = np.empty(len(begins), np.uint64), 0
    while k < len(begins):
        base = begins[k]
        last = int(np.searchsorted(ends, base + BLOCK, "right"))
        if last <= k:
            out[k] = xxhash.xxh3_64_intdigest(joined[base : ends[k]])
            k += 1
            continue
        a, z = begins[k:last] - base, ends[k:last] - base
        n = int(z[-1])
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTES[data[base : base + n]] * UP[:n], out=sums[1:])
        out[k:last] = (sums[z] - sums[a]) * DOWN[a] + (z - a).astype(np.uint64) * MULTIPLIER
        k = last
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


def distinct(hashes: np.ndarray) -> np.ndarray:
    """The set of some hashes, ascending as signed integers."""
    s = np.sort(hashes.view(np.int64))
    return s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) else s


def shingle_set(text: str | None) -> np.ndarray:
    return distinct(shingle_hashes(text))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard similarity of two sets is 0.8 or more."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * both >= 4 * (len(a) + len(b) - both)


def node_of(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def bands(s: np.ndarray) -> np.ndarray:
    """The cells of a set: a hash of each band's minima. Long sets are read in blocks."""
    if not len(s):
        return s
    x, least = s.view(np.uint64), np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(x), 1024):
        np.minimum(least, (MULTIPLIERS[:, None] * x[None, k : k + 1024]).min(axis=1), out=least)
    least ^= least >> np.uint64(29)
    cells = (least.reshape(BANDS, ROWS) * MIX).sum(axis=1, dtype=np.uint64)
    return (cells ^ (cells >> np.uint64(31))).view(np.int64)


def first_elements(s: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Of the elements in their common order (often ones last), as many from the front as similar sets cannot all lack."""
    n = len(s)
    if not n:
        return s
    last = often[np.minimum(np.searchsorted(often, s), len(often) - 1)] == s if len(often) else np.zeros(n, bool)
    return np.concatenate([s[~last], s[last]])[: n - (4 * n + 4) // 5 + 1]


def sketch(s: np.ndarray) -> np.ndarray:
    """Parities of the elements in 512 places, or in the next power of two from n: two sets differ in at least as many
    elements as their sketches in bits, also when the longer sketch is folded to the shorter."""
    places = 1 << max(9, (len(s) - 1).bit_length())
    odd = np.bincount((s.view(np.uint64) & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def text_key():
    """Names a text; null and empty differ."""
    return F.coalesce(F.md5("text"), F.lit(""))


def often_met(docs: DataFrame) -> np.ndarray:
    """Shingles that several documents of a sample hold, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([shingle_set(t.as_py()) for t in b.column(0)], pa.list_(pa.int64()))], ["s"])

    some = docs.select("text").sample(min(1.0, SAMPLE / max(docs.count(), 1)), 7)
    each = storage.in_batches(some).mapInArrow(storage.trimmed(run), "s array<bigint>").select(F.explode("s").alias("e"))
    most = each.groupBy("e").agg(F.count("*").alias("n")).where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "e").limit(LISTED)
    return np.sort(most.select("e").toArrow().column(0).to_numpy().astype(np.int64))


def prints(docs: DataFrame, often: np.ndarray) -> DataFrame:
    """doc_id, text_key, node (of the set), n (its size), fp (its fingerprint), cells (its bands), first (its first elements),
    sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps, nodes, sizes, cells, first, sketches = [], [], [], [], [], []
            for t in b.column(2):
                hashes = shingle_hashes(t.as_py())
                s = distinct(hashes)
                fps.append(simhash.fingerprint_of(hashes))
                nodes.append(node_of(s))
                sizes.append(len(s))
                cells.append(bands(s))
                first.append(first_elements(s, often))
                sketches.append(sketch(s))
            longs = pa.list_(pa.int64())
            of = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(cells, longs), pa.array(first, longs), pa.array(sketches, longs)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *of], ["doc_id", "text_key", "node", "n", "fp", "cells", "first", "sketch"])

    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("text_key"), "text")
    return storage.in_batches(keyed).mapInArrow(storage.trimmed(run), "doc_id bigint, text_key string, node bigint, n int, fp bigint, cells array<bigint>, first array<bigint>, sketch array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, elements of the wanted (node, text_key). Most other texts are left out before texts move, and copies of one."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t.as_py()).tobytes() for t in b.column(1)], pa.binary())], ["node", "elements"])

    place = F.pmod(F.xxhash64("text_key"), F.lit(PLACES)).cast("int").alias("place")
    places = F.broadcast(wanted.select(place).distinct())  # at most PLACES numbers
    texts = docs.select(text_key().alias("text_key"), "text").withColumn("place", place).join(places, "place", "left_semi")
    texts = texts.groupBy("text_key").agg(F.first("text").alias("text")).join(wanted.hint("merge"), "text_key").select("node", "text")
    return storage.in_batches(texts).mapInArrow(storage.trimmed(read), "node bigint, elements binary")


def _alike(n_a: str, of_a: str, n_b: str, of_b: str) -> Column:
    """What sizes and sketches leave of two sets: of similar sets at most a ninth of both sizes' sum differs."""
    short, xor = F.least(F.size(of_a), F.size(of_b)), lambda x, y: x.bitwiseXOR(y)
    folded = [F.when(F.size(c) == short, F.col(c)).otherwise(F.zip_with(F.slice(c, F.lit(1), short), F.slice(c, short + 1, short), xor)) for c in (of_a, of_b)]
    bits = F.aggregate(F.zip_with(*folded, xor), F.lit(0), lambda x, y: x + F.bit_count(y))
    return F.expr(f"5 * {n_a} >= 4 * {n_b} and 5 * {n_b} >= 4 * {n_a}") & (9 * bits <= F.col(n_a) + F.col(n_b))


def _possible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and sketches leave."""
    one, two = (nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"of_{c}")) for c in "ab")
    return pairs.join(two.hint("merge"), "b").join(one.hint("merge"), "a").where(_alike("n_a", "of_a", "n_b", "of_b")).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [similar(np.frombuffer(x.as_py(), np.int64), np.frombuffer(y.as_py(), np.int64)) for x, y in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one, two = (sets.select(F.col("node").alias(c), F.col("elements").alias(f"of_{c}")) for c in "ab")
    return storage.in_batches(pairs.join(two.hint("merge"), "b").join(one.hint("merge"), "a").select("a", "b", "of_a", "of_b")).mapInArrow(storage.trimmed(run), "a bigint, b bigint")


def _similar(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar. Sets are read for those alone that sizes and sketches leave. A written table."""
    possible = storage.written(_possible(pairs.distinct(), nodes), "copies-possible")
    met = possible.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = storage.written(_sets(docs, nodes.select("node", "text_key").join(met.hint("merge"), "node")), "copies-sets")
    out = storage.written(_confirmed(possible, sets), "copies-pairs")
    storage.drop(possible, sets)
    storage.released(docs.sparkSession)
    return out


def _entries(nodes: DataFrame) -> DataFrame:
    """(cell, node, n) of each distinct set that shares a cell: its bands, its fingerprint, and each link that multi-index
    hashing gives it; n: the members of the cell."""
    pairs = simhash.links(nodes.select("fp").distinct())
    met = pairs.select(F.xxhash64("a", "b").alias("cell"), F.explode(F.array("a", "b")).alias("fp")).join(nodes.select("fp", "node").hint("merge"), "fp").select("cell", "node")
    entries = nodes.select(F.explode(F.concat("cells", F.array(F.xxhash64("fp")))).alias("cell"), "node").unionByName(met)
    several = entries.groupBy("cell").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("n")).where("lo < hi").select("cell", "n")
    out = storage.written(entries.join(several.hint("merge"), "cell").select("cell", "node", "n"), "copies-cells")
    storage.drop(pairs)
    return out


def _drawn(cells: DataFrame, k: int) -> DataFrame:
    """The pairs (a, b) of a cell's members with one that round k draws, if of another component."""
    leaders = cells.groupBy("cell").agg(F.min(F.struct(F.xxhash64("label", "cell", F.lit(k)).alias("h"), F.col("label").alias("its"), F.col("node").alias("leader"))).alias("l"))
    return cells.join(leaders.select("cell", "l.leader", "l.its"), "cell").where("label <> its").select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b"))


def _drawn_alike(cells: DataFrame, k: int) -> DataFrame:
    """Of the pairs that `_drawn` gives those that sizes leave, and what can follow the element if it is their first common one.
    cells: with n and at."""
    order = F.struct(F.xxhash64("label", "cell", F.lit(k)).alias("h"), F.col("label").alias("its"), F.col("node").alias("leader"), F.col("n").alias("size"), F.col("at").alias("its_at"))
    leaders = cells.groupBy("cell").agg(F.min(order).alias("l")).select("cell", "l.leader", "l.its", "l.size", "l.its_at")
    near = cells.join(leaders, "cell").where("label <> its and 5 * n >= 4 * size and 5 * size >= 4 * n and 9 * least(n - at, size - its_at) >= 4 * (n + size)")
    return near.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b"))


def _still_open(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """The cells that hold several components, by new labels. A written table."""
    now = cells.drop("label").join(labels.select("node", "label").hint("merge"), "node", "left").withColumn("label", F.coalesce("label", "node")).select(cells.columns)
    now = storage.written(now, "copies-labelled")
    open_cells = now.groupBy("cell").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("cell")
    out = storage.written(now.join(open_cells, "cell", "left_semi"), "copies-cells")
    storage.drop(now)
    return out


def _relabelled(labels: DataFrame | None, more: DataFrame) -> DataFrame:
    """The components of labels and more pairs. Of earlier pairs a link from each node to its label stays, so what is joined
    again grows with nodes, not with pairs. Both tables are deleted. A written table."""
    out = components(more if labels is None else labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more))
    storage.drop(more, *([] if labels is None else [labels]))
    return out


def _linked_by_most(docs: DataFrame, nodes: DataFrame, rounds: int, small: int) -> DataFrame:
    """The labels that the similar pairs give which fingerprints and bands find. A written table."""
    entries = _entries(nodes)
    little = entries.where(F.col("n") <= small)
    pairs = little.alias("x").join(little.alias("y").hint("merge"), F.expr("x.cell = y.cell and x.node < y.node")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    large = entries.where(F.col("n") > small).select("cell", "node", F.col("node").alias("label"))
    labels, used = None, [entries]
    for k in range(rounds):
        drawn = _drawn(large, k)
        more = _similar(docs, nodes, drawn if k else pairs.unionByName(drawn))
        last = k == rounds - 1 or large.isEmpty()
        labels = _relabelled(labels, more)
        if last:
            break
        large = _still_open(large, labels)
        used.append(large)
    storage.drop(*used)
    return labels


def _first_cells(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """cell, node, n, at, label: entries under the sets' first elements (the at-th of n), in cells that hold several components.
    Most elements are in one set only, so labels come after those have gone."""
    cell = Window.partitionBy("cell")
    each = nodes.select("node", "n", F.posexplode("first").alias("at", "cell"))
    held = each.withColumns({"lo": F.min("node").over(cell), "hi": F.max("node").over(cell)}).where("lo < hi")
    shared = storage.written(held.select("cell", "node", "n", "at", F.col("node").alias("label")), "copies-shared")
    storage.released(nodes.sparkSession)
    out = _still_open(shared, labels)
    storage.drop(shared)
    return out


def linked(docs: DataFrame, nodes: DataFrame, rounds: int = ROUNDS, small: int = SMALL, few: float = FEW) -> DataFrame:
    """(node, label) for every node that is linked to another; label is the smallest of its component. A written table.

    nodes: node, text_key, n, fp, cells, first, sketch; a row for each distinct set.
    """
    labels = _linked_by_most(docs, nodes, rounds, small)
    cells, enough, before = _first_cells(nodes, labels), few * nodes.count(), float("inf")
    for k in range(rounds + 1):
        sizes = cells.groupBy("cell", "label").agg(F.count("*").cast("double").alias("m")).groupBy("cell").agg((F.pow(F.sum("m"), 2) - F.sum(F.col("m") * F.col("m"))).alias("twice"))
        left = sizes.agg(F.coalesce(F.sum("twice") / 2, F.lit(0.0))).first()[0]
        if not left:
            break
        last = k == rounds or left <= enough or left > MOST * before
        if last:  # sizes, sketches and what can follow the first common element leave similar sets in
            sketched = cells.join(nodes.select("node", "sketch").hint("merge"), "node")
            near = F.expr("x.cell = y.cell and x.node < y.node and x.label <> y.label and 9 * least(x.n - x.at, y.n - y.at) >= 4 * (x.n + y.n)") & _alike("x.n", "x.sketch", "y.n", "y.sketch")
            pairs = sketched.alias("x").join(sketched.alias("y").hint("merge"), near).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        else:
            pairs = _drawn_alike(cells, k)
        more = _similar(docs, nodes, pairs)
        if more.isEmpty():
            storage.drop(more)
        else:
            labels = _relabelled(labels, more)
        if last:
            break
        was, cells, before = cells, _still_open(cells, labels), left
        storage.drop(was)
    storage.drop(cells)
    return labels


def near_copies(docs: DataFrame, rounds: int = ROUNDS, small: int = SMALL, few: float = FEW) -> DataFrame:
    """Per document: doc_id, text_key, component (a name of the group of near copies it is in). A written table."""
    each = storage.written(prints(docs, often_met(docs)), "copies-prints")
    firsts = [F.first(c).alias(c) for c in ("n", "cells", "first", "sketch")]
    nodes = storage.written(each.groupBy("node").agg(F.min("text_key").alias("text_key"), F.min("fp").alias("fp"), *firsts), "copies-nodes")
    of = storage.written(each.select("doc_id", "text_key", "node"), "copies-of")  # what is still needed for each document
    storage.drop(each)
    storage.released(docs.sparkSession)
    labels = linked(docs, nodes, rounds, small, few)
    named = of.select("doc_id", "text_key", "node").join(labels.select("node", "label").hint("merge"), "node", "left").select("doc_id", "text_key", F.coalesce("label", "node").alias("component"))
    out = storage.written(named, "copies")
    storage.drop(of, nodes, labels)
    return out
