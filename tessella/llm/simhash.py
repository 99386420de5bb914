"""SimHash fingerprints and near-duplicates by multi-index hashing.

A fingerprint is cut into two segments of 32 bits. If two fingerprints differ in at most two bits, one of the segments
differs in at most one. So each distinct fingerprint is entered in a table per segment under the segment's value, and
looks up, in each table, the 33 values in the ball of radius one around its own; whole distances are checked on what is
found.

Hot table cells: a cell with more than HOT fingerprints would make candidates with the square of its size. Fingerprints
that look into such a cell are linked another exact way: two fingerprints differ in at most two bits just if the balls of
radius one around them meet, so each is dealt to the 65 values of its ball, and each value's members (65 at most) are
linked to the smallest. Every pair that a hot cell holds is linked so, directly or through that member.

Joins of tables that grow with the documents are sort-merge joins by hint: Spark guesses what an exploded table weighs from
the file below it, and would gather millions of entries on the driver to broadcast them.

Equal fingerprints are one node, however many documents have them. Components come from labels that shrink along links
and jump over each other, each round written to the shared folder.

Cases: null and empty texts have no words and fingerprint zero, which links like any other; fewer words than a shingle
give one shingle of them all; repeated rows are documents like any other; null doc_id: such rows get a component, but
never name one unless all of it has null ids; an empty table gives no rows. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm import storage
from tessella.llm.components import components

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
HOT = 64


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of a text's words."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    h = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([h(joined, 42)], np.uint64)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = np.concatenate(([0], stops[: -width]))
    return np.fromiter((h(joined[a:z], 42) for a, z in zip(begins.tolist(), (stops[width - 1 :] - 1).tolist(), strict=True)), np.uint64, len(begins))


def fingerprint(text: str | None, width: int = 3) -> int:
    return fingerprint_of(shingle_hashes(text, width))


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bit k is 1 if it is set in over half of the hashes. Long texts are counted in blocks."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        block = hashes[k : k + 4096].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, fp: the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), width) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["doc_id", "fp"])

    return storage.in_batches(docs.selectExpr("cast(doc_id as bigint) doc_id", "text")).mapInArrow(storage.trimmed(run), "doc_id bigint, fp bigint")


def _flips(bits: range) -> Column:
    """The one-bit masks of some bits, as signed longs."""
    return F.array(*[F.lit(int(np.uint64(1 << b).astype(np.int64))) for b in bits])


def links(nodes: DataFrame, hot: int = HOT) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints within two bits: enough of them to connect all that are linked.

    nodes: one row for each distinct fp. The result is a written table.
    """
    segments = F.array(F.shiftrightunsigned("fp", 32), F.expr("(fp & 4294967295L) + 4294967296L"))
    entries = nodes.select("fp", F.explode(segments).alias("cell"))
    crowded = entries.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("cell")
    held = entries.join(crowded, "cell", "left_anti").select("cell", F.col("fp").alias("other"))
    held = held.unionByName(crowded.select("cell", F.lit(None).cast("bigint").alias("other")))
    ball = F.transform(_flips(range(32)), lambda m: F.col("cell").bitwiseXOR(m))
    looks = entries.select("fp", F.explode(F.concat(F.array("cell"), ball)).alias("cell"))
    near = F.col("other").isNull() | ((F.col("fp") < F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= 2))
    found = storage.written(looks.join(held.hint("merge"), "cell").where(near).select("fp", "other"), "simhash-matches")
    pairs = found.where(F.col("other").isNotNull()).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    at_hot = found.where(F.col("other").isNull()).select("fp").distinct()
    around = at_hot.select("fp", F.explode(F.concat(F.array(F.lit(0).cast("bigint")), _flips(range(64)))).alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("middle"))
    met = around.groupBy("middle").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("members")).where(F.size("members") > 1)
    stars = met.select("a", F.explode("members").alias("b")).where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2))
    out = storage.written(pairs.unionByName(stars).distinct(), "simhash-links")
    storage.drop(found)
    return out


def near_duplicates(docs: DataFrame, width: int = 3, hot: int = HOT) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest doc_id it is linked to)."""
    prints = storage.written(fingerprints(docs, width), "simhash-fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    pairs = links(nodes.select("fp"), hot)
    labels = components(pairs)
    named = nodes.join(labels.select("node", "label").hint("merge"), F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    named = storage.written(named, "simhash-components")
    storage.drop(pairs, labels)
    smallest = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of_print = named.join(smallest.hint("merge"), "label").select("fp", "component_id")
    return prints.join(of_print.hint("merge"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
