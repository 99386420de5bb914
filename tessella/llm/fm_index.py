"""Benchmark decontamination with an FM-index per shard of the corpus.

The words of many documents make one text, a shard. Its alphabet is the words of the benchmark; a run of other words, and
the end of a document, is one gap that no phrase can cross. The suffixes are sorted, the Burrows-Wheeler transform stored
in a wavelet matrix, and every phrase is searched backwards, all phrases of a shard at once, one rank in each level for
either end of its range. Occurrences are located by walking back to a sampled suffix: every SAMPLE-th place and each place
after a gap is sampled, so a walk never crosses a gap. Overlapping occurrences merge into the spans to remove.

Sorting: suffixes that reach a gap with equal words are in the order of their places, which walks keep; so doubling stops
as soon as suffixes differ or reach a gap, whatever comes after.

Documents are never shuffled: a task builds the shards of what it reads. A benchmark of at most PHRASE_BYTES is broadcast.
A larger one never reaches the driver: tasks write it as blocks of items to the shared folder, and workers read one after
the other over each shard, so none holds more than a block.

Cases: null and empty texts have no words and no hits; items without words never occur; an item shorter than a window is
one window; an item repeated under several ids counts for each; items with a null
id hit like others and count, all together, as one item without a name; repeated documents are judged alike; other columns are
ignored; with an empty benchmark nothing is hit.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tessella.llm import storage

WINDOW = 10
SHARD_WORDS = 1 << 19
SAMPLE = 16
PHRASE_BYTES = 64 << 20
#: A-Z lower-cased, other ASCII but digits and letters to a space; bytes of longer signs stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


class WaveletMatrix:
    """Rank of any symbol in a sequence: a bit vector a level, with counts before each 64 bits."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.levels, n = [], len(seq)
        for k in range(bits - 1, -1, -1):
            bit = ((seq >> k) & 1).astype(np.uint8)
            packed = np.zeros((n // 64 + 1) * 8, np.uint8)
            packed[: (n + 7) // 8] = np.packbits(bit, bitorder="little")
            blocks = packed.view("<u8")
            before = np.zeros(len(blocks), np.int64)
            np.cumsum(np.bitwise_count(blocks[:-1]), out=before[1:])
            zeros = n - int(bit.sum())
            self.levels.append((k, blocks, before, zeros))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])
        self.at: dict = {}

    @staticmethod
    def _ones(blocks: np.ndarray, before: np.ndarray, i: np.ndarray) -> np.ndarray:
        block = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return before[block] + np.bitwise_count(blocks[block] & mask)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol is in the first i places."""
        begin = np.zeros(len(i), np.int64)
        end = i.astype(np.int64)
        for k, blocks, before, zeros in self.levels:
            ones_b, ones_e = self._ones(blocks, before, begin), self._ones(blocks, before, end)
            one = (symbol >> k) & 1 == 1
            begin = np.where(one, zeros + ones_b, begin - ones_b)
            end = np.where(one, zeros + ones_e, end - ones_e)
        return end - begin

    def access(self, i: np.ndarray) -> np.ndarray:
        out, at = np.zeros(len(i), np.int64), i.astype(np.int64)
        for k, blocks, before, zeros in self.levels:
            one = (blocks[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            ones = self._ones(blocks, before, at)
            out |= one.astype(np.int64) << k
            at = np.where(one, zeros + ones, at - ones)
        return out


def sort_suffixes(text: np.ndarray, bits: int) -> np.ndarray:
    """Places of text in the order of their suffixes; 0 is the gap. Ties at a gap stay in the order of their places."""
    n = len(text)
    take = max(1, min(62 // bits, 5))
    key = np.zeros(n, np.int64)
    open_ = np.ones(n, bool)
    for d in range(take):
        here = np.zeros(n, np.int64)
        here[: max(0, n - d)] = text[d:]
        here[~open_] = 0
        key = (key << bits) | here
        open_ &= here > 0
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    rank = np.empty(n, np.int64)
    group = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
    rank[order] = group
    gap_after = ~open_  # the suffix reaches a gap within what is sorted
    length = take
    while True:
        size = np.bincount(group)
        loose = np.flatnonzero((size[group] > 1) & ~gap_after[order])  # places in the order that are not settled
        if not len(loose):
            return order
        places = order[loose]
        second = np.zeros(n + length, np.int64)
        second[:n] = rank + 1
        tail = second[places + length]
        by = np.lexsort((places, tail, rank[places]))
        places = places[by]
        order[loose] = places
        # new ranks: groups split where the tail differs
        tail_of = np.zeros(n, np.int64)
        tail_of[places] = second[places + length]
        change = (group[1:] != group[:-1]) | ((tail_of[order][1:] != tail_of[order][:-1]) & ~gap_after[order][1:])
        group = np.concatenate(([0], np.cumsum(change)))
        rank = np.empty(n, np.int64)
        rank[order] = group
        ends = np.zeros(n + length, bool)
        ends[:n] = gap_after
        ends[n:] = True
        gap_after = gap_after.copy()
        gap_after[places] = ends[places + length]
        length *= 2


class FmIndex:
    def __init__(self, text: np.ndarray, alphabet: int):
        """text: symbols from 1, 0 for gaps; it begins and ends with a gap."""
        self.bits = max(1, int(alphabet).bit_length())
        self.n = len(text)
        order = sort_suffixes(text, self.bits)
        self.tree = WaveletMatrix(text[order - 1], self.bits)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=alphabet + 1))))
        sampled = (order % SAMPLE == 0) | (text[order - 1] == 0)
        self.marks = np.concatenate(([0], np.cumsum(sampled)))
        self.sampled, self.samples = sampled, order[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each phrase; phrases is padded on the right."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            going = np.flatnonzero((lengths >= back) & (high > low))
            if not len(going):
                continue
            symbol = phrases[going, lengths[going] - back].astype(np.int64)
            low[going], high[going] = (self.first[symbol] + self.tree.rank(symbol, side[going]) for side in (low, high))
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of suffixes, by their rows in the sorted order."""
        out, at, steps, left = np.empty(len(rows), np.int64), rows.copy(), np.zeros(len(rows), np.int64), np.arange(len(rows))
        while len(left):
            done = self.sampled[at[left]]
            out[left[done]] = self.samples[self.marks[at[left[done]]]] + steps[left[done]]
            left = left[~done]
            if len(left):
                symbol = self.tree.access(at[left])
                at[left] = self.first[symbol] + self.tree.rank(symbol, at[left])
                steps[left] += 1
        return out


class Phrases:
    """The windows of some benchmark items over the alphabet of their words."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.symbol: dict[bytes, int] = {}
        self.item_ids: list = []
        seen: dict[tuple, int] = {}
        owners: list[list[int]] = []
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            ids = [self.symbol.setdefault(w, len(self.symbol) + 1) for w in words]
            number = len(self.item_ids)
            self.item_ids.append(None if item_id is None else str(item_id))
            for k in range(max(1, len(ids) - window + 1)):
                phrase = tuple(ids[k : k + window])
                at = seen.setdefault(phrase, len(owners))
                if at == len(owners):
                    owners.append([])
                if not owners[at] or owners[at][-1] != number:
                    owners[at].append(number)
        self.lengths = np.array([len(p) for p in seen], np.int64)
        self.table = np.zeros((len(seen), window), np.int64)
        for k, p in enumerate(seen):
            self.table[k, : len(p)] = p
        self.owners = owners


def scan_shard(documents: list[list[bytes]], phrases: Phrases) -> list[tuple[set[str], list[tuple[int, int]]]]:
    """Per document the items that occur and the merged spans of words they cover, by the FM-index of all documents."""
    get = phrases.symbol.get
    counts = [len(d) for d in documents]
    flat = np.fromiter((get(w, 0) for d in documents for w in d), np.int64, sum(counts))
    begins = np.cumsum([0, *counts[:-1]]) if counts else np.empty(0, np.int64)
    if not flat.any() or not len(phrases.table):
        return [(set(), []) for _ in counts]
    # one gap before each document, runs of other words as one gap, a gap at the end
    with_gaps = np.insert(flat, begins, 0)
    where = np.insert(np.arange(len(flat)), begins, -1)
    keep = np.ones(len(with_gaps), bool)
    keep[1:] = (with_gaps[1:] != 0) | (with_gaps[:-1] != 0)
    text, where = np.append(with_gaps[keep], 0), np.append(where[keep], -1)
    index = FmIndex(text, len(phrases.symbol))
    low, high = index.search(phrases.table, phrases.lengths)
    times = high - low
    phrase = np.repeat(np.arange(len(times)), times)
    rows = np.repeat(low - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(int(times.sum()))
    place = where[index.locate(rows)]
    cover = np.zeros(len(flat) + 1, np.int64)
    np.add.at(cover, place, 1)
    np.subtract.at(cover, place + phrases.lengths[phrase], 1)
    hit = np.cumsum(cover)[:-1] > 0
    document = np.searchsorted(begins, place, "right") - 1
    items: dict[int, set[int]] = {}
    for d, p in np.unique(np.stack([document, phrase], 1), axis=0).tolist():
        items.setdefault(d, set()).update(phrases.owners[p])
    out = []
    for d, (a, c) in enumerate(zip(begins.tolist(), counts, strict=True)):
        edge = np.flatnonzero(np.diff(np.concatenate(([0], hit[a : a + c].view(np.int8), [0])))).tolist() if d in items else []
        out.append(({phrases.item_ids[i] for i in items.get(d, ())}, list(zip(edge[::2], edge[1::2], strict=True))))
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


FOUND = [("n_words", "bigint", pa.int64()), ("n_hit", "bigint", pa.int64()), ("items", "array<string>", pa.list_(pa.string())), ("spans", "array<struct<begin:bigint,end:bigint>>", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))]


def _items(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """The distinct items with a text, and in how many blocks of about PHRASE_BYTES they go."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null").distinct()
    return items, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PHRASE_BYTES) or 1


def _write_blocks(items: DataFrame, n: int, window: int) -> list[str]:
    """The phrases of each block of items as a file of the shared folder; the files' names."""
    root = storage.new_path(items.sparkSession, "fm-index-phrases")

    def run(key: tuple, groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for g in groups for r in zip(g.column("item_id").to_pylist(), g.column("text").to_pylist(), strict=True)]
        name = f"{root}/{key[0].as_py()}.phrases"
        storage.write_file(name, pickle.dumps(Phrases(sorted(rows, key=str), window)))
        yield pa.RecordBatch.from_arrays([pa.array([name])], ["name"])

    numbered = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    return [r["name"] for r in storage.in_batches(numbered).groupBy("block").applyInArrow(run, "name string").collect()]  # a name a block


def _read_block(name: str) -> Phrases:
    return pickle.loads(storage.mapped(name, "u1").tobytes())


def annotated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """docs (all columns or those of keep) with n_words, n_hit, items (those with windows in the document) and spans (word
    positions that they cover, merged), their names after a prefix. Columns of these names give way."""
    items, n = _items(benchmark)
    files = _write_blocks(items, n, window) if n > 1 else []
    small = docs.sparkSession.sparkContext.broadcast([] if files else [tuple(r) for r in items.collect()])  # PHRASE_BYTES at most
    added = [prefix + n for n, _, _ in FOUND]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    rows = docs.select("text", *[docs[c].alias(f"kept_{c}") for c in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = None if files else Phrases(small.value, window)
        pieces: list[pa.RecordBatch] = []
        held: list[list[bytes]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            items: list[set] = [set() for _ in held]
            spans: list[list] = [[] for _ in held]
            for phrases in map(_read_block, files) if files else [only]:
                for d, (i, s) in enumerate(scan_shard(held, phrases)):
                    items[d] |= i
                    spans[d] += s
            spans = [merged(s) for s in spans]
            found = [[len(w) for w in held], [sum(z - a for a, z in s) for s in spans], [sorted(i, key=lambda x: (x is None, x or "")) for i in items], [[{"begin": a, "end": z} for a, z in s] for s in spans]]
            at = 0
            for piece in pieces:
                mine = [pa.array(c[at : at + piece.num_rows], t) for c, (_, _, t) in zip(found, FOUND, strict=True)]
                yield pa.RecordBatch.from_arrays([*piece.columns[1:], *mine], [*keep, *added])
                at += piece.num_rows

        for b in batches:
            begin = 0
            for k, t in enumerate(b.column(0)):
                held.append(words_of(t.as_py()))
                size += len(held[-1])
                if size >= SHARD_WORDS:
                    pieces.append(b.slice(begin, k + 1 - begin))
                    yield from flush()
                    pieces, held, size, begin = [], [], 0, k + 1
            if begin < b.num_rows:
                pieces.append(b.slice(begin))
        if held:
            yield from flush()

    schema = StructType([StructField(c, docs.schema[c].dataType) for c in keep] + StructType.fromDDL(", ".join(f"{prefix}{n} {t}" for n, t, _ in FOUND)).fields)
    return storage.in_batches(rows).mapInArrow(storage.trimmed(run), schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items, spans."""
    return annotated(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), benchmark, window, ["doc_id"])


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns of `contamination`."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "spans"
    )
