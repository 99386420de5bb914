"""Token ids as binary shards under Re-Pair grammars.

A shard holds the ids of consecutive documents (ascending doc_id). Its grammar replaces, again and again, frequent pairs
of neighbouring symbols by a new symbol, until no pair occurs MIN_COUNT times (or MAX_RULES rules are made, or symbols
would need more than 16 bits where the vocabulary's ids do not). Rules and their expansion lengths are stored beside the
shortened sequence, and the place of every SAMPLE-th symbol, so any id range decodes from its sample on without a look
at the rest (`decode_range`, `read_ranges`).

Work is dealt by ranges of (doc_id, text hash, place in the input): no hot key, not even rows equal in both. The file is a Parquet table with a
row per shard, written by Spark's committer, so a lost executor repeats its tasks and nothing is half there.

Cases: null text counts as empty (it gets the end id alone); null doc_id sorts first; repeated rows stay, each with its
own ids; an empty table gives an empty file; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import gc
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm import splitting, storage

SHARD_SCHEMA = (
    "part int, shard int, part_start bigint, n_tokens bigint, doc_ids array<bigint>, doc_tokens array<int>, base int, "
    "width int, rules binary, rule_lengths binary, symbols binary, samples binary"
)
ROW_SCHEMA = "doc_id bigint, part int, local_start bigint, n_tokens bigint, ids_crc32 bigint"
SHARD_TOKENS = 1 << 18
MIN_COUNT, MAX_RULES, SAMPLE = 10, 1 << 14, 1024
CACHE_WORDS = 400_000
BATCH_CHARS = 4 << 20


# ---------------------------------------------------------------- grammar


def repair(ids: np.ndarray, base: int, min_count: int = MIN_COUNT, max_rules: int = MAX_RULES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules, expansion length of each, symbols): rules[k] is the pair that symbol base + k stands for.

    Each round counts neighbouring pairs, gives every pair seen min_count times a new symbol (the most frequent first
    where symbols run out) and replaces its occurrences from left to right without overlap; a rule that overlaps leave
    fewer than two uses is not made. A round looks at pairs with a symbol of the round before, as only those can have
    become frequent; when there is none, a last look at all pairs says that it is done. Symbols that would need more
    than 16 bits are only made if the base does.
    """
    seq, rules, lengths = ids.astype(np.uint64), [np.empty((0, 2), np.uint32)], np.ones(base, np.uint32)
    room = min(max_rules, (1 << 16) - base) if base < 1 << 16 else max_rules
    fresh = 0
    while True:
        wide, far = int(base + max_rules).bit_length(), np.uint64(max(1, len(seq).bit_length()))
        if len(seq) < 2 or room <= 0 or 2 * wide + int(far) > 64:
            break
        new = seq >= np.uint64(fresh)
        at = np.flatnonzero(new[:-1] | new[1:]).astype(np.uint64) if fresh else np.arange(len(seq) - 1, dtype=np.uint64)
        packed = (((seq[at] << np.uint64(wide)) | seq[at + np.uint64(1)]) << far) | at
        packed.sort()  # pairs together, their places ascending
        pair = packed >> far
        edge = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else at.astype(np.int64)
        counts = np.diff(np.append(edge, len(pair)))
        often = np.flatnonzero(counts >= max(min_count, 2))
        if len(often) > room:
            often = np.sort(often[np.argsort(-counts[often], kind="stable")[:room]])
        made = 0
        if len(often):
            rule_of_group = np.full(len(counts), -1, np.int32)
            rule_of_group[often] = np.arange(len(often), dtype=np.int32)
            by_pair = np.repeat(rule_of_group, counts)
            chosen = by_pair >= 0
            rule = np.full(len(seq), -1, np.int32)
            rule[(packed[chosen] & ((np.uint64(1) << far) - np.uint64(1))).astype(np.int64)] = by_pair[chosen]
            where = np.flatnonzero(rule >= 0)
            run = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1] + 1)))  # chains of overlapping places
            where = where[(np.arange(len(where)) - np.repeat(run, np.diff(np.append(run, len(where))))) % 2 == 0]
            used = np.bincount(rule[where], minlength=len(often)) >= 2
            where, made = where[used[rule[where]]], int(used.sum())
        if not made:
            if not fresh:
                break
            fresh = 0
            continue
        pairs = pair[edge[often[used]]]
        two = np.stack([pairs >> np.uint64(wide), pairs & np.uint64((1 << wide) - 1)], 1).astype(np.uint32)
        number = (len(lengths) + np.cumsum(used) - 1).astype(np.uint64)
        fresh = len(lengths)
        lengths = np.concatenate([lengths, lengths[two[:, 0]] + lengths[two[:, 1]]])
        rules.append(two)
        room -= made
        seq[where] = number[rule[where]]
        keep = np.ones(len(seq), bool)
        keep[where + 1] = False
        seq = seq[keep]
    return np.concatenate(rules), lengths[base:], seq.astype(np.uint32)


def sizes_of(symbols: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """How many ids each symbol stands for."""
    size = np.ones(len(symbols), np.int64)
    long = symbols >= base
    size[long] = lengths[symbols[long].astype(np.int64) - base]
    return size


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    seq = symbols.astype(np.uint32)
    while len(where := np.flatnonzero(seq >= base)):
        pair, where = rules[seq[where] - base], where + np.arange(len(where))
        longer = np.empty(len(seq) + len(where), np.uint32)
        old = np.ones(len(longer), bool)
        old[where] = old[where + 1] = False
        longer[where], longer[where + 1] = pair[:, 0], pair[:, 1]
        longer[old] = seq[seq < base]
        seq = longer
    return seq


def samples_of(symbols: np.ndarray, lengths: np.ndarray, base: int) -> bytes:
    """How many ids stand before every SAMPLE-th symbol."""
    size = sizes_of(symbols, lengths, base)
    return (np.cumsum(size) - size)[::SAMPLE].astype("<i8").tobytes()


def unpack(shard: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(symbols, rules, expansion length of each rule, base) of a row of the file."""
    return (
        np.frombuffer(shard["symbols"], f"<u{shard['width']}"),
        np.frombuffer(shard["rules"], "<u4").reshape(-1, 2),
        np.frombuffer(shard["rule_lengths"], "<u4"),
        shard["base"],
    )


def decode_range(shard: dict, begin: int, end: int) -> np.ndarray:
    """The ids begin to end of a shard: from the last sample before begin, symbols are measured up to end, and only those
    that cover the range are expanded."""
    symbols, rules, lengths, base = unpack(shard)
    samples = np.frombuffer(shard["samples"], "<i8")  # ids before every SAMPLE-th symbol
    begin = max(begin, 0)
    if begin >= end or not len(symbols):
        return np.empty(0, np.uint32)
    first = max(int(np.searchsorted(samples, begin, "right")) - 1, 0)
    last = int(np.searchsorted(samples, end, "left"))
    part, start = symbols[first * SAMPLE : last * SAMPLE], int(samples[first])
    stop = start + np.cumsum(sizes_of(part, lengths, base))
    end = min(end, int(stop[-1]))
    if begin >= end:
        return np.empty(0, np.uint32)
    a, b = np.searchsorted(stop, begin, "right"), np.searchsorted(stop, end, "left")
    skip = begin - (int(stop[a - 1]) if a else start)
    return expand(part[a : b + 1], rules, base)[skip : skip + end - begin]


# ---------------------------------------------------------------- encoding


class _Words(dict):
    """A word's ids as bytes, asked of the library's model when first seen."""

    def __init__(self, model):
        self.model = model

    def __missing__(self, word: str) -> bytes:
        shown = word if word.isascii() else "".join([BYTE_SIGNS[b] for b in word.encode()])
        self[word] = ids = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return ids


def _byte_signs() -> list[str]:
    """The sign that stands for each byte in byte-level vocabularies: printable Latin-1 itself, the rest from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


BYTE_SIGNS = _byte_signs()


class WordEncoder:
    """Ids of whole texts as the tokenizers library gives them.

    For texts of plain signs (ASCII and precomposed Latin, which the vocabulary's normaliser only lower-cases, and white
    space, which it drops) the splitter's pattern runs here and the library's model encodes each distinct word once for
    many texts. Texts with any other sign or with a special token's marks go to the library whole, as do all texts if
    the vocabulary has another splitter.
    """

    #: The splitter of the vocabulary, and the same with the commonest kind first; no two kinds begin alike.
    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    SAME = r"\p{L}+|'(?:s|t|re|ve|m|ll|d)|\p{N}|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.plain = self.PIECES in str(self.tokenizer.pre_tokenizer).replace("\\\\", "\\") and "Lowercase()" in str(self.tokenizer.normalizer)
        self.split = splitting.compiled(self.SAME)
        self.cache = _Words(self.tokenizer.model)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit little-endian integers."""
        out: list = [None] * len(texts)
        hard = []
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        get, odd, split = self.cache.__getitem__, splitting.odd, self.split
        for k, t in enumerate(texts):
            if not self.plain or "<|" in t or odd(t):
                hard.append(k)
            else:
                out[k] = b"".join(map(get, split(t.lower())))
        if hard:
            for k, e in zip(hard, self.tokenizer.encode_batch_fast([texts[k] for k in hard], add_special_tokens=False), strict=True):
                out[k] = np.asarray(e.ids, "<u4").tobytes()
        return out


@lru_cache(maxsize=2)
def encoder_of(path: str) -> WordEncoder:
    """One encoder a worker process: the words it has met in one task serve the next."""
    encoder = WordEncoder(path)
    gc.freeze()  # the vocabulary stays; words come and go without cycles
    return encoder


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(doc_ids, texts) with about BATCH_CHARS characters each."""
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            t = t.as_py() or ""
            ids.append(i)
            texts.append(t)
            size += len(t)
            if size >= BATCH_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def encode_shards(docs: DataFrame, tokenizer_path: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS, partitions: int | None = None) -> DataFrame:
    """The rows of the file (SHARD_SCHEMA): parts in ascending doc_id order, shards in order within each."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, part, shard, start = encoder_of(tokenizer_path), TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], "<u4").tobytes()
        doc_ids: list = []
        sizes: list[int] = []
        held: list[bytes] = []
        base = max(coder.size, end_id + 1)

        def flush() -> pa.RecordBatch:
            nonlocal shard, start, doc_ids, sizes, held
            ids = np.frombuffer(b"".join(held), "<u4")
            rules, lengths, symbols = repair(ids, base)
            width = 2 if base + len(rules) <= 1 << 16 else 4
            row = {
                "part": part, "shard": shard, "part_start": start, "n_tokens": len(ids), "doc_ids": doc_ids, "doc_tokens": sizes, "base": base, "width": width,
                "rules": rules.astype("<u4").tobytes(), "rule_lengths": lengths.astype("<u4").tobytes(), "symbols": symbols.astype(f"<u{width}").tobytes(), "samples": samples_of(symbols, lengths, base),
            }
            shard, start, doc_ids, sizes, held = shard + 1, start + len(ids), [], [], []
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        pending = 0
        for ids, texts in _chunks(batches):
            for i, e in zip(ids, coder.encode(texts), strict=True):
                doc_ids.append(i)
                sizes.append(len(e) // 4 + 1)
                held += (e, end)
                pending += sizes[-1]
                if pending >= shard_tokens:
                    yield flush()
                    pending = 0
        if held:
            yield flush()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(SHARD_SCHEMA))
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the place splits rows that are equal in id and text, whose order shows in nothing that is written
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("place"))
    rows = rows.repartitionByRange(n, "doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie", "text")
    return storage.in_batches(rows.select("doc_id", "text")).mapInArrow(encode, SHARD_SCHEMA)


def read_documents(shards: DataFrame) -> DataFrame:
    """Per document of the file: doc_id, start, n_tokens, ids_crc32 (and part, local_start), from the decoded ids.

    Starts come in two steps: each shard knows the ids before it in its part, and the totals of the parts, one number
    for each task of the writing, are summed on the driver.
    """
    spark = shards.sparkSession
    totals = sorted(shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    before, rows = 0, []
    for r in totals:
        rows.append((r["part"], before))
        before += r["n"]
    starts = spark.createDataFrame(rows, "part int, part_offset bigint")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                symbols, rules, _, base = unpack(r)
                ids = expand(symbols, rules, base).astype("<u4").tobytes()
                stops = np.cumsum(np.array(r["doc_tokens"], np.int64))
                begins = stops - np.array(r["doc_tokens"], np.int64)
                crc = [zlib.crc32(ids[4 * a : 4 * z]) for a, z in zip(begins.tolist(), stops.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array([r["part"]] * len(crc), pa.int32()), pa.array(begins + r["part_start"]), pa.array(stops - begins), pa.array(crc, pa.int64())],
                    ["doc_id", "part", "local_start", "n_tokens", "ids_crc32"],
                )

    out = storage.in_batches(shards).mapInArrow(decode, ROW_SCHEMA).join(F.broadcast(starts), "part")
    return out.select("doc_id", (F.col("part_offset") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", "part", "local_start")


def read_ranges(shards: DataFrame, wanted: DataFrame) -> DataFrame:
    """The ids of some documents (wanted: doc_id) without decoding the rest: doc_id, part, local_start, ids. Shards without
    any of them are left out; of the others, the samples lead to each document's symbols."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                stops = np.cumsum(np.array(r["doc_tokens"], np.int64)).tolist()
                found: tuple[list, list, list, list] = ([], [], [], [])
                for at in r["places"]:
                    begin = stops[at] - r["doc_tokens"][at]
                    for column, v in zip(found, (r["doc_ids"][at], r["part"], r["part_start"] + begin, decode_range(r, begin, stops[at])), strict=True):
                        column.append(v)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, kinds, strict=True)], ["doc_id", "part", "local_start", "ids"])

    here = shards.select("part", "shard", F.posexplode("doc_ids").alias("place", "doc_id"))
    here = here.join(wanted.select(F.col("doc_id").alias("_id")).distinct(), F.col("doc_id").eqNullSafe(F.col("_id"))).groupBy("part", "shard").agg(F.collect_list("place").alias("places"))
    return storage.in_batches(shards.join(here, ["part", "shard"])).mapInArrow(decode, "doc_id bigint, part int, local_start bigint, ids array<int>")
