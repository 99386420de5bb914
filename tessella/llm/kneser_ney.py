"""Interpolated modified Kneser-Ney language model of order two, counted in Spark, scored from memory-mapped arrays.

    P(w | v) = max(c(vw) - D(c(vw)), 0) / c(v.) + g(v) P1(w)      P1(w) = max(a(w) - E(a(w)), 0) / a(.) + h / (V + 1)

c: counts of pairs, a(w): distinct words before w, D and E: three discounts each from the counts of counts (Chen and
Goodman 1998), g and h: the mass the discounts leave, V: distinct words; the 1 is for all unknown words. Texts begin
after a start mark and end with an end mark that is predicted like a word.

Order: with three words, the files and the shuffle of this corpus's mostly distinct triples come to several times the
input; pairs are what the disk limit holds (see README).

Counting: a task counts the pairs of what it reads and sends, for each bucket of first words, one compressed row of
sorted arrays (7-byte hashes, counts), so a frequent word or pair is one entry a task, however often it occurs. The number
of buckets follows the size of the texts. A first word that a sample shows to be frequent has its pairs dealt to as many
buckets as its share asks for; the sample decides the places of counts, never a count. A bucket merges its rows, writes its
arrays as files of the shared folder (whole or not at all, under a name fixed by the bucket, so a repeated task writes the
same) and passes on what each of its words needs as first and as second, which is merged alike. Every bucket has its files,
empty ones too, so a file that is not there is an error. Nothing of the size of the vocabulary reaches the driver: only
counts of counts and the frequent words do.

Scoring: workers map the files and look up the sorted distinct pairs of a block of documents.

Words go by 56-bit hashes, pairs by 64-bit hashes within a bucket: two of a million million words may share a number, then
their counts are added up, and n_known and the scores of texts with such words are off by that.

Cases: null and empty texts are the end mark alone; texts of a null doc_id count as training; a repeated row counts
again; an empty table gives no rows; other columns are ignored; with no training rows every word is unknown and all
words share the uniform distribution.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm import storage

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
HASH = np.uint64((1 << 56) - 1)
#: No word contains white space, so these two name no word.
START, END = b" <", b" >"
BLOCK_WORDS = 1 << 19
#: Of text a bucket, until there are MANY buckets; then larger ones.
BUCKET_BYTES, LARGE_BYTES, MANY, MOST = 3 << 20, 64 << 20, 4096, 1 << 18
#: Documents of the sample that finds frequent words.
SAMPLED = 20_000
OPEN_FILES = 8192
#: Of a counting task, before it sends what it has.
HELD_WORDS, HELD_PAIRS = 250_000, 1_500_000


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) & 0xFFFFFFFFFFFFFF


class Words(dict):
    """Numbers words as they come; the hash of number k is hashes[k]."""

    def __init__(self):
        super().__init__()
        self.hashes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.hashes.append(word_hash(word))
        return n

    def table(self) -> np.ndarray:
        return np.array(self.hashes, np.uint64)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LOWER).split()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]]]]:
    """(doc_ids, words) of about BLOCK_WORDS words each."""
    ids, docs, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            words = words_of(t.as_py())
            ids.append(i)
            docs.append(words)
            size += len(words) + 1
            if size >= BLOCK_WORDS:
                yield ids, docs
                ids, docs, size = [], [], 0
    if ids:
        yield ids, docs


def _numbers(docs: list[list[bytes]], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(before, word, document) for every token of a block, ends included."""
    lengths = np.fromiter((len(d) + 1 for d in docs), np.int64, len(docs))
    get = words.__getitem__
    end, start = words[END], words[START]
    flat: list[int] = []
    for d in docs:
        flat += map(get, d)
        flat.append(end)
    word = np.array(flat, np.int64)
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[np.cumsum(lengths) - lengths] = start
    return before, word, np.repeat(np.arange(len(docs)), lengths)


# ---------------------------------------------------------------- packed arrays


def pack(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(data, np.uint8).reshape(-1, 7)
    return out.view("<u8").ravel().astype(np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Bytes up to 254; larger ones are 255 and follow in full."""
    big = counts[counts > 254].astype("<u8")
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + big.tobytes()


def unpack_counts(data: bytes, n: int) -> np.ndarray:
    small = np.frombuffer(data[:n], np.uint8).astype(np.int64)
    small[small == 255] = np.frombuffer(data[n:], "<u8").astype(np.int64)
    return small


def summed(keys: tuple[np.ndarray, ...], *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys in order (the first key leads) and the sums of the values."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    keys = tuple(k[order] for k in keys)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(new)
    return [k[at] for k in keys] + [np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values]


def pair_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One 64-bit hash of two word hashes."""
    x = before * np.uint64(0x9E3779B97F4A7C15) ^ (word + np.uint64(0xD1B54A32D192ED03))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


# ---------------------------------------------------------------- counting


def training(rule_out: int, modulus: int, doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus != rule_out, F.lit(True))


def pair_home(before: np.ndarray, word: np.ndarray, buckets: int, hot: np.ndarray) -> np.ndarray:
    """The bucket of each pair. hot: (2, n) of frequent first words, ascending, and the buckets that each is dealt to."""
    home = before % np.uint64(buckets)
    if hot.shape[1]:
        at = np.minimum(np.searchsorted(hot[0], before), hot.shape[1] - 1)
        mine = np.flatnonzero(hot[0][at] == before)
        home[mine] = (home[mine] + pair_key(before[mine], word[mine]) % hot[1][at[mine]]) % np.uint64(buckets)
    return home.astype(np.int64)


def frequent(docs: DataFrame, rows: int, buckets: int) -> np.ndarray:
    """For pair_home: the words that are more than a quarter of a bucket's share of what comes before a word, by a sample of
    about SAMPLED documents; at most four a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in _blocks(batches):
            words = Words()
            before, _, _ = _numbers(block, words)
            n = np.bincount(before, minlength=len(words))
            keep = np.flatnonzero(n >= max(1, len(before) // (8 * buckets)))
            yield pa.RecordBatch.from_arrays([pa.array([-1, *words.table()[keep].astype(np.int64).tolist()], pa.int64()), pa.array([len(before), *n[keep].tolist()], pa.int64())], ["word", "n"])

    some = docs.select("doc_id", "text").sample(min(1.0, SAMPLED / max(rows, 1)), 7)
    counts = storage.in_batches(some).mapInArrow(storage.trimmed(run), "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = storage.written(counts, "kneser-ney-frequent")
    total = counts.where("word = -1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = counts.where((F.col("word") >= 0) & (F.col("n") * 4 * buckets > total)).orderBy("word").collect() if total else []
    storage.drop(counts)
    return np.array([[r["word"] for r in found], [min(buckets, 1 + 2 * buckets * r["n"] // total) for r in found]], np.uint64).reshape(2, -1)


def count_pairs(docs: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """Rows (bucket, data) of each task: its pairs that fall into the bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def send() -> Iterator[pa.RecordBatch]:
            table = words.table()
            by_hash = np.argsort(table)
            place = np.empty(len(table), np.int64)  # words by hash
            place[by_hash] = np.arange(len(table))
            first, second = keys >> 32, keys & 0xFFFFFFFF
            ranked = pair_home(table[first], table[second], buckets, hot) << 44 | place[first] << 22 | place[second]
            del first, second
            order = np.argsort(ranked)
            ranked, n = ranked[order], counts[order]
            del order
            table = table[by_hash]
            edge = np.searchsorted(ranked, np.arange(buckets + 1, dtype=np.int64) << 44)
            for k in np.flatnonzero(np.diff(edge)).tolist():
                mine, times = ranked[edge[k] : edge[k + 1]], n[edge[k] : edge[k + 1]]
                before = mine >> 22 & 0x3FFFFF
                starts = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
                runs = np.diff(np.append(starts, len(mine)))
                parts = [pack(table[before[starts]]), pack_counts(runs), pack(table[mine & 0x3FFFFF]), pack_counts(times)]
                sizes = np.array([len(starts), len(mine), *map(len, parts)], "<i8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([sizes + b"".join(parts)], pa.binary())], ["bucket", "data"])

        for _, block in _blocks(batches):
            before, word, _ = _numbers(block, words)
            found, n = np.unique(before << 32 | word, return_counts=True)
            keys, counts = summed((np.concatenate([keys, found]),), np.concatenate([counts, n]))
            if len(keys) > HELD_PAIRS or len(words) > HELD_WORDS:  # a task of any length stays within bounded memory
                yield from send()
                words = Words()
                keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        if len(keys):
            yield from send()

    return storage.in_batches(docs.select("doc_id", "text")).mapInArrow(storage.trimmed(run), "bucket int, data binary")


def _read_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.frombuffer(data[:48], "<i8")
    cut = 48 + np.cumsum([0, *sizes[2:]])
    first, runs, word, n = (data[a:z] for a, z in zip(cut[:-1], cut[1:], strict=True))
    return np.repeat(unpack(first), unpack_counts(runs, sizes[0])), unpack(word), unpack_counts(n, sizes[1])


def _counts_of_counts(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


def bucket_count(size: int) -> int:
    """How many buckets for so many bytes of text."""
    return max(16, min(-(-size // BUCKET_BYTES), max(MANY, -(-size // LARGE_BYTES)), MOST))


def _packed(*columns: np.ndarray) -> bytes:
    """A table of words (the first column) and counts."""
    parts = [pack(columns[0]), *map(pack_counts, columns[1:])]
    return np.array([len(columns[0]), *map(len, parts)], "<i8").tobytes() + b"".join(parts)


def _unpacked(data: bytes, columns: int) -> tuple[list[np.ndarray], bytes]:
    """The table that data begins with, and what follows it."""
    sizes = np.frombuffer(data[: 8 * columns + 8], "<i8")
    cut = 8 * columns + 8 + np.cumsum([0, *sizes[1:]])
    parts = [data[a:z] for a, z in zip(cut[:-1], cut[1:], strict=True)]
    return [unpack(parts[0]), *(unpack_counts(p, sizes[0]) for p in parts[1:])], data[cut[-1] :]


def _columns(tables: list, n: int) -> list[np.ndarray]:
    """Tables of n columns under each other: the first of words, the others of counts."""
    return [np.concatenate([t[k] for t in tables] or [np.empty(0, np.int64 if k else np.uint64)]) for k in range(n)]


def build(docs: DataFrame, buckets: int | None = None) -> dict:
    """Count docs and write the model; returns its description (small: names of files, discounts, totals, frequent words)."""
    spark = docs.sparkSession
    rows, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n = buckets or bucket_count(size)
    m = max(16, n // 16)  # buckets of words: each bucket of pairs sends a row to each, so fewer, longer rows
    hot = frequent(docs, rows, n)
    root = storage.new_path(spark, "kneser-ney")

    def merge_pairs(key: tuple, groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = key[0].as_py()
        parts = [_read_pairs(d) for g in groups for x in g.column("data") if (d := x.as_py())]
        before, count = _columns([(p[0], p[2]) for p in parts], 2)
        (word,) = _columns([(p[1],) for p in parts], 1)
        del parts
        before, word, count = summed((before, word), count)
        hashed = pair_key(before, word)
        order = np.argsort(hashed)
        big = count[order] > 65534
        storage.write_file(f"{root}/pairs-{bucket}.hash", hashed[order].astype("<u8").tobytes())
        storage.write_file(f"{root}/pairs-{bucket}.count", np.minimum(count[order], 65535).astype("<u2").tobytes())
        storage.write_file(f"{root}/pairs-{bucket}.large", np.stack([hashed[order][big], count[order][big].astype(np.uint64)]).astype("<u8").tobytes())
        del hashed, order
        as_first = summed((before,), count, *((count == k).astype(np.int64) for k in (1, 2)), (count > 2).astype(np.int64))
        as_second = summed((word,), np.ones(len(word), np.int64), count)
        edges = [(t, np.argsort(h, kind="stable"), h) for t in (as_second, as_first) for h in [(t[0] % np.uint64(m)).astype(np.int64)]]
        edges = [(t, order, np.searchsorted(h[order], np.arange(m + 1))) for t, order, h in edges]
        out: tuple[list, list, list] = ([-1], [b""], [_counts_of_counts(count)])
        for k in range(m):
            mine = [[c[order[edge[k] : edge[k + 1]]] for c in t] for t, order, edge in edges]
            if any(len(t[0]) for t in mine):
                out[0].append(k)
                out[1].append(b"".join(_packed(*t) for t in mine))
                out[2].append([0, 0, 0, 0])
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.list_(pa.int64()))], ["bucket", "data", "ns"])

    def merge_words(key: tuple, groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, seconds, firsts = key[0].as_py(), [], []
        for g in groups:
            for x in g.column("data"):
                if d := x.as_py():
                    of, d = _unpacked(d, 3)
                    seconds.append(of)
                    firsts.append(_unpacked(d, 5)[0])
        a, b = _columns(seconds, 3), _columns(firsts, 5)
        seconds, firsts = summed((a[0],), *a[1:]), summed((b[0],), *b[1:])
        both = np.union1d(seconds[0], firsts[0])
        counts = np.zeros((len(both), 6), np.int64)  # distinct words before, occurrences; as a first word: all, once, twice, more
        counts[np.searchsorted(both, seconds[0]), :2] = np.stack(seconds[1:], 1)
        counts[np.searchsorted(both, firsts[0]), 2:] = np.stack(firsts[1:], 1)
        storage.write_file(f"{root}/words-{bucket}.hash", both.astype("<u8").tobytes())
        storage.write_file(f"{root}/words-{bucket}.counts", counts.astype("<i8").tobytes())
        kinds, total = seconds[1:]
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([len(kinds)], pa.int64()), pa.array([int(total.sum())]), pa.array([int(kinds.sum())]), pa.array([_counts_of_counts(kinds)], pa.list_(pa.int64()))], ["bucket", "words", "tokens", "kinds", "ns"])

    every = lambda k: spark.range(k).select(F.col("id").cast("int").alias("bucket"), F.lit(b"").alias("data"))  # noqa: E731  so that each bucket has its files
    merged = count_pairs(docs, n, hot).unionByName(every(n)).groupBy("bucket").applyInArrow(merge_pairs, "bucket int, data binary, ns array<bigint>")
    merged = storage.written(merged, "kneser-ney-words", compression="none")
    ns = merged.where("bucket = -1").select(*[F.coalesce(F.sum(F.col("ns")[k]), F.lit(0)) for k in range(4)]).first()
    totals = merged.where("bucket >= 0").select("bucket", "data").unionByName(every(m)).groupBy("bucket").applyInArrow(merge_words, "bucket int, words bigint, tokens bigint, kinds bigint, ns array<bigint>")
    t = totals.select(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "tokens", "kinds", *(F.col("ns")[k] for k in range(4)))]).first()
    storage.drop(merged)
    seen, e = list(t)[3:], discounts(list(t)[3:])
    left = (e[1] * seen[0] + e[2] * seen[1] + e[3] * (t[0] - seen[0] - seen[1])) / t[2] if t[2] else 1.0
    return {"root": root, "buckets": n, "word_buckets": m, "hot": hot, "words": t[0], "tokens": t[1], "kinds": t[2], "pair_discounts": discounts(list(ns)), "word_discounts": e, "word_left": left}


def discounts(ns: list[int]) -> list[float]:
    """(0, D1, D2, D3+) from the numbers of things counted once to four times; where one is zero, one half."""
    n1, n2, n3, n4 = ns
    if not (n1 and n2 and n3 and n4):
        return [0.0, 0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    return [0.0, *(min(max(d, 0.05), k - 0.05) for k, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3)))]


# ---------------------------------------------------------------- scoring


class Model:
    """The model's arrays as mapped files, OPEN_FILES at most at once. A missing file is an error."""

    def __init__(self, about: dict):
        self.about = about
        self.files: dict[str, np.ndarray] = {}
        self.pair_d, self.word_d = np.array(about["pair_discounts"]), np.array(about["word_discounts"])
        self.unseen = about["word_left"] / (about["words"] + 1)

    def file(self, name: str, dtype: str) -> np.ndarray:
        if (found := self.files.pop(name, None)) is None:
            found = storage.mapped(f"{self.about['root']}/{name}", dtype)
            if len(self.files) >= OPEN_FILES:
                del self.files[next(iter(self.files))]
        self.files[name] = found  # the last used is last
        return found

    def find(self, kind: str, keys: np.ndarray, home: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """For each bucket with keys that it has: (their places in keys, the bucket, their places in its arrays)."""
        order = np.lexsort((keys, home))
        edge = np.searchsorted(home[order], np.arange(self.about["word_buckets" if kind == "words" else "buckets"] + 1))
        for k in np.flatnonzero(np.diff(edge)).tolist():
            mine = order[edge[k] : edge[k + 1]]
            have = self.file(f"{kind}-{k}.hash", "<u8")
            if len(have):
                at = np.minimum(np.searchsorted(have, keys[mine]), len(have) - 1)
                same = have[at] == keys[mine]
                yield mine[same], k, at[same]

    def word_stats(self, words: np.ndarray) -> np.ndarray:
        """Of word hashes, a row each: distinct words before, count; as a context: count, followers seen once, twice, more."""
        out = np.zeros((len(words), 6), np.int64)
        for mine, k, at in self.find("words", words, (words % np.uint64(self.about["word_buckets"])).astype(np.int64)):
            out[mine] = self.file(f"words-{k}.counts", "<i8").reshape(-1, 6)[at]
        return out

    def pairs(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.zeros(len(word), np.int64)
        keys = pair_key(before, word)
        for mine, k, at in self.find("pairs", keys, pair_home(before, word, self.about["buckets"], self.about["hot"])):
            count = self.file(f"pairs-{k}.count", "<u2")[at].astype(np.int64)
            if len(big := np.flatnonzero(count == 65535)):
                hashes, values = self.file(f"pairs-{k}.large", "<u8").reshape(2, -1)
                count[big] = values[np.searchsorted(hashes, keys[mine[big]])]
            out[mine] = count
        return out

    def unigram(self, kinds: np.ndarray) -> np.ndarray:
        total = max(self.about["kinds"], 1)
        return np.maximum(kinds - self.word_d[np.minimum(kinds, 3)], 0) / total + self.unseen

    def probability(self, count: np.ndarray, context: np.ndarray, unigram: np.ndarray) -> np.ndarray:
        total = context[:, 0]
        left = context[:, 1:] @ self.pair_d[1:]
        seen = total > 0
        safe = np.maximum(total, 1)
        return np.where(seen, np.maximum(count - self.pair_d[np.minimum(count, 3)], 0) / safe + left / safe * unigram, unigram)


def score(docs: DataFrame, about: dict) -> DataFrame:
    """Per document: n_tokens, n_known, base_score (additive unigram) and score, both log10 of the text's probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(about)
        for ids, block in _blocks(batches):
            words = Words()
            before, word, document = _numbers(block, words)
            table = words.table()
            stats = model.word_stats(table)
            count, context, unigram = stats[:, 1], stats[:, 2:], model.unigram(stats[:, 0])
            keys, back = np.unique(before << 32 | word, return_inverse=True)
            a, w = keys >> 32, keys & 0xFFFFFFFF
            log = np.log10(model.probability(model.pairs(table[a], table[w]), context[a], unigram[w]))
            base = np.log10((count + 0.1) / (about["tokens"] + 0.1 * (about["words"] + 1)))
            n = len(block)
            sums = [np.bincount(document, minlength=n), np.bincount(document, weights=count[word] > 0, minlength=n).astype(np.int64), np.bincount(document, weights=base[word], minlength=n), np.bincount(document, weights=log[back], minlength=n)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *map(pa.array, sums)], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return storage.in_batches(docs.selectExpr("cast(doc_id as bigint) doc_id", "text")).mapInArrow(storage.trimmed(run), "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")


def held_out_scores(docs: DataFrame, modulus: int = 10, rule_out: int = 0) -> DataFrame:
    """Learns from the rows whose crc32(doc_id) mod modulus isn't rule_out, scores all."""
    docs = docs.selectExpr("cast(doc_id as bigint) doc_id", "text")
    about = build(docs.where(training(rule_out, modulus, F.col("doc_id"))))
    return score(docs, about).select("doc_id", (~training(rule_out, modulus, F.col("doc_id"))).alias("held_out"), "n_tokens", "n_known", F.lit(int(about["tokens"])).cast("bigint").alias("train_tokens"), "base_score", "score")
