"""Token totals by source, language and tokenizer version, kept by deltas.

A batch is a feed of signed changes: insert (+tokens, +1 document), delete (-tokens, -1 document) and revise
(tokens - old_tokens, no document). Its sums by group are written to a hidden folder, which is then renamed to a name made
of the batch: that one step is the commit. A run that dies before it leaves a folder that nobody reads, and the batch can be
sent again; of two that commit one batch at once, the second finds the name taken. Committing a batch again does nothing.
Totals are sums, so batches commute.

    live/<batch>        sums of a committed batch
    snapshots/<number>  sums of all batches compacted so far, with the list of live folders that they cover
    done/<batch>        an empty file for each compacted batch: looked up when a batch is sent, never listed

`compact` publishes the next snapshot by such a rename, marks what it covers as done, and removes what the snapshot before
it covered (reads that began before a compaction still find their files). So a read lists the folders of the last batches
only, whatever the length of history. The store must rename folders in one step, as HDFS and file systems do.

Sums are formed before the shuffle, so a source with a third of all rows is one row a task.

Cases: null source, language or version are groups of their own; null counts are 0; an empty batch commits; a group whose
changes cancel stays with zeros; unknown kinds of change are an error; repeated rows in a feed count each; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import storage

KEYS = ["source", "lang", "tokenizer_version"]
SCHEMA = "source string, lang string, tokenizer_version string, documents bigint, tokens bigint"


def signed(op: Column, tokens: Column, old_tokens: Column) -> tuple[Column, Column]:
    """(documents, tokens) that a change adds."""
    new, old = F.coalesce(tokens, F.lit(0)).cast("bigint"), F.coalesce(old_tokens, F.lit(0)).cast("bigint")
    documents = F.when(op == "insert", 1).when(op == "delete", -1).when(op == "revise", 0).otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(op, F.lit("null")))).cast("int"))
    return documents.cast("bigint"), F.when(op == "insert", new).when(op == "delete", -new).otherwise(new - old)


class TokenRollup:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.root}/{name}" if name else self.root)

    def _names(self, folder: str) -> list[str]:
        if not self._fs.exists(self._path(folder)):
            return []
        return sorted(n for s in self._fs.listStatus(self._path(folder)) if not (n := s.getPath().getName()).startswith((".", "_")))

    def _publish(self, draft: str, name: str) -> bool:
        """Give a finished folder its name; False, and the folder is gone, if another has that name. A folder that is
        renamed onto another lands inside it, where its hidden name keeps it from being read."""
        if not self._fs.exists(self._path(name)):
            self._fs.mkdirs(self._path(name).getParent())
            if not self._fs.rename(self._path(draft), self._path(name)) and not self._fs.exists(self._path(name)):
                raise OSError(f"{self.root}/{draft} can't be renamed to {name}")
        nested = f"{name}/{draft.rpartition('/')[2]}"
        lost = [x for x in (draft, nested) if self._fs.exists(self._path(x))]
        for x in lost:
            self._fs.delete(self._path(x), True)
        return not lost

    @staticmethod
    def _marker(batch_id: str) -> str:
        return hashlib.sha256(batch_id.encode()).hexdigest()

    def committed(self, batch_id: str) -> bool:
        name = self._marker(batch_id)  # done is written before live goes
        return self._fs.exists(self._path(f"live/{name}")) or self._fs.exists(self._path(f"done/{name}"))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply a feed (source, lang, tokenizer_version, op, tokens, old_tokens) once; False if it was applied before."""
        if self.committed(batch_id):
            return False
        documents, tokens = signed(F.col("op"), F.col("tokens"), F.col("old_tokens"))
        sums = changes.select(*[F.col(k).cast("string").alias(k) for k in KEYS], documents.alias("documents"), tokens.alias("tokens")).groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        draft, name = f"_draft-{uuid.uuid4().hex}", self._marker(batch_id)
        sums.coalesce(1).write.parquet(f"{self.root}/{draft}")
        if not self._publish(draft, f"live/{name}"):
            return False
        if self._fs.exists(self._path(f"done/{name}")):  # another run committed the batch and compacted it meanwhile
            self._fs.delete(self._path(f"live/{name}"), True)
            return False
        return True

    def _write(self, name: str, content: str) -> None:
        out = self._fs.create(self._path(name), True)
        out.write(bytearray(content.encode()))
        out.close()

    def _read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _current(self) -> tuple[list[str], list[str]]:
        """(the latest snapshot, if any; batches that it does not cover)."""
        snapshots = self._names("snapshots")[-1:]
        covered = {x for n in snapshots for x in self._read(f"snapshots/{n}/_covers").split()}
        return snapshots, [b for b in self._names("live") if b not in covered and not self._fs.exists(self._path(f"done/{b}"))]

    def _sums(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(*[f"{self.root}/{f}" for f in folders])
        return rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))

    def totals(self) -> DataFrame:
        snapshots, new = self._current()
        return self._sums([f"snapshots/{n}" for n in snapshots] + [f"live/{b}" for b in new])

    def _mark_done(self, batches: list[str]) -> None:
        for b in batches:
            self._write(f"done/{b}", "")

    def compact(self) -> bool:
        """Fold what is committed into one snapshot; False if there is nothing new or another run was first."""
        snapshots, new = self._current()
        before = self._read(f"snapshots/{snapshots[0]}/_covers").split() if snapshots else []
        self._mark_done(before)  # in case the run that published it died
        for b in before:
            self._fs.delete(self._path(f"live/{b}"), True)
        for old in self._names("snapshots")[:-1]:
            self._fs.delete(self._path(f"snapshots/{old}"), True)
        if not new:
            return False
        draft, number = f"_draft-{uuid.uuid4().hex}", int(snapshots[0]) + 1 if snapshots else 0
        self._sums([f"snapshots/{n}" for n in snapshots] + [f"live/{b}" for b in new]).coalesce(1).write.parquet(f"{self.root}/{draft}")
        self._write(f"{draft}/_covers", "\n".join(new))
        if not self._publish(draft, f"snapshots/{number:012d}"):
            return False
        self._mark_done(new)
        return True


def token_counts(docs: DataFrame, ranks_path: str, pattern: str, version: str) -> DataFrame:
    """doc_id, source, lang, copy_of (a digest of the text), tokens of a byte-level vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        from tessella.llm.byte_bpe import load_ranks

        coder = tiktoken.Encoding(version, pat_str=pattern, mergeable_ranks=load_ranks(ranks_path), special_tokens={})
        for b in batches:
            n = [len(coder.encode_ordinary(t.as_py() or "")) for t in b.column(4)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(n, pa.int64())], ["doc_id", "source", "lang", "copy_of", "tokens"])

    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(source as string) source", "cast(lang as string) lang", "sha2(cast(coalesce(text, '') as binary), 256) copy_of", "text")
    return storage.in_batches(rows).mapInArrow(run, "doc_id bigint, source string, lang string, copy_of string, tokens bigint")


def replayed(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The totals after a history over all documents: estimates inserted, revised by real counts, texts with copies
    replaced by the first of them (all rows deleted, the first by doc_id inserted, which needs no join on texts), a second
    tokenizer version inserted; every batch is sent twice, which changes nothing."""
    spark = docs.sparkSession
    store = TokenRollup(spark, storage.new_path(spark, "rollup"))
    counts = storage.written(token_counts(docs, ranks_path, pattern, "byte_bpe_50k"), "token-counts")
    first = counts.groupBy("copy_of").agg(F.min(F.struct("doc_id", "source", "lang", "tokens")).alias("first")).select("first.*")
    none, estimate = F.lit(None).cast("bigint"), F.lit(1).cast("bigint")

    def feed(rows: DataFrame, op: str, version: str, tokens: Column, old: Column) -> DataFrame:
        return rows.select("source", "lang", F.lit(version).alias("tokenizer_version"), F.lit(op).alias("op"), tokens.alias("tokens"), old.alias("old_tokens"))

    history = {
        "estimate": feed(counts, "insert", "byte_bpe_50k", estimate, none),
        "recount": feed(counts, "revise", "byte_bpe_50k", F.col("tokens"), estimate),
        "drop copies": feed(counts, "delete", "byte_bpe_50k", F.col("tokens"), none).unionByName(feed(first, "insert", "byte_bpe_50k", F.col("tokens"), none)),
        "with end marks": feed(counts, "insert", "byte_bpe_50k+end", F.col("tokens") + 1, none),
    }
    for batch_id, changes in history.items():
        store.commit(batch_id, changes)
        store.commit(batch_id, changes)
    store.compact()
    storage.drop(counts)
    return store.totals()
