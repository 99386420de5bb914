"""A corpus from documents to tokens: toxic documents go, one of each group of near copies stays, documents with benchmark
passages go, the rest is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame over all that its predecessor kept; run() writes each
stage's result to the shared folder and reads it as the next stage's docs.

Cases: stages take null and empty texts, repeated rows, empty tables and further columns as their operators do. Null and
empty texts have no toxic clause and no benchmark passage; they have the same, empty, set of shingles, so one of them
stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import byte_bpe, fm_index, near_copies, storage, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold. Learns from labelled rows outside the held-out third."""
    scorer = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, scorer, names=("_toxic_score", "_toxic")).where("_toxic = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest (doc_id, text key), null ids last; of rows equal in both, one."""
    found = near_copies.near_copies(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")).alias("first")
    kept = found.groupBy("component").agg(first).select(F.col("first.doc_id").alias("_kept_id"), F.col("first.text_key").alias("_kept_text"))
    named = docs.withColumns({"_near_id": F.col("doc_id").cast("bigint"), "_near_text": near_copies.text_key()})
    out = named.join(kept.hint("merge"), F.col("_near_id").eqNullSafe(F.col("_kept_id")) & (F.col("_near_text") == F.col("_kept_text")), "left_semi")
    if not found.groupBy("doc_id", "text_key").count().where("count > 1").isEmpty():  # repeated rows: one of them
        out = out.dropDuplicates(["_near_id", "_near_text"])
    return out.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no window of a benchmark item occurs in."""
    return fm_index.annotated(docs, _table(spark, sf_dir, "benchmark"), prefix="_bench_").where("_bench_n_hit = 0").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids' count and digest, and the digest of the text decoded from them."""
    import public_tokenizers

    return byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", drop_toxic), ("simhash near-dedup", drop_near_copies), ("benchmark decontamination", drop_contaminated), ("byte-level BPE", encode)]

#: SQL expresses neither the fitted scorer nor byte-pair merges; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with storage.scratch() as made:  # what a stage wrote for itself goes, its result stays
            docs = storage.written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
            made.remove(docs)
        if before is not None:
            storage.drop(before)
        before = docs
    return docs
