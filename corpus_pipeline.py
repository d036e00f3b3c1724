"""The corpus pipeline: stages over documents, each written as Parquet and read as the next one's input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lunaria.llm import decontaminate, jaccard, mixing, quality, sharding
from lunaria.llm.common import cut, fresh, own_dir, remove, table, temporary


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects (score below 0.3)."""
    model = quality.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    score = fresh(docs, "__quality")
    return quality.with_score(docs, model, score).where(F.col(score) >= quality.THRESHOLD).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one text of each group of near copies (five-word shingles, Jaccard 0.8): one of the smallest id.
    Texts are told apart, not ids: an id with several texts keeps those that are no copies. Rows with a null
    id and texts without shingles stay; of rows that repeat an id and its text one stays."""
    key, mark = fresh(docs, "__id"), fresh(docs, "__text")
    whole, rows, repeated = (cut(x.withColumnsRenamed({"doc_id": key, "h": mark}), "surplus") for x in jaccard.surplus(docs, 5, 80))
    own = F.col("doc_id") == F.col(key)
    same = own & (F.xxhash64("text") == F.col(mark))
    # the copies are a small part or a large one: Spark picks the join by the size of their table
    out = docs.join(whole, own, "left_anti")
    if not rows.isEmpty():
        out = out.join(rows, same, "left_anti")
    if not repeated.isEmpty():
        again = out.join(repeated, same, "left_semi").withColumn(mark, F.xxhash64("text"))
        out = out.join(repeated, same, "left_anti").unionByName(again.dropDuplicates(["doc_id", mark]).drop(mark))
    return out


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold an exact or edited copy of a benchmark item."""
    flag = fresh(docs, "__copy_of")
    return decontaminate.with_flag(docs, table(spark, sf_dir, "benchmark"), flag).where(~F.col(flag)).drop(flag)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emits each document as often as its source's target rate takes it."""
    return mixing.emit(docs)


def shard_corpus(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every remaining row in one of 16 shards of nearly equal bytes."""
    return sharding.shard(docs, 16)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard_corpus),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{own_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        if k == len(STAGES) - 1:
            return stage(spark, docs, sf_dir)
        with temporary(spark):  # what a stage wrote on its way goes when its result is stored
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        if k:
            remove(spark, f"{folder}/{k - 1}")
        docs = spark.read.parquet(f"{folder}/{k}")
