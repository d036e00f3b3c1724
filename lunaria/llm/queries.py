"""The registered queries of this subpackage: each applies its operator to the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, jaccard, langid, mixing, packing, quality, resampling, secrets, sharding, tokens, topk, toxicity, vectorcodes
from .common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 16)


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), 5, 50)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.training_order(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"), 4, 85)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.encode(table(spark, sf_dir, "embeddings"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_ALL = (op1_sharding, op2_exact_topk, op3_secret_scan, op4_language_id, op5_mixing, op6_decontamination, op7_token_output, op8_jaccard_join, op9_toxicity, op10_quality, op11_vector_codes, op12_packing, op13_importance_resampling)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
ORACLE_SQL: dict[str, str] = {
    "op1_sharding": sharding.ORACLE_SQL, "op2_exact_topk": topk.ORACLE_SQL, "op5_mixing": mixing.ORACLE_SQL, "op8_jaccard_join": jaccard.ORACLE_SQL,
    "op11_vector_codes": vectorcodes.ORACLE_SQL, "op13_importance_resampling": resampling.ORACLE_SQL,
}
