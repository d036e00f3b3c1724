"""Stand-ins: the driver's tables seen as recordings, signals and annotations. They exercise the
operators; they are no physiology. Only the columns in use leave the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .operators.select import lookup

#: Event types as stage codes (9 is in no mapping).
CODES = {"view": 0, "click": 1, "signup": 2, "purchase": 3, "error": 9}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sig(spark: SparkSession, d: str) -> DataFrame:
    """events as a signal: recording_id = user, samples in time order, value, event_type."""
    e = table(spark, d, "events").select("user_id", "ts", "event_id", "value", "event_type")
    at = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long") - 1
    return e.select(F.col("user_id").alias("recording_id"), at.alias("sample_idx"), "value", "event_type")


def imu(spark: SparkSession, d: str) -> DataFrame:
    """lineitem as three axes: recording_id = supplier."""
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("recording_id"), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_discount")
    # dealt by the name that later steps group by, so that they need no shuffle of their own
    at = F.row_number().over(Window.partitionBy("recording_id").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")).cast("long") - 1
    return li.select("recording_id", at.alias("sample_idx"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_discount") * 100).alias("z"))


def ann(spark: SparkSession, d: str) -> DataFrame:
    """events as annotations: epoch_idx in time order, code by event type."""
    s = sig(spark, d)
    return s.select("recording_id", F.col("sample_idx").alias("epoch_idx"), lookup(F.col("event_type"), CODES, 9).cast("long").alias("code"))


def emb(spark: SparkSession, d: str) -> DataFrame:
    """embeddings as class scores."""
    return table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"), F.col("label").cast("long").alias("label"))


SIG = "sig AS (SELECT user_id AS recording_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS sample_idx, value, event_type FROM events)"
IMU = """imu AS (SELECT l_suppkey AS recording_id, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS sample_idx,
  l_quantity AS x, l_extendedprice / 1000 AS y, l_discount * 100 AS z FROM lineitem)"""
CODE = "CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'signup' THEN 2 WHEN 'purchase' THEN 3 ELSE 9 END"
ANN = f"{SIG}, ann AS (SELECT recording_id, sample_idx AS epoch_idx, CAST({CODE} AS BIGINT) AS code FROM sig)"
LABEL = "CASE code WHEN 0 THEN 'W' WHEN 1 THEN 'N1' WHEN 2 THEN 'N2' WHEN 3 THEN 'N3' WHEN 4 THEN 'REM' WHEN 5 THEN 'REM' ELSE 'UNKNOWN' END"
LAB = f"{ANN}, lab AS (SELECT recording_id, epoch_idx, {LABEL} AS label FROM ann)"
EMB = "emb AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e, label::BIGINT AS label FROM embeddings)"
