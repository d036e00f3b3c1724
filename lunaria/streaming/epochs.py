"""Streaming versions of the epoch aggregates (an extension): samples arrive as (recording_id, channel,
ts, value) with event time; late samples count until the watermark passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLES = T.StructType([T.StructField("recording_id", T.StringType()), T.StructField("channel", T.StringType()), T.StructField("ts", T.TimestampType()), T.StructField("value", T.DoubleType())])


def read_samples(spark: SparkSession, folder: str, files_per_trigger: int = 8) -> DataFrame:
    return spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def _timed(samples: DataFrame, lateness: str) -> DataFrame:
    # a watermark needs a timestamp with time zone; other kinds are read as session time
    return samples.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)


def epoch_stats(samples: DataFrame, epoch: str = "30 seconds", lateness: str = "2 minutes") -> DataFrame:
    """(recording_id, channel, start, n, min, max, mean, std) per epoch; NaN makes min NaN as well."""
    spoilt = F.max(F.isnan("value"))
    out = _timed(samples, lateness).groupBy(F.window("ts", epoch).alias("w"), "recording_id", "channel").agg(
        F.count(F.lit(1)).alias("n"), F.when(spoilt, float("nan")).otherwise(F.min("value")).alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")
    )
    return out.select("recording_id", "channel", F.col("w.start").alias("start"), "n", "min", "max", "mean", "std")


def artifact_epochs(samples: DataFrame, least_quality: float = 0.8, bounds: tuple[float, float] = (300.0, 2000.0), least_ratio: float = 0.5, epoch: str = "30 seconds", lateness: str = "2 minutes") -> DataFrame:
    """(recording_id, start, valid_ratio, is_artifact) of samples that carry ibi and quality."""
    from ..operators.segment import valid_sample

    ok = valid_sample(F.col("quality"), F.col("ibi"), least_quality, bounds)
    out = _timed(samples, lateness).groupBy(F.window("ts", epoch).alias("w"), "recording_id").agg(F.avg(ok.cast("double")).alias("valid_ratio"))
    return out.select("recording_id", F.col("w.start").alias("start"), "valid_ratio", (F.col("valid_ratio") < least_ratio).alias("is_artifact"))


def sensor_sessions(samples: DataFrame, gap: str = "1 minute", lateness: str = "2 minutes") -> DataFrame:
    """(recording_id, start, end, n): spells without a gap."""
    out = _timed(samples, lateness).groupBy(F.session_window("ts", gap).alias("w"), "recording_id").agg(F.count(F.lit(1)).alias("n"))
    return out.select("recording_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
