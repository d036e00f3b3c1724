"""Nested Parquet recordings: one row per device, with lists and maps of signals and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import AnnotationsMissing
from ..schema import channel_label

SCORED_DEVICE, MANUAL = "PSG", "Manual"


def read_nested(spark: SparkSession, glob: str, device: str = "device") -> DataFrame:
    """(recording_id, device, SignalLabel, SamplingRate, SignalData, SleepScores); the id is the file's stem."""
    df = spark.read.parquet(glob)
    index = device if device in df.columns else "__index_level_0__"
    stem = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(?:\.[^./]*)?$", 1)
    return df.select(stem.alias("recording_id"), F.col(index).alias("device"), *[c for c in ("SignalLabel", "SamplingRate", "SignalData", "SleepScores") if c in df.columns])


def metadata(nested: DataFrame) -> DataFrame:
    """(recording_id, device, channel, label, sample_rate, n_samples), one row per listed signal."""
    each = nested.select("recording_id", "device", F.explode("SignalLabel").alias("channel"), "SamplingRate", "SignalData")
    name = F.concat_ws("-", "device", F.replace("channel", F.lit(" "), F.lit("_")))
    rate, n = F.try_element_at("SamplingRate", F.col("channel")), F.size(F.try_element_at("SignalData", F.col("channel"))).cast("long")
    return each.select("recording_id", "device", "channel", name.alias("label"), rate.alias("sample_rate"), n.alias("n_samples"))


def signals(nested: DataFrame, wanted: list[tuple[str, str]] | None = None) -> DataFrame:
    """(recording_id, channel, sample_idx, value), channels labelled device-channel. With `wanted`
    (device, channel) pairs only those leave the maps."""
    each = nested.select("recording_id", "device", F.explode("SignalData").alias("c", "x"))
    name = F.concat_ws("-", "device", F.replace("c", F.lit(" "), F.lit("_")))
    if wanted is not None:
        each = each.where(name.isin(*[channel_label(c, d) for d, c in wanted]))
    return each.select("recording_id", name.alias("channel"), F.posexplode("x").alias("i", "value")).select("recording_id", "channel", F.col("i").cast("long").alias("sample_idx"), F.col("value").cast("double").alias("value"))


def manual_scores(nested: DataFrame, annotation_type: str = "SLEEP_STAGE") -> DataFrame:
    """(recording_id, epoch_idx, code) of the manual scores that the scored device carries."""
    if annotation_type != "SLEEP_STAGE":
        raise AnnotationsMissing(f"{annotation_type} is not in nested recordings")
    own = nested.where(F.col("device") == SCORED_DEVICE).select("recording_id", F.try_element_at("SleepScores", F.lit(MANUAL)).alias("s"))
    return own.select("recording_id", F.posexplode("s").alias("i", "code")).select("recording_id", F.col("i").cast("long").alias("epoch_idx"), F.col("code").cast("int").alias("code"))
