"""Exports: signals with metadata, runs, catalogs, usability and feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import LunariaError, RateMismatch
from ..operators.aggregate import channel_stats, label_counts
from ..operators.annotate import squeeze_runs
from ..operators.features import globally_sorted
from ..operators.merge import FAILED, SUCCESS, combine_first, upsert
from .policy import Existing, exists, replace, write

PARTITIONS = ("dataset", "recording_id", "channel")


def check_rates(meta: DataFrame, stored: DataFrame) -> None:
    """A channel that is added to a stored recording must have the rate the recording has."""
    bad = meta.alias("n").join(stored.alias("o"), ["dataset", "recording_id"]).where("n.sample_rate <> o.sample_rate").limit(1).collect()
    if bad:
        raise RateMismatch(f"{bad[0]['recording_id']} is stored at another rate")


def check_durations(signal: DataFrame, rates: DataFrame) -> None:
    """All channels of a recording must last equally long."""
    n = signal.groupBy("dataset", "recording_id", "channel").agg(F.count(F.lit(1)).alias("n")).join(rates, ["dataset", "recording_id", "channel"])
    bad = n.groupBy("dataset", "recording_id").agg(F.count_distinct(F.col("n") / F.col("sample_rate")).alias("k")).where("k > 1").limit(1).collect()
    if bad:
        raise LunariaError(f"channels of {bad[0]['recording_id']} differ in duration")


def write_signals(signal: DataFrame, meta: DataFrame, root: str, existing: Existing = Existing.RAISE) -> None:
    """signal (dataset, recording_id, channel, sample_idx, value) and meta. Channels replace channels of
    the same name and leave others alone (dynamic partition overwrite); rates and durations are checked."""
    check_durations(signal, meta.select("dataset", "recording_id", "channel", "sample_rate"))
    there = exists(signal, f"{root}/meta")
    if there:
        stored = signal.sparkSession.read.parquet(f"{root}/meta")
        if existing is Existing.APPEND:
            check_rates(meta, stored)
    rows = signal.repartition(*PARTITIONS).sortWithinPartitions(*PARTITIONS, "sample_idx")
    if existing in (Existing.APPEND, Existing.OVERWRITE):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(f"{root}/signal")
        merged = upsert(stored, meta, ["dataset", "recording_id", "channel"]) if there else meta
        small = merged.sparkSession.createDataFrame(merged.toArrow()) if there else merged  # metadata: a row a channel, read before it is replaced
        small.write.mode("overwrite").parquet(f"{root}/meta")
    elif write(rows, f"{root}/signal", existing, partition_by=PARTITIONS):
        write(meta, f"{root}/meta", existing)


def write_runs(labels: DataFrame, path: str, existing: Existing = Existing.RAISE, key: Sequence[str] = ("recording_id",)) -> bool:
    """start,duration,stage lines without header, one folder per recording."""
    runs = squeeze_runs(labels, key=key).repartition(*key).sortWithinPartitions(*key, "start_s")
    return write(runs.select(*key, "start_s", "duration_s", "label"), path, existing.for_annotations(), "csv", tuple(key))


def catalog(recordings: DataFrame, signal: DataFrame, rates: DataFrame, channels: Sequence[str], annotations: DataFrame | None = None, stages: Sequence[str] = (), errors: DataFrame | None = None) -> DataFrame:
    """One row per recording: status, which channels it has, their statistics, length, duration, label
    counts and error. Columns follow from the configuration, not from the data."""
    s = channel_stats(signal.where(F.col("channel").isin(*channels)), ("recording_id", "channel"))
    wide = s.groupBy("recording_id").pivot("channel", list(channels)).agg(*[F.first(m).alias(m) for m in ("min", "max", "mean", "std")])
    n = signal.groupBy("recording_id", "channel").agg(F.count(F.lit(1)).alias("length")).join(rates.select("recording_id", "channel", "sample_rate"), ["recording_id", "channel"])
    size = n.groupBy("recording_id").agg(F.max("length").alias("length"), F.max(F.col("length") / F.col("sample_rate")).alias("duration"))
    out = recordings.select("recording_id").join(size, "recording_id", "left").join(wide, "recording_id", "left")
    out = out.withColumns({c: F.col(f"{c}_min").isNotNull() for c in channels})
    if annotations is not None:
        counts = label_counts(annotations, stages).withColumn("has_annotations", F.lit(True))
        out = out.join(counts, "recording_id", "left").withColumn("has_annotations", F.coalesce("has_annotations", F.lit(False)))
    else:
        out = out.withColumn("has_annotations", F.lit(False))
    if errors is not None:
        out = out.join(errors.groupBy("recording_id").agg(F.max("error_message").alias("error_message")), "recording_id", "left")
    else:
        out = out.withColumn("error_message", F.lit(None).cast("string"))
    return out.withColumn("export_status", F.when(F.col("error_message").isNull(), SUCCESS).otherwise(FAILED))


def update_catalog(new: DataFrame, path: str) -> DataFrame:
    """Puts rows into a catalog CSV by recording_id; the latest row of a recording stays."""
    spark = new.sparkSession
    if exists(new, path):
        old = spark.read.csv(path, header=True)
        text = new.select(*[F.col(c).cast("string").alias(c) for c in new.columns])
        merged = spark.createDataFrame(upsert(old, text, ["recording_id"]).toArrow())  # a catalog has one row a recording
        merged.coalesce(1).write.mode("overwrite").csv(path, header=True)
    else:
        new.coalesce(1).write.csv(path, header=True)
    return spark.read.csv(path, header=True)


def write_csv(df: DataFrame, path: str) -> None:
    """A table as CSV with header, always in place of an older one."""
    df.write.mode("overwrite").csv(path, header=True)


def write_usability(scores: DataFrame, path: str, left: str, right: str, existing: Existing = Existing.RAISE) -> bool:
    """(recording_id, period_idx, left, right) classes, in order, with the outputs' labels as header."""
    rows = scores.select("recording_id", "period_idx", F.col("left").cast("int").alias(left), F.col("right").cast("int").alias(right))
    return write(rows.repartition("recording_id").sortWithinPartitions("recording_id", "period_idx").drop("period_idx"), path, existing, "csv", ("recording_id",), header="true")


def write_features(features: DataFrame, path: str, existing: Existing = Existing.RAISE) -> bool:
    """Epoch features in order of set, dataset, subject, session and epoch, from file to file as well.
    With APPEND rows that are there stay, and new ones win over old ones of the same epoch."""
    if existing is Existing.APPEND:
        if exists(features, path):
            on = ["set", "dataset", "subj", "session", "epoch_idx"]
            whole = combine_first(features, features.sparkSession.read.parquet(path), on)
            # the old table is one of the inputs: the new one is written beside it and takes its place when it is whole
            globally_sorted(whole).write.mode("overwrite").parquet(f"{path}.next")
            replace(features, f"{path}.next", path)
            return True
        existing = Existing.RAISE
    return write(globally_sorted(features), path, existing)
