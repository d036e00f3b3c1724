"""The native store: signals as Parquet by dataset, recording and channel, with a metadata table.

<root>/signal/dataset=/recording_id=/channel=/*.parquet and <root>/meta/*.parquet. Readers that name
recordings or channels touch only their partitions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import MissingChannel, ModelUnavailable, RateNotFound
from ..operators.align import check_stack, stack_long
from ..schema import HEADBAND_CHANNELS


def read_signal(spark: SparkSession, root: str, channels: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.option("recursiveFileLookup", "false").parquet(f"{root}/signal")
    return df if channels is None else df.where(F.col("channel").isin(*channels))


def read_meta(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/meta")


def resolve_rates(meta: DataFrame, file_rates: DataFrame | None = None) -> DataFrame:
    """meta with the channel's rate, else its file's; a channel without either is an error."""
    out = meta
    if file_rates is not None:
        out = out.join(file_rates.select("recording_id", F.col("sample_rate").alias("__file")), "recording_id", "left")
        out = out.withColumn("sample_rate", F.coalesce("sample_rate", "__file")).drop("__file")
    lost = out.where(F.col("sample_rate").isNull()).limit(1).collect()
    if lost:
        raise RateNotFound(f"{lost[0]['recording_id']}: {lost[0]['channel']}")
    return out


def require(meta: DataFrame, channels: Sequence[str]) -> None:
    """Fails, before any signal is read, if a recording lacks a channel."""
    have = meta.where(F.col("channel").isin(*channels)).groupBy("recording_id").agg(F.count_distinct("channel").alias("n"))
    lost = meta.select("recording_id").distinct().join(have, "recording_id", "left").where(F.coalesce("n", F.lit(0)) < len(set(channels))).limit(1).collect()
    if lost:
        raise MissingChannel(f"{lost[0]['recording_id']} lacks one of {', '.join(channels)}")


def load_channels(spark: SparkSession, root: str, channels: Sequence[str], microvolts: bool = True) -> tuple[DataFrame, float]:
    """(wide signal, rate): the channels side by side, EEG in microvolts."""
    meta = read_meta(spark, root)
    require(meta, channels)
    rates = {(r.channel, r.sample_rate) for r in meta.where(F.col("channel").isin(*channels)).select("channel", "sample_rate").distinct().collect()}
    rate = check_stack(sorted(rates)) if len(channels) > 1 else next(iter(rates))[1]
    wide = stack_long(read_signal(spark, root, channels), channels)
    if microvolts:
        eeg = [c for c in channels if HEADBAND_CHANNELS.get(c.replace("_", " "), HEADBAND_CHANNELS.get(c)) == "EEG"]
        wide = wide.withColumns({c: F.col(c) * 1e6 for c in eeg})
    return wide, rate


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_hdf5(path: str, channel: str):
    """(samples, rate) of an HDF5 file of the classic layout; needs h5py, which is optional."""
    try:
        import h5py
    except ImportError as e:
        raise ModelUnavailable("HDF5 files need the optional package h5py") from e
    with h5py.File(path, "r") as f:
        d = f["channels"][channel]
        rate = d.attrs.get("sample_rate", f.attrs.get("sample_rate"))
        if rate is None:
            raise RateNotFound(f"{path}: {channel}")
        return d[:], float(rate)


def latest(names: Sequence[str]) -> str:
    """The name with the highest version (v1.2.3), as numbers."""
    def version(name: str) -> tuple[int, ...]:
        m = re.search(r"v?(\d+(?:\.\d+)*)", name)
        return tuple(map(int, m[1].split("."))) if m else ()

    if not names:
        raise ModelUnavailable("no classifier to choose from")
    return max(names, key=version)
