"""Aligning channels and joining recordings end to end."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import DuplicateChannel, NoSamples, RateMismatch
from .select import INDEX, KEY, data_channels


def check_stack(meta: Sequence[tuple[str, float]]) -> float:
    """The common rate of (channel, rate) pairs that are to be stacked. Only metadata is looked at."""
    if len(meta) < 2:
        raise NoSamples("stacking takes two channels or more")
    names = [m[0] for m in meta]
    if len(set(names)) < len(names):
        raise DuplicateChannel(", ".join(sorted({n for n in names if names.count(n) > 1})))
    if len({m[1] for m in meta}) > 1:
        raise RateMismatch(str(dict(meta)))
    return meta[0][1]


def stack_long(signal: DataFrame, channels: Sequence[str], key: Sequence[str] = KEY) -> DataFrame:
    """Long to wide in one shuffle: a column per channel, in the order given, for instants that all have."""
    wide = signal.where(F.col("channel").isin(*channels)).groupBy(*key, INDEX).pivot("channel", list(channels)).agg(F.first("value"))
    return wide.dropna(subset=list(channels))


def stack_wide(frames: Sequence[DataFrame], key: Sequence[str] = KEY) -> DataFrame:
    """Joins wide signals on recording and index; channel names must differ."""
    names = [c for f in frames for c in data_channels(f, key)]
    if len(frames) < 2:
        raise NoSamples("stacking takes two signals or more")
    if len(set(names)) < len(names):
        raise DuplicateChannel(", ".join(sorted({n for n in names if names.count(n) > 1})))
    on = [*key, INDEX]
    slim = [frames[0], *(f.select(*on, *data_channels(f, key)) for f in frames[1:])]
    return reduce(lambda a, b: a.join(b, on), slim)


def to_long(wide: DataFrame, channels: Sequence[str] | None = None, key: Sequence[str] = KEY) -> DataFrame:
    names = list(channels or data_channels(wide, key))
    return wide.unpivot([*key, INDEX], names, "channel", "value")


def concatenate(parts: Sequence[DataFrame], key: Sequence[str] = KEY, rates: Sequence[float] | None = None) -> DataFrame:
    """Parts of recordings end to end, indexes running on; channel names must agree.

    Offsets come from the parts' lengths (one row per recording and part), so samples are not sorted. With
    rates, one for each part, which must agree, the times of later parts (ts_ns, if there is such a column)
    move on so that each part begins a sample after the one before ends; without, times stay as they are.
    """
    if len(parts) < 2:
        raise NoSamples("concatenation takes two parts or more")
    if any(sorted(p.columns) != sorted(parts[0].columns) for p in parts):
        raise DuplicateChannel("parts differ in their columns")
    if rates is not None and len(set(rates)) > 1:
        raise RateMismatch(", ".join(map(str, rates)))
    timed = rates is not None and "ts_ns" in parts[0].columns
    whole = reduce(DataFrame.unionByName, [p.withColumn("__part", F.lit(i)) for i, p in enumerate(parts)])
    sizes = whole.groupBy(*key, "__part").agg((F.max(INDEX) + 1).alias("__n"), *([F.min("ts_ns").alias("__t")] if timed else []))
    order = Window.partitionBy(*key).orderBy("__part")
    offset = F.coalesce(F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__from")
    first = [F.first("__t").over(order).alias("__t0"), "__t"] if timed else []
    out = whole.join(sizes.select(*key, "__part", offset, *first), [*key, "__part"]).withColumn(INDEX, F.col(INDEX) + F.col("__from"))
    if timed:
        out = out.withColumn("ts_ns", F.col("ts_ns") - F.col("__t") + F.col("__t0") + (F.col("__from") * F.lit(1e9 / rates[0])).cast("long"))
    return out.select(*parts[0].columns)


def samples_to_signal(samples: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """(key, ts_ns, values) instants to a long signal: indexes by time, channels channel_0, channel_1, ..."""
    at = F.row_number().over(Window.partitionBy(*key).orderBy("ts_ns")).cast("long") - 1
    return samples.withColumn(INDEX, at).select(*key, INDEX, "ts_ns", F.posexplode("values").alias("c", "value")).select(*key, F.concat(F.lit("channel_"), "c").alias("channel"), INDEX, "ts_ns", "value")
