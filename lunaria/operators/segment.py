"""Cutting signals into periods and segments. Lengths in samples are int(duration x rate), truncated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import LunariaError, NotAMultiple
from .select import INDEX, KEY, drop_tail


def segment_length(seconds: float, rate: float) -> int:
    n = int(seconds * rate)
    if n < 1:
        raise LunariaError(f"{seconds} s at {rate} Hz is less than a sample")
    return n


def frame_periods(signal: DataFrame, length: int, strict: bool = True, first: int | None = None, last: int | None = None, key: Sequence[str] = (*KEY, "channel")) -> DataFrame:
    """(key, period_idx, samples array). Strict: a length that is no multiple is an error (found by
    one aggregate); otherwise the tail is dropped. first and last bound the periods, last excluded."""
    if first is not None and last is not None and not 0 <= first < last:
        raise LunariaError(f"periods {first} to {last}")
    if strict:
        odd = signal.groupBy(*key).count().where(F.col("count") % length != 0).limit(1).collect()
        if odd:
            raise NotAMultiple(f"{odd[0]['count']} samples are no multiple of {length}")
    df = signal if strict else drop_tail(signal, length, key)
    df = df.withColumn("period_idx", F.expr(f"{INDEX} div {length}"))
    if first is not None:
        df = df.where(F.col("period_idx") >= first)
    if last is not None:
        df = df.where(F.col("period_idx") < last)
    ordered = F.array_sort(F.collect_list(F.struct(INDEX, "value")))
    return df.groupBy(*key, "period_idx").agg(F.transform(ordered, lambda s: s["value"]).alias("samples"))


def frame_channels(signal: DataFrame, channels: Sequence[str], length: int, key: Sequence[str] = KEY, whole: bool = True) -> DataFrame:
    """(key, period_idx, c0, c1, ...): the samples of all channels side by side, in one shuffle. Periods in
    which a channel has fewer samples than length (the tail) are dropped, unless whole is off."""
    own = signal.where(F.col("channel").isin(*channels))
    at = F.struct(INDEX, F.col("value").cast("double").alias("value"))
    lists = [F.array_sort(F.collect_list(F.when(F.col("channel") == c, at))).alias(f"c{i}") for i, c in enumerate(channels)]
    out = own.groupBy(*key, F.expr(f"{INDEX} div {length}").alias("period_idx")).agg(*lists)
    for i in range(len(channels) if whole else 0):
        out = out.where(F.size(f"c{i}") == length)
    return out.select(*key, "period_idx", *[F.transform(f"c{i}", lambda s: s["value"]).alias(f"c{i}") for i in range(len(channels))])


def valid_sample(quality: Column, interval: Column, least: float, bounds: tuple[float, float]) -> Column:
    """A sample counts if its quality reaches a bound and its beat interval (ms) lies in a range, ends
    included. NaN and null never count, though NaN sorts above all numbers in Spark."""
    fine = ~F.isnan(quality) & (quality >= least) & ~F.isnan(interval) & interval.between(*bounds)
    return F.coalesce(fine, F.lit(False))


def artifact_segments(
    signal: DataFrame, length: int, least_quality: float = 0.8, bounds: tuple[float, float] = (300.0, 2000.0), least_ratio: float = 0.5,
    quality: str = "quality", interval: str = "ibi", key: Sequence[str] = KEY,
) -> DataFrame:
    """(key, epoch_idx, valid_ratio, is_artifact) for each segment, the partial last one included: an
    artifact if the share of valid samples is below least_ratio."""
    ok = valid_sample(F.col(quality), F.col(interval), least_quality, bounds)
    out = signal.groupBy(*key, F.expr(f"{INDEX} div {length}").alias("epoch_idx")).agg(F.avg(ok.cast("double")).alias("valid_ratio"))
    return out.withColumn("is_artifact", F.col("valid_ratio") < least_ratio)
