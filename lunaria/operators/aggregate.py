"""Aggregates over signals and labels."""

from __future__ import annotations

from collections.abc import Sequence

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .select import INDEX, KEY


def channel_stats(signal: DataFrame, key: Sequence[str] = ("channel",), value: str = "value") -> DataFrame:
    """(key, min, max, mean, std): population deviation; one NaN makes all four NaN."""
    spoilt = F.max(F.isnan(value))
    return signal.groupBy(*key).agg(
        F.when(spoilt, float("nan")).otherwise(F.min(value)).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")
    )


def label_counts(labels: DataFrame, names: Sequence[str], key: Sequence[str] = KEY) -> DataFrame:
    """(key, <label>_count for every name), zeros included."""
    return labels.groupBy(*key).agg(*[F.count_if(F.col("label") == n).alias(f"{n}_count") for n in names])


def side_counts(labels: DataFrame) -> DataFrame:
    """(side, label, n)."""
    return labels.groupBy("side", "label").agg(F.count(F.lit(1)).alias("n"))


def nan_mean(df: DataFrame, value: str = "value", key: Sequence[str] = KEY) -> DataFrame:
    """(key, mean) over what is a number; null if nothing is."""
    return df.groupBy(*key).agg(F.avg(F.when(~F.isnan(value), F.col(value))).alias("mean"))


def durations(signal: DataFrame, rate: float, key: Sequence[str] = (*KEY, "channel")) -> DataFrame:
    """(key, length, duration in seconds)."""
    return signal.groupBy(*key).agg(F.count(F.lit(1)).alias("length"), (F.count(F.lit(1)) / F.lit(float(rate))).alias("duration"))


def first_window_time(signal: DataFrame, samples: int, key: Sequence[str] = KEY) -> DataFrame:
    """(key, ts_ns): the mean time of the first samples, truncated."""
    return signal.where(F.col(INDEX) < samples).groupBy(*key).agg(F.avg("ts_ns").cast("long").alias("ts_ns"))


def artifact_count(segments: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return segments.groupBy(*key).agg(F.count_if("is_artifact").alias("n_artifacts"))


def recording_ids(recordings: DataFrame) -> DataFrame:
    """(dataset, n, ids) of a dataset's recordings, ids sorted."""
    return recordings.groupBy("dataset").agg(F.count_distinct("recording_id").alias("n"), F.array_sort(F.collect_set("recording_id")).alias("ids"))


def beat_measures(beats: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """(key, n_beats, mean_ibi, sdnn, rmssd, pnn50, bpm) of beat intervals in ms, in order (an extension)."""
    step = F.col("ibi") - F.lag("ibi").over(Window.partitionBy(*key).orderBy(INDEX))
    d = beats.where("ibi > 0").withColumn("step", step)
    return d.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_beats"), F.avg("ibi").alias("mean_ibi"), F.stddev_samp("ibi").alias("sdnn"),
        F.sqrt(F.avg(F.col("step") ** 2)).alias("rmssd"), F.avg((F.abs("step") > 50).cast("double")).alias("pnn50"), (F.lit(60000.0) / F.avg("ibi")).alias("bpm"),
    )


#: Frequencies (Hz) at which breathing is looked for.
BREATHING = (0.1, 0.4)


def interval_spectrum(beats: DataFrame, rate: float, frequencies: Sequence[float], key: Sequence[str] = KEY) -> DataFrame:
    """(key, frequency, power): Lomb-Scargle power of beat intervals (ms, less their mean) at the uneven times of
    their beats. One aggregation over beats and frequencies gives five sums, from which the power follows;
    a recording with fewer than two intervals has none."""
    key = list(key)
    own = beats.where("ibi > 0").select(*key, (F.col(INDEX) / F.lit(float(rate))).alias("t"), F.col("ibi").cast("double").alias("y"))
    mean = own.groupBy(*key).agg(F.avg("y").alias("m"), F.count(F.lit(1)).alias("k")).where("k > 1")
    x = own.join(mean, key).select(*key, "t", (F.col("y") - F.col("m")).alias("y"), F.explode(F.array(*[F.lit(float(f)) for f in frequencies])).alias("frequency"))
    x = x.withColumn("a", F.lit(2 * math.pi) * F.col("frequency") * F.col("t")).withColumns({"c": F.cos("a"), "s": F.sin("a")})
    of = lambda v: F.sum(v)
    sums = x.groupBy(*key, "frequency").agg(of(F.col("y") * F.col("c")).alias("yc"), of(F.col("y") * F.col("s")).alias("ys"), of(F.col("c") * F.col("c")).alias("cc"), of(F.col("s") * F.col("s")).alias("ss"), of(F.col("c") * F.col("s")).alias("cs"))
    turned = sums.withColumn("tau", F.atan2(2 * F.col("cs"), F.col("cc") - F.col("ss")) / 2).withColumns({"c": F.cos("tau"), "s": F.sin("tau")})
    c, s = F.col("c"), F.col("s")
    part = lambda v, w: F.coalesce(F.try_divide(v * v, F.when(w > 1e-9, w)), F.lit(0.0))
    even = part(c * F.col("yc") + s * F.col("ys"), c * c * F.col("cc") + 2 * c * s * F.col("cs") + s * s * F.col("ss"))
    odd = part(c * F.col("ys") - s * F.col("yc"), c * c * F.col("ss") - 2 * c * s * F.col("cs") + s * s * F.col("cc"))
    return turned.select(*key, "frequency", ((even + odd) / 2).alias("power"))


def interval_measures(beats: DataFrame, rate: float, key: Sequence[str] = KEY, step: float = 0.01) -> DataFrame:
    """(key, bpm, ibi, sdnn, sdsd, rmssd, pnn20, pnn50, hr_mad, sd1, sd2, s, sd1_sd2, breathingrate) of beat intervals
    in ms. Deviations are those of a population; sd1 and sd2 are the axes of the Poincare plot, s its area; the
    breathing rate (Hz) is where the intervals' spectrum is highest between 0.1 and 0.4 Hz, the lowest such place."""
    key = list(key)
    d = beats.where("ibi > 0").withColumn("next", F.lead("ibi").over(Window.partitionBy(*key).orderBy(INDEX))).withColumn("step", F.abs(F.col("next") - F.col("ibi")))
    middle = d.groupBy(*key).agg(F.percentile("ibi", F.lit(0.5)).alias("__middle"))
    mad = d.join(middle, key).groupBy(*key).agg(F.percentile(F.abs(F.col("ibi") - F.col("__middle")), F.lit(0.5)).alias("hr_mad"))
    above = lambda ms: F.avg((F.col("step") > ms).cast("double"))
    axis = lambda sign: F.stddev_pop((F.col("next") + sign * F.col("ibi")) / F.lit(math.sqrt(2)))
    m = d.groupBy(*key).agg(
        (F.lit(60000.0) / F.avg("ibi")).alias("bpm"), F.avg("ibi").alias("ibi"), F.stddev_pop("ibi").alias("sdnn"), F.stddev_pop("step").alias("sdsd"), F.sqrt(F.avg(F.col("step") ** 2)).alias("rmssd"),
        above(20).alias("pnn20"), above(50).alias("pnn50"), axis(-1).alias("sd1"), axis(1).alias("sd2"),
    )
    m = m.withColumns({"s": F.lit(math.pi) * F.col("sd1") * F.col("sd2"), "sd1_sd2": F.try_divide("sd1", "sd2")})
    grid = [round(BREATHING[0] + k * step, 9) for k in range(int(round((BREATHING[1] - BREATHING[0]) / step)) + 1)]
    top = interval_spectrum(beats, rate, grid, key).groupBy(*key).agg(F.max(F.struct(F.round("power", 3).alias("p"), (-F.col("frequency")).alias("f"))).alias("top"))
    return m.join(mad, key).join(top.select(*key, (-F.col("top.f")).alias("breathingrate")), key, "left").select(*key, "bpm", "ibi", "sdnn", "sdsd", "rmssd", "pnn20", "pnn50", "hr_mad", "sd1", "sd2", "s", "sd1_sd2", "breathingrate")
