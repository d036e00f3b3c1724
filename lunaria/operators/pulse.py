"""Pulse-wave peaks and beats in window functions alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .select import INDEX, KEY


def elgendi_peaks(signal: DataFrame, short: int, long: int, offset: float = 0.02, least: int | None = None, key: Sequence[str] = KEY) -> DataFrame:
    """(key, index, value) of the pulse peaks: blocks where the short moving average of the squared
    positive signal exceeds the long one plus offset x its mean; each block of `least` samples or more
    gives its highest sample (the first at a tie). Widths are odd numbers of samples; at the ends of
    a recording the averages run over what there is."""
    least = short if least is None else least
    by = Window.partitionBy(*key).orderBy(INDEX)
    mean = lambda w: F.sum("sq").over(by.rowsBetween(-(w // 2), w // 2)).cast("double") / F.count("sq").over(by.rowsBetween(-(w // 2), w // 2))
    x = signal.select(*key, INDEX, "value").withColumn("sq", F.greatest("value", F.lit(0)) * F.greatest("value", F.lit(0)))
    level = x.groupBy(*key).agg((F.sum("sq").cast("double") / F.count("sq")).alias("level"))
    x = x.withColumn("s", mean(short)).withColumn("l", mean(long)).join(level, list(key))
    inside = F.col("s") > F.col("l") + F.col("level") * offset
    x = x.where(inside).withColumn("block", F.col(INDEX) - F.row_number().over(by))  # equal in a run of indexes
    best = x.groupBy(*key, "block").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("value", (-F.col(INDEX)).alias("i"))).alias("top"))
    return best.where(F.col("n") >= least).select(*key, (-F.col("top.i")).alias(INDEX), F.col("top.value").alias("value"))


def beat_intervals(peaks: DataFrame, rate: float, key: Sequence[str] = KEY) -> DataFrame:
    """(key, index, ibi in ms, rate per minute) from each peak to the one before; none for the first."""
    step = (F.col(INDEX) - F.lag(INDEX).over(Window.partitionBy(*key).orderBy(INDEX))).cast("double")
    out = peaks.select(*key, INDEX, step.alias("d")).where("d is not null")
    return out.select(*key, INDEX, (F.col("d") / F.lit(float(rate)) * 1000).alias("ibi"), F.try_divide(F.lit(60.0) * rate, F.col("d")).alias("rate"))


def positive_intervals(beats: DataFrame) -> DataFrame:
    return beats.where("ibi > 0")


#: Fixed values of the published method: beats of a threshold's and of a median's window, quartile deviations
#: that a threshold takes, slope and offset of the ectopic region, and the distance from the median that counts.
THRESHOLD_BEATS, MEDIAN_BEATS, DEVIATIONS, SLOPE, OFFSET, FAR = 91, 11, 5.2, 0.13, 0.17, 3.0
#: A threshold is never below so many ms: intervals in whole samples can lie on few values.
LEAST_MS = 20.0


def classify_beats(peaks: DataFrame, rate: float, key: Sequence[str] = KEY) -> DataFrame:
    """(key, index, kind, rr, before, after) of each peak: the interval before it in ms, the peaks beside it,
    and whether its interval is normal, ectopic (the beat before it is out of place), missed (a beat is lacking
    in it), extra (the peak is one too many), long or short.

    After Lipponen and Tarvainen (2019): differences of intervals and distances from a running median, in
    units of thresholds that follow their quartile deviation over 91 beats, place each interval in a region.
    A beat is judged by itself, so two artifacts that touch may be taken for one. Windows run over a
    recording's beats, which are some hundredths of its samples.
    """
    by = Window.partitionBy(*key).orderBy(INDEX)
    wide, near = (by.rowsBetween(-(w // 2), w // 2) for w in (THRESHOLD_BEATS, MEDIAN_BEATS))
    beside = lambda c, k: F.coalesce(F.lag(c, -k).over(by), F.lit(0.0))
    ms = F.lit(1000.0 / rate)
    b = peaks.select(*key, INDEX, F.lag(INDEX).over(by).alias("before"), F.lead(INDEX).over(by).alias("after"))
    b = b.withColumn("rr", F.coalesce(F.col(INDEX) - F.col("before"), F.col("after") - F.col(INDEX)) * ms)
    b = b.withColumn("d", F.coalesce(F.col("rr") - F.lag("rr").over(by), F.lit(0.0))).withColumn("med", F.percentile("rr", F.lit(0.5)).over(near))
    b = b.withColumn("m", (F.col("rr") - F.col("med")) * F.when(F.col("rr") < F.col("med"), 2.0).otherwise(1.0))
    for c in ("d", "m"):
        q = F.percentile(F.abs(c), F.array(F.lit(0.25), F.lit(0.75))).over(wide)
        b = b.withColumn("q", q).withColumn(f"t{c}", F.greatest(F.lit(DEVIATIONS / 2) * (F.get("q", F.lit(1)) - F.get("q", F.lit(0))), F.lit(LEAST_MS)))
    b = b.withColumn("x", F.col("d") / F.col("td")).withColumn("y", F.col("m") / F.col("tm"))
    b = b.withColumns({"x0": beside("x", -1), "x1": beside("x", 1), "x2": beside("x", 2), "next": F.lead("rr").over(by)})
    x, y = F.col("x"), F.col("y")
    ectopic = ((x > 1) & (F.greatest("x0", "x1") < -SLOPE * x - OFFSET)) | ((x < -1) & (F.least("x0", "x1") > -SLOPE * x + OFFSET))
    long = ((x > 1) & (F.least("x1", "x2") < -1)) | (y > FAR)
    short = ((x < -1) & (F.greatest("x1", "x2") > 1)) | (y < -FAR)
    missed, extra = F.abs(F.col("rr") / 2 - F.col("med")) < F.col("tm"), F.coalesce(F.abs(F.col("rr") + F.col("next") - F.col("med")) < F.col("tm"), F.lit(False))
    kind = F.when(F.col("before").isNull(), "normal").when(ectopic, "ectopic").when(long & missed, "missed").when(short & extra, "extra").when(long, "long").when(short, "short").otherwise("normal")
    b = b.withColumn("k", kind)
    # the interval after an extra peak, and the one before an ectopic one, are odd for the same reason
    again = (F.lag("k").over(by) == "extra") | (F.col("k").isin("long", "short") & (F.lead("k").over(by) == "ectopic"))
    return b.select(*key, INDEX, F.when(F.coalesce(again, F.lit(False)), "normal").otherwise(F.col("k")).alias("kind"), "rr", "before", "after")


def correct_beats(peaks: DataFrame, rate: float, key: Sequence[str] = KEY) -> DataFrame:
    """(key, index, kind) of peaks(key, index) after correction: extra peaks are left out, a missed beat is put
    midway into its interval, a beat out of place is moved midway between its neighbours (kind 'moved')."""
    by = Window.partitionBy(*key).orderBy(INDEX)
    c = classify_beats(peaks, rate, key).withColumn("follows", F.lead("kind").over(by))
    moved = F.col("before").isNotNull() & F.col("after").isNotNull() & (F.coalesce(F.col("follows") == "ectopic", F.lit(False)) | F.col("kind").isin("long", "short"))
    place = F.when(moved, F.expr("before + (after - before) div 2")).otherwise(F.col(INDEX))
    kept = c.where("kind <> 'extra'").select(*key, place.alias(INDEX), F.when(moved, "moved").otherwise("normal").alias("kind"))
    put = c.where("kind = 'missed'").select(*key, F.expr(f"before + ({INDEX} - before) div 2").alias(INDEX), F.lit("missed").alias("kind"))
    return kept.unionByName(put)
