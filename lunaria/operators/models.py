"""Adapters for models of one's own: batch shaping, prediction in Arrow batches, usability scoring.

Weights are no part of this package. A model is a callable that is made once per Python worker by a
factory (so it need not be picklable) and maps an array to class scores.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import LunariaError
from . import dsp, scores
from .segment import frame_channels, segment_length
from .select import INDEX, KEY, quantiles

Predict = Callable[[np.ndarray], np.ndarray]



def check_groups(groups: Sequence[Sequence[str]], channels: Sequence[str]) -> None:
    """Every group has as many channels as the others, and all of them are there."""
    if not groups or len({len(g) for g in groups}) != 1:
        raise LunariaError("channel groups must be of one size")
    if lost := {c for g in groups for c in g} - set(channels):
        raise LunariaError(f"no channels {', '.join(sorted(lost))}")


def predict_epochs(epochs: DataFrame, columns: Sequence[str], factory: Callable[[], Predict], key: Sequence[str] = (*KEY, "period_idx"), batch: int = 64, periods: int | None = None) -> DataFrame:
    """(key, probs) from array columns: the model gets float32 (batch, samples, channels), or, with
    periods, (batch, periods, samples, channels) of arrays that hold so many periods each. A model that
    makes several predictions of an array, (batch, ..., classes), gives a row for each: the key's last
    column then counts predictions (array number x predictions an array + place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                x = np.stack([part.column(part.schema.get_field_index(c)).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1) for c in columns], -1)
                if periods:
                    x = x.reshape(len(x), periods, -1, len(columns))
                y = np.asarray(model(x.astype(np.float32)), np.float64)
                y = y.reshape(part.num_rows, -1, y.shape[-1])
                each = y.shape[1]
                own = [part.column(part.schema.get_field_index(k)).take(pa.array(np.repeat(np.arange(part.num_rows), each))) for k in key]
                if each > 1:
                    place = own[-1].to_numpy() * each + np.tile(np.arange(each), part.num_rows)
                    own[-1] = pa.array(place, own[-1].type)
                y = y.reshape(-1, y.shape[-1])
                probs = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1]), pa.array(y.ravel()))
                yield pa.RecordBatch.from_arrays([*own, probs], [*key, "probs"])

    kinds = ", ".join(f"{k} {epochs.schema[k].dataType.simpleString()}" for k in key)
    return epochs.select(*key, *columns).mapInArrow(run, f"{kinds}, probs array<double>")


def window_offset(rate: float, samples: int) -> int:
    """The mean time (ns, truncated) of a signal's first samples: when a prediction over them is made."""
    return int(np.mean((np.arange(max(1, samples)) * (1e9 / rate)).astype(np.int64)))


def prediction_time(epoch: Column, period_s: float, rate: float, start_ns: int = 0) -> Column:
    """The time (ns) of each prediction of period_s seconds: whole periods after the middle of the first
    one's samples in the signal as recorded, at `rate`."""
    return (epoch * F.lit(period_s * 1e9)).cast("long") + F.lit(window_offset(rate, int(period_s * rate)) + start_ns)


def score_groups(signal: DataFrame, rate: float, groups: Sequence[Sequence[str]], factory: Callable[[], Predict], period_s: float = 30.0, n_periods: int | None = None, times: float | None = None) -> DataFrame:
    """(recording_id, channel_group, epoch_idx, probs): each channel group scored by itself, channels named in
    order. All channels are framed in one shuffle; a group's predictions end where its shortest channel does.
    With n_periods the model gets (batch, n_periods, samples, channels), and periods after the last whole
    multiple of n_periods are dropped; epoch_idx then counts the model's predictions. With times, the rate of
    the signal as recorded, a column ts_ns (before probs) says when each prediction is made."""
    names = list(dict.fromkeys(c for g in groups for c in g))
    length, out = segment_length(period_s, rate) * (n_periods or 1), None
    wide = frame_channels(signal, names, length, whole=False)
    for g in groups:
        columns = [f"c{names.index(c)}" for c in g]
        full = reduce(operator.and_, [F.size(c) == length for c in columns])
        y = predict_epochs(wide.where(full), columns, factory, periods=n_periods).withColumnRenamed("period_idx", "epoch_idx")
        y = y.select(*KEY, F.lit("+".join(g)).alias("channel_group"), "epoch_idx", "probs")
        out = y if out is None else out.unionByName(y)
    if times is not None:
        out = out.withColumn("ts_ns", prediction_time(F.col("epoch_idx"), period_s, times))
    return out


def score_sleep(signal: DataFrame, rate: float, groups: Sequence[Sequence[str]], factory: Callable[[], Predict], period_s: float = 30.0, channels: Sequence[str] | None = None, n_periods: int | None = None) -> DataFrame:
    """(recording_id, epoch_idx, probs, stage): each channel group is scored, scores are averaged, the
    tail of a recording is dropped. All channels are framed in one shuffle.

    With n_periods the model gets (batch, n_periods, samples, channels), and periods after the last whole
    multiple of n_periods are dropped; epoch_idx then counts the model's predictions.
    """
    names = list(channels or [c for g in groups for c in g])
    check_groups(groups, names)
    names = list(dict.fromkeys(c for g in groups for c in g))
    wide = frame_channels(signal, names, segment_length(period_s, rate) * (n_periods or 1))
    out = None
    for g in groups:
        y = predict_epochs(wide, [f"c{names.index(c)}" for c in g], factory, periods=n_periods)
        out = y if out is None else out.unionByName(y)
    means = scores.mean_groups(out.withColumnRenamed("period_idx", "epoch_idx"))
    return scores.as_arrays(means).withColumn("stage", scores.argmax("probs"))


def score_usability(signal: DataFrame, rate: float, eeg: Sequence[str], movement: str, factory: Callable[[], Predict], n_features: int, period_s: float = 10.0) -> DataFrame:
    """(recording_id, period_idx, left, right): the usability class of each EEG channel. The layout of
    the features (spectrograms, or spectrograms and statistics) follows from their number."""
    length = segment_length(period_s, rate)
    bins = (length - dsp.spectro.SEGMENT) // (dsp.spectro.SEGMENT - dsp.spectro.OVERLAP) + 1
    lite = 2 * bins * (dsp.spectro.SEGMENT // 2 + 1)
    make = {lite: dsp.lite_features, lite + 2 * len(dsp.spectro.FEATURES): dsp.full_features}.get(n_features)
    if make is None:
        raise LunariaError(f"a model of {n_features} features; epochs give {lite} (spectrograms) or {lite + 2 * len(dsp.spectro.FEATURES)} (with statistics)")
    frames = frame_channels(signal, [*eeg, movement], length)
    out = None
    for i, side in enumerate(("left", "right")):
        feats = make(frames, rate, (f"c{i}", "c2")).withColumn("x", F.col("features"))
        y = predict_epochs(feats.select(*KEY, "period_idx", "x"), ["x"], functools.partial(_flat, factory))
        y = y.select(*KEY, "period_idx", scores.argmax("probs").alias(side))
        out = y if out is None else out.join(y, [*KEY, "period_idx"])
    return out


def _flat(factory: Callable[[], Predict]) -> Predict:
    model = factory()
    return lambda x: model(x[:, :, 0])


#: Scalers by the names that models' parameters use: what is taken off and what it is divided by.
SCALERS = ("RobustScaler", "StandardScaler", "MinMaxScaler", "MaxAbsScaler", "none")


def quality_control(signal: DataFrame, length: int, k: float = 20.0, key: Sequence[str] = (*KEY, "channel"), scaler: str = "RobustScaler", affected: bool = False) -> DataFrame:
    """Clips each channel to k interquartile ranges beyond its quartiles, then scales it: by median and
    interquartile range (RobustScaler), mean and deviation (StandardScaler), or its range (MinMaxScaler,
    MaxAbsScaler); what cannot be divided is 0. With affected, a column of that name says whether any sample
    of the period of `length` samples was clipped."""
    if scaler not in SCALERS:
        raise LunariaError(f"scaler {scaler}; known: {', '.join(SCALERS)}")
    key, v = list(key), F.col("value")
    q = quantiles(signal, (0.25, 0.5, 0.75), "value", key)
    low, high = F.col("q0") - k * (F.col("q2") - F.col("q0")), F.col("q2") + k * (F.col("q2") - F.col("q0"))
    held = signal.join(q, key, "left").withColumns({"value": F.least(F.greatest(v, low), high), "__hit": (v < low) | (v > high)})
    by = {"RobustScaler": (F.col("q1"), F.col("q2") - F.col("q0")), "none": (F.lit(0.0), F.lit(1.0))}.get(scaler)
    if by is None:
        m = held.groupBy(*key).agg(F.avg(v).alias("__mean"), F.stddev_pop(v).alias("__std"), F.min(v).alias("__min"), F.max(v).alias("__max"), F.max(F.abs(v)).alias("__abs"))
        held = held.join(m, key, "left")
        by = {"StandardScaler": (F.col("__mean"), F.col("__std")), "MinMaxScaler": (F.col("__min"), F.col("__max") - F.col("__min")), "MaxAbsScaler": (F.lit(0.0), F.col("__abs"))}[scaler]
    out = held.withColumn("value", F.coalesce(F.try_divide(v - by[0], by[1]), F.lit(0.0)))
    if affected:
        period = F.expr(f"{INDEX} div {length}").alias("__period")
        hit = held.groupBy(*key, period).agg(F.max(F.coalesce("__hit", F.lit(False))).alias("affected"))
        out = out.withColumn("__period", F.expr(f"{INDEX} div {length}")).join(hit, [*key, "__period"])
    return out.select(*signal.columns, *(["affected"] if affected else []))


def affected_periods(signal: DataFrame, length: int, k: float = 20.0, key: Sequence[str] = (*KEY, "channel")) -> DataFrame:
    """(key, period_idx, n_clipped) of the periods in which quality control clips samples."""
    key, v = list(key), F.col("value")
    q = quantiles(signal, (0.25, 0.75), "value", key)
    spread = k * (F.col("q1") - F.col("q0"))
    hit = signal.join(q, key).where((v < F.col("q0") - spread) | (v > F.col("q1") + spread))
    return hit.groupBy(*key, F.expr(f"{INDEX} div {length}").alias("period_idx")).agg(F.count(F.lit(1)).alias("n_clipped"))
