from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lunaria.errors import ChannelCountMismatch, LunariaError, MissingChannel
from lunaria.operators import aggregate, select
from lunaria.schema import STAGES


def signal(spark, values, rid="a"):
    return spark.createDataFrame([(rid, i, float(v)) for i, v in enumerate(values)], "recording_id string, sample_idx long, value double")


def column(df, name="value"):
    return [r[name] for r in df.orderBy("sample_idx").collect()]


def test_time_index_truncates(spark):
    assert column(select.with_time(signal(spark, [1, 2, 3]), 256.0), "ts_ns") == [0, 3906250, 7812500]


def test_time_slice_includes_both_ends(spark):
    df = select.with_time(signal(spark, [0, 1, 2, 3]), 1e8)
    assert column(select.slice_by_time(df, 10, 20)) == [1.0, 2.0]
    assert len(column(select.slice_by_time(df))) == 4


def test_channels_by_name_and_position(spark):
    wide = spark.createDataFrame([("a", 0, 1.0, 2.0, 3.0)], "recording_id string, sample_idx long, x double, y double, z double")
    assert select.select_channels(wide, ["z", "x"]).columns == ["recording_id", "sample_idx", "z", "x"]
    assert select.select_positions(wide, [-1]).columns[-1] == "z"
    with pytest.raises(MissingChannel):
        select.select_channels(wide, ["w"])
    with pytest.raises(MissingChannel):
        select.select_positions(wide, [3])
    with pytest.raises(MissingChannel):
        select.rename_channels(wide, {"w": "v"})
    with pytest.raises(ChannelCountMismatch):
        select.split_outputs(wide, ["one", "two"])


def test_rename_long_needs_no_alignment(spark):
    df = spark.createDataFrame([("a", "EEG L", 0, 1.0), ("a", "TEMP", 0, 2.0), ("a", "TEMP", 1, 2.0)], "recording_id string, channel string, sample_idx long, value double")
    out = select.rename_channels(df, {"EEG L": "EEG_LEFT"})
    assert sorted(r.channel for r in out.collect()) == ["EEG_LEFT", "TEMP", "TEMP"]


def test_mask_must_be_boolean(spark):
    df = signal(spark, [1, 2])
    assert column(select.mask_samples(df, F.col("value") > 1)) == [2.0]
    with pytest.raises(LunariaError):
        select.mask_samples(df, F.col("value"))


def test_assign_roll_tail(spark):
    df = signal(spark, range(7))
    assert column(select.assign_where(df, F.col("value") > 4, ["value"], 0.0)) == [0, 1, 2, 3, 4, 0, 0]
    assert column(select.roll(df, 2)) == [5, 6, 0, 1, 2, 3, 4]
    assert column(select.roll(df, -1)) == [1, 2, 3, 4, 5, 6, 0]
    assert len(column(select.drop_tail(df, 3))) == 6


def test_label_map(spark):
    df = spark.createDataFrame([(0,), (4,), (9,), (None,)], "code int")
    assert [r.label for r in select.map_labels(df, STAGES, "UNKNOWN").collect()] == ["W", "REM", "UNKNOWN", "UNKNOWN"]
    assert select.map_labels(df.limit(0), STAGES, "UNKNOWN").count() == 0
    assert select.composed({0: "W", 1: "x"}, {"W": "Wake"}, "?") == {0: "Wake", 1: "?"}


def test_clip_iqr(spark):
    out = column(select.clip_iqr(signal(spark, [1, 2, 3, 4, 100]), 1.0))
    assert out == [1.0, 2.0, 3.0, 4.0, 6.0]


def test_stats_with_nan(spark):
    df = spark.createDataFrame([("c", 1.0), ("c", float("nan")), ("d", 3.0), ("d", 5.0)], "channel string, value double")
    rows = {r.channel: r for r in aggregate.channel_stats(df).collect()}
    assert all(v != v for v in rows["c"][1:])
    assert tuple(rows["d"])[1:] == (3.0, 5.0, 4.0, 1.0)
    assert {r.channel: r["mean"] for r in aggregate.nan_mean(df, key=("channel",)).collect()} == {"c": 1.0, "d": 4.0}


def test_label_counts_have_zeros(spark):
    df = spark.createDataFrame([("a", "W"), ("a", "W"), ("b", "N1")], "recording_id string, label string")
    rows = {r.recording_id: tuple(r)[1:] for r in aggregate.label_counts(df, ["W", "N1", "REM"]).collect()}
    assert rows == {"a": (2, 0, 0), "b": (0, 1, 0)}


def test_beat_measures(spark):
    df = signal(spark, [800, 860, 800]).withColumnRenamed("value", "ibi")
    r = aggregate.beat_measures(df).first()
    assert (r.n_beats, r.rmssd, r.pnn50) == (3, 60.0, 1.0)


def test_quantiles_are_exact(spark):
    """Small, tied, constant and large recordings, at quantiles inside and at the ends."""
    rng, at, rows, want = np.random.default_rng(0), (0.0, 0.01, 0.25, 0.5, 0.995, 1.0), [], {}
    for k, n in enumerate((1, 2, 3, 10, 1999, 2001, 6000, 6000, 4000)):
        v = np.full(n, 3.5) if k == 8 else np.round(rng.normal(size=n), 1) if k == 7 else rng.normal(size=n)
        rows += [(str(k), float(x)) for x in v]
        want[str(k)] = np.percentile(v, [100 * q for q in at])
    df = spark.createDataFrame([*rows, ("none", None)], "recording_id string, value double")
    got = {r.recording_id: list(r)[1:] for r in select.quantiles(df, at).collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], rtol=1e-12, atol=1e-12) for k in want)
    assert [r.value for r in select.clip_iqr(df.where("recording_id = 'none'")).collect()] == [None]


def test_quantiles_of_short_recordings_are_one_aggregate(spark):
    """Their values are neither multiplied nor ranked row by row; NaN sorts last, infinities stay."""
    nan, inf = float("nan"), float("inf")
    rows = {"a": [nan, 1.0, 2.0, 4.0, nan], "b": [inf, -inf, inf, inf], "c": [0.5] * 2000}
    df = spark.createDataFrame([(k, v) for k, x in rows.items() for v in x], "recording_id string, value double")
    q = select.quantiles(df, (0.0, 0.25, 0.5, 1.0))
    got = {r.recording_id: list(r)[1:] for r in q.collect()}
    assert got["a"][:3] == [1.0, 2.0, 4.0] and got["a"][3] != got["a"][3]
    assert got["b"][0] == -inf and got["b"][2:] == [inf, inf] and got["c"] == [0.5] * 4
    assert "percentile(__v" in q._jdf.queryExecution().executedPlan().toString()
