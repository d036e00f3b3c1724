"""Streamed filters and beats equal the batch's, however the samples are split and ordered."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lunaria.functions import fir
from lunaria.operators import pulse
from lunaria.streaming import signals
from lunaria.streaming.replay import replay

RATE, STEP = 64.0, 16  # a sample a 16 ms, so the times are whole
FAR = 1 << 60


def streamed(at, x, kernel, reach, parts, shuffled, grace=1000, late=5000):
    """Rows of samples fed in micro-batches, and the most samples that were kept."""
    rng = random.Random(parts)
    order = sorted(range(len(at)), key=lambda i: at[i] + (rng.random() * 200 if shuffled else 0))
    c, out, watermark, kept = signals.Channel(), [], 0, 0
    for part in np.array_split(np.array(order), parts):
        new = part[at[part] * STEP >= watermark]
        assert len(new) == len(part)  # the order keeps within the lateness
        c.add(at[new], x[new], at[new] * STEP)
        out += signals.advance(c, watermark, grace, reach, kernel)
        kept = max(kept, len(c.at))
        if len(new):
            watermark = max(watermark, int(at[new].max()) * STEP - late)
    out += signals.advance(c, FAR, grace, reach, kernel)
    assert not len(c.at)
    rows = np.vstack(out)
    return rows[np.argsort(rows[:, 0])], kept


def stretches(at):
    return np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) != 1) + 1)


@pytest.mark.parametrize("shuffled", [False, True])
@pytest.mark.parametrize("parts", [1, 2, 7, 60])
@pytest.mark.parametrize("gaps", [[], [(0, 3)], [(500, 510), (511, 512), (1500, 2200)]])
def test_filter_equals_the_batch(parts, shuffled, gaps):
    at = np.array([i for i in range(4000) if not any(a <= i < b for a, b in gaps)])
    x = np.random.default_rng(1).normal(size=len(at)) * 100
    taps = fir.design(RATE, 2.0, 16.0)
    rows, kept = streamed(at, x, signals.filter_kernel(taps), len(taps) // 2, parts, shuffled)
    want = np.concatenate([fir.filtered(x[s], taps) for s in stretches(at)])
    assert np.array_equal(rows[:, 0], at) and np.abs(rows[:, 1] - want).max() < 1e-9
    if parts == 60:
        assert kept < 1200  # a kernel, the lateness and a micro-batch


def naive_peaks(x, short, long, floor, least):
    sq = np.square(np.maximum(x, 0))
    mean = lambda i, w: sq[max(0, i - w // 2) : i + w // 2 + 1].mean()
    inside = [mean(i, short) > mean(i, long) + floor for i in range(len(x))]
    out, i = [], 0
    while i < len(x):
        j = i
        while j < len(x) and inside[j]:
            j += 1
        if j - i >= max(least, 1):
            out.append(i + int(np.argmax(x[i:j])))
        i = max(j, i + 1)
    return out


@pytest.mark.parametrize("shuffled", [False, True])
@pytest.mark.parametrize("parts", [1, 3, 17, 400])
def test_peaks_equal_brute_force(parts, shuffled):
    at = np.array([i for i in range(3000) if not 1000 <= i < 1040])
    x = np.random.default_rng(2).integers(-40, 60, len(at)).astype(float)  # ties within blocks
    rows, _ = streamed(at, x, signals.peak_kernel(3, 11, 0.0, 2), 5, parts, shuffled)
    found, since = [], []
    for s in stretches(at):
        own = at[s][naive_peaks(x[s], 3, 11, 0.0, 2)]
        found += [*own]
        since += [np.nan, *np.diff(own)]
    assert np.array_equal(rows[:, 0], found) and np.array_equal(rows[:, 2], since, equal_nan=True)
    assert np.array_equal(rows[:, 1], x[np.searchsorted(at, found)])


def test_repeated_and_early_samples():
    c = signals.Channel()
    kernel = signals.filter_kernel(np.array([0.0, 1.0, 0.0]))
    c.add(np.array([2, 1, 1]), np.array([2.0, 9.0, 1.0]), np.array([20, 10, 10]))
    assert signals.advance(c, 5, 100, 1, kernel) == []  # sample 0 may still come
    c.add(np.array([0, 1]), np.array([0.0, 7.0]), np.array([0, 10]))
    assert signals.advance(c, 5, 100, 1, kernel)[0].tolist() == [[0, 0], [1, 1]]
    c.add(np.array([0, 1, 3]), np.array([5.0, 5.0, 3.0]), np.array([0, 10, 30]))  # given out: they repeat
    assert signals.advance(c, 5, 100, 1, kernel)[0].tolist() == [[2, 2]]
    assert signals.advance(c, FAR, 100, 1, kernel)[0].tolist() == [[3, 3]]


def drained(df, tmp_path, name):
    q = df.writeStream.format("parquet").option("path", f"file://{tmp_path}/{name}").option("checkpointLocation", f"file://{tmp_path}/{name}-state").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()


@pytest.fixture
def recorded(spark, tmp_path):
    """Files of two channels in order of time; the second half comes when the stream has been stopped once."""
    t0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    rng = np.random.default_rng(3)
    rows = [(r, "x", i, t0 + dt.timedelta(milliseconds=STEP * i), float(v)) for r, n in (("a", 900), ("b", 400)) for i, v in enumerate(rng.integers(-40, 60, n))]
    schema = "recording_id string, channel string, sample_idx long, ts timestamp, value double"
    df = spark.createDataFrame(rows, schema).cache()
    half = df.where("sample_idx < 300"), df.where("sample_idx >= 300").unionByName(df.where("sample_idx between 295 and 299"))
    mark = spark.createDataFrame([("end", "x", 0, t0 + dt.timedelta(days=1), 0.0), (None, "x", 1, t0, 0.0), ("a", "x", None, t0, None)], schema)
    return df, half, mark


def test_streams_equal_the_batch_across_a_restart(spark, tmp_path, recorded):
    df, (one, two), mark = recorded
    source = f"file://{tmp_path}/in"
    stream = lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    for part in (one, two, mark):
        part.coalesce(1).write.mode("append").parquet(source)
        drained(signals.fir_filter(stream(), RATE, 2.0, 16.0), tmp_path, "filtered")
        drained(signals.beats(stream(), RATE, 3, 11, least=2), tmp_path, "beats")
    from lunaria.operators import dsp

    key = ["recording_id", "channel", "sample_idx"]
    kept = F.col("recording_id") != "end"
    got = {tuple(r[:3]): r.value for r in spark.read.parquet(f"file://{tmp_path}/filtered").where(kept).collect()}
    want = {(r.recording_id, r.channel, r.sample_idx): r.value for r in dsp.fir_filter(df.select(*key, "value"), RATE, 2.0, 16.0).collect()}
    assert got.keys() == want.keys() and len(got) == 1300 and max(abs(got[k] - want[k]) for k in want) < 1e-9
    found = spark.read.parquet(f"file://{tmp_path}/beats").where(kept)
    peaks = pulse.elgendi_peaks(df, 3, 11, 0.0, least=2)
    assert sorted(map(tuple, found.select("recording_id", "sample_idx", "value").collect())) == sorted(map(tuple, peaks.collect()))
    assert sorted(map(tuple, found.where("ibi is not null").select("recording_id", "sample_idx", "ibi", "rate").collect())) == sorted(map(tuple, pulse.beat_intervals(peaks, RATE).collect()))


def test_an_empty_stream(spark, tmp_path):
    spark.createDataFrame([], "recording_id string, channel string, sample_idx long, ts timestamp, value double").coalesce(1).write.parquet(f"file://{tmp_path}/in")
    s = spark.readStream.schema("recording_id string, channel string, sample_idx long, ts timestamp, value double").parquet(f"file://{tmp_path}/in")
    drained(signals.fir_filter(s, RATE, 2.0, 16.0), tmp_path, "out")
    assert spark.read.schema("value double").parquet(f"file://{tmp_path}/out").count() == 0


def test_replay_in_any_order_of_files(spark):
    """Files that hold each channel's samples at random, among them rows that repeat; and no rows at all."""
    t0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    x = np.random.default_rng(4).normal(size=(3, 700))
    rows = [(r, "x", i, t0 + dt.timedelta(milliseconds=STEP * i), float(x[r, i])) for r in range(3) for i in range(700)]
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows + rows[:50], "recording_id long, channel string, sample_idx long, ts timestamp, value double").repartition(6)
    job = lambda s, late: signals.fir_filter(s, RATE, 2.0, 16.0, late)
    taps = fir.design(RATE, 2.0, 16.0)
    want = {(r, i): v for r in range(3) for i, v in enumerate(fir.filtered(x[r], taps))}
    out = replay(df, job, files_per_trigger=2).collect()
    assert len(out) == len(want) and all(abs(want[r.recording_id, r.sample_idx] - r.value) < 1e-9 for r in out)
    assert replay(df.limit(0), job).count() == 0
