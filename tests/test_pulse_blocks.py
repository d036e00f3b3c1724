"""Pulse waves in blocks against the whole signal, and the correction of planted beat artifacts."""

from __future__ import annotations

import numpy as np
import pytest

from lunaria.errors import LunariaError
from lunaria.functions import ppg
from lunaria.operators import dsp, pulse


def wave(n, rate=32.0, seed=0):
    rng = np.random.default_rng(seed)
    t = np.cumsum(1 + 0.15 * np.sin(np.arange(n) / 200)) / rate
    return np.exp(-(((t * 1.2) % 1 - 0.3) ** 2) / 0.01) - 0.2 + 0.05 * rng.normal(size=n)


def frame(spark, recordings):
    rows = [(r, "x", i, float(v)) for r, x in recordings.items() for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "recording_id string, channel string, sample_idx long, value double")


def same(got, x, *args):
    want = ppg.process(x, *args)
    assert [r.sample_idx for r in got] == list(range(len(x)))
    for c in ("clean", "peaks", "ibi", "rate", "quality"):
        assert np.allclose([r[c] for r in got], want[c], atol=1e-9, equal_nan=True), c


@pytest.mark.parametrize("method", ppg.PEAK_METHODS)
@pytest.mark.parametrize("block", [1, 700, 1 << 18])
def test_blocks_give_what_the_whole_signal_does(spark, method, block):
    """Blocks as small as the halo, in the middle of beats, and larger than the signal; short and flat signals."""
    given = {"long": wave(3001), "short": wave(50, seed=1), "two": np.array([1.0, 2.0]), "flat": np.zeros(900), "one": np.eye(1, 400, 200)[0]}
    out = {}
    for r in dsp.process_ppg(frame(spark, given), 32.0, method, block=block).orderBy("recording_id", "sample_idx").collect():
        out.setdefault(r.recording_id, []).append(r)
    assert out.keys() == given.keys()
    for name, x in given.items():
        same(out[name], x, 32.0, method)


@pytest.mark.parametrize("interpolation", ppg.INTERPOLATIONS)
def test_curves_in_pieces(interpolation):
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 4, 25):
        x = np.sort(rng.choice(400, n, replace=False)).astype(float)
        y = rng.normal(size=n)
        assert np.allclose(ppg.on_pieces(ppg.pieces(x, y, 400, interpolation), np.arange(400.0)), ppg.interpolate(x, y, np.arange(400.0), interpolation))


def test_dissimilarity_in_blocks(spark):
    x = wave(1500, seed=4)
    got = dsp.process_ppg(frame(spark, {"a": x}), 32.0, "elgendi", "dissimilarity", "linear", block=400).orderBy("sample_idx").collect()
    same(got, x, 32.0, "elgendi", "dissimilarity", "linear")
    with pytest.raises(LunariaError):
        dsp.process_ppg(frame(spark, {"a": x}), 32.0, "none")


def test_short_recordings_are_one_pass(spark):
    """Steps before included: one shuffle, and in one plan with longer recordings the values of the whole."""
    steps = (dsp.resample_step(32.0, 20.0), dsp.fir_step(20.0, 0.5, 8.0))
    given = {"long": wave(3001), "short": wave(900, seed=1), "edge": wave(1601, seed=2)}
    df = frame(spark, given)
    plan = dsp.process_ppg(df, 20.0, "charlton", steps=steps)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    out = {}
    for r in dsp.process_ppg(df, 20.0, "charlton", block=1000, steps=steps).orderBy("recording_id", "sample_idx").collect():
        out.setdefault(r.recording_id, []).append(r)
    assert out.keys() == given.keys()
    for name, x in given.items():
        same(out[name], dsp.stepped(x, steps)[0], 20.0, "charlton")
    assert dsp.process_ppg(df.limit(0), 20.0).count() == 0


RATE = 250.0


def beats(seed=5, n=300):
    rng = np.random.default_rng(seed)
    return np.cumsum(200 + np.round(12 * np.sin(np.arange(n) / 7)) + rng.integers(-1, 2, n)).astype(int)


def kinds(spark, p):
    df = spark.createDataFrame([("a", int(v)) for v in p], "recording_id string, sample_idx long")
    made = {r.sample_idx: r.kind for r in pulse.classify_beats(df, RATE).collect()}
    fixed = sorted((r.sample_idx, r.kind) for r in pulse.correct_beats(df, RATE).collect())
    return made, fixed


def test_regular_beats_stay(spark):
    made, fixed = kinds(spark, beats())
    assert set(made.values()) == {"normal"} and [i for i, _ in fixed] == beats().tolist()


@pytest.mark.parametrize("at", [5, 60, 150, 290])
def test_planted_artifacts(spark, at):
    p = beats()
    made, fixed = kinds(spark, np.delete(p, at))  # a missed beat
    assert made[p[at + 1]] == "missed" and list(made.values()).count("normal") == len(p) - 2
    put = [i for i, k in fixed if k == "missed"]
    assert len(put) == 1 and abs(put[0] - p[at]) < 10 and len(fixed) == len(p)
    extra = int(p[at]) + 70
    made, fixed = kinds(spark, np.sort(np.append(p, extra)))  # one too many
    assert "extra" in (made[extra], made[p[at + 1]]) and len(fixed) == len(p)
    early = p.copy()
    early[at] -= 60  # an ectopic beat
    made, fixed = kinds(spark, early)
    assert made[p[at + 1]] == "ectopic" and [k for _, k in fixed].count("moved") == 1
    assert max(abs(np.array([i for i, _ in fixed]) - p)) < 10


def test_few_beats(spark):
    for n in (0, 1, 2, 3):
        made, fixed = kinds(spark, beats()[:n])
        assert set(made.values()) <= {"normal"} and [i for i, _ in fixed] == beats()[:n].tolist()


def test_corrected_waves(spark):
    """A wave with a beat left out: the correction puts it in, and intervals are even again."""
    x = np.zeros(40 * 100)
    for k in range(100):
        if k != 50:
            x[40 * k + 10 : 40 * k + 20] = np.hanning(10)
    ibi = {}
    for correct in (False, True):
        got = dsp.process_ppg(frame(spark, {"a": x}), 40.0, "elgendi", correct=correct, block=900).orderBy("sample_idx").collect()
        ibi[correct] = np.array([r.ibi for r in got])
    assert ibi[False].max() > 1900 and abs(ibi[True] - 1000).max() < 60
