from __future__ import annotations

import numpy as np
import pytest

from lunaria.errors import LunariaError
from lunaria.functions import fir, ppg, resample, spectro
from lunaria.operators import dsp, pulse

KEY = ("recording_id", "channel")


def long(spark, x, rid="a"):
    return spark.createDataFrame([(rid, "c", i, float(v)) for i, v in enumerate(x)], "recording_id string, channel string, sample_idx long, value double")


def values(df):
    rows = df.orderBy("sample_idx").collect()
    assert [r.sample_idx for r in rows] == list(range(len(rows)))
    return np.array([r.value for r in rows])


def gain(taps, rate, f):
    n = np.arange(len(taps)) - len(taps) // 2
    return abs((taps * np.exp(-2j * np.pi * f / rate * n)).sum())


@pytest.mark.parametrize(
    ("low", "high", "passed", "stopped"),
    [(0.5, 8.0, [2, 5, 7.5], [0.01, 14, 30]), (None, 8.0, [0, 4, 7.5], [12, 40]), (1.0, None, [2, 30], [0.01]), (20.0, 10.0, [1, 7, 26, 50], [13, 16])],
)
def test_filter_response(low, high, passed, stopped):
    taps = fir.design(128.0, low, high)
    assert len(taps) % 2 == 1 and np.allclose(taps, taps[::-1])
    assert all(abs(gain(taps, 128, f) - 1) < 0.02 for f in passed)
    assert all(gain(taps, 128, f) < 0.02 for f in stopped)


def test_filter_arguments():
    with pytest.raises(LunariaError):
        fir.design(128.0)
    with pytest.raises(LunariaError):
        fir.design(128.0, 70.0)


def test_fft_convolution_equals_direct():
    rng = np.random.default_rng(0)
    x, taps = rng.normal(size=40_000), rng.normal(size=301)
    assert np.allclose(fir.convolve(x, taps), np.convolve(x, taps, "valid"))


@pytest.mark.parametrize("n", [1, 5, 300, 1000, 1003, 2048, 2600])
def test_blocks_filter_like_the_whole(spark, n):
    x = np.random.default_rng(n).normal(size=n)
    taps = fir.design(64.0, 2.0, 16.0)
    out = values(dsp.fir_filter(long(spark, x), 64.0, 2.0, 16.0, KEY, block=256))
    assert np.allclose(out, fir.filtered(x, taps), atol=1e-9)


def test_resample_factors_and_lengths():
    assert [resample.factors(r, 128) for r in (256, 64, 32, 4, 1, 20)] == [(1, 2), (2, 1), (4, 1), (32, 1), (128, 1), (32, 5)]
    assert len(resample.resampled(np.zeros(7), 1, 2)) == 4 and len(resample.resampled(np.zeros(7), 2, 1)) == 14
    with pytest.raises(LunariaError):
        resample.factors(0.0001, 1)


def test_resample_keeps_constants_and_tones():
    y = resample.resampled(np.ones(4000), 5, 8)
    assert np.allclose(y[100:-100], 1, atol=1e-3)
    t = np.arange(2560) / 256
    y = resample.resampled(np.sin(2 * np.pi * 5 * t), 1, 2)
    assert np.allclose(y[50:-50], np.sin(2 * np.pi * 5 * np.arange(1280) / 128)[50:-50], atol=2e-3)


def test_resample_direct():
    x = np.random.default_rng(1).normal(size=90)
    up, down = 5, 3
    h = resample.kernel(up, down)
    full = np.zeros(len(x) * up)
    full[::up] = x
    direct = np.convolve(full, h)[len(h) // 2 :][::down][: -(-len(x) * up // down)]
    assert np.allclose(resample.resampled(x, up, down), direct)


@pytest.mark.parametrize(("rate", "target"), [(64.0, 40.0), (64.0, 128.0), (64.0, 16.0)])
@pytest.mark.parametrize("n", [1, 50, 1000, 1003])
def test_blocks_resample_like_the_whole(spark, n, rate, target):
    x = np.random.default_rng(n).normal(size=n)
    out = values(dsp.resample_signal(long(spark, x), rate, target, KEY, block=128))
    assert np.allclose(out, resample.resampled(x, *resample.factors(rate, target)), atol=1e-9)


def test_spectrogram_shape_and_peak():
    t = np.arange(2560) / 256
    s = spectro.spectrogram(np.sin(2 * np.pi * 32 * t), 256)
    assert s.shape == (11, 129) and (s.argmax(1) == 32).all()
    assert spectro.lite_row(np.zeros((3, 2, 2560)), 256).shape == (3, 2838)


def test_spectrogram_power():
    x = np.random.default_rng(2).normal(size=256 * 400)
    assert spectro.spectrogram(x, 256).mean(0).sum() == pytest.approx(1, rel=0.05)


def test_features():
    f = dict(zip(spectro.FEATURES, spectro.features(np.array([[0.0, 1, 2, 3]]), 4)[0], strict=True))
    assert f["mean"] == 1.5 and f["max"] == 3 and f["slope"] == pytest.approx(1) and f["abs_energy"] == 14
    assert np.isfinite(spectro.features(np.zeros((1, 64)), 64)).all()


def beats(rate=64.0, seconds=60, bpm=72):
    t = np.arange(int(rate * seconds)) / rate
    return np.exp(-(((t * bpm / 60) % 1 - 0.3) ** 2) / 0.01) - 0.2


@pytest.mark.parametrize("method", ppg.PEAK_METHODS)
def test_peaks_of_regular_beats(method):
    p = ppg.find_peaks(beats(), 64.0, method)
    assert abs(len(p) - 72) <= 2
    assert np.median(np.diff(p)) == pytest.approx(64 * 60 / 72, abs=1)


def test_process_regular_beats():
    out = ppg.process(beats(), 64.0)
    assert np.nanmedian(out["ibi"]) == pytest.approx(833, abs=16)
    assert np.nanmedian(out["quality"]) > 0.95
    few = ppg.process(np.zeros(50), 64.0)
    assert np.isnan(few["ibi"]).all() and few["peaks"].sum() == 0


@pytest.mark.parametrize("method", ppg.INTERPOLATIONS)
def test_interpolations_meet_their_points(method):
    x, y = np.array([0.0, 2, 5, 9]), np.array([1.0, 3, 2, 4])
    assert np.allclose(ppg.interpolate(x, y, x, method), y)


def test_monotone_stays_monotone():
    x, y = np.array([0.0, 1, 2, 3, 4]), np.array([0.0, 0, 0, 1, 1])
    z = ppg.interpolate(x, y, np.linspace(0, 4, 101))
    assert (np.diff(z) >= -1e-12).all()
    with pytest.raises(LunariaError):
        ppg.interpolate(x, y, x, "septic")


def test_quadratic_gives_parabolas_back():
    x = np.array([0.0, 1, 4, 5, 9, 10, 12])
    at = np.linspace(0, 12, 97)
    assert np.allclose(ppg.interpolate(x, 2 * x**2 - 3 * x + 1, at, "quadratic"), 2 * at**2 - 3 * at + 1)


def test_interval_correction():
    p = np.array([0, 50, 100, 105, 150, 250, 300])
    assert ppg.correct_intervals(p, 64.0).tolist() == [0, 50, 100, 150, 200, 250, 300]


def test_elgendi_in_windows(spark):
    x = beats(16.0, 30)
    df = long(spark, x)
    out = sorted(r.sample_idx for r in pulse.elgendi_peaks(df.drop("channel"), 3, 11, 0.02, least=1).collect())
    assert abs(len(out) - 36) <= 2
    ibi = [r.ibi for r in pulse.beat_intervals(pulse.elgendi_peaks(df.drop("channel"), 3, 11, 0.02, least=1), 16.0).collect()]
    assert np.median(ibi) == pytest.approx(833, abs=63)
