"""Complexity and model features of epochs, smoothing, and measures of beat intervals, against plain Python."""

from __future__ import annotations

import math

import numpy as np
import pytest

from lunaria.functions import complexity as c
from lunaria.operators import aggregate, features

RNG = np.random.default_rng(0)


def test_ordinal_patterns():
    assert c.permutation_entropy(np.array([np.arange(20.0)]))[0] == 0
    x = RNG.normal(size=(1, 5000))
    assert c.permutation_entropy(x)[0] > 0.99
    got = c.permutation_entropy(np.array([[4.0, 7, 9, 10, 6, 11, 3]]))[0]  # patterns 012 x 2, 021... counted by hand
    p = np.array([2, 2, 1]) / 5
    assert got == pytest.approx(-(p * np.log2(p)).sum() / math.log2(6))


def test_fractal_dimensions():
    line, noise = np.array([np.arange(1000.0)]), RNG.normal(size=(1, 4000))
    assert c.higuchi(line)[0] == pytest.approx(1, abs=1e-6) and c.higuchi(noise)[0] == pytest.approx(2, abs=0.05) and c.higuchi(np.zeros((1, 50)))[0] == 0
    assert c.petrosian(line)[0] == 1 and c.petrosian(noise)[0] > 1.02
    x = RNG.normal(size=37)
    length = []
    for k in range(1, 11):
        parts = []
        for m in range(k):
            steps = (len(x) - m - 1) // k
            parts.append(sum(abs(x[m + i * k] - x[m + (i - 1) * k]) for i in range(1, steps + 1)) * (len(x) - 1) / (steps * k) / k)
        length.append(np.mean(parts))
    assert c.higuchi(x[None])[0] == pytest.approx(np.polyfit(np.log(1 / np.arange(1, 11)), np.log(length), 1)[0])


def test_hjorth():
    x = RNG.normal(size=(2, 300))
    mobility, complexity = c.hjorth(x)
    for i in range(2):
        d = np.diff(x[i])
        assert mobility[i] == pytest.approx(math.sqrt(d.var() / x[i].var()))
        assert complexity[i] == pytest.approx(math.sqrt(np.diff(d).var() / d.var()) / mobility[i])
    assert np.isfinite(c.complexity(np.zeros((1, 64)))).all()


def test_linear_prediction_solves_its_equations():
    x = RNG.normal(size=(3, 400)).cumsum(1)
    a = c.linear_prediction(x, 5)
    r = c.autocorrelation(x, 5)
    for i in range(3):
        m = np.array([[r[i, abs(j - k)] for k in range(5)] for j in range(5)])
        assert np.allclose(a[i], np.linalg.solve(m, r[i, 1:]))
    assert (c.linear_prediction(np.ones((1, 30)), 4) == 0).all()
    ar = np.zeros(20_000)
    for t in range(2, len(ar)):
        ar[t] = 0.6 * ar[t - 1] - 0.3 * ar[t - 2] + RNG.normal()
    assert np.allclose(c.linear_prediction(ar[None], 2)[0], [0.6, -0.3], atol=0.03)


def test_cepstra_are_those_of_the_model():
    """The log of 1 / |A| has the cepstra as its Fourier coefficients."""
    a = c.linear_prediction(RNG.normal(size=(1, 300)).cumsum(1), 8)[0]
    w = 2 * np.pi * np.arange(1 << 14) / (1 << 14)
    log = -np.log(np.abs(1 - sum(v * np.exp(-1j * w * (k + 1)) for k, v in enumerate(a))))
    x = RNG.normal(size=(1, 300)).cumsum(1)
    a, got = c.linear_prediction(x, 8)[0], c.cepstra(x, 8)[0]
    log = -np.log(np.abs(1 - sum(v * np.exp(-1j * w * (k + 1)) for k, v in enumerate(a))))
    assert np.allclose(got, 2 * np.fft.ifft(log).real[1:9], atol=1e-6)


def test_wavelets_keep_energy():
    x = RNG.normal(size=(2, 64))
    assert np.allclose(c.wavelet_energies(x, 6).sum(1), (x**2).sum(1) - 64 * x.mean(1) ** 2)


def test_lempel_ziv():
    def phrases(bits):
        at, n = 0, 0
        while at < len(bits):
            size = 1
            while at + size <= len(bits) and bits[at : at + size] in bits[: at + size - 1]:
                size += 1
            n, at = n + 1, at + size
        return n

    assert phrases("0001101001000101") == 6  # the example of the definition: 0, 001, 10, 100, 1000, 101
    x = RNG.normal(size=(3, 120))
    for i in range(3):
        bits = "".join("1" if v > np.median(x[i]) else "0" for v in x[i])
        assert c.lempel_ziv(x)[i] == pytest.approx(phrases(bits) * math.log2(120) / 120)


def test_sleep_features(spark):
    x = RNG.normal(size=16 * 4 * 20)
    df = spark.createDataFrame([("a", k, i, float(v)) for k in ("E", "O") for i, v in enumerate(x)], "recording_id string, channel string, sample_idx long, value double")
    made = features.sleep_features(df, 16.0, {"eeg": "E", "eog": "O"}, 4.0).orderBy("epoch_idx").collect()
    assert len(made) == 20 and {"eeg_higuchi", "eog_delta_beta", "eeg_std_centred", "eeg_alpha_theta_past"} <= set(made[0].asDict())
    own = np.array([x[k * 64 : (k + 1) * 64].std() for k in range(20)])
    near = np.array([np.average(own[max(0, k - 7) : k + 8], weights=[8 - abs(j - k) for j in range(max(0, k - 7), min(20, k + 8))]) for k in range(20)])
    want = (near - np.median(near)) / (np.quantile(near, 0.95) - np.quantile(near, 0.05))
    assert np.allclose([r.eeg_std_centred for r in made], want)
    assert features.epoch_models(df, 16.0, {"eeg": "E"}, 4.0).count() == 20


def beats(spark, x):
    at = np.cumsum(x).astype(int)
    return spark.createDataFrame([("a", int(i), float(v)) for i, v in zip(at, x, strict=True)], "recording_id string, sample_idx long, ibi double")


def test_spectrum_finds_breathing(spark):
    """Intervals (ms at 1000 Hz) that breathe at 0.25 Hz, and the power by its definition."""
    t, x = 0.0, []
    for _ in range(200):
        x.append(round(900 + 60 * math.sin(2 * math.pi * 0.25 * t)))
        t += x[-1] / 1000
    df = beats(spark, x)
    row = aggregate.interval_measures(df, 1000.0).first()
    assert row.breathingrate == pytest.approx(0.25, abs=0.011)
    d = np.diff(x)
    assert row.sd1 == pytest.approx((d / math.sqrt(2)).std()) and row.sdsd == pytest.approx(np.abs(d).std()) and row.hr_mad == pytest.approx(np.median(np.abs(x - np.median(x))))
    assert row.s == pytest.approx(math.pi * row.sd1 * row.sd2) and row.pnn20 == pytest.approx((np.abs(d) > 20).mean())
    got = {r.frequency: r.power for r in aggregate.interval_spectrum(df, 1000.0, [0.1, 0.25, 0.33]).collect()}
    at, y = np.cumsum(x) / 1000, np.array(x) - np.mean(x)
    for f, p in got.items():
        w = 2 * math.pi * f
        tau = math.atan2(np.sin(2 * w * at).sum(), np.cos(2 * w * at).sum()) / (2 * w)
        co, si = np.cos(w * (at - tau)), np.sin(w * (at - tau))
        assert p == pytest.approx(((y @ co) ** 2 / (co @ co) + (y @ si) ** 2 / (si @ si)) / 2)


def test_few_intervals(spark):
    row = aggregate.interval_measures(beats(spark, [800]), 1000.0).first()
    assert row.ibi == 800 and row.rmssd is None and row.breathingrate is None
    assert aggregate.interval_measures(beats(spark, [800]).limit(0), 1000.0).collect() == []


def test_scalers_and_affected_periods(spark):
    from lunaria.errors import LunariaError
    from lunaria.operators import models

    x = np.append(RNG.normal(size=60), [1e6, -1e6])
    df = spark.createDataFrame([("a", "c", i, float(v)) for i, v in enumerate(x)], "recording_id string, channel string, sample_idx long, value double")
    q1, q2, q3 = np.quantile(x, (0.25, 0.5, 0.75))
    held = np.clip(x, q1 - 2 * (q3 - q1), q3 + 2 * (q3 - q1))
    want = {"RobustScaler": (held - q2) / (q3 - q1), "StandardScaler": (held - held.mean()) / held.std(), "MinMaxScaler": (held - held.min()) / np.ptp(held), "MaxAbsScaler": held / abs(held).max(), "none": held}
    for name, y in want.items():
        rows = models.quality_control(df, 20, 2.0, scaler=name, affected=True).orderBy("sample_idx").collect()
        assert np.allclose([r.value for r in rows], y) and {r.sample_idx // 20 for r in rows if r.affected} == {i // 20 for i in np.flatnonzero(held != x)}
    assert {r.period_idx: r.n_clipped for r in models.affected_periods(df, 20, 2.0).collect()} == {k: int((held != x)[k * 20 : k * 20 + 20].sum()) for k in {i // 20 for i in np.flatnonzero(held != x)}}
    with pytest.raises(LunariaError):
        models.quality_control(df, 20, scaler="other")
