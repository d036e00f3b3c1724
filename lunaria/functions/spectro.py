"""Spectrograms and per-epoch features. numpy only."""

from __future__ import annotations

import numpy as np

SEGMENT, OVERLAP, TAPER = 256, 32, 0.25


def tukey(n: int, taper: float = TAPER) -> np.ndarray:
    """Periodic Tukey window."""
    k = np.arange(n + 1)
    edge = taper * n / 2
    w = np.ones(n + 1)
    rise = k < edge
    w[rise] = 0.5 * (1 + np.cos(np.pi * (k[rise] / edge - 1)))
    fall = k > n - edge
    w[fall] = 0.5 * (1 + np.cos(np.pi * ((k[fall] - n) / edge + 1)))
    return w[:n]


def spectrogram(x: np.ndarray, rate: float, segment: int = SEGMENT, overlap: int = OVERLAP) -> np.ndarray:
    """One-sided power density, (..., times, frequencies), of the last axis; each segment's mean is removed."""
    x = np.asarray(x, np.float64)
    step, n = segment - overlap, x.shape[-1]
    starts = np.arange(0, n - segment + 1, step)
    s = x[..., starts[:, None] + np.arange(segment)]
    w = tukey(segment)
    p = np.abs(np.fft.rfft((s - s.mean(-1, keepdims=True)) * w)) ** 2 / (rate * (w**2).sum())
    p[..., 1 : -1 if segment % 2 == 0 else None] *= 2
    return p


FEATURES = (
    "mean", "std", "var", "min", "max", "median", "q25", "q75", "rms", "skewness", "kurtosis", "abs_energy", "mean_abs_diff", "mean_diff",
    "zero_crossings", "peak_to_peak", "autocorrelation", "slope", "centroid", "spread", "max_frequency", "median_frequency", "spectral_entropy",
    "delta", "theta", "alpha", "sigma", "beta",
)
BANDS = {"delta": (0.5, 4), "theta": (4, 8), "alpha": (8, 12), "sigma": (12, 16), "beta": (16, 30)}


def features(x: np.ndarray, rate: float) -> np.ndarray:
    """FEATURES of each row: statistical, temporal and spectral; 0 where a ratio has no denominator."""
    x = np.asarray(x, np.float64)
    n, m = x.shape[1], x.mean(1, keepdims=True)
    d, c = np.diff(x, axis=1), x - m
    ratio = lambda a, b: np.divide(a, b, out=np.zeros_like(a), where=b > 0)
    var = x.var(1)
    q25, q50, q75 = np.percentile(x, (25, 50, 75), axis=1)
    t = np.arange(n) - (n - 1) / 2
    p, f = np.abs(np.fft.rfft(c)) ** 2, np.fft.rfftfreq(n, 1 / rate)
    total = p.sum(1)
    share = ratio(p, np.broadcast_to(total[:, None], p.shape))
    centroid = (share * f).sum(1)
    run = np.cumsum(share, 1)
    at = lambda q: f[np.minimum((run < q).sum(1), len(f) - 1)]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(1) / np.log2(len(f))
    bands = [(share * ((f >= a) & (f < b))).sum(1) for a, b in BANDS.values()]
    return np.column_stack([
        m[:, 0], np.sqrt(var), var, x.min(1), x.max(1), q50, q25, q75, np.sqrt((x**2).mean(1)), ratio((c**3).mean(1), var**1.5), ratio((c**4).mean(1), var**2) - 3 * (var > 0),
        (x**2).sum(1), np.abs(d).mean(1), d.mean(1), (np.diff(np.signbit(x), axis=1) != 0).sum(1), np.ptp(x, 1), ratio((c[:, 1:] * c[:, :-1]).sum(1), (c**2).sum(1)), (c * t).sum(1) / (t**2).sum(),
        centroid, np.sqrt((share * (f - centroid[:, None]) ** 2).sum(1)), at(0.95), at(0.5), entropy, *bands,
    ])


def lite_row(signals: np.ndarray, rate: float) -> np.ndarray:
    """(epochs, channels, samples) to spectrograms, time-major, channel after channel."""
    s = spectrogram(signals, rate)
    return s.reshape(len(signals), -1)


def full_row(signals: np.ndarray, rate: float) -> np.ndarray:
    """Spectrograms, then the features of every channel."""
    own = [features(signals[:, c], rate) for c in range(signals.shape[1])]
    return np.hstack([lite_row(signals, rate), *own])
