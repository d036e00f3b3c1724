"""Complexity and model features of epochs (rows of samples), from published definitions. numpy only."""

from __future__ import annotations

import math

import numpy as np

#: Longest lag of Higuchi's curve lengths, samples of an ordinal pattern, coefficients of linear prediction and
#: cepstra, and levels of the wavelet transform.
LAGS, ORDER, PREDICTION, CEPSTRA, LEVELS = 10, 3, 8, 8, 6
COMPLEXITY = ("perm_entropy", "higuchi", "petrosian", "mobility", "complexity")
MODELS = (*(f"wavelet_{k}" for k in range(1, LEVELS + 1)), *(f"lpc_{k}" for k in range(1, PREDICTION + 1)), *(f"cepstrum_{k}" for k in range(1, CEPSTRA + 1)), "lempel_ziv")


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a / b, 0 where there is no denominator."""
    return np.divide(a, b, out=np.zeros_like(a, dtype=np.float64), where=b > 0)


def permutation_entropy(x: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Entropy of the ordinal patterns of neighbouring samples, of 1 at most; the earlier of equal samples is the
    smaller one."""
    n = x.shape[1] - order + 1
    parts = np.stack([x[:, i : i + n] for i in range(order)], 2)
    rank = np.argsort(parts, 2, kind="stable") @ (order ** np.arange(order))
    out = np.zeros(len(x))
    for i, row in enumerate(rank):
        p = np.unique(row, return_counts=True)[1] / n
        out[i] = -(p * np.log2(p)).sum() / math.log2(math.factorial(order))
    return out + 0.0


def higuchi(x: np.ndarray, lags: int = LAGS) -> np.ndarray:
    """Fractal dimension: the slope of log curve length over log resolution; 0 for a constant epoch."""
    n = x.shape[1]
    length = np.zeros((len(x), lags))
    for k in range(1, lags + 1):
        for m in range(k):
            steps = (n - m - 1) // k
            if steps:
                length[:, k - 1] += np.abs(np.diff(x[:, m : m + steps * k + 1 : k], axis=1)).sum(1) * (n - 1) / (steps * k * k)
        length[:, k - 1] /= k
    flat = (length <= 0).any(1)
    t = np.log(1 / np.arange(1, lags + 1))
    t = t - t.mean()
    return np.where(flat, 0.0, np.log(np.where(flat[:, None], 1.0, length)) @ t / (t @ t))


def petrosian(x: np.ndarray) -> np.ndarray:
    """Fractal dimension from the number of turns."""
    d, n = np.diff(x, axis=1), x.shape[1]
    turns = (d[:, 1:] * d[:, :-1] < 0).sum(1)
    return math.log10(n) / (math.log10(n) + np.log10(n / (n + 0.4 * turns)))


def hjorth(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mobility and complexity."""
    d = np.diff(x, axis=1)
    v0, v1, v2 = x.var(1), d.var(1), np.diff(d, axis=1).var(1)
    mobility = np.sqrt(_ratio(v1, v0))
    return mobility, _ratio(np.sqrt(_ratio(v2, v1)), mobility)


def complexity(x: np.ndarray) -> np.ndarray:
    """COMPLEXITY of each row of at least LAGS + 2 samples."""
    return np.column_stack([permutation_entropy(x), higuchi(x), petrosian(x), *hjorth(x)])


def wavelet_energies(x: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Energy of the details at each level of the Haar transform; what does not fill a pair is left out."""
    out, a = [], x
    for _ in range(levels):
        a = a[:, : a.shape[1] // 2 * 2]
        out.append((((a[:, ::2] - a[:, 1::2]) / math.sqrt(2)) ** 2).sum(1))
        a = (a[:, ::2] + a[:, 1::2]) / math.sqrt(2)
    return np.column_stack(out)


def autocorrelation(x: np.ndarray, lags: int) -> np.ndarray:
    c = x - x.mean(1, keepdims=True)
    return np.column_stack([(c[:, : x.shape[1] - k] * c[:, k:]).sum(1) for k in range(lags + 1)])


def linear_prediction(x: np.ndarray, order: int = PREDICTION) -> np.ndarray:
    """Coefficients a1, a2, ... of the prediction of a sample from those before (autocorrelation method), by the
    Levinson-Durbin recursion; 0 once nothing is left to predict."""
    r = autocorrelation(x, order)
    a, error = np.zeros((len(x), order)), r[:, 0].copy()
    for k in range(order):
        fine = error > 1e-12 * r[:, 0]
        reflection = _signed(r[:, k + 1] - (a[:, :k] * r[:, k:0:-1]).sum(1), np.where(fine, error, 0.0))
        a[:, :k] = a[:, :k] - reflection[:, None] * a[:, :k][:, ::-1]
        a[:, k] = reflection
        error = error * (1 - reflection**2)
    return a


def _signed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=b != 0)


def cepstra(x: np.ndarray, n: int = CEPSTRA) -> np.ndarray:
    """Cepstral coefficients that follow from the linear prediction."""
    a = linear_prediction(x, n)
    c = np.zeros((len(x), n))
    for k in range(n):
        c[:, k] = a[:, k] + sum((j + 1) / (k + 1) * c[:, j] * a[:, k - j - 1] for j in range(k))
    return c


def lempel_ziv(x: np.ndarray) -> np.ndarray:
    """Phrases of the sequence 'above the median' (each the shortest that was not there before, as Lempel and Ziv
    counted in 1976), as a share of n / log2 n, the number of a random one."""
    out, n = np.zeros(len(x)), x.shape[1]
    for i, row in enumerate(x > np.median(x, axis=1, keepdims=True)):
        text = row.astype(np.uint8).tobytes()
        at, phrases = 0, 0
        while at < n:
            size = 1
            while at + size <= n and text.find(text[at : at + size], 0, at + size - 1) >= 0:
                size += 1
            phrases, at = phrases + 1, at + size
        out[i] = phrases * math.log2(n) / n
    return out


def models(x: np.ndarray) -> np.ndarray:
    """MODELS of each row."""
    return np.column_stack([wavelet_energies(x), linear_prediction(x), cepstra(x), lempel_ziv(x)])
