"""Zero-phase FIR filters: windowed-sinc design (Hamming) and reflected edges. numpy only.

The design follows the published rules for firwin-type filters with a 0.0194 passband ripple:
length = 3.3 / transition width, made odd; transitions min(max(0.25 f, 2), f) below and
min(max(0.25 f, 2), Nyquist - f) above. It is tested by response, not by equality with a library.
"""

from __future__ import annotations

import numpy as np

from ..errors import LunariaError


def _lowpass(cut: float, taps: int, rate: float) -> np.ndarray:
    n = np.arange(taps) - (taps - 1) / 2
    h = 2 * cut / rate * np.sinc(2 * cut / rate * n) * np.hamming(taps)
    return h / h.sum()


def design(rate: float, low: float | None = None, high: float | None = None) -> np.ndarray:
    """Taps for: low only, high-pass; high only, low-pass; low < high, band-pass; low > high, band-stop."""
    nyquist = rate / 2
    if low is None and high is None:
        raise LunariaError("a filter needs a cutoff")
    for f in (low, high):
        if f is not None and not 0 < f < nyquist:
            raise LunariaError(f"cutoff {f} Hz outside 0 to {nyquist} Hz")
    widths = []
    low_width = min(max(0.25 * low, 2.0), low) if low is not None else None
    high_width = min(max(0.25 * high, 2.0), nyquist - high) if high is not None else None
    if low is not None and high is not None and low > high:  # stop band between high and low
        low_width = min(max(0.25 * low, 2.0), nyquist - low)
        high_width = min(max(0.25 * high, 2.0), high)
    widths = [w for w in (low_width, high_width) if w]
    taps = int(np.ceil(3.3 / min(widths) * rate))
    taps += 1 - taps % 2
    delta = np.zeros(taps)
    delta[taps // 2] = 1
    if low is None:
        return _lowpass(high + high_width / 2, taps, rate)
    if high is None:
        return delta - _lowpass(low - low_width / 2, taps, rate)
    if low < high:
        return _lowpass(high + high_width / 2, taps, rate) - _lowpass(low - low_width / 2, taps, rate)
    return _lowpass(high - high_width / 2, taps, rate) + delta - _lowpass(low + low_width / 2, taps, rate)


def reflected(x: np.ndarray, pad: int) -> tuple[np.ndarray, int]:
    """x with an odd reflection on both sides, as far as x reaches, zeros beyond."""
    own = min(pad, max(len(x) - 1, 0))
    left = 2 * x[0] - x[own:0:-1] if own else np.zeros(0)
    right = 2 * x[-1] - x[-2 : -own - 2 : -1] if own else np.zeros(0)
    zero = np.zeros(pad - own)
    return np.concatenate([zero, left, x, right, zero]), pad


def convolve(x: np.ndarray, taps: np.ndarray) -> np.ndarray:
    """'valid' convolution, by FFT blocks where that is cheaper."""
    if len(x) < len(taps):
        return np.zeros(0)
    if len(taps) < 64 or len(x) < 4096:
        return np.convolve(x, taps, "valid")
    size = 1 << int(np.ceil(np.log2(max(8 * len(taps), 16384))))
    step = size - len(taps) + 1
    spectrum = np.fft.rfft(taps, size)
    out = np.empty(len(x) - len(taps) + 1)
    for at in range(0, len(out), step):
        y = np.fft.irfft(np.fft.rfft(x[at : at + size], size) * spectrum, size)[len(taps) - 1 : size]
        m = min(step, len(out) - at)
        out[at : at + m] = y[:m]
    return out


def filtered(x: np.ndarray, taps: np.ndarray) -> np.ndarray:
    """x filtered without phase shift, as long as x."""
    if not len(x):
        return x.astype(np.float64)
    padded, _ = reflected(np.asarray(x, np.float64), len(taps) // 2)
    return convolve(padded, taps)
