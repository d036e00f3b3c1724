"""Pulse-wave processing from published definitions. numpy only.

Peaks: `elgendi` (two moving averages, Elgendi et al. 2013), `bishop` (multi-scale peak detection,
Bishop and Ercole 2018), `charlton` (the same on a signal thinned to about 20 Hz, with scales up to
the slowest plausible beat, Charlton et al. 2025). Beats become an interval series by interpolation,
and each beat's quality is its correlation with the mean beat (or a dissimilarity to it).
"""

from __future__ import annotations

import numpy as np

from ..errors import LunariaError

PEAK_METHODS = ("elgendi", "bishop", "charlton")
QUALITY_METHODS = ("templatematch", "dissimilarity")
INTERPOLATIONS = ("linear", "slinear", "nearest", "zero", "previous", "next", "cubic", "monotone_cubic", "akima", "quadratic")


def moving_mean(x: np.ndarray, width: int) -> np.ndarray:
    """Centred mean over what lies within the signal."""
    half = width // 2
    total = np.concatenate([[0.0], np.cumsum(x)])
    i = np.arange(len(x))
    lo, hi = np.maximum(i - half, 0), np.minimum(i + half + 1, len(x))
    return (total[hi] - total[lo]) / (hi - lo)


def elgendi_widths(rate: float, peak_s: float = 0.111, beat_s: float = 0.667) -> tuple[int, int, int]:
    """Samples of the short and of the long moving mean, and of a block at least."""
    return 2 * int(peak_s * rate / 2) + 1, 2 * int(beat_s * rate / 2) + 1, int(peak_s * rate)


def elgendi_blocks(x: np.ndarray, rate: float, level: float, lo: int = 0, hi: int | None = None, offset: float = 0.02) -> np.ndarray:
    """Rows (first, after the last, place of the highest, its value) of the blocks in which the short mean of
    the squared positive signal exceeds the long one and a share of its level, among samples lo to hi - 1."""
    squared = np.square(np.maximum(x, 0))
    short, long, _ = elgendi_widths(rate)
    inside = moving_mean(squared, short) > moving_mean(squared, long) + offset * level
    edge = np.diff(np.concatenate([[0], inside[lo:hi].astype(np.int8), [0]]))
    a, b = np.flatnonzero(edge == 1) + lo, np.flatnonzero(edge == -1) + lo
    top = np.array([i + int(np.argmax(x[i:j])) for i, j in zip(a, b, strict=True)], np.int64)
    return np.column_stack([a, b, top, x[top]]) if len(a) else np.zeros((0, 4))


def elgendi_beats(blocks: np.ndarray, rate: float, gap_s: float = 0.3) -> np.ndarray:
    """Peaks of blocks in order, of which parts that touch are one: long enough, and apart from the peak before."""
    peaks: list[int] = []
    k, least = 0, elgendi_widths(rate)[2]
    while k < len(blocks):
        end, best = k, k
        while end + 1 < len(blocks) and blocks[end + 1, 0] == blocks[end, 1]:
            end += 1
            best = end if blocks[end, 3] > blocks[best, 3] else best
        if blocks[end, 1] - blocks[k, 0] >= least and (not peaks or blocks[best, 2] - peaks[-1] > gap_s * rate):
            peaks.append(int(blocks[best, 2]))
        k = end + 1
    return np.array(peaks, np.int64)


def elgendi(x: np.ndarray, rate: float) -> np.ndarray:
    return elgendi_beats(elgendi_blocks(x, rate, float(np.square(np.maximum(x, 0)).mean())), rate)


def _multiscale(x: np.ndarray, scales: int) -> np.ndarray:
    t = np.arange(len(x)) - (len(x) - 1) / 2
    x = x - x.mean() - t * ((x * t).sum() / max((t * t).sum(), 1e-12))
    n = len(x)
    higher = np.zeros((scales, n), bool)
    for k in range(1, scales + 1):
        if n > 2 * k:
            higher[k - 1, k : n - k] = (x[k : n - k] > x[: n - 2 * k]) & (x[k : n - k] > x[2 * k :])
    best = int(higher.sum(1).argmax()) + 1
    return np.flatnonzero(higher[:best].all(0))


WINDOW_S, STEP, LONGEST_S, THIN_HZ = 6.0, 0.8, 2.0, 20.0


def bishop_windows(rate: float) -> tuple[int, int]:
    """Samples of a window and from one to the next."""
    return max(int(WINDOW_S * rate), 8), max(int(WINDOW_S * rate * STEP), 4)


def bishop(x: np.ndarray, rate: float, first: int = 0, last: int | None = None, n: int | None = None) -> np.ndarray:
    """Peaks of windows at whole steps. x may be a part of a signal of n samples that begins with sample `first`
    (then a whole step); windows that begin before sample `last` are looked at."""
    width, step = bishop_windows(rate)
    n = len(x) if n is None else n
    found: set[int] = set()
    for at in range(first, min(max(n - width // 4, 1), n if last is None else last), step):
        part = x[at - first : at - first + width]
        found.update((at + _multiscale(part, max(1, min(len(part) // 2, int(LONGEST_S * rate / 2))))).tolist())
    return np.array(sorted(found), np.int64)


def thinning(rate: float) -> int:
    return max(1, int(rate // THIN_HZ))


def charlton(x: np.ndarray, rate: float) -> np.ndarray:
    thin = thinning(rate)
    return refined(x, bishop(x[::thin], rate / thin) * thin, thin)


def refined(x: np.ndarray, rough: np.ndarray, thin: int, first: int = 0) -> np.ndarray:
    """The highest samples within thin samples of peaks of a thinned signal; x begins with sample `first`."""
    rough = rough - first
    fine = [max(0, p - thin) + int(np.argmax(x[max(0, p - thin) : p + thin + 1])) for p in rough.tolist()]
    return np.array(sorted(set(fine)), np.int64) + first


def find_peaks(x: np.ndarray, rate: float, method: str = "elgendi") -> np.ndarray:
    if method not in PEAK_METHODS:
        raise LunariaError(f"peak method {method}")
    if len(x) < 3:
        return np.zeros(0, np.int64)
    return {"elgendi": elgendi, "bishop": bishop, "charlton": charlton}[method](np.asarray(x, np.float64), rate)


def correct_intervals(peaks: np.ndarray, rate: float, spread: float = 0.3) -> np.ndarray:
    """Drops peaks that come too early and fills gaps with evenly spaced ones, judged by the median beat."""
    if len(peaks) < 3:
        return peaks
    usual = np.median(np.diff(peaks))
    out = [int(peaks[0])]
    for p in peaks[1:].tolist():
        gap = p - out[-1]
        if gap < (1 - spread - 0.2) * usual:
            continue
        missing = int(round(gap / usual)) - 1
        if missing > 0 and gap > (1 + spread) * usual:
            out += [int(round(out[-1] + gap * (k + 1) / (missing + 1))) for k in range(missing)]
        out.append(p)
    return np.array(out, np.int64)


def _slopes_monotone(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    h, d = np.diff(x), np.diff(y) / np.diff(x)
    m = np.zeros(len(x))
    same = d[:-1] * d[1:] > 0
    w1, w2 = 2 * h[1:] + h[:-1], h[1:] + 2 * h[:-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        m[1:-1] = np.where(same, (w1 + w2) / (w1 / d[:-1] + w2 / d[1:]), 0)

    def end(h0: float, h1: float, d0: float, d1: float) -> float:
        s = ((2 * h0 + h1) * d0 - h0 * d1) / (h0 + h1)
        return 0.0 if s * d0 <= 0 else 3 * d0 if d0 * d1 <= 0 and abs(s) > 3 * abs(d0) else s

    m[0], m[-1] = end(h[0], h[1], d[0], d[1]), end(h[-1], h[-2], d[-1], d[-2])
    return m


def _slopes_akima(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = np.diff(y) / np.diff(x)
    d = np.concatenate([[3 * d[0] - 2 * d[1], 2 * d[0] - d[1]], d, [2 * d[-1] - d[-2], 3 * d[-1] - 2 * d[-2]]])
    w1, w2 = np.abs(d[3:] - d[2:-1]), np.abs(d[1:-2] - d[:-3])
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(w1 + w2 > 0, (w1 * d[1:-2] + w2 * d[2:-1]) / (w1 + w2), (d[1:-2] + d[2:-1]) / 2)


def _banded(low: np.ndarray, mid: np.ndarray, up: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """The solution of a tridiagonal system (diagonally dominant, so no pivots are needed)."""
    n, mid, rhs = len(mid), mid.astype(np.float64), rhs.astype(np.float64)
    for k in range(1, n):
        f = low[k - 1] / mid[k - 1]
        mid[k] -= f * up[k - 1]
        rhs[k] -= f * rhs[k - 1]
    m = np.empty(n)
    m[-1] = rhs[-1] / mid[-1]
    for k in range(n - 2, -1, -1):
        m[k] = (rhs[k] - up[k] * m[k + 1]) / mid[k]
    return m


def _slopes_spline(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Natural cubic spline."""
    h, d = np.diff(x), np.diff(y) / np.diff(x)
    low, mid, up = np.append(h[1:], 1.0), np.concatenate([[2], 2 * (h[:-1] + h[1:]), [2]]), np.append(1.0, h[:-1])
    return _banded(low, mid, up, np.concatenate([[3 * d[0]], 3 * (h[1:] * d[:-1] + h[:-1] * d[1:]), [3 * d[-1]]]))


def _quadratic_spline(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(knots, coefficients) of the quadratic spline through all points, with knots midway between neighbours
    but for the outermost two at either end, where one parabola goes on to the end."""
    n = len(x)
    t = np.concatenate([[x[0]] * 3, ((x[1:] + x[:-1]) / 2)[1:-1], [x[-1]] * 3])
    j = np.clip(np.searchsorted(t, x, "right") - 1, 2, n - 1)
    width = t[j + 1] - t[j]
    a = (t[j + 1] - x) ** 2 / ((t[j + 1] - t[j - 1]) * width)
    c = (x - t[j]) ** 2 / ((t[j + 2] - t[j]) * width)
    rows = np.zeros((n, 5))  # columns i - 2 to i + 2; all but the middle three stay 0
    for k, part in enumerate((a, 1 - a - c, c)):
        rows[np.arange(n), j - 2 + k - np.arange(n) + 2] = part
    return t, _banded(rows[1:, 1], rows[:, 2], rows[:-1, 3], y)


#: A curve over samples 0 to n - 1 as rows (first sample, sample after the last, x0, c0, c1, c2, c3): at a sample
#: i of a row the curve is the polynomial of these coefficients at i - x0.
def pieces(x: np.ndarray, y: np.ndarray, n: int, method: str = "monotone_cubic") -> np.ndarray:
    """Interpolation through points (x, y), x being samples in rising order; beyond the ends the end values hold."""
    if method not in INTERPOLATIONS:
        raise LunariaError(f"interpolation {method}")
    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    m, zero = len(x), np.zeros(max(len(x) - 1, 0))
    flat = lambda lo, hi, v: [lo, hi, lo, v, 0, 0, 0]
    ends = [flat(0, x[0], y[0]), flat(x[-1], n, y[-1])]
    if m == 1:
        body = np.zeros((0, 7))
    elif method in ("zero", "previous"):
        body = np.column_stack([x[:-1], x[1:], x[:-1], y[:-1], zero, zero, zero])
    elif method == "next":
        ends = [flat(0, x[0] + 1, y[0]), flat(x[-1] + 1, n, y[-1])]
        body = np.column_stack([x[:-1] + 1, x[1:] + 1, x[:-1], y[1:], zero, zero, zero])
    elif method == "nearest":
        half = np.concatenate([[0], np.floor((x[:-1] + x[1:]) / 2) + 1, [n]])
        return np.column_stack([half[:-1], half[1:], x, y, *[np.zeros(m)] * 3])
    elif method in ("linear", "slinear") or m < 3:
        body = np.column_stack([x[:-1], x[1:], x[:-1], y[:-1], np.diff(y) / np.diff(x), zero, zero])
    elif method == "quadratic":
        t, c = _quadratic_spline(x, y)
        j = np.arange(2, m)
        w = t[j + 1] - t[j]
        a, b = (c[j - 2] - c[j - 1]) / ((t[j + 1] - t[j - 1]) * w), (c[j] - c[j - 1]) / ((t[j + 2] - t[j]) * w)
        body = np.column_stack([np.ceil(t[j]), np.ceil(t[j + 1]), t[j], c[j - 1] + a * w * w, -2 * a * w, a + b, np.zeros(len(j))])
    else:
        s = {"monotone_cubic": _slopes_monotone, "akima": _slopes_akima, "cubic": _slopes_spline}[method](x, y)
        h, d = np.diff(x), np.diff(y) / np.diff(x)
        body = np.column_stack([x[:-1], x[1:], x[:-1], y[:-1], s[:-1], (3 * d - 2 * s[:-1] - s[1:]) / h, (s[:-1] + s[1:] - 2 * d) / h**2])
    return np.vstack([ends[0], body, ends[1]])


def on_pieces(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Values of a curve at samples; NaN where no row holds."""
    out = np.full(len(at), np.nan)
    rows = rows[rows[:, 0] < rows[:, 1]]
    if len(rows):
        k = np.searchsorted(rows[:, 0], at, "right") - 1
        held = (k >= 0) & (at < rows[k, 1])
        r, u = rows[k[held]], at[held] - rows[k[held], 2]
        out[held] = ((r[:, 6] * u + r[:, 5]) * u + r[:, 4]) * u + r[:, 3]
    return out


def interpolate(x: np.ndarray, y: np.ndarray, at: np.ndarray, method: str = "monotone_cubic") -> np.ndarray:
    """Values at given places; beyond the ends the end values hold."""
    if method not in INTERPOLATIONS:
        raise LunariaError(f"interpolation {method}")
    at = np.clip(at, x[0], x[-1])
    k = np.clip(np.searchsorted(x, at, "right") - 1, 0, max(len(x) - 2, 0))
    if len(x) == 1:
        return np.full(len(at), y[0], np.float64)
    if method in ("zero", "previous"):
        return y[np.searchsorted(x, at, "right") - 1]
    if method == "next":
        return y[np.minimum(np.searchsorted(x, at, "left"), len(x) - 1)]
    if method == "nearest":
        return np.where(at - x[k] <= x[k + 1] - at, y[k], y[k + 1])
    if method in ("linear", "slinear") or len(x) < 3:
        return np.interp(at, x, y)
    if method == "quadratic":
        t, c = _quadratic_spline(x, np.asarray(y, np.float64))
        j = np.clip(np.searchsorted(t, at, "right") - 1, 2, len(x) - 1)
        w = t[j + 1] - t[j]
        a, b = (t[j + 1] - at) ** 2 / ((t[j + 1] - t[j - 1]) * w), (at - t[j]) ** 2 / ((t[j + 2] - t[j]) * w)
        return a * c[j - 2] + (1 - a - b) * c[j - 1] + b * c[j]
    m = {"monotone_cubic": _slopes_monotone, "akima": _slopes_akima, "cubic": _slopes_spline}[method](x, y)
    h = x[k + 1] - x[k]
    t = (at - x[k]) / h
    return (1 + 2 * t) * (1 - t) ** 2 * y[k] + t * (1 - t) ** 2 * h * m[k] + t**2 * (3 - 2 * t) * y[k + 1] + t**2 * (t - 1) * h * m[k + 1]


def beat_series(peaks: np.ndarray, n: int, rate: float, method: str = "monotone_cubic") -> np.ndarray:
    """Seconds between beats at every sample; NaN with fewer than two beats."""
    if len(peaks) < 2:
        return np.full(n, np.nan)
    period = np.diff(peaks) / rate
    return interpolate(peaks.astype(np.float64), np.append(period[0], period), np.arange(n, dtype=np.float64), method)


def window_half(peaks: np.ndarray) -> int:
    """Samples of a beat before and after its peak: half the median interval."""
    return max(2, int(np.median(np.diff(peaks)) / 2))


def likeness(beats: np.ndarray, mean: np.ndarray, method: str) -> np.ndarray:
    """Quality of beats (rows, each less its own mean), given the mean beat."""
    if method == "templatematch":
        scale = np.sqrt((beats**2).sum(1) * (mean**2).sum())
        return np.divide(beats @ mean, scale, out=np.zeros(len(beats)), where=scale > 0)
    return np.abs(beats - mean).sum(1) / max(np.abs(mean).sum(), 1e-12)


def beat_ends(peaks: np.ndarray, n: int) -> np.ndarray:
    """Where each beat's stretch of samples ends: midway to the next peak."""
    return np.append(peaks[:-1] + np.diff(peaks) // 2, n)


def beat_quality(x: np.ndarray, peaks: np.ndarray, method: str = "templatematch") -> np.ndarray:
    """A value per sample, held from beat to beat: correlation with the mean beat, or its mean distance."""
    if method not in QUALITY_METHODS:
        raise LunariaError(f"quality method {method}")
    out = np.full(len(x), np.nan)
    if len(peaks) < 2:
        return out
    half = window_half(peaks)
    beats = x[np.clip(peaks[:, None] + np.arange(-half, half + 1), 0, len(x) - 1)].astype(np.float64)
    beats -= beats.mean(1, keepdims=True)
    q, bound = likeness(beats, beats.mean(0), method), beat_ends(peaks, len(x))
    at = 0
    for b, v in zip(bound, q, strict=True):
        out[at:b] = v
        at = b
    return out


def process(x: np.ndarray, rate: float, peak_method: str = "elgendi", quality_method: str = "templatematch", interpolation: str = "monotone_cubic", correct: bool = False) -> dict[str, np.ndarray]:
    """Columns clean, peaks (0/1), ibi (ms), rate (per minute), quality, each as long as x."""
    x = np.asarray(x, np.float64)
    peaks = find_peaks(x, rate, peak_method)
    if correct:
        peaks = correct_intervals(peaks, rate)
    mark = np.zeros(len(x))
    mark[peaks] = 1
    period = beat_series(peaks, len(x), rate, interpolation)
    return {"clean": x, "peaks": mark, "ibi": period * 1000, "rate": 60 / period, "quality": beat_quality(x, peaks, quality_method)}
