"""Polyphase resampling by a rational factor. numpy only."""

from __future__ import annotations

from math import gcd

import numpy as np

from ..errors import LunariaError


def factors(source: float, target: float) -> tuple[int, int]:
    """(up, down) in lowest terms; rates count in whole thousandths of a hertz."""
    a, b = int(source * 1000), int(target * 1000)
    if a < 1 or b < 1:
        raise LunariaError(f"rates {source} and {target} Hz: at least 0.001 Hz each")
    g = gcd(a, b)
    return b // g, a // g


def kernel(up: int, down: int) -> np.ndarray:
    """Kaiser (5.0) low-pass of 20 max(up, down) + 1 taps at the lower Nyquist rate, gain up."""
    most = max(up, down)
    n = np.arange(20 * most + 1) - 10 * most
    h = np.sinc(n / most) / most * np.kaiser(20 * most + 1, 5.0)
    return h / h.sum() * up


def resampled(x: np.ndarray, up: int, down: int) -> np.ndarray:
    """ceil(n up / down) samples; beyond its ends the signal counts as zero."""
    x = np.asarray(x, np.float64)
    if up == down or not len(x):
        return x
    h, n = kernel(up, down), -(-len(x) * up // down)
    half = len(h) // 2
    place = np.arange(n) * down + half  # in the upsampled grid, filter centred
    phase, last = place % up, place // up
    width = -(-len(h) // up)
    bank = np.zeros((up, width))
    for p in range(up):
        own = h[p::up]
        bank[p, : len(own)] = own
    padded = np.concatenate([np.zeros(width), x, np.zeros(width + half // up + 1)])
    out = np.empty(n)
    for at in range(0, n, 1 << 16):
        s = slice(at, at + (1 << 16))
        index = last[s][:, None] - np.arange(width)[None, :] + width
        out[s] = (padded[np.clip(index, 0, len(padded) - 1)] * bank[phase[s]]).sum(1)
    return out
