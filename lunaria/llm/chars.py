"""Code points of UTF-8 chunks as numpy arrays."""

from __future__ import annotations

import functools

import numpy as np

from .common import mix, powers

_U = np.uint64

#: Lower-cased letters below 65,536 map to themselves; everything else to 0.
OTHER = 0


@functools.cache
def letter_table() -> np.ndarray:
    """For each code point of the basic plane its lower-case letter, or 0 if it is no letter."""
    out = np.zeros(65536, np.uint16)
    for c in range(65536):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 and ord(low) < 65536 else c
    return out


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets of the documents in them); beyond the basic plane 0xFFFD stands in."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    b = data[at].astype(np.uint32)
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    cp = b
    many = np.flatnonzero(b >= 0xC0)
    if len(many):
        m, i = b[many], at[many]
        n1, n2 = (padded[i + k].astype(np.uint32) & 0x3F for k in (1, 2))
        cp[many] = np.where(m < 0xE0, ((m & 0x1F) << 6) | n1, np.where(m < 0xF0, ((m & 0x0F) << 12) | (n1 << 6) | n2, 0xFFFD))
    count = np.concatenate([[0], np.cumsum(lead)])
    return cp.astype(np.uint16), count[offsets]


@functools.cache
def alnum_table() -> np.ndarray:
    """The letter table with decimal digits standing for themselves."""
    out = letter_table().copy()
    for c in range(65536):
        if not out[c] and chr(c).isdecimal():
            out[c] = c
    return out


def alnum_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the maximal runs of letters and digits in lower case, first word of each document)."""
    cp, at = code_points(data, offsets)
    low = alnum_table()[cp]
    solid = low > 0
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = at[:-1][at[:-1] < at[1:]]
    first[inner] = solid[inner]
    starts = np.flatnonzero(first)
    of_doc = np.searchsorted(starts, at)
    if not len(starts):
        return np.zeros(0, np.uint64), of_doc
    chars = low[solid].astype(np.uint64)
    begin = np.cumsum(solid)[starts] - 1
    lengths = np.diff(np.append(begin, len(chars)))
    within = np.arange(len(chars)) - np.repeat(begin, lengths)
    value = (chars + _U(0x9E37)) * _U(0xBF58476D1CE4E5B9)
    value ^= value >> _U(29)
    return mix(np.add.reduceat(value * powers(int(lengths.max()) + 1)[within], begin) + lengths.astype(np.uint64)), of_doc
