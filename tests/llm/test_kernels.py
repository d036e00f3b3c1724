from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lunaria.llm import chars, common

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["", None, " ", "a", "A b\tC\n", "é x é X", " lead", "trail ", "one word", "x" * 300, "a\x0bb\x0cc\x1dd", "日本 語 𝔘 z"]


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_words_are_those_of_the_pattern(most):
    seen = {}
    for lo, hi, data, offsets in common.text_chunks(pa.array(TEXTS, pa.string()), most):
        w = common.Words(data, offsets)
        for i in range(lo, hi):
            own = w.hashes[w.doc_first[i - lo] : w.doc_first[i - lo + 1]]
            want = WORD.findall(fold(TEXTS[i] or ""))
            assert len(own) == len(want)
            for h, x in zip(own.tolist(), want, strict=True):
                assert seen.setdefault(x, h) == h
    assert len(set(seen.values())) == len(seen)


def test_chunks_of_a_slice_and_of_nothing():
    column = pa.array(["ab", "cd", None, "ef"], pa.string()).slice(1, 3)
    got = [bytes(d[a:b]).decode() for _, _, d, o in common.text_chunks(column, 1) for a, b in zip(o[:-1], o[1:], strict=True)]
    assert got == ["cd", "", "ef"]
    assert list(common.text_chunks(pa.array([], pa.string()))) == []
    assert [h for _, h, _, _ in common.text_chunks(pa.array([None, None], pa.string()))] == [2]


def test_shingles():
    w = np.arange(6, dtype=np.uint64)
    assert len(common.shingle_set(w, 4)) == 3 and len(common.shingle_set(w[:2], 4)) == 1 and len(common.shingle_set(w[:0], 4)) == 0
    assert len(common.shingle_set(np.zeros(9, np.uint64), 4)) == 1
    assert common.shingle_set(w[:3], 4) == common.shingle_set(w[:3], 5)


def test_code_points():
    rng = random.Random(1)
    texts = ["".join(chr(rng.choice([65, 0xE9, 0x20AC, 0x1D518, 32])) for _ in range(20)) for _ in range(5)] + [""]
    for _, _, data, offsets in common.text_chunks(pa.array(texts)):
        cp, at = chars.code_points(data, offsets)
        for i, t in enumerate(texts):
            assert cp[at[i] : at[i + 1]].tolist() == [min(ord(c), 0xFFFD) if ord(c) > 0xFFFF else ord(c) for c in t]


def test_alnum_words():
    texts = ["Ab-c É1 é1", "ab C", ""]
    (_, _, data, offsets) = next(common.text_chunks(pa.array(texts)))
    h, first = chars.alnum_words(data, offsets)
    assert np.diff(first).tolist() == [4, 2, 0]
    assert h[2] == h[3] and h[0] == h[4] and h[1] == h[5]


def test_cut_and_clear(spark):
    df = common.cut(spark.range(5))
    assert df.count() == 5 and common.own_dir(spark).startswith(common.shared_dir(spark).rstrip("/"))
    common.clear(spark)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|PATH_NOT_FOUND"):
        df.count()
