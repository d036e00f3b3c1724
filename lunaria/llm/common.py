"""What the operators of this subpackage share: tables, lineage cuts and byte-level text kernels.

Text kernels read Arrow string buffers as numpy byte arrays, so a batch is tokenised and hashed
without a Python object per document or word.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MASK32 = 2.0**32
#: Bytes of text that a kernel handles at once (a longer document is still handled whole).
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_OWN: dict[str, str] = {}
#: Paths that `cut` has written and nobody has removed.
_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or, where that is unset and all runs in one
    process (tests), a local one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="lunaria-")
    return _OWN[app]


def own_dir(spark: SparkSession) -> str:
    """The part of the shared folder that this application writes to."""
    return f"{shared_dir(spark).rstrip('/')}/lunaria-{spark.sparkContext.applicationId}"


def cut(df: DataFrame, tag: str = "t", codec: str | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back: later stages survive lost executors and
    nothing above is computed twice."""
    return cut_at(df, tag, codec)[0]


def cut_at(df: DataFrame, tag: str = "t", codec: str | None = None) -> tuple[DataFrame, str]:
    """cut, with the path for `discard`; by a codec, if given, that is not the session's."""
    spark = df.sparkSession
    path = f"{own_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Removes one table that `cut_at` has written, when nothing reads it any more."""
    remove(spark, path)
    if path in _WRITTEN:
        _WRITTEN.remove(path)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def clear(spark: SparkSession) -> None:
    """Removes all that `cut` has written for this application. Results that are not stored yet read
    from it, so call it when the job is done."""
    remove(spark, own_dir(spark))
    _WRITTEN.clear()


@contextlib.contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Removes what `cut` writes within the block at its end, when the block's own results are stored."""
    before = len(_WRITTEN)
    try:
        yield
    finally:
        for path in _WRITTEN[before:]:
            remove(spark, path)
        del _WRITTEN[before:]


def fresh(df: DataFrame, name: str) -> str:
    """name, with underscores before it until df has no such column."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id as text leaves 0 modulo 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def bounded_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """About `most` rows of df, chosen by a hash of key: the documented bound for fitting classifiers.
    Below the bound every row stays."""
    n = df.count()
    if n <= most:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit("fit"), F.col(key)), F.lit(1 << 30)) < int(most / n * (1 << 30)))


# ---------------------------------------------------------------- numpy text kernels

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (murmur style) over an uint64 array."""
    x = x + _U((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(256, dtype=np.uint64), 7)
_STEP = _U(0xD6E8FEB86659FD93)
_POWERS = np.ones(64, np.uint64)


def powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        p = np.full(n, _STEP, np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    elif _POWERS[1] == 1:
        p = np.full(len(_POWERS), _STEP, np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Splits a string column into (first row, row after the last, UTF-8 bytes, offsets). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    large = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if large else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        end = min(end, n)
        yield at, end, raw[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


class Words:
    """Words ([^\\x20\\x09-\\x0D]+) of a chunk of documents: byte starts and lengths, 64-bit hashes of
    their bytes (A-Z folded to a-z if asked), and the first word of each document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, fold: bool = True):
        solid = ~_SPACE[data]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        inner = offsets[:-1][(offsets[:-1] < offsets[1:])]
        first[inner] = solid[inner]
        self.starts = np.flatnonzero(first)
        self.doc_first = np.searchsorted(self.starts, offsets)
        chars = data[solid]
        if fold:
            chars = _FOLD[chars]
        at = np.cumsum(solid)[self.starts] - 1 if len(self.starts) else np.zeros(0, np.int64)
        self.lengths = np.diff(np.append(at, len(chars)))
        if len(at):
            within = np.arange(len(chars)) - np.repeat(at, self.lengths)
            p = powers(int(self.lengths.max()) + 1)
            self.hashes = mix(np.add.reduceat(_BYTE[chars] * p[within], at) + self.lengths.astype(np.uint64))
        else:
            self.hashes = np.zeros(0, np.uint64)


_GRAM = mix(np.arange(64, dtype=np.uint64), 11) | _U(1)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-word windows; none if there are fewer words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    k = len(hashes) - n + 1
    out = np.zeros(k, np.uint64)
    for i in range(n):
        out += hashes[i : i + k] * _GRAM[i]
    return mix(out, n)


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-word shingles; with fewer words the whole sequence as one; none without words."""
    if not len(hashes):
        return hashes
    s = np.sort(grams(hashes, min(n, len(hashes))))  # np.unique takes five times as long
    return s[np.append(True, s[1:] != s[:-1])]
