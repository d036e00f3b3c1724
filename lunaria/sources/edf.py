"""European Data Format through Spark's binary files, for any store that Spark reads: one file is read whole
by one task. `edfsource` reads headers and ranges of records alone, where Arrow has a file system."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import HEADBAND_CHANNELS
from .edfsource import BLOCK_SAMPLES, HEAD, EdfSource, header

__all__ = ["EdfSource", "discover", "files", "header", "parse", "read_edf", "read_rates", "to_long"]

SCHEMA = "path string, channel string, unit string, sample_rate double, n_samples long, block_idx long, start_idx long, samples array<double>"


def parse(data: bytes) -> list[tuple[str, str, float, np.ndarray]]:
    """(label, unit, rate, samples in physical units) of each ordinary signal; annotation signals are skipped."""
    records, seconds, fields, at = header(data)
    label, unit, count = fields[0], fields[2], [int(x) for x in fields[8]]
    low, high, dlow, dhigh = ([float(x) for x in fields[k]] for k in (3, 4, 5, 6))
    body = np.frombuffer(data, "<i2", offset=at)
    per = sum(count)
    if records < 0:  # unknown in a file that was cut off while recording
        records = len(body) // per
    body = body[: records * per].reshape(-1, per)
    out, first = [], 0
    for i, n in enumerate(count):
        if not label[i].endswith("Annotations"):
            gain = (high[i] - low[i]) / (dhigh[i] - dlow[i])
            x = body[:, first : first + n].astype(np.float64).ravel()
            out.append((label[i], unit[i], n / seconds, (x - dlow[i]) * gain + low[i]))
        first += n
    return out


def rows(path: str, data: bytes, block: int = BLOCK_SAMPLES) -> Iterator[tuple]:
    for channel, unit, rate, x in parse(data):
        for k in range(-(-len(x) // block)):
            yield path, channel, unit, rate, len(x), k, k * block, x[k * block : (k + 1) * block]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            for r in rows(batch.column(0)[i].as_py(), batch.column(1)[i].as_py()):
                kinds = (pa.string(), pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(r, kinds, strict=True)], names)


def files(spark: SparkSession, paths: str | list[str], channels: Sequence[str] | None) -> DataFrame:
    """Files by path. Those of other channels (by file name, a blank or an underscore alike) are left out
    when folders are listed, so they are never opened."""
    reader = spark.read.format("binaryFile")
    if channels is not None:
        names = ",".join(sorted({c.replace(" ", "?").replace("_", "?") for c in channels}))
        reader = reader.option("pathGlobFilter", f"{{{names}}}.[eE][dD][fF]")
    return reader.load(paths)


def read_edf(spark: SparkSession, paths: str | list[str], channels: Sequence[str] | None = None) -> DataFrame:
    """Blocks of all EDF files that match, through any file system that Spark reads; with channels, of the
    files that bear their names alone."""
    return files(spark, paths, channels).select("path", "content").mapInArrow(_batches, SCHEMA)


def read_rates(spark: SparkSession, paths: str | list[str], channels: Sequence[str] | None = None) -> DataFrame:
    """(path, sample_rate) of the ordinary signals of each file, from headers: no sample leaves the scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, rate = [], []
            for i in range(batch.num_rows):
                _, seconds, fields, _ = header(batch.column(1)[i].as_py())
                own = {int(n) / seconds for name, n in zip(fields[0], fields[8], strict=True) if not name.endswith("Annotations")}
                path += [batch.column(0)[i].as_py()] * len(own)
                rate += own
            yield pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(rate, pa.float64())], ["path", "sample_rate"])

    size = F.expr(f"{HEAD} * (1 + cast(trim(cast(substring(content, 253, 4) as string)) as int))")  # as the fixed header says
    heads = files(spark, paths, channels).select("path", F.substring("content", F.lit(1), size).alias("head"))
    return heads.mapInArrow(run, "path string, sample_rate double")


def discover(spark: SparkSession, glob: str, channels: Sequence[str] = tuple(HEADBAND_CHANNELS)) -> DataFrame:
    """(path, channel) of files whose name is a known channel; others are ignored. Contents are not read."""
    stem = F.regexp_extract("path", r"([^/]+)\.[eE][dD][fF]$", 1)
    files = spark.read.format("binaryFile").load(glob).select("path", F.replace(stem, F.lit("%20"), F.lit(" ")).alias("channel"))
    return files.where(F.col("channel").isin(*channels))


def to_long(blocks: DataFrame, key: Sequence[str] = ("path",)) -> DataFrame:
    """(key, channel, sample_idx, value) of blocks."""
    return blocks.select(*key, "channel", "start_idx", F.posexplode("samples").alias("k", "value")).select(*key, "channel", (F.col("start_idx") + F.col("k")).alias("sample_idx"), "value")
