"""EDF recordings as a Spark data source: files by name, headers alone, and ranges of records.

Planning lists files and their sizes and opens none. Files are cut into ranges of bytes, a task gets some
ranges, and a range stands for the data records that begin in it: a task reads a file's header and those
records, so one night is many tasks and small files share one. Filters on `stem` (the file's name, blanks
as underscores) and `path` leave files out before they are opened, filters on `channel` (the label in the
header) leave out all but the header of files without such a signal.

Files are reached through Arrow's file systems (local and mounted folders, HDFS, S3, GCS). Of other stores
`edf.read_edf` reads whole files through Spark.
"""

from __future__ import annotations

import fnmatch
import json
import os
import re
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

BLOCK_SAMPLES = 1 << 16
SIGNALS = "path string, stem string, channel string, unit string, sample_rate double, n_samples long, block_idx long, start_idx long, samples array<double>"
HEADERS = "path string, stem string, channel string, unit string, sample_rate double, n_samples long, file_bytes long"
#: Bytes of a task at most and at least, what opening a file counts as, and bytes that are decoded at once.
MOST, LEAST, OPEN, CHUNK = 128 << 20, 1 << 20, 1 << 20, 16 << 20
#: Bytes of the fixed header and of each signal's header.
HEAD = 256
#: Names that Hadoop and Arrow have for one store.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def header(data: bytes) -> tuple[int, float, list[list[str]], int]:
    """(records, seconds a record, the ten fields of all signals, bytes of the header)."""
    text = lambda a, b: data[a:b].decode("latin-1").strip()
    records, seconds, ns = int(text(236, 244)), float(text(244, 252)), int(text(252, 256))
    widths = (16, 80, 8, 8, 8, 8, 8, 80, 8, 32)
    fields, at = [], HEAD
    for w in widths:
        fields.append([text(at + i * w, at + (i + 1) * w) for i in range(ns)])
        at += w * ns
    return records, seconds, fields, at


def split_uri(uri: str) -> tuple[str, str]:
    """(scheme and authority as given, Arrow's name of the file)."""
    scheme, there, rest = uri.partition(":/")
    if not there or "/" in scheme:
        return "file:", uri
    rest = "/" + rest.lstrip("/")
    if scheme == "file":
        return "file:", rest
    host, _, path = rest[1:].partition("/")
    return (f"{scheme}://", f"{host}/{path}") if SCHEMES.get(scheme, scheme) in ("s3", "gs", "gcs") else (f"{scheme}://{host}", f"/{path}")


def file_system(prefix: str) -> pa.fs.FileSystem:
    scheme = prefix.partition(":")[0]
    if scheme == "file":
        return pa.fs.LocalFileSystem()
    name = SCHEMES.get(scheme, scheme)
    return pa.fs.FileSystem.from_uri(prefix.replace(f"{scheme}:", f"{name}:", 1) + ("bucket" if prefix.endswith("://") else "/"))[0]


def readable(uri: str) -> bool:
    """Whether Arrow has a file system for the store."""
    scheme = split_uri(uri)[0].partition(":")[0]
    return SCHEMES.get(scheme, scheme) in ("file", "hdfs", "s3", "gs", "gcs")


def braces(pattern: str) -> list[str]:
    """The patterns that alternatives in braces stand for."""
    m = re.search(r"\{([^{}]*)\}", pattern)
    return [pattern] if m is None else [p for part in m[1].split(",") for p in braces(pattern[: m.start()] + part + pattern[m.end() :])]


def expand(fs: pa.fs.FileSystem, pattern: str) -> Iterator[tuple[str, int]]:
    """(name, size) of the EDF files that match a pattern or lie in folders that do; only folders that a
    part of the pattern matches are listed."""
    parts = [p for p in pattern.split("/") if p]
    found = [("/" if pattern.startswith("/") else "", None)]
    for k, part in enumerate(parts):
        if re.search(r"[*?\[]", part):
            deeper = [(i.path, i) for base, _ in found for i in fs.get_file_info(pa.fs.FileSelector(base or ".", allow_not_found=True)) if fnmatch.fnmatchcase(os.path.basename(i.path), part)]
            found = sorted(x for x in deeper if k + 1 == len(parts) or x[1].type == pa.fs.FileType.Directory)
        else:
            found = [(f"{base.rstrip('/')}/{part}" if base else part, None) for base, _ in found]
    for path, info in found:
        info = info or fs.get_file_info(path)
        if info.type == pa.fs.FileType.Directory:
            for i in fs.get_file_info(pa.fs.FileSelector(path)):
                if i.type == pa.fs.FileType.File and i.path.lower().endswith(".edf"):
                    yield i.path, i.size
        elif info.type == pa.fs.FileType.File:
            yield path, info.size


def stem_of(path: str) -> str:
    return os.path.splitext(os.path.basename(path))[0].replace(" ", "_")


def ranges(files: Sequence[tuple[str, int]], parallelism: int, most: int = MOST) -> list[list[tuple[str, int, int, int]]]:
    """Tasks of (name, size, first byte, byte after the last): as large as an even deal among `parallelism`
    tasks asks for, within bounds; small files share a task."""
    total = sum(size + OPEN for _, size in files)
    each = min(most, max(LEAST, -(-total // max(parallelism, 1))))
    tasks, room = [[]], each
    for path, size in files:
        for at in range(0, max(size, 1), each):
            n = min(each, size - at)
            if tasks[-1] and n + OPEN > room:
                tasks.append([])
                room = each
            tasks[-1].append((path, size, at, at + n))
            room -= n + OPEN
    return [t for t in tasks if t]


class _Task(InputPartition):
    def __init__(self, pieces: list[tuple[str, int, int, int]]):
        super().__init__(pieces)


class EdfReader(DataSourceReader):
    """Options: path (a pattern, or a JSON list of them), stems and channels (JSON lists; all if absent),
    parallelism, splitBytes, headers (true: a row a signal, from headers alone), audit (a folder for one
    JSON line for every file that is opened: name, bytes read)."""

    def __init__(self, options):
        get = options.get
        path = get("path") or get("paths")
        self.paths = json.loads(path) if path.startswith("[") else [path]
        self.stems, self.channels = (None if get(k) is None else set(json.loads(get(k))) for k in ("stems", "channels"))
        self.names: set[str] | None = None
        self.parallelism, self.most = int(get("parallelism") or 1), int(get("splitBytes") or MOST)
        self.headers, self.audit = get("headers") == "true", get("audit")

    def partitions(self) -> list[_Task]:
        found: dict[str, int] = {}
        for uri in self.paths:
            prefix, whole = split_uri(uri)
            for pattern in braces(whole):
                found |= {prefix + path: size for path, size in expand(file_system(prefix), pattern) if self.stems is None or stem_of(path) in self.stems}
        files = [f for f in found.items() if self.names is None or f[0] in self.names]
        if self.headers:
            each = max(1, min(512, -(-len(files) // self.parallelism)))
            return [_Task([(p, n, 0, n) for p, n in files[k : k + each]]) for k in range(0, len(files), each)] or [_Task([])]
        return [_Task(t) for t in ranges(files, self.parallelism, self.most)] or [_Task([])]

    def read(self, partition: _Task) -> Iterator[pa.RecordBatch]:
        systems: dict[str, pa.fs.FileSystem] = {}
        for uri, size, lo, hi in partition.value:
            prefix, path = split_uri(uri)
            if prefix not in systems:
                systems[prefix] = file_system(prefix)
            with systems[prefix].open_input_file(path) as f:
                source = _Counted(f)
                yield from self._rows(source, uri, stem_of(path), size, lo, hi)
            if self.audit:
                with open(f"{self.audit}/{uuid.uuid4().hex}", "w") as out:
                    out.write(json.dumps({"path": uri, "bytes": source.bytes}))

    def _rows(self, f: _Counted, uri: str, stem: str, size: int, lo: int, hi: int) -> Iterator[pa.RecordBatch]:
        fixed = f.read(0, HEAD)
        records, seconds, fields, at = header(fixed + f.read(HEAD, HEAD * int(fixed[252:256])))
        label, unit, count = fields[0], fields[2], [int(x) for x in fields[8]]
        low, high, dlow, dhigh = ([float(x) for x in fields[k]] for k in (3, 4, 5, 6))
        own = [i for i, name in enumerate(label) if not name.endswith("Annotations") and (self.channels is None or name in self.channels)]
        width = sum(count)
        whole = (size - at) // (2 * width) if width else 0
        records = whole if records < 0 else min(records, whole)  # unknown, or cut off, while recording
        if self.headers:
            columns = [[uri] * len(own), [stem] * len(own), [label[i] for i in own], [unit[i] for i in own], [count[i] / seconds for i in own], [count[i] * records for i in own], [size] * len(own)]
            kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _names(HEADERS))
            return
        if not own or not width:
            return
        first, last = (min(max(-((at - x) // (2 * width)), 0), records) for x in (lo, hi))
        place = np.concatenate([[0], np.cumsum(count)])
        step = max(1, CHUNK // (2 * width))
        for r in range(first, last, step):
            n = min(step, last - r)
            body = np.frombuffer(f.read(at + 2 * width * r, 2 * width * n), "<i2").reshape(n, width)
            for i in own:
                gain = (high[i] - low[i]) / (dhigh[i] - dlow[i])
                x = (body[:, place[i] : place[i + 1]].astype(np.float64).ravel() - dlow[i]) * gain + low[i]
                yield from _blocks(x, r * count[i], uri, stem, label[i], unit[i], count[i] / seconds, count[i] * records)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _blocks(x: np.ndarray, start: int, uri: str, stem: str, label: str, unit: str, rate: float, total: int) -> Iterator[pa.RecordBatch]:
    """Samples from `start` on as rows, cut where block numbers change."""
    cuts = [0, *range(BLOCK_SAMPLES - start % BLOCK_SAMPLES, len(x), BLOCK_SAMPLES), len(x)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b:
            row = (pa.array([uri]), pa.array([stem]), pa.array([label]), pa.array([unit]), pa.array([float(rate)]), *(pa.array([v], pa.int64()) for v in (total, (start + a) // BLOCK_SAMPLES, start + a)), pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), pa.array(x[a:b])))
            yield pa.RecordBatch.from_arrays(list(row), _names(SIGNALS))


class _Counted:
    def __init__(self, f: pa.NativeFile):
        self.f, self.bytes = f, 0

    def read(self, at: int, n: int) -> bytes:
        data = self.f.read_at(n, at)
        self.bytes += len(data)
        return data


class EdfSource(DataSource):
    """spark.read.format('edf').load(pattern), after `register`; options as in EdfReader."""

    @classmethod
    def name(cls) -> str:
        return "edf"

    def schema(self) -> str:
        return HEADERS if self.options.get("headers") == "true" else SIGNALS

    def reader(self, schema) -> DataSourceReader:
        return EdfReader(self.options)


class _Pushing(EdfReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            column = f.attribute if values is not None else ()
            if column == ("stem",):
                self.stems = values if self.stems is None else self.stems & values
            elif column == ("channel",):
                self.channels = values if self.channels is None else self.channels & values
            elif column == ("path",):
                self.names = values if self.names is None else self.names & values
            else:
                yield f


class PushedEdfSource(EdfSource):
    """EdfSource that takes the query's own filters on stem, channel and path."""

    @classmethod
    def name(cls) -> str:
        return "edf_pushed"

    def reader(self, schema) -> DataSourceReader:
        return _Pushing(self.options)


def register(spark: SparkSession) -> None:
    """Makes the formats 'edf' and 'edf_pushed' known and lets Spark push filters into the latter."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(EdfSource)
    spark.dataSource.register(PushedEdfSource)


#: A folder in which readers note the files they open (tests).
AUDIT: str | None = None


def _read(spark: SparkSession, paths: str | Sequence[str], stems: Sequence[str] | None, headers: bool, split: int | None) -> DataFrame:
    spark.dataSource.register(EdfSource)
    reader = spark.read.format("edf").option("paths", json.dumps([paths] if isinstance(paths, str) else list(paths)))
    given = {"stems": None if stems is None else json.dumps(sorted(stems)), "headers": "true" if headers else None, "splitBytes": split, "audit": AUDIT}
    for k, v in given.items():
        if v is not None:
            reader = reader.option(k, v)
    return reader.option("parallelism", 2 * spark.sparkContext.defaultParallelism).load()


def read_signals(spark: SparkSession, paths: str | Sequence[str], stems: Sequence[str] | None = None, split: int | None = None) -> DataFrame:
    """Blocks (SIGNALS) of the files that match and, if stems are given, bear one of these names. A block at
    the edge of a range is two rows with the same block_idx. No other file is opened."""
    return _read(spark, paths, stems, False, split)


def read_headers(spark: SparkSession, paths: str | Sequence[str], stems: Sequence[str] | None = None) -> DataFrame:
    """A row (HEADERS) for each ordinary signal of the files: rates and lengths, from headers alone."""
    return _read(spark, paths, stems, True, None)
