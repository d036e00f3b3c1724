"""A versioned store of signals: writes that happen as a whole or not at all.

<root>/data/<transaction>/*.parquet holds samples, a file a task, sorted by recording, channel and index.
<root>/manifest/<version>.parquet has a row for each (dataset, recording, channel) that is live in a version
and says in which file it lies. Tasks only write new files and report what is in them; the commit, on the
driver, checks rates and durations over these reports (a row a channel and task, no samples) and publishes the
next manifest, which must not exist yet. A task or driver that dies in between leaves the last version as it
was; a writer that began from an older version than the last one gets an error and its files are removed.
Nothing that a version names is ever deleted but by `vacuum`.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..errors import LunariaError, RateMismatch, StoreConflict
from ..sources.edfsource import file_system, split_uri

SCHEMA = "dataset string, recording_id string, channel string, sample_idx long, value double, sample_rate double"
KEYS = ["dataset", "recording_id", "channel"]
ENTRY = pa.schema([(k, pa.string()) for k in KEYS] + [("file", pa.string()), ("n_samples", pa.int64()), ("last_idx", pa.int64()), ("sample_rate", pa.float64())])
_COLUMNS = [*KEYS, "sample_idx", "value", "sample_rate"]


class _Place:
    """The store's folder in its file system."""

    def __init__(self, root: str):
        self.prefix, self.path = split_uri(root.rstrip("/"))
        self.fs = file_system(self.prefix)

    def names(self, folder: str) -> list[str]:
        return sorted(i.path for i in self.fs.get_file_info(pa.fs.FileSelector(f"{self.path}/{folder}", allow_not_found=True)))

    def last(self) -> int:
        """The last version; 0 for an empty store."""
        found = [int(m[1]) for p in self.names("manifest") if (m := re.search(r"/(\d{8})\.parquet$", p))]
        return max(found, default=0)

    def manifest(self, version: int) -> str:
        return f"{self.path}/manifest/{version:08d}.parquet"

    def publish(self, table: pa.Table, version: int) -> None:
        """Makes a manifest appear whole, under a name that nothing has yet. On local and mounted folders that is
        one step (a link); elsewhere the name is looked up right before the file is moved there."""
        self.fs.create_dir(f"{self.path}/manifest")
        draft, final = f"{self.path}/manifest/.{uuid.uuid4().hex}", self.manifest(version)
        pq.write_table(table, draft, filesystem=self.fs)
        try:
            if isinstance(self.fs, pa.fs.LocalFileSystem):
                try:
                    os.link(draft, final)
                except FileExistsError as e:
                    raise StoreConflict(f"version {version} of {self.path} was written by another job") from e
            elif self.fs.get_file_info(final).type != pa.fs.FileType.NotFound:
                raise StoreConflict(f"version {version} of {self.path} was written by another job")
            else:
                self.fs.copy_file(draft, final)
        finally:
            self.fs.delete_file(draft)


@dataclass
class _Told(WriterCommitMessage):
    file: str | None
    entries: list[tuple]


class _Writer(DataSourceArrowWriter):
    def __init__(self, root: str, base: int, transaction: str):
        self.root, self.base, self.transaction = root, base, transaction

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Told:
        place, out, counts = _Place(self.root), None, {}
        file = f"data/{self.transaction}/{uuid.uuid4().hex}.parquet"
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                place.fs.create_dir(f"{place.path}/data/{self.transaction}")
                out = pq.ParquetWriter(f"{place.path}/{file}", batch.schema, filesystem=place.fs)
            out.write_batch(batch)
            t = pa.Table.from_batches([batch]).group_by([*KEYS, "sample_rate"]).aggregate([("sample_idx", "count"), ("sample_idx", "max")])
            for r in t.to_pylist():
                k = (*(r[c] for c in KEYS), r["sample_rate"])
                n, last = counts.get(k, (0, -1))
                counts[k] = n + r["sample_idx_count"], max(last, r["sample_idx_max"])
        if out is not None:
            out.close()
        return _Told(None if out is None else file, [(*k[:3], file, n, last, k[3]) for k, (n, last) in counts.items()])

    def commit(self, messages: list[_Told | None]) -> None:
        place = _Place(self.root)
        if place.last() != self.base:
            raise StoreConflict(f"{self.root} is at version {place.last()}, not at {self.base} any more")
        new = [e for m in messages if m is not None for e in m.entries]
        own = {e[:3] for e in new}
        old = [e for e in entries(self.root, self.base) if e[:3] not in own] if self.base else []
        checked(new, old)
        place.publish(pa.table([pa.array(c, f.type) for c, f in zip(zip(*[*old, *new], strict=True), ENTRY, strict=True)] if old or new else [pa.array([], f.type) for f in ENTRY], schema=ENTRY), self.base + 1)

    def abort(self, messages: list[_Told | None]) -> None:
        place = _Place(self.root)
        if place.fs.get_file_info(f"{place.path}/data/{self.transaction}").type == pa.fs.FileType.Directory:
            place.fs.delete_dir(f"{place.path}/data/{self.transaction}")


class SignalStore(DataSource):
    """df.write.format('signal_store') with the options path and, optionally, base: the version that the
    writer has seen, which must still be the last one when it commits."""

    @classmethod
    def name(cls) -> str:
        return "signal_store"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> _Writer:
        root = self.options["path"]
        return _Writer(root, int(self.options.get("base") or _Place(root).last()), uuid.uuid4().hex)


def entries(root: str, version: int) -> list[tuple]:
    """The manifest's rows: one a channel."""
    place = _Place(root)
    return [tuple(r.values()) for r in pq.read_table(place.manifest(version), filesystem=place.fs).to_pylist()]


def checked(new: Sequence[tuple], old: Sequence[tuple]) -> None:
    """Channels of one recording have one rate, stored ones included, and those written together last equally
    long; a channel has each sample once, from 0 on."""
    rates: dict[tuple, set[float]] = {}
    lengths: dict[tuple, int] = {}
    for e in new:
        if e[4] != e[5] + 1 or e[:3] in lengths:
            raise LunariaError(f"{e[1]}: {e[2]} has gaps or repeated samples, or lies in two tasks")
        lengths[e[:3]] = e[4]
        rates.setdefault(e[:2], set()).add(e[6])
    spans: dict[tuple, set[float]] = {}
    for e in new:
        spans.setdefault(e[:2], set()).add(e[4] / e[6])
    for e in old:
        if e[:2] in rates:
            rates[e[:2]].add(e[6])
    if odd := [k for k, r in rates.items() if len(r) > 1]:
        raise RateMismatch(f"{odd[0][1]} is stored at several rates")
    if odd := [k for k, s in spans.items() if len(s) > 1]:
        raise LunariaError(f"channels of {odd[0][1]} differ in duration")


def store_signals(signal: DataFrame, root: str, rates: Mapping[str, float] | None = None, base: int | None = None) -> int:
    """Writes signal(dataset, recording_id, channel, sample_idx, value and, unless rates gives it by channel,
    sample_rate) as the store's next version, which it returns. Channels replace those of their name and leave
    others alone. base is the version that the caller has read (default: the last one now)."""
    spark = signal.sparkSession
    seen = _Place(root).last() if base is None else base
    if rates is not None:
        signal = signal.withColumn("sample_rate", F.element_at(F.create_map(*[F.lit(x) for c, r in rates.items() for x in (c, float(r))]), F.col("channel")))
    spark.dataSource.register(SignalStore)
    rows = signal.select(*[F.col(c).cast("string") for c in KEYS], F.col("sample_idx").cast("long"), F.col("value").cast("double"), F.col("sample_rate").cast("double"))
    rows.repartition(*KEYS).sortWithinPartitions(*KEYS, "sample_idx").write.format("signal_store").option("path", root).option("base", str(seen)).mode("append").save()
    return seen + 1


def versions(root: str) -> list[int]:
    return list(range(1, _Place(root).last() + 1))


def read_entries(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(dataset, recording_id, channel, file, n_samples, last_idx, sample_rate) of a version (default: the last
    one), read by Spark."""
    place = _Place(root)
    return spark.read.parquet(place.prefix + place.manifest(_known(place, version)))


def _known(place: _Place, version: int | None) -> int:
    last = place.last()
    if not last or (version is not None and not 1 <= version <= last):
        raise LunariaError(f"{place.path} has no version {version or ''}".rstrip())
    return version or last


def read_signals(spark: SparkSession, root: str, version: int | None = None, channels: Sequence[str] | None = None, recordings: Sequence[str] | None = None) -> DataFrame:
    """The samples (SCHEMA) of a version. Files without a wanted channel or recording are not opened; what a
    later version has replaced in a file is left out by a join with the manifest."""
    live = read_entries(spark, root, version)
    for column, wanted in (("channel", channels), ("recording_id", recordings)):
        if wanted is not None:
            live = live.where(F.col(column).isin(*wanted))
    files = [r.file for r in live.select("file").distinct().collect()]  # a row a file
    if not files:
        return spark.createDataFrame([], SCHEMA)
    place = _Place(root)
    rows = spark.read.parquet(*[f"{place.prefix}{place.path}/{f}" for f in files])
    for column, wanted in (("channel", channels), ("recording_id", recordings)):
        if wanted is not None:
            rows = rows.where(F.col(column).isin(*wanted))
    named = rows.withColumn("__file", F.element_at(F.split("_metadata.file_path", "/"), -1))
    own = live.select(*[F.col(k).alias(f"__{k}") for k in KEYS], F.element_at(F.split("file", "/"), -1).alias("__of"))
    same = (F.col("__file") == F.col("__of")) & (F.col("dataset") == F.col("__dataset")) & (F.col("recording_id") == F.col("__recording_id")) & (F.col("channel") == F.col("__channel"))
    return named.join(own, same, "left_semi").select(*_COLUMNS)


def vacuum(root: str, keep: int = 1) -> int:
    """Deletes the manifests before the last `keep` versions and the files that no kept version names, and gives
    the number of files. Not to be run while a job writes to the store or reads an older version."""
    place, dropped = _Place(root), 0
    last = place.last()
    kept = range(max(1, last - keep + 1), last + 1)
    named = {e[3] for v in kept for e in entries(root, v)}
    for p in place.names("manifest"):
        if (m := re.search(r"/(\d{8})\.parquet$", p)) and int(m[1]) not in kept:
            place.fs.delete_file(p)
    for transaction in place.names("data"):
        for p in place.names(transaction.removeprefix(f"{place.path}/")):
            if p.removeprefix(f"{place.path}/") not in named:
                place.fs.delete_file(p)
                dropped += 1
    return dropped
