"""The versioned store: whole versions, crashes in mid-write, conflicts, replaced channels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lunaria import jobs
from lunaria.errors import LunariaError, RateMismatch, StoreConflict
from lunaria.plans.pipeline import rename_only
from lunaria.sinks import transactions as t
from test_edfsource import nights

KIND = "dataset string, recording_id string, channel string, sample_idx long, value double"


def frame(spark, channels, recordings=("a", "b"), n=6, add=0.0):
    return spark.createDataFrame([("d", r, c, i, i + add) for r in recordings for c in channels for i in range(n)], KIND)


def content(df):
    return sorted((r.recording_id, r.channel, r.sample_idx, r.value) for r in df.collect())


def files(root):
    return sorted(p.name for p in root.glob("data/*/*.parquet"))


def test_versions(spark, tmp_path):
    root = f"file://{tmp_path}/s"
    with pytest.raises(LunariaError):
        t.read_signals(spark, root)
    assert t.store_signals(frame(spark, ["x", "y"]), root, {"x": 4.0, "y": 4.0}) == 1
    assert t.store_signals(frame(spark, ["y", "z"], ["b"], add=100.0), root, {"y": 4.0, "z": 4.0}) == 2
    want = [(r, c, i, i + 100.0 * (r == "b" and c != "x")) for r, cs in (("a", "xy"), ("b", "xyz")) for c in cs for i in range(6)]
    assert content(t.read_signals(spark, root)) == sorted(want)
    assert content(t.read_signals(spark, root, 1)) == content(frame(spark, ["x", "y"]))
    assert content(t.read_signals(spark, root, channels=["y"], recordings=["b"])) == [("b", "y", i, i + 100.0) for i in range(6)]
    assert t.read_signals(spark, root, channels=["none"]).collect() == [] and t.versions(root) == [1, 2]
    assert {(r.channel, r.n_samples, r.sample_rate) for r in t.read_entries(spark, root).collect()} == {(c, 6, 4.0) for c in "xyz"}
    t.store_signals(frame(spark, ["x", "y"]), root, {"x": 4.0, "y": 4.0})
    t.store_signals(frame(spark, ["z"], ["b"]), root, {"z": 4.0})
    before = content(t.read_signals(spark, root))
    assert t.vacuum(root) > 0 and content(t.read_signals(spark, root)) == before and t.versions(root)[-1] == 4


def test_a_task_that_dies_leaves_the_last_version(spark, tmp_path):
    root = f"file://{tmp_path}/s"
    t.store_signals(frame(spark, ["x"]), root, {"x": 4.0})
    held, before = content(t.read_signals(spark, root)), files(tmp_path / "s")

    def dies(batches):
        for b in batches:
            if pa.compute.any(pa.compute.equal(b.column(1), "b")).as_py():
                raise RuntimeError("killed in mid-write")
            yield b

    # the failure comes after the shuffle, when other tasks have written their files
    spark.dataSource.register(t.SignalStore)
    rows = frame(spark, ["x"], ["a", "b", "c"], add=9.0).withColumn("sample_rate", F.lit(4.0)).repartition(3, "recording_id").sortWithinPartitions("recording_id", "sample_idx").mapInArrow(dies, t.SCHEMA)
    with pytest.raises(Exception, match="mid-write"):
        rows.write.format("signal_store").option("path", root).option("base", "1").mode("append").save()
    assert t.versions(root) == [1] and content(t.read_signals(spark, root)) == held and files(tmp_path / "s") == before


def test_two_writers_conflict(spark, tmp_path):
    root = f"file://{tmp_path}/s"
    t.store_signals(frame(spark, ["x"]), root, {"x": 4.0})
    t.store_signals(frame(spark, ["y"]), root, {"y": 4.0}, base=1)
    before = files(tmp_path / "s")
    with pytest.raises(Exception, match="version 2"):  # as seen through the job that writes
        t.store_signals(frame(spark, ["z"]), root, {"z": 4.0}, base=1)
    assert files(tmp_path / "s") == before and {r.channel for r in t.read_entries(spark, root).collect()} == {"x", "y"}
    with pytest.raises(StoreConflict):  # both have passed the look at the last version
        t._Place(root).publish(pa.table({"a": [1]}), 2)


def test_what_is_checked(spark, tmp_path):
    root = f"file://{tmp_path}/s"
    t.store_signals(frame(spark, ["x"]), root, {"x": 4.0})
    with pytest.raises(Exception, match="several rates"):
        t.store_signals(frame(spark, ["y"], n=12), root, {"y": 8.0})
    with pytest.raises(Exception, match="duration"):
        t.store_signals(frame(spark, ["y"], n=5).union(frame(spark, ["z"], n=6)), root, {"y": 4.0, "z": 4.0})
    with pytest.raises(Exception, match="gaps or repeated"):
        t.store_signals(frame(spark, ["y"]).union(frame(spark, ["y"])), root, {"y": 4.0})
    assert t.versions(root) == [1]
    with pytest.raises(RateMismatch):
        t.checked([("d", "a", "x", "f", 2, 1, 4.0)], [("d", "a", "y", "f", 2, 1, 8.0)])
    assert t.store_signals(frame(spark, []), root, {"x": 4.0}) == 2 and len(content(t.read_signals(spark, root))) == 12


def test_a_job_writes_a_version(spark, tmp_path):
    config = nights(tmp_path / "data", 2)
    jobs.process(spark, config, rename_only("export", {"EEG_L": "LEFT", "EEG_R": "RIGHT"}), f"file://{tmp_path}/out", versioned=True)
    made = t.read_signals(spark, f"file://{tmp_path}/out/store", channels=["LEFT"]).where("recording_id = 's0 x-n1'").orderBy("sample_idx").collect()
    assert np.allclose([r.value for r in made], (np.arange(2560) % 60) / 2)
