from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lunaria.errors import AnnotationsMissing, BadConfig, ExistingOutput, LunariaError, MissingChannel, ModelUnavailable, RateMismatch, RateNotFound, UnknownName
from lunaria.plans.pipeline import Datasets
from lunaria.sinks import export, policy
from lunaria.sources import edf, nested, recordings, store, text


def write_edf(path, label="EEG L", rate=4, seconds=3, gain=0.5):
    n = rate * seconds
    raw = np.arange(n, dtype="<i2") - 3
    pad = lambda s, w: str(s).ljust(w).encode()
    head = pad("0", 8) + pad("x", 80) + pad("y", 80) + pad("01.01.20", 8) + pad("00.00.00", 8) + pad(512, 8) + pad("", 44) + pad(seconds, 8) + pad(1, 8) + pad(1, 4)
    sig = pad(label, 16) + pad("", 80) + pad("uV", 8) + pad(-100 * gain, 8) + pad(100 * gain, 8) + pad(-100, 8) + pad(100, 8) + pad("", 80) + pad(rate, 8) + pad("", 32)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(head + sig + struct.pack(f"<{n}h", *raw))
    return raw * gain


def test_edf(spark, tmp_path):
    x = write_edf(tmp_path / "s1/n1/EEG L.edf")
    write_edf(tmp_path / "s1/n1/other.edf")
    blocks = edf.read_edf(spark, str(tmp_path / "*/*/EEG L.edf"))
    r = blocks.first()
    assert (r.channel, r.unit, r.sample_rate, r.n_samples) == ("EEG L", "uV", 4.0, 12)
    assert np.allclose([v.value for v in edf.to_long(blocks).orderBy("sample_idx").collect()], x)
    assert [f.channel for f in edf.discover(spark, str(tmp_path / "*/*/*.edf")).collect()] == ["EEG L"]
    spark.dataSource.register(edf.EdfSource)
    assert spark.read.format("edf").load(str(tmp_path / "*/*/EEG L.edf")).first().samples == pytest.approx(list(x))


def test_scoring_text(spark, tmp_path):
    (tmp_path / "blank.txt").write_text("0 0\n1 1\n\n5 0\n")
    (tmp_path / "tab.txt").write_text("2\t0\r\n3\t1\r\n")
    (tmp_path / "three.txt").write_text("1 2 3\n")
    (tmp_path / "word.txt").write_text("1 x\n")
    s = text.read_scoring(spark, str(tmp_path / "blank.txt")).orderBy("epoch_idx").collect()
    assert [(r.sleep_stage, r.arousal) for r in s] == [(0, 0), (1, 1), (5, 0)]
    assert [r.code for r in text.pick_annotation(text.read_scoring(spark, str(tmp_path / "tab.txt")), text.AROUSAL).orderBy("epoch_idx").collect()] == [0, 1]
    for bad in ("three.txt", "word.txt"):
        with pytest.raises(Exception, match="expected|not a number"):
            text.read_scoring(spark, str(tmp_path / bad)).collect()
    with pytest.raises(AnnotationsMissing):
        text.pick_annotation(text.read_scoring(spark, str(tmp_path / "tab.txt")), "OTHER")


def test_runs_file(spark, tmp_path):
    (tmp_path / "a.ids").write_text("0,60,W\n60,30,N1\n")
    r = text.read_runs(spark, str(tmp_path / "a.ids")).orderBy("run_no").collect()
    assert [(x.start_s, x.duration_s, x.label) for x in r] == [(0, 60, "W"), (60, 30, "N1")]
    with pytest.raises(AnnotationsMissing):
        text.read_runs(spark, str(tmp_path / "a.ids"), text.AROUSAL)


def test_nested(spark, tmp_path):
    kind = "device string, SignalLabel array<string>, SamplingRate map<string,double>, SignalData map<string,array<double>>, SleepScores map<string,array<int>>"
    rows = [("Head", ["EEG L", "T"], {"EEG L": 4.0, "T": 1.0}, {"EEG L": [1.0, 2.0], "T": [9.0]}, None), ("PSG", [], {}, {}, {"Manual": [0, 2], "Auto": [1]})]
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / "p1"))
    n = nested.read_nested(spark, str(tmp_path / "p1"))
    assert {(r.label, r.sample_rate, r.n_samples) for r in nested.metadata(n).collect()} == {("Head-EEG_L", 4.0, 2), ("Head-T", 1.0, 1)}
    assert [(r.channel, r.value) for r in nested.signals(n, [("Head", "EEG L")]).orderBy("sample_idx").collect()] == [("Head-EEG_L", 1.0), ("Head-EEG_L", 2.0)]
    assert [r.code for r in nested.manual_scores(n).orderBy("epoch_idx").collect()] == [0, 2]
    with pytest.raises(AnnotationsMissing):
        nested.manual_scores(n, "AROUSAL")


def test_recordings(spark, tmp_path):
    for s in ("s_1", "s2"):
        write_edf(tmp_path / f"data/{s}/n1/device/EEG L.edf")
    c = recordings.DatasetConfig("d", f"file://{tmp_path}/data", "s*/n*/device", "grandparent_parent", "{subject_id} {session_id}.txt", strip_prefix="s")
    r = recordings.scoring_path(recordings.scan(spark, c), c).orderBy("recording_id").collect()
    assert [(x.recording_id, x.scoring_file) for x in r] == [("s2-n1", "2 n1.txt"), ("s_1-n1", "_1 n1.txt")]
    rules = {k: recordings.ID_RULES[k] for k in ("parent_name", "grandparent_name", "constant_name")}
    df = spark.createDataFrame([("/a/b_b/c_c/d_d",)], "p string")
    got = {k: tuple(df.select(*f(F.col("p"))).first()) for k, f in rules.items()}
    assert got == {"parent_name": ("cc", "dd"), "grandparent_name": ("b_b", "d_d"), "constant_name": ("s1", "d_d")}
    lookup = spark.createDataFrame([("n1", "f.txt")], "session_id string, scoring_file string")
    found = recordings.scoring_lookup(recordings.scan(spark, c), lookup)
    assert found.where("scoring_file = 'f.txt'").count() == 2
    kept = recordings.with_scores(found, found.where("subject_id = 's2'"))
    assert {x.recording_id: x.has_annotations for x in kept.collect()} == {"s2-n1": True, "s_1-n1": False}
    assert recordings.from_files(spark, f"file://{tmp_path}/data/s2/n1/device/*").first().recording_id == "EEG L"
    with pytest.raises(UnknownName):
        recordings.scan(spark, recordings.DatasetConfig("d", "x", id_rule="none"))


def test_dataset_configs(tmp_path):
    p = tmp_path / "d.yaml"
    p.write_text("- {name: a, data_dir: /x, mapping: {0: W}}\n- {name: b, data_dir: /y, id_rule: constant_name}\n")
    d = Datasets.load(p)
    assert [c.name for c in d.choose(["b"])] == ["b"] and d.configs["a"].mapping == {0: "W"}
    with pytest.raises(UnknownName):
        d.choose(["c"])
    p.write_text("- {name: a, folder: /x}\n")
    with pytest.raises(BadConfig):
        Datasets.load(p)


def make(spark, channel, n=8, rate=4.0, rid="a"):
    s = spark.createDataFrame([("d", rid, channel, i, float(i)) for i in range(n)], "dataset string, recording_id string, channel string, sample_idx long, value double")
    m = spark.createDataFrame([("d", rid, channel, rate, n)], "dataset string, recording_id string, channel string, sample_rate double, n_samples long")
    return s, m


def test_store(spark, tmp_path):
    root = str(tmp_path / "store")
    export.write_signals(*make(spark, "EEG_L"), root)
    with pytest.raises(ExistingOutput):
        export.write_signals(*make(spark, "EEG_L"), root)
    export.write_signals(*make(spark, "EEG_R"), root, policy.Existing.APPEND)
    assert store.read_meta(spark, root).count() == 2 and store.read_signal(spark, root, ["EEG_R"]).count() == 8
    with pytest.raises(RateMismatch):
        export.write_signals(*make(spark, "EEG_X", rate=8.0, n=16), root, policy.Existing.APPEND)
    two = make(spark, "EEG_R", n=4)
    export.write_signals(*two, root, policy.Existing.OVERWRITE)
    assert store.read_signal(spark, root).count() == 12
    wide, rate = store.load_channels(spark, root, ["EEG_L", "EEG_R"])
    assert rate == 4.0 and sorted(r.EEG_L for r in wide.collect()) == [0, 1e6, 2e6, 3e6]
    with pytest.raises(MissingChannel):
        store.load_channels(spark, root, ["EEG_L", "none"])
    a, b = make(spark, "x", n=4), make(spark, "y", n=8)
    with pytest.raises(LunariaError):
        export.write_signals(a[0].union(b[0]), a[1].union(b[1]), str(tmp_path / "other"))


def test_rates_and_versions(spark):
    m = spark.createDataFrame([("a", "x", None), ("a", "y", 2.0)], "recording_id string, channel string, sample_rate double")
    files = spark.createDataFrame([("a", 8.0)], "recording_id string, sample_rate double")
    assert {r.channel: r.sample_rate for r in store.resolve_rates(m, files).collect()} == {"x": 8.0, "y": 2.0}
    with pytest.raises(RateNotFound):
        store.resolve_rates(m)
    assert store.latest(["clf-v0.9.joblib", "clf-v0.10.joblib"]) == "clf-v0.10.joblib"
    with pytest.raises(ModelUnavailable):
        store.latest([])


def test_policies(spark, tmp_path):
    df, path = spark.createDataFrame([(1,)], "x int"), str(tmp_path / "t")
    assert policy.write(df, path)
    with pytest.raises(ExistingOutput):
        policy.write(df, path)
    assert not policy.write(df, path, policy.Existing.SKIP)
    policy.write(df, path, policy.Existing.APPEND)
    assert spark.read.parquet(path).count() == 2
    policy.write(df, path, policy.Existing.OVERWRITE)
    assert spark.read.parquet(path).count() == 1
    assert policy.Existing.APPEND.for_annotations() is policy.Existing.OVERWRITE
    e = spark.createDataFrame([("a", None), ("b", "broken file")], "recording_id string, error_message string")
    assert [r.recording_id for r in policy.handle_errors(e, policy.OnError.SKIP).collect()] == ["a"]
    with pytest.raises(Exception, match="broken file"):
        policy.handle_errors(e, policy.OnError.RAISE).collect()


def test_catalog_and_runs(spark, tmp_path):
    s, m = make(spark, "x")
    recs = spark.createDataFrame([("a",), ("b",)], "recording_id string")
    labels = spark.createDataFrame([("a", 0, "W"), ("a", 1, "W"), ("a", 2, "N1")], "recording_id string, epoch_idx long, label string")
    errors = spark.createDataFrame([("b", "no file")], "recording_id string, error_message string")
    c = export.catalog(recs, s, m, ["x"], labels, ["W", "N1", "N2"], errors)
    rows = {r.recording_id: r for r in c.collect()}
    assert (rows["a"].length, rows["a"].duration, rows["a"].x_max, rows["a"].W_count, rows["a"].N2_count, rows["a"].x, rows["a"].export_status) == (8, 2.0, 7.0, 2, 0, True, "success")
    assert (rows["b"].has_annotations, rows["b"].x, rows["b"].export_status) == (False, False, "failed")
    path = str(tmp_path / "catalog")
    export.update_catalog(c, path)
    again = export.update_catalog(c.where("recording_id = 'b'").withColumn("export_status", F.lit("success")), path)
    assert sorted((r.recording_id, r.export_status) for r in again.collect()) == [("a", "success"), ("b", "success")]
    assert text.read_catalog(spark, path).where("recording_id = 'a'").first().W_count == 2.0
    export.write_runs(labels, str(tmp_path / "runs"))
    back = spark.read.csv(str(tmp_path / "runs"), schema="start_s long, duration_s long, label string, recording_id string")
    assert sorted(tuple(r)[:3] for r in back.collect()) == [(0, 60, "W"), (60, 30, "N1")]


def test_other_sinks(spark, tmp_path):
    u = spark.createDataFrame([("a", 1, 0, 1), ("a", 0, 2, 2)], "recording_id string, period_idx long, left long, right long")
    export.write_usability(u, str(tmp_path / "u"), "EEG_L", "EEG_R")
    assert [tuple(r)[:2] for r in spark.read.csv(str(tmp_path / "u"), header=True).collect()] == [("2", "2"), ("0", "1")]
    f = spark.createDataFrame(pd.DataFrame({"set": ["x"], "dataset": ["d"], "subj": ["s"], "session": ["n"], "epoch_idx": [0], "eeg_a": [1.0], "stage": ["W"]}))
    export.write_features(f, str(tmp_path / "f"))
    assert store.read_features(spark, str(tmp_path / "f")).count() == 1
    export.write_csv(f, str(tmp_path / "c"))
    export.write_csv(f, str(tmp_path / "c"))
