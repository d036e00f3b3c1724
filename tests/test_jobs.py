from __future__ import annotations

import struct

import numpy as np
import pytest

from lunaria import cli, jobs
from lunaria.errors import AnnotationsMissing, DurationMismatch, ExistingOutput, HypnogramMismatch, LunariaError, MissingChannel
from lunaria.plans.pipeline import bundled
from lunaria.operators import models
from lunaria.sinks.policy import Existing, OnError
from lunaria.sources import edf
from lunaria.sources.recordings import DatasetConfig


def put(path, x, rate):
    pad = lambda s, w: str(s).ljust(w).encode()
    seconds = len(x) // rate
    raw = np.round(np.asarray(x) * 1000).astype("<i2")[: seconds * rate]
    head = pad("0", 8) + pad("x", 80) + pad("y", 80) + pad("01.01.20", 8) + pad("00.00.00", 8) + pad(512, 8) + pad("", 44) + pad(seconds, 8) + pad(1, 8) + pad(1, 4)
    sig = pad(path.stem, 16) + pad("", 80) + pad("V", 8) + pad(-32.768, 8) + pad(32.767, 8) + pad(-32768, 8) + pad(32767, 8) + pad("", 80) + pad(rate, 8) + pad("", 32)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(head + sig + struct.pack(f"<{len(raw)}h", *raw))


@pytest.fixture(scope="module")
def nights(tmp_path_factory):
    root = tmp_path_factory.mktemp("nights")
    t = np.arange(64 * 90) / 64
    for s in ("s1", "s2"):
        put(root / f"{s}/n1/device/PPG.edf", np.sin(2 * np.pi * 1.25 * t), 64)
        put(root / f"{s}/n1/device/EEG L.edf", np.sin(2 * np.pi * 10 * t), 64)
        (root / f"{s} n1.txt").write_text("0 0\n2 1\n9 0\n")
    put(root / "s3/n1/device/EEG L.edf", np.zeros(64 * 30), 64)
    return root


def config(root):
    return DatasetConfig("d", f"file://{root}", "s*/n*/device", "grandparent_parent", "{subject_id} {session_id}.txt", mapping={0: "W", 2: "N2"})


def test_process(spark, nights, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(MissingChannel):
        jobs.process(spark, config(nights), bundled("ppg"), out)
    rows = {r.recording_id: r for r in jobs.process(spark, config(nights), bundled("ppg"), out, ["PPG_ibi", "PPG_quality"], on_error=OnError.SKIP).collect()}
    assert rows["s1-n1"].export_status == "success" and rows["s3-n1"].export_status == "failed" and "PPG" in rows["s3-n1"].error_message
    assert float(rows["s1-n1"].PPG_ibi_mean) == pytest.approx(800, rel=0.02) and rows["s1-n1"].N2_count == "1" and rows["s1-n1"].UNKNOWN_count == "1"
    stored = spark.read.parquet(f"{out}/signal")
    assert {r.channel for r in stored.select("channel").distinct().collect()} == {"PPG_ibi", "PPG_quality"}
    again = jobs.process(spark, config(nights), bundled("ppg"), out, ["PPG_ibi", "PPG_quality"], on_error=OnError.SKIP)
    assert again.count() == 3 and spark.read.parquet(f"{out}/signal").count() == stored.count()
    with pytest.raises(ExistingOutput):
        jobs.process(spark, config(nights), bundled("ppg"), out, ["PPG_ibi"], on_error=OnError.SKIP, resume=False)


def steady():
    return lambda x: np.tile([0.1, 0.7, 0.2], (len(x), 1))


def test_command_line(spark, nights, tmp_path, capsys):
    cli.main(["pipelines"])
    assert "accelerometer" in capsys.readouterr().out
    book = tmp_path / "d.yaml"
    book.write_text(f"- {{name: d, data_dir: 'file://{nights}', pattern: 's*/n*/device', id_rule: grandparent_parent}}\n")
    base = ["--datasets", str(book), "--dataset", "d", "--on-error", "SKIP"]
    cli.main(["export", *base, "--out", str(tmp_path / "e"), "--rename", "EEG_L=EEG_LEFT", "--rate", "32"], spark)
    assert spark.read.parquet(str(tmp_path / "e/d/meta")).where("sample_rate = 32 and channel = 'EEG_LEFT'").count() == 3
    cli.main(["intervals", *base, "--out", str(tmp_path / "i"), "--pulse", "PPG"], spark)
    ibi = spark.read.csv(str(tmp_path / "i/d"), header=True, inferSchema=True)
    assert all(r.bpm == pytest.approx(75, rel=0.05) for r in ibi.collect()) and ibi.count() == 2
    cli.main(["score", *base, "--out", str(tmp_path / "s"), "--model", "test_jobs:steady", "--channels", "EEG_L", "--threshold", "0.6"], spark)
    stages = spark.read.csv(str(tmp_path / "s/d"), header=True, inferSchema=True).collect()
    assert len(stages) == 7 and {(r.stage, r.channel_group) for r in stages} == {(1, "aggregated")}
    cli.main(["score", *base, "--out", str(tmp_path / "c"), "--model", "test_jobs:steady", "--channels", "EEG_L", "--channels", "PPG", "--confidences", "--each", "--no-filter"], spark)
    probs = spark.read.csv(str(tmp_path / "c/d"), header=True, inferSchema=True).collect()
    assert {(r.channel_group, r.class_idx, round(r.prob, 6)) for r in probs} == {(g, k, p) for g in ("aggregated", "EEG_L", "PPG") for k, p in enumerate((0.1, 0.7, 0.2))}
    cli.main(["usability", *base, "--out", str(tmp_path / "u"), "--model", "test_jobs:steady", "--channels", "EEG_L,PPG", "--movement", "PPG", "--features", "516"], spark)
    assert spark.read.csv(str(tmp_path / "u/d"), header=True).count() == 18


def test_only_wanted_files_are_opened(spark, nights):
    glob = f"file://{nights}/s*/n*/device"
    blocks = edf.read_edf(spark, glob, ["PPG"])
    assert len(blocks.inputFiles()) == 2 and {r.channel for r in blocks.select("channel").collect()} == {"PPG"}
    assert len(edf.read_edf(spark, glob, ["EEG_L"]).inputFiles()) == 3  # a blank in the file name
    assert len(edf.read_edf(spark, glob).inputFiles()) == 5
    assert {r.sample_rate for r in edf.read_rates(spark, glob, ["EEG_L"]).collect()} == {64.0}


@pytest.fixture(scope="module")
def scored_nights(tmp_path_factory):
    root = tmp_path_factory.mktemp("scored")
    rng = np.random.default_rng(0)
    for k in range(1, 6):
        for c in ("EEG R", "EEG L"):
            put(root / f"s{k}/n1/device/{c}.edf", rng.normal(size=64 * 30 * 4), 64)
        (root / f"s{k} n1.txt").write_text("0 0\n2 1\n3 0\n4 0\n")
    return root


def stages_of(root):
    return DatasetConfig("d", f"file://{root}", "s*/n*/device", "grandparent_parent", "{subject_id} {session_id}.txt", mapping={0: "W", 2: "N2", 3: "N3", 4: "REM"})


def test_features(spark, scored_nights, tmp_path):
    out = str(tmp_path / "f")
    rows = jobs.export_features(spark, stages_of(scored_nights), "EEG_R", out, "EEG_L", 32.0, 0.2, existing=Existing.RAISE, on_error=OnError.RAISE)
    got = rows.collect()
    assert len(got) == 20 and {r.stage for r in got} == {"W", "N2", "N3", "R"} and {"eeg_mean", "eog_delta"} <= set(rows.columns)
    assert {r.set for r in got} == {"test", "train"} and len({r.subj for r in got if r.set == "test"}) == 1
    order = [(r.set, r.dataset, r.subj, r.session, r.epoch_idx) for part in sorted(tmp_path.glob("f/*.parquet")) for r in spark.read.parquet(str(part)).collect()]
    assert order == sorted(order)
    with pytest.raises(ExistingOutput):
        jobs.export_features(spark, stages_of(scored_nights), "EEG_R", out)
    again = jobs.export_features(spark, stages_of(scored_nights), "EEG_R", out, None, 32.0, existing=Existing.APPEND)
    assert again.count() == 20 and again.where("eog_mean is null").count() == 0  # the old values fill in
    report = jobs.train_stages(spark, out, ["eeg_"], str(tmp_path / "m"), {"N2": 2.0}, 5, 3)
    assert {r.label for r in report.collect()} == {"W", "N2", "N3", "R"}


def test_features_of_unequal_lengths(spark, scored_nights, tmp_path):
    c = stages_of(scored_nights)
    put(scored_nights / "s9/n1/device/EEG R.edf", np.zeros(64 * 90), 64)
    put(scored_nights / "s9/n1/device/EEG L.edf", np.zeros(64 * 60), 64)
    (scored_nights / "s9 n1.txt").write_text("0 0\n2 1\n")
    with pytest.raises(DurationMismatch):
        jobs.export_features(spark, c, "EEG_R", str(tmp_path / "a"), "EEG_L", 32.0)
    assert jobs.export_features(spark, c, "EEG_R", str(tmp_path / "b"), "EEG_L", 32.0, on_error=OnError.SKIP).count() == 20
    with pytest.raises(HypnogramMismatch):
        jobs.export_features(spark, c, "EEG_R", str(tmp_path / "c"), None, 32.0)
    assert jobs.export_features(spark, c, "EEG_R", str(tmp_path / "e"), None, 32.0, on_error=OnError.SKIP).count() == 20
    with pytest.raises(AnnotationsMissing):
        jobs.export_features(spark, DatasetConfig("d", c.data_dir, c.pattern), "EEG_R", str(tmp_path / "g"))


def halves():
    return lambda x: np.tile([0.1, 0.9], (len(x), 1))


def second_epoch(probs):
    return [(2 * 15 + 1, 2 * 15 + 2)]  # 2 s a prediction: the third epoch of 30 s


def test_evaluation(spark, scored_nights, tmp_path):
    c = stages_of(scored_nights)
    (scored_nights / "s2 n1.txt").write_text("0 0\n2 0\n3 1\n4 0\n")
    for name in ("EEG R", "EEG L"):
        put(scored_nights / f"s9/n1/device/{name}.edf", np.zeros(64 * 90), 64)
    (scored_nights / "s9 n1.txt").write_text("0 0\n2 1\n")  # shorter than the predictions
    book = tmp_path / "d.yaml"
    book.write_text(f"- {{name: d, data_dir: '{c.data_dir}', pattern: '{c.pattern}', id_rule: grandparent_parent, scoring_pattern: '{c.scoring_pattern}'}}\n")
    store = str(tmp_path / "x")
    cli.main(["export", "--datasets", str(book), "--dataset", "d", "--on-error", "SKIP", "--out", store, "--rename", "EEG_R=R", "--rename", "EEG_L=L"], spark)
    cli.main(["evaluate", "--datasets", str(book), "--dataset", "d", "--out", str(tmp_path / "t"), "--store", f"{store}/d", "--channels", "R,L", "--model", "test_jobs:halves", "--detector", "test_jobs:second_epoch", "--period", "2"], spark)
    rows = {r.dataset: r for r in spark.read.csv(str(tmp_path / "t"), header=True, inferSchema=True).collect()}
    # epochs from 1 on are deep; epoch 2 is predicted, which is true for s2 alone
    assert rows["d"].recording_count == rows["TOTAL"].recording_count == 6
    assert rows["d"].precision == pytest.approx(1 / 6)


def test_batches_of_periods(spark):
    """(batch, periods, samples, channels) with several predictions a batch; a tail of periods is dropped."""
    df = spark.createDataFrame([("r", c, i, float(i)) for c in "ab" for i in range(70)], "recording_id string, channel string, sample_idx long, value double")

    def make():
        def model(x):
            assert x.shape[1:] == (3, 10, 2) and x.dtype == np.float32
            first = x[:, :, ::5, 0].reshape(len(x), -1)  # two predictions a period
            return np.stack([first, -first], -1)

        return model

    out = models.score_sleep(df, 1.0, [["a", "b"]], make, 10.0, n_periods=3).orderBy("epoch_idx").collect()
    assert [(r.epoch_idx, r.probs[0], r.stage) for r in out] == [(i, 5.0 * i, 0) for i in range(12)]
    assert models.window_offset(256.0, 128) == int(np.mean((np.arange(128) * (1e9 / 256)).astype(np.int64)))
    with pytest.raises(LunariaError):
        models.score_usability(df, 1.0, ["a", "b"], "a", make, 7, 512.0)
