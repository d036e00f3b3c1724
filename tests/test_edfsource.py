"""The EDF data source: ranges of records, headers alone, pushed filters, and how often files are opened."""

from __future__ import annotations

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from lunaria import jobs
from lunaria.errors import ChannelCountMismatch
from lunaria.operators import dsp
from lunaria.sources import edf, edfsource
from lunaria.sources.recordings import DatasetConfig


def put(path, signals, seconds, records=None, cut=0):
    """signals: (label, rate, digital samples)."""
    pad = lambda s, w: str(s).ljust(w).encode()
    ns = len(signals)
    head = pad("0", 8) + pad("x", 80) + pad("y", 80) + pad("01.01.20", 8) + pad("00.00.00", 8) + pad(256 * (1 + ns), 8) + pad("", 44) + pad(seconds if records is None else records, 8) + pad(1, 8) + pad(ns, 4)
    for w, value in ((16, lambda s: s[0]), (80, ""), (8, "uV"), (8, -50), (8, 50), (8, -100), (8, 100), (80, ""), (8, lambda s: s[1]), (32, "")):
        head += b"".join(pad(value(s) if callable(value) else value, w) for s in signals)
    body = b"".join(struct.pack(f"<{rate}h", *x[r * rate : (r + 1) * rate]) for r in range(seconds) for _, rate, x in signals)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(head + body[: len(body) - cut])


def whole(df):
    return {(r.stem, r.channel): [v for v in r.x] for r in edf.to_long(df, ("stem",)).groupBy("stem", "channel").agg(F.array_sort(F.collect_list(F.struct("sample_idx", "value"))).alias("x")).collect()}


@pytest.mark.parametrize("split", [1, 97, 1000, 10**9])
def test_any_split_gives_the_same_samples(spark, tmp_path, monkeypatch, split):
    monkeypatch.setattr(edfsource, "LEAST", 1)
    rng = np.random.default_rng(0)
    a, b = (rng.integers(-100, 100, 4 * 9).tolist() for _ in range(2))
    c = rng.integers(-100, 100, 2 * 9).tolist()
    put(tmp_path / "s 1/EEG L.edf", [("EEG L", 4, a), ("EDF Annotations", 3, [0] * 27), ("slow", 2, c)], 9)
    put(tmp_path / "s 1/other.edf", [("x", 4, b)], 9, records=-1, cut=5)
    files = [(str(p), p.stat().st_size) for p in sorted(tmp_path.glob("*/*.edf"))]
    tasks = edfsource.ranges(files, 1, split)
    assert len(tasks) >= min(sum(n for _, n in files) // split, 1)
    for path, n in files:  # ranges cover each file once
        cover = sorted((lo, hi) for t in tasks for p, _, lo, hi in t if p == path)
        assert cover[0][0] == 0 and cover[-1][1] == n and all(x[1] == y[0] for x, y in zip(cover, cover[1:], strict=False))
    got = whole(edfsource.read_signals(spark, f"file://{tmp_path}/s*/", split=split))
    assert got.keys() == {("EEG_L", "EEG L"), ("EEG_L", "slow"), ("other", "x")}
    for key, x in ((("EEG_L", "EEG L"), a), (("EEG_L", "slow"), c), (("other", "x"), b[:32])):  # a torn record is left out
        assert [s.sample_idx for s in got[key]] == list(range(len(x))) and [s.value for s in got[key]] == [v / 2 for v in x]


def test_blocks_end_at_block_numbers(spark, tmp_path, monkeypatch):
    put(tmp_path / "a.edf", [("a", 1000, list(np.arange(200_000) % 100))], 200)
    rows = sorted((r.block_idx, r.start_idx, r.n) for r in edfsource.read_signals(spark, f"{tmp_path}/a.edf", split=150_001).select("block_idx", "start_idx", F.size("samples").alias("n")).collect())
    assert all(s // edfsource.BLOCK_SAMPLES == b and (s + n - 1) // edfsource.BLOCK_SAMPLES == b for b, s, n in rows)
    assert [s for _, s, _ in rows] == list(np.cumsum([0, *[n for _, _, n in rows]]))[:-1]


def test_many_signals(spark, tmp_path):
    """More signals than a fixed header read would hold, by either reader."""
    put(tmp_path / "many.edf", [(f"c{k}", 2, [k, k]) for k in range(120)], 1)
    heads = edfsource.read_headers(spark, f"file://{tmp_path}/many.edf").collect()
    assert len(heads) == 120 and {(h.sample_rate, h.n_samples) for h in heads} == {(2.0, 2)}
    assert {r.sample_rate for r in edf.read_rates(spark, str(tmp_path / "many.edf")).collect()} == {2.0}


def opened(folder):
    seen = [json.loads(p.read_text()) for p in folder.iterdir()]
    for p in folder.iterdir():
        p.unlink()
    return sorted((s["path"], s["bytes"]) for s in seen)


@pytest.fixture
def audit(tmp_path, monkeypatch):
    folder = tmp_path / "audit"
    folder.mkdir()
    monkeypatch.setattr(edfsource, "AUDIT", str(folder))
    return folder


def test_filters_are_pushed(spark, tmp_path, audit):
    for s in ("s1", "s2"):
        for c in ("EEG L", "PPG"):
            put(tmp_path / f"{s}/{c}.edf", [(c, 4, [1, 2, 3, 4] * 5)], 5)
    edfsource.register(spark)
    df = spark.read.format("edf_pushed").option("audit", str(audit)).load(f"file://{tmp_path}/s*")
    assert df.where("stem = 'PPG'").count() == 2 and [p[-10:] for p, _ in opened(audit)] == ["s1/PPG.edf", "s2/PPG.edf"]
    assert df.where(F.col("stem").isin("EEG_L", "none") & (F.col("sample_rate") > 9)).count() == 0 and len(opened(audit)) == 2
    assert df.where("channel = 'PPG'").count() == 2
    assert {n for p, n in opened(audit) if "EEG" in p} == {512}  # the header alone
    assert df.where(F.col("path") == f"file:{tmp_path}/s1/PPG.edf").count() == 1 and len(opened(audit)) == 1
    assert df.where("stem = 'nothing'").count() == 0 and opened(audit) == []


def nights(root, n=3, seconds=40):
    for k in range(n):
        for c in ("EEG L", "EEG R", "PPG"):
            put(root / f"s{k} x/n1/device/{c}.edf", [(c, 64, (np.arange(64 * seconds) % 60).tolist())], seconds)
    return DatasetConfig("d", f"file://{root}", "s*/n*/device", "grandparent_parent")


def halves():
    return lambda x: np.tile([0.1, 0.9], (len(x), 1))


def test_a_job_opens_each_file_once_for_its_samples(spark, tmp_path, audit):
    """Two channels of three nights: a header pass over six files, then six files, once each."""
    config = nights(tmp_path / "data")
    loaded = jobs.load_edf(spark, config, ["EEG_L", "EEG_R"])
    heads = opened(audit)
    assert len(heads) == 6 and {n for _, n in heads} == {512} and not any("PPG" in p for p, _ in heads)
    assert {(r.channel, r.n) for s in loaded.signals.values() for r in s.sizes.collect()} == {("EEG_L", 2560), ("EEG_R", 2560)}
    assert opened(audit) == []  # lengths are those of the header pass
    clean = [dsp.fir_filter(s.df, s.rate, 0.5, 20, ("recording_id", "channel"), sizes=s.sizes) for s in loaded.signals.values()]
    assert clean[0].union(clean[1]).count() == 6 * 2560
    bodies = opened(audit)
    assert len(bodies) == len({p for p, _ in bodies}) == 6 and {n for _, n in bodies} == {512 + 2 * 2560}


def test_scores_say_when(spark, tmp_path, audit):
    out = jobs.score_stages(spark, nights(tmp_path / "data"), [["EEG_L"], ["EEG_R"]], halves, str(tmp_path / "out"), model_rate=32.0, each=True)
    rows = out.collect()
    assert {(r.channel_group, r.epoch_idx, r.stage, r.ts_ns) for r in rows} == {(g, 0, 1, 14_992_187_500) for g in ("aggregated", "EEG_L", "EEG_R")} and len(rows) == 9
    assert not any("PPG" in p for p, _ in opened(audit))


def test_a_file_of_several_signals_is_no_channel(spark, tmp_path):
    config = nights(tmp_path / "data", 1)
    put(tmp_path / "data/s0 x/n1/device/PPG.edf", [("a", 4, [0] * 4), ("b", 4, [0] * 4)], 1)
    with pytest.raises(ChannelCountMismatch):
        jobs.load_edf(spark, config, ["PPG"])


def test_patterns(spark, tmp_path):
    for s in ("a1", "b1", "c1"):
        put(tmp_path / f"{s}/x.edf", [("x", 2, [1, 2])], 1)
    count = lambda p: edfsource.read_headers(spark, f"file://{tmp_path}/{p}").count()
    assert (count("{a,b}1"), count("{a,b}1/{x,y}.edf"), count("[bc]?/*.edf"), count("{a1,a*}/x.edf")) == (2, 2, 2, 1)


def test_no_files(spark, tmp_path):
    assert edfsource.read_signals(spark, f"file://{tmp_path}/none*").collect() == []
    assert edfsource.split_uri("s3a://b/x/*.edf") == ("s3a://", "b/x/*.edf") and edfsource.split_uri("hdfs://h:8020/x") == ("hdfs://h:8020", "/x")
    assert edfsource.readable("/x") and not edfsource.readable("viewfs://store/x")
