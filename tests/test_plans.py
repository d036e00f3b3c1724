from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lunaria.errors import BadConfig, ChannelCountMismatch, LunariaError, MissingChannel, RateMismatch, UnknownName
from lunaria.functions import fir, resample
from lunaria.operators import dsp, models, train
from lunaria.plans import pipeline, transforms
from lunaria.plans.transforms import Signal


def signal(spark, x, rate, channel="c"):
    rows = [("a", channel, i, float(v)) for i, v in enumerate(x)]
    return Signal(spark.createDataFrame(rows, "recording_id string, channel string, sample_idx long, value double"), (channel,), rate)


def read(s):
    return np.array([r.value for r in s.df.orderBy("sample_idx").collect()])


ALL = ("ppg", "simple_ppg", "wrist_ppg", "wrist_ppg_artifact", "accelerometer", "headband", "multi_device")


@pytest.mark.parametrize("name", ALL)
def test_bundled_pipelines_load(name):
    assert pipeline.bundled(name).name == name


def test_accelerometer_fork(spark):
    rng = np.random.default_rng(0)
    given = {f"ACCELEROMETER_{c}": signal(spark, rng.normal(size=1600) + (c == "Z"), 64.0) for c in "XYZ"}
    p = pipeline.bundled("accelerometer")
    assert p.shared() == {f"ACCELEROMETER_{c}_128" for c in "XYZ"}
    out = p.run(given, ["ACCELEROMETER_magnitude", "ACCELEROMETER_pitch"])
    assert set(out) == {"ACCELEROMETER_magnitude", "ACCELEROMETER_pitch"}
    assert all(s.rate == 128.0 for s in out.values())
    assert len(read(out["ACCELEROMETER_magnitude"])) == 3200
    assert np.abs(read(out["ACCELEROMETER_pitch"])).max() <= np.pi / 2
    assert len(p.needed(["ACCELEROMETER_pitch"])) == 3
    with pytest.raises(MissingChannel):
        p.run({})


def test_filters_in_one_pass(spark):
    """Resampling, a filter and the channels side by side: one shuffle a fork, the values of step by step."""
    rng = np.random.default_rng(1)
    x = {c: rng.normal(size=700) for c in "XYZ"}
    names = [f"ACCELEROMETER_{c}" for c in "XYZ"]
    wide = spark.createDataFrame([("a", i, *(float(x[c][i]) for c in "XYZ")) for i in range(700)], f"recording_id string, sample_idx long, {', '.join(f'{n} double' for n in names)}")
    axes = transforms.beside(wide, names, 64.0)
    out = pipeline.bundled("accelerometer").run(dict.fromkeys(names, axes), ["ACCELEROMETER_magnitude", "ACCELEROMETER_pitch"])
    for name in out:
        assert out[name].df._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    taps = fir.design(128.0, 0.25, 15.0)
    norm = np.sqrt(sum(fir.filtered(resample.resampled(x[c], 2, 1), taps) ** 2 for c in "XYZ"))
    assert np.allclose(read(out["ACCELEROMETER_magnitude"]), norm, atol=1e-9)


@pytest.mark.parametrize("block", [1, 1000, 1 << 18])
@pytest.mark.parametrize("n", [1, 5, 1280, 2561])
def test_chain_in_blocks(spark, n, block):
    """A filter between two changes of rate: any block size gives what the whole signal does."""
    x = np.random.default_rng(n).normal(size=n)
    steps = (dsp.resample_step(64.0, 40.0), dsp.fir_step(40.0, 2.0, 8.0), dsp.resample_step(40.0, 100.0))
    got = dsp.chain(signal(spark, x, 64.0).df, steps, block=block).orderBy("sample_idx").collect()
    want = resample.resampled(fir.filtered(resample.resampled(x, 5, 8), fir.design(40.0, 2.0, 8.0)), 5, 2)
    assert [r.sample_idx for r in got] == list(range(len(want))) and len(want) == dsp.length_after(n, steps)
    assert np.allclose([r.value for r in got], want, atol=1e-9)


def test_pulse_pipelines(spark):
    t = np.arange(64 * 40) / 64
    wave = signal(spark, np.sin(2 * np.pi * 1.2 * t), 64.0)
    out = pipeline.bundled("ppg").run({"PPG": wave}, ["PPG_ibi", "PPG_quality"])
    assert np.nanmedian(read(out["PPG_ibi"])) == pytest.approx(1000 / 1.2, rel=0.02)
    mask = pipeline.bundled("wrist_ppg_artifact")
    notes = Signal(spark.createDataFrame([("a", "annotations", 0, "W"), ("a", "annotations", 1, "N2"), ("a", "annotations", 7, "N3")], "recording_id string, channel string, sample_idx long, value string"), ("annotations",), 1 / 30)
    got = mask.run({"WRIST_BVP_ibi": out["PPG_ibi"], "WRIST_BVP_quality": out["PPG_quality"], "annotations": notes}, ["annotations"])
    assert [(r.sample_idx, r.value) for r in got["annotations"].df.orderBy("sample_idx").collect()] == [(0, "W"), (1, "N2"), (7, "N3")]
    bad = signal(spark, np.zeros(64 * 40), 64.0)
    got = mask.run({"WRIST_BVP_ibi": bad, "WRIST_BVP_quality": bad, "annotations": notes}, ["annotations"])
    assert [r.value for r in got["annotations"].df.orderBy("sample_idx").collect()] == ["ARTIFACT", "ARTIFACT", "N3"]


def test_rename_needs_no_equal_rates(spark):
    p = pipeline.rename_only("r", {"a": "A", "b": "B"})
    out = p.run({"a": signal(spark, [1, 2], 4.0), "b": signal(spark, [3], 1.0)})
    assert (out["A"].rate, out["B"].rate, out["A"].channels) == (4.0, 1.0, ("A",))
    both = pipeline.parse({"name": "x", "steps": [{"input_data_types": ["a", "b"], "output_data_types": ["A", "B"]}]})
    made = both.run({"a": signal(spark, [1, 2], 4.0), "b": signal(spark, [3], 1.0)}, ["A", "B"])
    assert (made["A"].rate, made["B"].rate) == (4.0, 1.0) and read(made["B"]).tolist() == [3.0]
    mixed = pipeline.parse({"name": "x", "steps": [{"inputs": ["a", "b"], "outputs": ["A", "B"], "transforms": [{"transform": "Resample", "config": {"new_sample_rate": 2.0}}]}]})
    with pytest.raises(RateMismatch):
        mixed.run({"a": signal(spark, [1, 2], 4.0), "b": signal(spark, [3], 1.0)})


def test_resample_to_own_rate_is_dropped(spark):
    p = pipeline.rename_only("r", {"a": "A"}, 4.0)
    s = signal(spark, [1, 2], 4.0)
    assert "ArrowInPandas" not in p.run({"a": s}, ["A"])["A"].df._jdf.queryExecution().toString()


@pytest.mark.parametrize(
    ("config", "error"),
    [
        ({"steps": []}, BadConfig),
        ({"name": "x", "steps": [{"inputs": ["a"]}]}, BadConfig),
        ({"name": "x", "steps": [{"inputs": ["a"], "outputs": ["b"], "transforms": [{"transform": "None"}]}]}, UnknownName),
        ({"name": "x", "steps": [{"inputs": ["a"], "outputs": ["b"], "transforms": [{"transform": "FIRFilter", "config": {"cutoff": 1}}]}]}, BadConfig),
    ],
)
def test_bad_configs(config, error):
    with pytest.raises(error):
        pipeline.parse(config)


def test_bad_yaml_and_names(tmp_path):
    (tmp_path / "p.yaml").write_text("name: x\nsteps: []\nstray line\n")
    with pytest.raises(BadConfig):
        pipeline.load(tmp_path / "p.yaml")
    with pytest.raises(UnknownName):
        pipeline.bundled("none")


def test_counts_and_own_transforms(spark):
    s = signal(spark, [1, 2], 4.0)
    p = pipeline.parse({"name": "x", "steps": [{"inputs": ["a"], "outputs": ["b", "c"]}]})
    with pytest.raises(ChannelCountMismatch):
        p.run({"a": s})
    with pytest.raises(ChannelCountMismatch):
        transforms.gravity(s)
    transforms.register("Double", lambda s, by=2.0: Signal(s.df.withColumn("value", F.col("value") * by), s.channels, s.rate))
    p = pipeline.parse({"name": "x", "steps": [{"inputs": ["a"], "outputs": ["b"], "transforms": [{"transform": "Double", "config": {"by": 3.0}}]}]})
    assert read(p.run({"a": s}, ["b"])["b"]).tolist() == [3.0, 6.0]


def peak_class():
    """A stand-in model: the class is the number of the channel-summed third with the largest mean."""

    def predict(x):
        parts = np.array_split(x.reshape(len(x), -1), 3, axis=1)
        return np.stack([p.mean(1) for p in parts], 1)

    return predict


def test_sleep_and_usability_scores(spark):
    x = np.concatenate([np.repeat([3.0, 1, 1], 10), np.repeat([1.0, 1, 3], 10), np.ones(7)])
    df = signal(spark, x, 1.0, "l").df.union(signal(spark, x, 1.0, "r").df)
    out = models.score_sleep(df, 1.0, [["l"], ["r"]], peak_class, 30.0).orderBy("epoch_idx").collect()
    assert [r.stage for r in out] == [0, 2]
    assert np.allclose(out[0].probs, [3, 1, 1])
    with pytest.raises(LunariaError):
        models.check_groups([["l"], ["l", "r"]], ["l", "r"])
    rng = np.random.default_rng(0)
    s = [signal(spark, rng.normal(size=3 * 2560 + 9), 256.0, c).df for c in ("l", "r", "m")]
    u = models.score_usability(s[0].union(s[1]).union(s[2]), 256.0, ["l", "r"], "m", peak_class, 2838)
    assert u.count() == 3 and set(u.columns) == {"recording_id", "period_idx", "left", "right"}


def test_quality_control(spark):
    out = models.quality_control(signal(spark, [1, 2, 3, 4, 100], 1.0).df, 1, 1.0).orderBy("sample_idx")
    assert [r.value for r in out.collect()] == [-1.0, -0.5, 0.0, 0.5, 1.5]


def test_training(spark):
    rng = np.random.default_rng(0)
    rows = [(float(v), float(rng.normal()), "W" if v > 0 else "N1") for v in rng.normal(size=200)] + [(0.0, 0.0, "Uns")]
    df = spark.createDataFrame(rows, "eeg_b double, eeg_a double, stage string")
    kept, names = train.training_rows(df, ["eeg_"], {"W": 2.0})
    assert names == ["eeg_a", "eeg_b"] and kept.count() == 200
    model = train.train(df, ["eeg_"], trees=5, depth=3)
    hit = model.transform(kept).where("label = prediction").count()
    assert hit > 180
