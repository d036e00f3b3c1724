from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lunaria.errors import AmbiguousLookup, DuplicateChannel, HypnogramMismatch, NoSamples, RateMismatch
from lunaria.operators import align, merge, metrics, motion, scores, split, train


def test_consensus(spark):
    df = spark.createDataFrame([(2, 2), (2, -1), (-1, 3), (1, 2), (-1, -1)], "a long, b long")
    assert [r.c for r in df.select(scores.consensus("a", "b").alias("c")).collect()] == [2, 2, 3, -1, -1]
    votes = spark.createDataFrame([("r", 0, 2), ("r", 0, -1), ("r", 0, 2), ("r", 1, 1), ("r", 1, 2)], "recording_id string, epoch_idx long, label long")
    assert {r.epoch_idx: r.label for r in scores.consensus_many(votes).collect()} == {0: 2, 1: -1}


def test_argmax_and_threshold(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],), ([],), (None,)], "p array<double>")
    rows = df.select(scores.argmax("p").alias("m"), scores.confident("p", 0.4).alias("keep"), scores.confident("p", 0.41).alias("drop")).collect()
    assert (rows[0].m, rows[0].keep, rows[0].drop) == (1, 1, -1)
    assert rows[1].m is None and rows[2].m is None


def test_stack_checks():
    assert align.check_stack([("a", 1.0), ("b", 1.0)]) == 1.0
    with pytest.raises(NoSamples):
        align.check_stack([("a", 1.0)])
    with pytest.raises(DuplicateChannel):
        align.check_stack([("a", 1.0), ("a", 1.0)])
    with pytest.raises(RateMismatch):
        align.check_stack([("a", 1.0), ("b", 2.0)])


def test_concatenate_runs_on(spark):
    part = lambda n: spark.createDataFrame([("a", i, float(i)) for i in range(n)], "recording_id string, sample_idx long, value double")
    out = align.concatenate([part(2), part(3)]).orderBy("sample_idx").collect()
    assert [(r.sample_idx, r.value) for r in out] == [(0, 0), (1, 1), (2, 0), (3, 1), (4, 2)]
    with pytest.raises(NoSamples):
        align.concatenate([part(2)])


def test_samples_to_signal(spark):
    df = spark.createDataFrame([("a", 20, [3.0, 4.0]), ("a", 10, [1.0, 2.0])], "recording_id string, ts_ns long, values array<double>")
    out = align.samples_to_signal(df).orderBy("channel", "sample_idx").collect()
    assert [(r.channel, r.sample_idx, r.value) for r in out] == [("channel_0", 0, 1), ("channel_0", 1, 3), ("channel_1", 0, 2), ("channel_1", 1, 4)]


def test_resume_and_lookup(spark):
    recordings = spark.createDataFrame([("a",), ("b",), ("c",)], "recording_id string")
    catalog = spark.createDataFrame([("a", "success"), ("b", "failed")], "recording_id string, export_status string")
    assert sorted(r[0] for r in merge.pending(recordings, catalog).collect()) == ["b", "c"]
    assert sorted(r[0] for r in merge.pending(recordings, catalog, retry_failed=False).collect()) == ["c"]
    with pytest.raises(AmbiguousLookup):
        merge.attach_unique(recordings, recordings.union(recordings), ["recording_id"])


def test_combine_first_and_upsert(spark):
    new = spark.createDataFrame([("a", 1, None), ("b", 2, 5)], "k string, x int, y int")
    old = spark.createDataFrame([("a", 9, 7, "z"), ("c", 3, 4, "w")], "k string, x int, y int, o string")
    rows = {r.k: tuple(r)[1:] for r in merge.combine_first(new, old, ["k"]).collect()}
    assert rows == {"a": (1, 7, "z"), "b": (2, 5, None), "c": (3, 4, "w")}
    rows = {r.k: (r.x, r.y, r.o) for r in merge.upsert(old, new, ["k"]).collect()}
    assert rows == {"a": (1, None, None), "b": (2, 5, None), "c": (3, 4, "w")}


def test_motion(spark):
    df = spark.createDataFrame([("a", 0, 3.0, 4.0, 0.0), ("a", 1, 0.0, 0.0, 5.0), ("a", 2, 0.0, 0.0, 6.0)], "recording_id string, sample_idx long, x double, y double, z double")
    out = motion.dynamic(df, 2.0).orderBy("sample_idx").collect()
    assert [r.magnitude for r in out] == [5, 5, 6] and [r.derivative for r in out] == [0, 0, 2]
    g = spark.createDataFrame([("a", 0, 0.0, 0.0, 1.0), ("a", 1, -1.0, 0.0, 0.0)], df.schema)
    rows = motion.gravity(g).orderBy("sample_idx").collect()
    assert (rows[0].pitch, rows[0].roll) == (0, 0) and rows[1].pitch == pytest.approx(1.5707963267948966)


def test_split_is_by_subject(spark):
    df = spark.createDataFrame([(s, e) for s in range(10) for e in range(3)], "subj long, epoch long")
    out = split.split_subjects(df, 0.2, seed=1)
    test = {r.subj for r in out.where(F.col("set") == "test").collect()}
    assert len(test) == 2 and not test & {r.subj for r in out.where(F.col("set") == "train").collect()}
    assert {r.subj for r in split.split_subjects(df, 0.2, seed=1).where(F.col("set") == "test").collect()} == test
    named = df.withColumn("subj", F.concat(F.lit("s"), "subj"))
    assert split.split_subjects(named, 0.25).where(F.col("set") == "test").select("subj").distinct().count() == 2
    both = split.stratified_subjects(df.withColumn("dataset", F.col("subj") % 2), 0.4, "dataset")
    assert both.where(F.col("set") == "test").select("subj").distinct().count() == 4


def test_metrics(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (1, 0), (0, 0), (0, -1)], "truth int, guess int")
    r = metrics.binary_metrics(metrics.scorable(df)).first()
    assert tuple(r) == (0.5, 0.5, 0.5, 0.5)
    none = metrics.binary_metrics(df.where("truth = 0 and guess = 0")).first()
    assert tuple(none) == (0.0, 0.0, 0.0, 1.0)
    rows = spark.createDataFrame([("x", 1.0), ("x", 0.0), ("y", 1.0)], "dataset string, f1 double")
    assert {r.dataset: round(r.f1, 4) for r in metrics.macro(rows, ["f1"]).collect()} == {"x": 0.5, "y": 1.0, "TOTAL": 0.6667}


def test_truth_is_cut_to_the_predictions(spark):
    guess = spark.createDataFrame([("a", 0, 1), ("a", 1, 0), ("b", 0, 1)], "recording_id string, epoch_idx long, guess int")
    truth = spark.createDataFrame([("a", 0, 1), ("a", 1, 1), ("a", 2, 0), ("b", 0, 0), ("c", 0, 1)], "recording_id string, epoch_idx long, truth int")
    assert sorted(map(tuple, scores.with_truth(guess, truth).collect())) == [("a", 0, 1, 1), ("a", 1, 0, 1), ("b", 0, 1, 0)]


def test_features_need_a_hypnogram_of_their_length(spark):
    f = spark.createDataFrame([("a", 0, 0.5), ("a", 1, 0.7)], "recording_id string, epoch_idx long, eeg_x double")
    schema = "recording_id string, epoch_idx long, stage int"
    h = [("a", 1, 3), ("a", 0, 2), ("b", 0, 1)]
    assert sorted(map(tuple, train.with_hypnogram(f, spark.createDataFrame(h, schema)).collect())) == [("a", 0, 0.5, 2), ("a", 1, 0.7, 3)]
    for other in (h[1:], [*h, ("a", 2, 0)], [("a", 0, 2), ("a", 2, 1)], [("b", 0, 1)]):
        with pytest.raises(HypnogramMismatch):
            train.with_hypnogram(f, spark.createDataFrame(other, schema))
