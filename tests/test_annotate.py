from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lunaria.errors import NotAMultiple
from lunaria.operators import annotate, segment

RUN = "recording_id string, run_no long, start_s long, duration_s long, label string"


def runs(spark, *rows):
    return spark.createDataFrame([("a", i, *r) for i, r in enumerate(rows)], RUN)


def stages(df):
    return [r.label for r in df.orderBy("epoch_idx").collect()]


def labels(spark, names):
    return spark.createDataFrame([("a", i, n) for i, n in enumerate(names)], "recording_id string, epoch_idx long, label string")


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([(0, 30, "W"), (60, 30, "N2")], ["W", "UNKNOWN", "N2"]),
        ([(0, 60, "W"), (30, 60, "N2")], ["W", "N2", "N2"]),
        ([(0, 45, "W"), (45, 45, "N1")], ["W", "N1", "N1"]),
        ([(60, 60, "N2"), (0, 30, "W")], ["W"]),  # the last line sets the length
    ],
)
def test_expand(spark, rows, expected):
    assert stages(annotate.expand_runs(runs(spark, *rows))) == expected


def test_squeeze(spark):
    out = annotate.squeeze_runs(labels(spark, ["W", "W", "N1", "N1", "N1", "W"])).orderBy("start_s")
    assert [tuple(r)[1:] for r in out.collect()] == [(0, 60, "W"), (60, 90, "N1"), (150, 30, "W")]


def test_squeeze_and_expand_are_inverse(spark):
    rng = random.Random(3)
    names = [rng.choice(["W", "N1", "REM"]) for _ in range(200)]
    back = annotate.expand_runs(annotate.squeeze_runs(labels(spark, names)).withColumn("run_no", F.col("start_s")))
    assert stages(back) == names


def test_intervals_touch_their_end(spark):
    df = spark.createDataFrame([("a", 29, 60)], "recording_id string, start_idx long, end_idx long")
    spine = labels(spark, "wxyz").select("recording_id", "epoch_idx")
    out = annotate.flag_epochs(spine, annotate.intervals_to_epochs(df, 30)).orderBy("epoch_idx")
    assert [r.flag for r in out.collect()] == [1, 1, 1, 0]


def ppg(spark, ibi, quality):
    return spark.createDataFrame([("a", i, float(b), float(q)) for i, (b, q) in enumerate(zip(ibi, quality, strict=True))], "recording_id string, sample_idx long, ibi double, quality double")


def test_artifact_segments_keep_the_tail(spark):
    out = segment.artifact_segments(ppg(spark, [800, 800, 100, 100, 100], [1, 0.5, 1, 1, 1]), 2).orderBy("epoch_idx").collect()
    assert [r.valid_ratio for r in out] == [0.5, 0.0, 0.0]
    assert [r.is_artifact for r in out] == [False, True, True]


def test_nan_quality_is_not_valid(spark):
    out = segment.artifact_segments(ppg(spark, [800], [float("nan")]), 1).first()
    assert out.valid_ratio == 0 and out.is_artifact


def test_merge_keeps_unmatched_labels(spark):
    mask = spark.createDataFrame([("a", 1, True), ("a", 0, False), ("a", 9, True)], "recording_id string, epoch_idx long, is_artifact boolean")
    assert stages(annotate.merge_artifacts(labels(spark, ["W", "W", "N1"]), mask)) == ["W", "ARTIFACT", "N1"]


def test_framing(spark):
    df = spark.createDataFrame([("a", "c", i, float(i)) for i in range(7)], "recording_id string, channel string, sample_idx long, value double")
    with pytest.raises(NotAMultiple):
        segment.frame_periods(df, 3)
    out = segment.frame_periods(df, 3, strict=False).orderBy("period_idx").collect()
    assert [r.samples for r in out] == [[0, 1, 2], [3, 4, 5]]
    assert segment.segment_length(30, 0.5) == 15
