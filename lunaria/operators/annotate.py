"""Annotations per epoch, their runs, intervals, and artifact masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import ARTIFACT, EPOCH_S, UNKNOWN
from .select import KEY


def expand_runs(runs: DataFrame, period: int = EPOCH_S, default: str = UNKNOWN, key: Sequence[str] = KEY) -> DataFrame:
    """(key, epoch_idx, label) from runs (key, run_no, start_s, duration_s, label).

    A run covers epochs start div period to (start + duration) div period, the last excluded; where
    runs overlap the later line wins; gaps get the default. The number of epochs follows from the last
    line. Runs explode into their own epochs, so no range join is needed.
    """
    end = F.col("start_s") + F.col("duration_s")
    last = runs.groupBy(*key).agg(F.expr(f"max_by((start_s + duration_s) div {period}, run_no)").alias("n"))
    spine = last.where("n > 0").select(*key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("epoch_idx"))
    first, stop = F.expr(f"start_s div {period}"), F.expr(f"(start_s + duration_s) div {period}")
    own = runs.where(end >= 0).select(*key, "run_no", "label", first.alias("a"), stop.alias("b")).where("a < b")
    own = own.select(*key, "run_no", "label", F.explode(F.sequence("a", F.col("b") - 1)).alias("epoch_idx"))
    won = own.groupBy(*key, "epoch_idx").agg(F.max_by("label", "run_no").alias("label"))
    return spine.join(won, [*key, "epoch_idx"], "left").select(*key, "epoch_idx", F.coalesce("label", F.lit(default)).alias("label"))


def squeeze_runs(labels: DataFrame, period: int = EPOCH_S, key: Sequence[str] = KEY) -> DataFrame:
    """(key, start_s, duration_s, label) runs of equal labels; the inverse of expand_runs."""
    w = Window.partitionBy(*key).orderBy("epoch_idx")
    before = F.lag("label").over(w)
    opens = F.when(F.row_number().over(w) == 1, 1).when(before.eqNullSafe(F.col("label")), 0).otherwise(1)
    runs = labels.withColumn("opens", opens).withColumn("island", F.sum("opens").over(w))
    runs = runs.groupBy(*key, "island").agg(F.min("epoch_idx").alias("e"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"))
    return runs.select(*key, (F.col("e") * period).alias("start_s"), (F.col("n") * period).alias("duration_s"), "label")


def intervals_to_epochs(intervals: DataFrame, length: int, key: Sequence[str] = KEY) -> DataFrame:
    """Distinct (key, epoch_idx) that intervals (key, start_idx, end_idx) touch, their ends included."""
    spans = F.sequence(F.expr(f"start_idx div {length}"), F.expr(f"end_idx div {length}"))
    return intervals.where("start_idx <= end_idx").select(*key, F.explode(spans).alias("epoch_idx")).distinct()


def flag_epochs(epochs: DataFrame, touched: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """epochs with flag 1 where touched has them, else 0."""
    hit = touched.select(*key, "epoch_idx", F.lit(1).alias("__hit"))
    return epochs.join(hit, [*key, "epoch_idx"], "left").withColumn("flag", F.coalesce("__hit", F.lit(0)).cast("int")).drop("__hit")


def merge_artifacts(labels: DataFrame, mask: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """labels with ARTIFACT where mask (key, epoch_idx, is_artifact) says so. Epochs that the mask does
    not have keep their label, and the mask's own extra epochs are ignored."""
    m = mask.select(*key, "epoch_idx", "is_artifact")
    label = F.when(F.coalesce("is_artifact", F.lit(False)), F.lit(ARTIFACT)).otherwise(F.col("label"))
    return labels.join(m, [*key, "epoch_idx"], "left").select(*key, "epoch_idx", label.alias("label"))
