"""Evaluation of predicted events (arousals, say) against annotations, epoch by epoch. All recordings
go through one plan; nothing is looped over on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import annotate, metrics, scores
from .select import KEY

MEASURES = ("precision", "recall", "f1", "accuracy")
Detector = Callable[[np.ndarray], Sequence[tuple[int, int]]]


def detect_intervals(scored: DataFrame, detector: Detector, key: Sequence[str] = KEY) -> DataFrame:
    """(key, start_idx, end_idx): what a detector finds in each recording's class probabilities
    (epochs x classes, in order). scored(key, epoch_idx, probs); a recording's predictions, a few
    thousand rows, are one array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = len(key)
        for batch in batches:
            rows, a, b = [], [], []
            for i in range(batch.num_rows):
                for start, end in detector(np.array(batch.column(at)[i].as_py(), np.float64)):
                    rows.append(i)
                    a.append(int(start))
                    b.append(int(end))
            own = [batch.column(k).take(pa.array(rows, pa.int64())) for k in range(at)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(a, pa.int64()), pa.array(b, pa.int64())], [*key, "start_idx", "end_idx"])

    ordered = F.array_sort(F.collect_list(F.struct("epoch_idx", "probs")))
    whole = scored.groupBy(*key).agg(F.transform(ordered, lambda s: s["probs"]).alias("probs"))
    kinds = ", ".join(f"{k} {scored.schema[k].dataType.simpleString()}" for k in key)
    return whole.mapInArrow(run, f"{kinds}, start_idx long, end_idx long")


def predicted_epochs(lengths: DataFrame, intervals: DataFrame, length: int, key: Sequence[str] = KEY) -> DataFrame:
    """(key, epoch_idx, guess): every epoch of length samples of recordings (key, n_samples), the partial
    last one included, with 1 where an interval touches it (its ends included) and 0 elsewhere."""
    last = F.expr(f"(n_samples + {length - 1}) div {length}") - 1
    spine = lengths.where("n_samples > 0").select(*key, F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("epoch_idx"))
    flags = annotate.flag_epochs(spine, annotate.intervals_to_epochs(intervals, length, key), key)
    return flags.select(*key, "epoch_idx", F.col("flag").alias("guess"))


def evaluated(guess: DataFrame, truth: DataFrame, stages: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """(key, precision, recall, f1, accuracy) per recording: guess(key, epoch_idx, guess), truth(key,
    epoch_idx, truth) and stages(key, epoch_idx, stage) met epoch by epoch, in deep sleep alone.
    Recordings without a true event there are left out."""
    met = scores.with_truth(guess, truth, [*key, "epoch_idx"])
    deep = metrics.deep_sleep(scores.with_truth(met, stages, [*key, "epoch_idx"]))
    return metrics.binary_metrics(metrics.without_empty(deep, key), key=key)
