"""Summaries and quality measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dataset_summary(rows: DataFrame) -> DataFrame:
    """(set, n_subjects, n_recordings, n_rows) per split and in total (set = 'TOTAL'). Subjects and
    sessions are told apart by dataset, so equal ids of two datasets do not merge."""
    subject, session = F.struct("dataset", "subj"), F.struct("dataset", "subj", "session")
    # two levels of grouping: distinct sessions first, so that the distinct counts run over few rows
    per = rows.groupBy("set", "dataset", "subj", "session").agg(F.count(F.lit(1)).alias("n"))
    out = per.groupingSets([["set"], []], "set").agg(F.count_distinct(subject).alias("n_subjects"), F.count_distinct(session).alias("n_recordings"), F.sum("n").alias("n_rows"), F.grouping("set").alias("__total"))
    return out.select(F.when(F.col("__total") == 1, "TOTAL").otherwise(F.col("set")).alias("set"), "n_subjects", "n_recordings", "n_rows")


def confusion_cells(truth: Column, guess: Column) -> dict[str, Column]:
    return {
        "tp": F.count_if((truth == 1) & (guess == 1)), "fp": F.count_if((truth == 0) & (guess == 1)),
        "fn": F.count_if((truth == 1) & (guess == 0)), "tn": F.count_if((truth == 0) & (guess == 0)),
    }


def binary_metrics(rows: DataFrame, truth: str = "truth", guess: str = "guess", key: Sequence[str] = ()) -> DataFrame:
    """(key, precision, recall, f1, accuracy); 0 where a ratio has no denominator."""
    cells = rows.groupBy(*key).agg(*[c.alias(n) for n, c in confusion_cells(F.col(truth), F.col(guess)).items()])
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.select(*key, ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"))


def scorable(rows: DataFrame, truth: str = "truth", guess: str = "guess") -> DataFrame:
    """Rows whose labels are both 0 or 1 (others, such as -1, are left out)."""
    return rows.where(F.col(truth).isin(0, 1) & F.col(guess).isin(0, 1))


#: Fixed values of the workload: codes of wake, of the lightest stage and of unscored epochs.
NOT_DEEP = (0, 1, -1)


def deep_sleep(rows: DataFrame, stage: str = "stage") -> DataFrame:
    """Rows whose stage code is none of 0, 1 and -1; a null stage counts as unscored."""
    return rows.where(~F.col(stage).isin(*NOT_DEEP))


def without_empty(rows: DataFrame, key: Sequence[str], truth: str = "truth") -> DataFrame:
    """Only recordings that have a positive label at all."""
    some = rows.groupBy(*key).agg(F.max(truth).alias("__m")).where("__m > 0").select(*key)
    return rows.join(some, list(key), "left_semi")


def macro(per_recording: DataFrame, measures: Sequence[str], group: str = "dataset", count: str | None = None) -> DataFrame:
    """Means over recordings per dataset and over all recordings (TOTAL, not a mean of means); count names
    a column for the number of recordings."""
    n = [F.count(F.lit(1)).alias(count)] if count else []
    out = per_recording.rollup(group).agg(*[F.avg(m).alias(m) for m in measures], *n, F.grouping(group).alias("__total"))
    return out.select(F.when(F.col("__total") == 1, "TOTAL").otherwise(F.col(group)).alias(group), *measures, *([count] if count else []))


def confusion_matrix(rows: DataFrame, truth: str = "truth", guess: str = "guess") -> DataFrame:
    return rows.groupBy(truth, guess).agg(F.count(F.lit(1)).alias("n"))


def class_report(rows: DataFrame, truth: str = "truth", guess: str = "guess") -> DataFrame:
    """(label, precision, recall, f1, support) of every label in the truth or the prediction."""
    cells = confusion_matrix(rows, truth, guess)
    t = cells.groupBy(F.col(truth).alias("label")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col(truth) == F.col(guess), F.col("n")).otherwise(0)).alias("hit"))
    g = cells.groupBy(F.col(guess).alias("label")).agg(F.sum("n").alias("guessed"))
    both = t.join(g, "label", "full_outer").na.fill(0)
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    return both.select("label", ratio(F.col("hit"), F.col("guessed")).alias("precision"), ratio(F.col("hit"), F.col("support")).alias("recall"), ratio(2 * F.col("hit"), F.col("guessed") + F.col("support")).alias("f1"), F.col("support"))
