"""Class probabilities and predictions per epoch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .select import KEY

NONE = -1


def argmax(probs: Column | str) -> Column:
    """The position of the largest value, the first one at a tie; null for an empty or null array."""
    p = F.col(probs) if isinstance(probs, str) else probs
    at = F.array_position(p, F.array_max(p)) - 1
    return F.when(F.size(p) > 0, at)


def confident(probs: Column | str, threshold: float) -> Column:
    """argmax, or -1 where the largest value is below the threshold (equal is enough)."""
    p = F.col(probs) if isinstance(probs, str) else probs
    return F.when(F.array_max(p) < threshold, F.lit(NONE).cast("long")).otherwise(argmax(p))


def mean_groups(scores: DataFrame, key: Sequence[str] = (*KEY, "epoch_idx")) -> DataFrame:
    """(key, class_idx, prob): probabilities averaged over channel groups."""
    each = scores.select(*key, F.posexplode("probs").alias("class_idx", "p"))
    return each.groupBy(*key, "class_idx").agg(F.avg("p").alias("prob"))


def as_arrays(means: DataFrame, key: Sequence[str] = (*KEY, "epoch_idx")) -> DataFrame:
    """(key, probs) from (key, class_idx, prob)."""
    items = F.array_sort(F.collect_list(F.struct("class_idx", "prob")))
    return means.groupBy(*key).agg(F.transform(items, lambda s: s["prob"]).alias("probs"))


def consensus(a: Column | str, b: Column | str) -> Column:
    """Two voters: equal labels stand, an unknown (-1) yields to the other, a conflict is unknown."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.when(a == b, a).when(a == NONE, b).when(b == NONE, a).otherwise(F.lit(NONE).cast("long"))


def consensus_many(votes: DataFrame, key: Sequence[str] = (*KEY, "epoch_idx")) -> DataFrame:
    """(key, label): any number of voters, unknowns left out; a label stands if all others agree
    (equal to `consensus` for two; an extension beyond two)."""
    known = F.when(F.col("label") != NONE, F.col("label"))
    low, high = F.min(known), F.max(known)
    return votes.groupBy(*key).agg(F.when(low == high, low).otherwise(F.lit(NONE).cast("long")).alias("label"))


def with_truth(predicted: DataFrame, truth: DataFrame, key: Sequence[str] = (*KEY, "epoch_idx")) -> DataFrame:
    """Predictions joined with the truth of the same epoch; truth beyond the predictions is cut off, as are
    predictions beyond the truth."""
    return predicted.join(truth, list(key))


def lengths(predicted: DataFrame, truth: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """(key, n_predicted, n_truth): the epochs of each recording in predictions and in truth, of which `with_truth`
    keeps what both have; a difference says how much it cuts, and on which side."""
    key = list(key)
    a, b = (df.groupBy(*key).agg(F.count(F.lit(1)).alias(n)) for df, n in ((predicted, "n_predicted"), (truth, "n_truth")))
    return a.join(b, key, "full").fillna(0, ["n_predicted", "n_truth"])
