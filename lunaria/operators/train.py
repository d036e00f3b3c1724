"""Training a stage classifier on epoch features with Spark ML: weights per class. It has no early
stopping; `boost` trains boosted trees, with it. Neither is equal to any library's model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import HypnogramMismatch
from ..schema import UNSCORED
from .select import KEY, features_by_prefix


def with_hypnogram(features: DataFrame, hypnogram: DataFrame, key: Sequence[str] = KEY, skip: bool = False) -> DataFrame:
    """features(key, epoch_idx, ...) with the stage of hypnogram(key, epoch_idx, stage), by position. A
    recording of features with another number of epochs in its hypnogram, or none, is an error (with
    skip it is left out); so are epochs without a partner. Recordings of the hypnogram alone are ignored."""
    key = list(key)
    n = features.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    m = hypnogram.groupBy(key).agg(F.count(F.lit(1)).alias("m"))
    out = features.join(hypnogram.select(*key, "epoch_idx", "stage"), [*key, "epoch_idx"])
    met = out.groupBy(key).agg(F.count(F.lit(1)).alias("met"))
    lengths = n.join(m, key, "left").join(met, key, "left").fillna(0, ["m", "met"])
    odd = lengths.where((F.col("n") != F.col("m")) | (F.col("n") != F.col("met")))
    if skip:
        return out.join(odd.select(*key), key, "left_anti")
    bad = odd.orderBy(key).first()
    if bad is not None:
        raise HypnogramMismatch(f"{[bad[k] for k in key]}: {bad.n} epochs of features, {bad.m} of hypnogram, {bad.met} in both")
    return out


def training_rows(features: DataFrame, prefixes: Sequence[str], weights: Mapping[str, float] | None = None) -> tuple[DataFrame, list[str]]:
    """(rows with label and weight, feature names): unscored epochs are left out, features sorted by name."""
    names = features_by_prefix(features.columns, prefixes)
    rows = features.where(F.col("stage") != UNSCORED)
    weight = F.lit(1.0)
    for stage, w in (weights or {}).items():
        weight = F.when(F.col("stage") == stage, float(w)).otherwise(weight)
    return rows.withColumn("weight", weight), names


def train(features: DataFrame, prefixes: Sequence[str], weights: Mapping[str, float] | None = None, trees: int = 50, depth: int = 6, seed: int = 0):
    """A fitted Spark ML pipeline (index labels, assemble, random forest)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    rows, names = training_rows(features, prefixes, weights)
    stages = [
        StringIndexer(inputCol="stage", outputCol="label", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=names, outputCol="x", handleInvalid="skip"),
        RandomForestClassifier(featuresCol="x", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed),
    ]
    return Pipeline(stages=stages).fit(rows)


def predicted(model, rows: DataFrame) -> DataFrame:
    """rows with guess, the label of the class that the fitted pipeline predicts."""
    from pyspark.ml.feature import IndexToString

    names = IndexToString(inputCol="prediction", outputCol="guess", labels=list(model.stages[0].labels))
    return names.transform(model.transform(rows)).drop("x", "rawPrediction", "probability", "prediction", "label")
