"""Epoch features of EEG and EOG with their stages, for training."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import DurationMismatch
from ..functions import complexity, spectro
from . import split
from .segment import frame_channels
from .select import KEY


def unequal_lengths(signal: DataFrame, channels: Sequence[str], key: Sequence[str] = KEY) -> DataFrame:
    """(key, lengths) of recordings whose channels differ in length or are not all there."""
    n = signal.where(F.col("channel").isin(*channels)).groupBy(*key, "channel").agg(F.count(F.lit(1)).alias("n"))
    per = n.groupBy(*key).agg(F.min("n").alias("a"), F.max("n").alias("b"), F.count(F.lit(1)).alias("k"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("channel", "n")))).alias("lengths"))
    return per.where((F.col("a") != F.col("b")) | (F.col("k") != len(channels))).select(*key, "lengths")


def combine_channels(signal: DataFrame, channels: Sequence[str], skip: bool = False, key: Sequence[str] = KEY) -> DataFrame:
    """The channels of each recording, which must be equally long: others are an error or, with skip,
    are left out. One narrow aggregate over the signal finds them; no alignment cuts them in silence."""
    odd = unequal_lengths(signal, channels, key)
    own = signal.where(F.col("channel").isin(*channels))
    if skip:
        return own.join(odd.select(*key), list(key), "left_anti")
    if (bad := odd.orderBy(*key).first()) is not None:
        raise DurationMismatch(f"{[bad[k] for k in key]}: {bad.lengths}")
    return own


def epoch_features(signal: DataFrame, rate: float, channels: dict[str, str], period_s: float = 30.0, key: Sequence[str] = KEY) -> DataFrame:
    """(key, epoch_idx, <prefix>_<feature>...) of whole epochs; channels maps prefixes (eeg, eog) to
    channels. All channels of an epoch are framed in one shuffle."""
    return _kernel_features(signal, rate, channels, period_s, key, lambda x: spectro.features(x, rate), spectro.FEATURES)


def feature_table(parts: Sequence[DataFrame], share: float = 0.2, seed: int = 0) -> DataFrame:
    """The parts (dataset, subj, session, epoch_idx, ...; columns that one lacks are null there) as one
    table with set: test for a share of the subjects, train for the others."""
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return split.split_subjects(whole, share, seed)


def globally_sorted(features: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows in order of set, dataset, subject, session and epoch: a range partition, then a sort within."""
    by = [c for c in ("set", "dataset", "subj", "session", "epoch_idx") if c in features.columns]
    ranged = features.repartitionByRange(partitions, *by) if partitions else features.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by)



def _kernel_features(signal: DataFrame, rate: float, channels: dict[str, str], period_s: float, key: Sequence[str], kernel: Callable[[np.ndarray], np.ndarray], names: Sequence[str]) -> DataFrame:
    """(key, epoch_idx, <prefix>_<name>...) of whole epochs, all channels framed in one shuffle."""
    columns = [f"{p}_{f}" for p in channels for f in names]
    frames = frame_channels(signal, list(channels.values()), int(period_s * rate), key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = len(key) + 1
        for batch in batches:
            if batch.num_rows:
                x = [batch.column(at + i).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for i in range(len(channels))]
                y = np.hstack([kernel(v) for v in x])
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(at)), *map(pa.array, y.T)], [*key, "epoch_idx", *columns])

    kinds = ", ".join(f"{k} {frames.schema[k].dataType.simpleString()}" for k in key)
    slim = frames.select(*key, F.col("period_idx").alias("epoch_idx"), *[f"c{i}" for i in range(len(channels))])
    return slim.mapInArrow(run, f"{kinds}, epoch_idx long, " + ", ".join(f"`{n}` double" for n in columns))


def epoch_complexity(signal: DataFrame, rate: float, channels: dict[str, str], period_s: float = 30.0, key: Sequence[str] = KEY) -> DataFrame:
    """Entropy of ordinal patterns, fractal dimensions and Hjorth parameters of each epoch."""
    return _kernel_features(signal, rate, channels, period_s, key, complexity.complexity, complexity.COMPLEXITY)


def epoch_models(signal: DataFrame, rate: float, channels: dict[str, str], period_s: float = 30.0, key: Sequence[str] = KEY) -> DataFrame:
    """Wavelet energies, linear prediction, cepstra and Lempel-Ziv complexity of each epoch."""
    return _kernel_features(signal, rate, channels, period_s, key, complexity.models, complexity.MODELS)


#: Epochs of the centred window and of the past one: 7.5 and 2 minutes of 30 s.
CENTRED, PAST = 15, 4


def smoothed(features: DataFrame, names: Sequence[str], key: Sequence[str] = KEY, centred: int = CENTRED, past: int = PAST) -> DataFrame:
    """features(key, epoch_idx, names...) with <name>_centred and <name>_past: means over the epochs around each one
    (weights fall to both sides as a triangle's) and over the last ones, both less the recording's median and in
    units of the range from its 5th to its 95th percentile (0 where that is empty). At a recording's ends means
    are over what there is; nulls and NaN are left out."""
    key, half = list(key), centred // 2
    by = Window.partitionBy(*key).orderBy("epoch_idx")
    made = {}
    for c in names:
        own = F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`").cast("double"))
        near = [(half + 1 - abs(k), F.lag(own, k).over(by)) for k in range(-half, half + 1)]
        total = sum((w * F.coalesce(v, F.lit(0.0)) for w, v in near), F.lit(0.0))
        made[f"{c}_centred"] = F.try_divide(total, sum((F.when(v.isNotNull(), float(w)).otherwise(0.0) for w, v in near), F.lit(0.0)))
        made[f"{c}_past"] = F.avg(own).over(by.rowsBetween(1 - past, 0))
    out = features.withColumns(made)
    spread = out.groupBy(*key).agg(*[F.percentile(f"`{c}`", F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95))).alias(f"__{c}") for c in made])
    scaled = {c: F.coalesce(F.try_divide(F.col(f"`{c}`") - F.get(f"`__{c}`", F.lit(1)), F.get(f"`__{c}`", F.lit(2)) - F.get(f"`__{c}`", F.lit(0))), F.when(F.col(f"`{c}`").isNotNull(), 0.0)) for c in made}
    return out.join(spread, key).withColumns(scaled).drop(*[f"__{c}" for c in made])


def sleep_features(signal: DataFrame, rate: float, channels: dict[str, str], period_s: float = 30.0, key: Sequence[str] = KEY) -> DataFrame:
    """Statistics, spectra, complexity and band ratios of each epoch, with all of them smoothed."""
    on = [*key, "epoch_idx"]
    own = epoch_features(signal, rate, channels, period_s, key).join(epoch_complexity(signal, rate, channels, period_s, key), on)
    ratios = {f"{p}_{a}_{b}": F.coalesce(F.try_divide(F.col(f"{p}_{a}"), F.col(f"{p}_{b}")), F.lit(0.0)) for p in channels for a, b in (("delta", "theta"), ("delta", "sigma"), ("delta", "beta"), ("alpha", "theta"))}
    own = own.withColumns(ratios)
    return smoothed(own, [c for c in own.columns if c not in on], key)
