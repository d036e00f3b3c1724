"""Whole jobs over datasets of EDF recordings: load, run a pipeline, export signals, annotations and a
catalog, resume. Each job is a few plans; recordings are never looped over on the driver."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .errors import AnnotationsMissing, ChannelCountMismatch, MissingChannel, RateMismatch
from .operators import aggregate, boost, dsp, evaluate, features, merge, metrics, models, scores, select, train
from .plans.pipeline import Pipeline, rename_only
from .plans.transforms import Signal, fir, resample_to, stacked
from .schema import EPOCH_S, SHORT_LABELS, STAGE_CLASSES, UNKNOWN, UNSCORED
from .sinks import export, transactions
from .sinks.policy import Existing, OnError, delete, exists
from .sources import edf, edfsource, recordings, store, text
from .sources.recordings import DatasetConfig


@dataclass
class Loaded:
    """A dataset's recordings, its channels as signals, its annotations, and what could not be used."""

    recordings: DataFrame
    signals: dict[str, Signal]
    annotations: DataFrame | None
    errors: DataFrame


def load_edf(spark: SparkSession, config: DatasetConfig, channels: Sequence[str], on_error: OnError = OnError.RAISE, done: DataFrame | None = None, retry_failed: bool = True) -> Loaded:
    """Channels (labels as in channel_label) of all recordings that have them all. Recordings without
    one are an error, or, with SKIP, are left out and listed. `done` is a catalog: what it holds is
    not read again."""
    recs = recordings.scan(spark, config)
    if done is not None:
        recs = merge.pending(recs, done, retry_failed=retry_failed)
    glob = f"{config.data_dir.rstrip('/')}/{config.pattern.strip('/')}"
    folder = F.regexp_replace("path", r"/[^/]*$", "")
    stem = F.replace(F.replace(F.regexp_extract("path", r"([^/]+)\.[^./]*$", 1), F.lit("%20"), F.lit(" ")), F.lit(" "), F.lit("_"))
    files = edf.files(spark, glob, channels).select(folder.alias("folder"), stem.alias("channel")).where(F.col("channel").isin(*channels))
    have = recs.join(files, "folder").groupBy("recording_id").agg(F.array_sort(F.collect_set("channel")).alias("have"))
    lost = F.array_except(F.array(*map(F.lit, sorted(set(channels)))), F.coalesce("have", F.array().cast("array<string>")))
    state = recs.join(have, "recording_id", "left").withColumn("lost", lost)
    errors = state.where(F.size("lost") > 0).select("recording_id", F.concat(F.lit("missing channels: "), F.array_join("lost", ", ")).alias("error_message"))
    if on_error is OnError.RAISE and (first := errors.limit(1).collect()):
        raise MissingChannel(f"{first[0].recording_id}: {first[0].error_message}")
    # a row a recording, kept: Spark then knows its size, so blocks of samples are not shuffled to it
    fine = state.where(F.size("lost") == 0).select(*recs.columns).persist()
    several = fine.count()
    own = annotations(spark, config, fine) if config.scoring_pattern else None
    if not several:
        return Loaded(fine, {}, own, errors)
    # when resuming, only the folders that are left are listed (a path a recording); otherwise the pattern is
    paths = glob if done is None else [r.folder.replace("%20", " ") for r in fine.select("folder").collect()]
    named = lambda df: df.withColumn("channel", stem).withColumn("place", _place(folder)).join(fine.select(_place(F.col("folder")).alias("place"), "recording_id"), "place")
    ranged = edfsource.readable(config.data_dir)
    heads = edfsource.read_headers(spark, paths, channels) if ranged else edf.read_rates(spark, paths, channels).withColumn("n_samples", F.lit(None).cast("long"))
    heads = named(heads).select("recording_id", "channel", "sample_rate", F.col("n_samples").alias("n")).persist()
    rates: dict[str, set[float]] = {c: set() for c in channels}
    for r in heads.select("channel", "sample_rate").distinct().collect():  # a row per channel and rate
        rates[r.channel].add(r.sample_rate)
    if odd := [c for c, r in rates.items() if len(r) > 1]:
        raise RateMismatch(f"{config.name}: {', '.join(odd)} have several rates")
    if (two := heads.groupBy("recording_id", "channel").count().where("count > 1").first()) is not None:
        raise ChannelCountMismatch(f"{two.recording_id}: the file {two.channel} holds {two['count']} signals")
    signals = {}
    for c, r in rates.items():  # a plan of its own for each channel, which opens that channel's files alone
        if r:
            blocks = edfsource.read_signals(spark, paths, [c]) if ranged else edf.read_edf(spark, paths, [c])
            sizes = heads.where(F.col("channel") == c).select("recording_id", "channel", "n") if ranged else None
            signals[c] = Signal(edf.to_long(named(blocks), ("recording_id",)), (c,), min(r), sizes)
    return Loaded(fine, signals, own, errors)


def _place(folder: Column) -> Column:
    """A folder's path in one spelling, as Spark's readers and Arrow's differ in theirs."""
    return F.regexp_replace(F.replace(folder, F.lit("%20"), F.lit(" ")), r"^([A-Za-z0-9]+):/+", "$1:/")


def annotation_codes(spark: SparkSession, config: DatasetConfig, recs: DataFrame, annotation_type: str = text.SLEEP_STAGE) -> DataFrame:
    """(recording_id, epoch_idx, code) from the scoring files that the recordings' names lead to."""
    named = recordings.scoring_path(recs, config).select("recording_id", F.element_at(F.split("scoring_file", "/"), -1).alias("file"))
    root = config.data_dir.rstrip("/")
    pattern = config.scoring_pattern.replace("{subject_id}", "*").replace("{session_id}", "*")
    codes = text.pick_annotation(text.read_scoring(spark, f"{root}/{pattern}"), annotation_type)
    codes = codes.withColumn("file", F.replace(F.element_at(F.split("path", "/"), -1), F.lit("%20"), F.lit(" ")))
    return named.join(codes, "file").select("recording_id", "epoch_idx", "code")


def annotations(spark: SparkSession, config: DatasetConfig, recs: DataFrame, annotation_type: str = text.SLEEP_STAGE) -> DataFrame:
    """(recording_id, epoch_idx, label) of annotation_codes, by the dataset's mapping."""
    codes = annotation_codes(spark, config, recs, annotation_type)
    return select.map_labels(codes, config.mapping, UNKNOWN).select("recording_id", "epoch_idx", "label")


def process(spark: SparkSession, config: DatasetConfig, pipeline: Pipeline, root: str, outputs: Iterable[str] | None = None, existing: Existing = Existing.RAISE, on_error: OnError = OnError.RAISE, resume: bool = True, versioned: bool = False) -> DataFrame:
    """Runs a pipeline over a dataset and writes signals, runs of labels and the catalog; gives the catalog.
    If versioned, signals go to the versioned store in <root>/store, as a whole or not at all."""
    book = f"{root}/catalog"
    done = text.read_catalog(spark, book) if resume and exists(spark.range(0), book) else None
    names = sorted(pipeline.missing(()))
    loaded = load_edf(spark, config, names, on_error, done)
    wanted = list(outputs or dict.fromkeys(o for s in pipeline.steps for o in s.outputs))
    made = pipeline.together(loaded.signals, wanted) if loaded.signals else []
    if made:
        frames = [s.df.select(F.lit(config.name).alias("dataset"), "recording_id", "channel", "sample_idx", F.col("value").cast("double").alias("value")) for s in made]
        # computed once, into a table beside the output: lengths, checks, statistics and the output read that
        stage = f"{root}/.stage-{uuid.uuid4().hex}"
        try:
            reduce(DataFrame.unionByName, frames).write.parquet(stage)
            return _store(spark, spark.read.parquet(stage), made, wanted, loaded, root, existing if done is None else Existing.APPEND, versioned)
        finally:
            delete(spark, stage)
    return text.read_catalog(spark, book) if done is not None else loaded.errors


def _store(spark: SparkSession, signal: DataFrame, made: Sequence[Signal], wanted: Sequence[str], loaded: Loaded, root: str, existing: Existing, versioned: bool) -> DataFrame:
    """Writes signals with their metadata, runs of labels and the catalog; gives the catalog."""
    names = {c for s in made for c in s.channels}
    rates = spark.createDataFrame([(c, s.rate) for s in made for c in s.channels], "channel string, sample_rate double")
    meta = signal.groupBy("dataset", "recording_id", "channel").agg(F.count(F.lit(1)).alias("n_samples")).join(rates, "channel")
    meta = meta.select("dataset", "recording_id", "channel", "sample_rate", "n_samples")
    if versioned:
        transactions.store_signals(signal, f"{root}/store", {c: s.rate for s in made for c in s.channels})
    else:
        export.write_signals(signal, meta, root, existing)
    if loaded.annotations is not None:
        export.write_runs(loaded.annotations, f"{root}/runs", Existing.OVERWRITE)
    every = loaded.recordings.select("recording_id").union(loaded.errors.select("recording_id"))
    rows = export.catalog(every, signal, meta, [n for n in wanted if n in names], loaded.annotations, (*STAGE_CLASSES, UNKNOWN), loaded.errors)
    return export.update_catalog(rows, f"{root}/catalog")


def export_channels(spark: SparkSession, config: DatasetConfig, names: Mapping[str, str], root: str, rate: float | None = None, **policies) -> DataFrame:
    """Channels renamed and, if a rate is given, resampled, then exported like a pipeline's outputs."""
    return process(spark, config, rename_only("export", names, rate), root, **policies)


def export_intervals(spark: SparkSession, config: DatasetConfig, pulse: str, root: str, pipeline: Pipeline, on_error: OnError = OnError.RAISE) -> DataFrame:
    """Measures of beat intervals per recording: (recording_id, n_beats, mean_ibi, ..., and all of interval_measures)."""
    loaded = load_edf(spark, config, [pulse], on_error)
    made = stacked(pipeline.together({"PPG": loaded.signals[pulse]}, ["PPG_peaks", "PPG_ibi"]))
    of = lambda c: F.max(F.when(F.col("channel") == c, F.col("value")))
    wide = made.df.groupBy("recording_id", "sample_idx").agg(of("PPG_peaks").alias("peak"), of("PPG_ibi").alias("ibi"))
    # a row a beat, kept, so that the measures do not process the pulse wave again each
    beats = wide.where("peak = 1").select("recording_id", "sample_idx", "ibi").persist()
    names = ("sdsd", "pnn20", "hr_mad", "sd1", "sd2", "s", "sd1_sd2", "breathingrate")  # what beat_measures has not got
    try:
        beats.count()
        out = aggregate.beat_measures(beats).join(aggregate.interval_measures(beats, made.rate).select("recording_id", *names), "recording_id")
        export.write_csv(out.coalesce(1), root)
    finally:
        beats.unpersist()
    return spark.read.csv(root, header=True, inferSchema=True)


AGGREGATED = "aggregated"


def score_stages(
    spark: SparkSession, config: DatasetConfig, groups: Sequence[Sequence[str]], factory: Callable, root: str, threshold: float = 0.0, low: float = 0.3, high: float = 30.0, model_rate: float = 128.0,
    on_error: OnError = OnError.RAISE, confidences: bool = False, each: bool = False, filtered: bool = True,
) -> DataFrame:
    """(recording_id, channel_group, epoch_idx, ts_ns, stage): band-pass (unless filtered is off), resample, a
    model per channel group, the consensus of the groups' confident labels, as group 'aggregated'; written as
    CSV. ts_ns is the time of a prediction, the middle of its samples.

    With confidences the rows are (recording_id, channel_group, epoch_idx, ts_ns, class_idx, prob) instead, and
    the groups' probabilities are averaged. With each, every group's own rows stand beside the aggregate.
    """
    names = sorted({c for g in groups for c in g})
    loaded = load_edf(spark, config, names, on_error)
    key, given = ("recording_id", "channel_group", "epoch_idx", "ts_ns"), list(loaded.signals.values())
    if not given:
        raise MissingChannel(f"{config.name}: no recording has all of {', '.join(names)}")
    clean = [fir(s, low, min(high, 0.45 * s.rate)) if filtered else s for s in given]
    signal = stacked([resample_to(s, model_rate) for s in clean])
    scored = models.score_groups(signal.df, model_rate, groups, factory, EPOCH_S, times=given[0].rate)
    if confidences:
        own = scores.mean_groups(scored, key)
        whole = own.groupBy("recording_id", "epoch_idx", "ts_ns", "class_idx").agg(F.avg("prob").alias("prob"))
    else:
        own = scored.select(*key, scores.confident("probs", threshold).alias("stage"))
        whole = scores.consensus_many(own.withColumnRenamed("stage", "label"), ("recording_id", "epoch_idx", "ts_ns")).withColumnRenamed("label", "stage")
    out = whole.withColumn("channel_group", F.lit(AGGREGATED)).select(*own.columns)
    out = out.unionByName(own) if each else out
    export.write_csv(out.repartition("recording_id").sortWithinPartitions(*key[:3]), root)
    return out


def evaluate_events(spark: SparkSession, datasets: Sequence[tuple[DatasetConfig, str]], channels: Sequence[str], factory: Callable, detector: evaluate.Detector, out: str, period_s: float = 0.5) -> DataFrame:
    """(dataset, precision, recall, f1, accuracy, recording_count): means over recordings for each dataset
    and in total, of events (arousals) that a detector finds in a model's class probabilities.

    datasets pairs each configuration with the native store of its signals. The model scores each channel
    by itself every period_s seconds, and the channels' probabilities are averaged. Truth and sleep stages
    come from the scoring files, cut to the predicted epochs; epochs outside deep sleep, recordings that
    are not stored, and recordings without a true event are left out. The table is written as CSV.
    """
    per = None
    for config, root in datasets:
        if not config.scoring_pattern:
            raise AnnotationsMissing(f"{config.name} has no scoring pattern")
        recs = recordings.scan(spark, config)
        meta = store.read_meta(spark, root).where(F.col("channel").isin(*channels))
        rates = sorted({(r.channel, r.sample_rate) for r in meta.select("channel", "sample_rate").distinct().collect()})
        if lost := set(channels) - {c for c, _ in rates}:
            raise MissingChannel(f"{config.name}: {', '.join(sorted(lost))}")
        if len({r for _, r in rates}) > 1:
            raise RateMismatch(f"{config.name}: {rates}")
        signal = store.read_signal(spark, root, channels).join(recs.select("recording_id"), "recording_id", "left_semi")
        scored = models.score_sleep(signal, rates[0][1], [[c] for c in channels], factory, period_s)
        found = evaluate.detect_intervals(scored, detector)
        lengths = scored.groupBy("recording_id").agg((F.max("epoch_idx") + 1).alias("n_samples"))
        guess = evaluate.predicted_epochs(lengths, found, int(EPOCH_S / period_s))
        truth = annotation_codes(spark, config, recs, text.AROUSAL).withColumnRenamed("code", "truth")
        stages = annotation_codes(spark, config, recs).withColumnRenamed("code", "stage")
        mine = evaluate.evaluated(guess, truth, stages).withColumn("dataset", F.lit(config.name))
        per = mine if per is None else per.unionByName(mine)
    table = metrics.macro(per, evaluate.MEASURES, count="recording_count")
    export.write_csv(table.coalesce(1), out)  # a row a dataset
    return spark.read.csv(out, header=True, inferSchema=True)


def export_features(spark: SparkSession, config: DatasetConfig, eeg_channel: str, out: str, eog_channel: str | None = None, sampling_frequency: float = 100.0, test_split_size: float = 0.2, seed: int = 0, existing: Existing = Existing.RAISE, on_error: OnError = OnError.RAISE) -> DataFrame:
    """Epoch features of an EEG (and an EOG) channel with stages, as one sorted Parquet table with
    (set, dataset, subj, session, epoch_idx, stage, eeg_..., eog_...).

    Channels are resampled; recordings whose channels or whose hypnogram differ in length are an error or,
    with SKIP, left out. A share of the subjects is the test set. With APPEND, rows that are there stay.
    """
    skip = on_error is OnError.SKIP
    kinds = {"eeg": eeg_channel} | ({"eog": eog_channel} if eog_channel else {})
    loaded = load_edf(spark, config, list(kinds.values()), on_error)
    if not loaded.signals or loaded.annotations is None:
        raise AnnotationsMissing(f"no features extracted for {config.name}")
    signal = None
    for c in kinds.values():
        s = dsp.resample_signal(loaded.signals[c].df, loaded.signals[c].rate, sampling_frequency, key=("recording_id", "channel"))
        signal = s if signal is None else signal.unionByName(s)
    own = features.combine_channels(signal, list(kinds.values()), skip)
    table = features.epoch_features(own, sampling_frequency, kinds, EPOCH_S)
    stage = loaded.annotations.withColumn("stage", select.lookup(F.col("label"), SHORT_LABELS, UNSCORED)).select("recording_id", "epoch_idx", "stage")
    scored = train.with_hypnogram(table, stage.join(loaded.recordings.select("recording_id"), "recording_id", "left_semi"), skip=skip)
    named = scored.join(loaded.recordings.select("recording_id", F.col("subject_id").alias("subj"), F.col("session_id").alias("session")), "recording_id").drop("recording_id")
    rows = features.feature_table([named.withColumn("dataset", F.lit(config.name))], test_split_size, seed)
    export.write_features(rows, out, existing)
    return store.read_features(spark, out)


def train_stages(
    spark: SparkSession, path: str, prefixes: Sequence[str], out: str, weights: Mapping[str, float] | None = None, trees: int = 50, depth: int = 6,
    boosted: bool = False, patience: int = 10,
) -> DataFrame:
    """Fits a classifier on the train set of a feature table, saves it to a new folder, and gives the report
    (label, precision, recall, f1, support) over the test set, or over the train set if there is no other.
    It is a forest or, if boosted, boosted trees, at most so many rounds, which end early by the loss over a
    fifth of the train set's subjects."""
    table = store.read_features(spark, path)
    rows = table.where("set = 'train'")
    test, names = train.training_rows(table.where("set = 'test'"), prefixes)
    if test.isEmpty():
        test = rows.where(F.col("stage") != UNSCORED)
    if boosted:
        model = boost.train(rows.where(F.col("stage") != UNSCORED), names, "stage", "subj", weights, trees=trees, depth=depth, patience=patience)
        model.save(spark, out)
        guessed = model.predicted(test)
    else:
        model = train.train(rows, prefixes, weights, trees, depth)
        model.save(out)
        guessed = train.predicted(model, test)
    return metrics.class_report(guessed, "stage", "guess").orderBy("label")
