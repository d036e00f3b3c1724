"""Command line: python -m lunaria.cli {process,export,intervals,score,usability,features,train,evaluate,pipelines} ..."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession

from . import jobs
from .operators import models
from .plans import pipeline
from .sinks import export
from .sinks.policy import Existing, OnError


def factory(name: str):
    """module:function, a maker of the model."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def plan(name: str) -> pipeline.Pipeline:
    return pipeline.load(name) if Path(name).exists() else pipeline.bundled(name)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lunaria", description=__doc__)
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("process", "export", "intervals", "score", "usability", "features", "evaluate"):
        s = sub.add_parser(name)
        s.add_argument("--datasets", required=True, help="YAML list of datasets")
        s.add_argument("--dataset", action="append", required=True)
        s.add_argument("--out", required=True)
        s.add_argument("--existing", choices=[e.name for e in Existing], default="RAISE")
        s.add_argument("--on-error", choices=[e.name for e in OnError], default="RAISE")
        if name in ("process", "intervals"):
            s.add_argument("--pipeline", default="ppg", help="a bundled pipeline or a YAML file")
        if name == "process":
            s.add_argument("--output", action="append")
        if name == "export":
            s.add_argument("--rename", action="append", required=True, help="CHANNEL=NAME")
            s.add_argument("--rate", type=float)
        if name == "intervals":
            s.add_argument("--pulse", required=True)
        if name == "features":
            s.add_argument("--eeg", required=True)
            s.add_argument("--eog")
            s.add_argument("--rate", type=float, default=100.0)
            s.add_argument("--test-share", type=float, default=0.2)
        if name == "evaluate":
            s.add_argument("--store", action="append", required=True, help="the native store of each dataset, in order")
            s.add_argument("--detector", required=True, help="module:function that finds intervals in class probabilities")
            s.add_argument("--period", type=float, default=0.5, help="seconds a prediction")
        if name in ("score", "usability", "evaluate"):
            s.add_argument("--model", required=True, help="module:function that makes the model")
            s.add_argument("--channels", action="append", required=True, help="A,B: a channel group")
        if name == "score":
            s.add_argument("--threshold", type=float, default=0.0)
            s.add_argument("--confidences", action="store_true", help="class probabilities instead of stages")
            s.add_argument("--each", action="store_true", help="the channel groups' own rows as well")
            s.add_argument("--no-filter", action="store_true")
        if name == "usability":
            s.add_argument("--movement", required=True)
            s.add_argument("--features", type=int, required=True)
    t = sub.add_parser("train")
    t.add_argument("--features", required=True, help="a table that the job features has made")
    t.add_argument("--prefix", action="append", required=True, help="of feature columns, such as eeg_")
    t.add_argument("--weight", action="append", default=[], help="STAGE=WEIGHT")
    t.add_argument("--out", required=True, help="folder of the fitted model")
    t.add_argument("--trees", type=int, default=50)
    t.add_argument("--depth", type=int, default=6)
    t.add_argument("--boosted", action="store_true", help="boosted trees that stop early, instead of a forest")
    sub.add_parser("pipelines")
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    if a.job == "pipelines":
        print("\n".join(sorted(f.stem for f in pipeline.FOLDER.glob("*.yaml"))))
        return
    spark = spark or SparkSession.builder.appName(f"lunaria {a.job}").getOrCreate()
    if a.job == "train":
        jobs.train_stages(spark, a.features, a.prefix, a.out, {k: float(v) for k, v in (w.split("=", 1) for w in a.weight)}, a.trees, a.depth, a.boosted).show(truncate=False)
        return
    existing, on_error = Existing[a.existing], OnError[a.on_error]
    if a.job == "evaluate":
        chosen = list(zip(pipeline.Datasets.load(a.datasets).choose(a.dataset), a.store, strict=True))
        channels = [c for g in a.channels for c in g.split(",")]
        jobs.evaluate_events(spark, chosen, channels, factory(a.model), factory(a.detector), a.out, a.period).show(truncate=False)
        return
    for config in pipeline.Datasets.load(a.datasets).choose(a.dataset):
        out = f"{a.out}/{config.name}"
        if a.job == "process":
            jobs.process(spark, config, plan(a.pipeline), out, a.output, existing, on_error)
        elif a.job == "export":
            jobs.export_channels(spark, config, dict(r.split("=", 1) for r in a.rename), out, a.rate, existing=existing, on_error=on_error)
        elif a.job == "intervals":
            jobs.export_intervals(spark, config, a.pulse, out, plan(a.pipeline), on_error)
        elif a.job == "features":
            jobs.export_features(spark, config, a.eeg, out, a.eog, a.rate, a.test_share, existing=existing, on_error=on_error)
        elif a.job == "score":
            jobs.score_stages(spark, config, [g.split(",") for g in a.channels], factory(a.model), out, a.threshold, on_error=on_error, confidences=a.confidences, each=a.each, filtered=not a.no_filter)
        else:
            eeg = [c for g in a.channels for c in g.split(",")]
            loaded = jobs.load_edf(spark, config, [*eeg, a.movement], on_error)
            signal = loaded.signals[eeg[0]].df
            for c in dict.fromkeys(c for c in (*eeg[1:], a.movement) if c != eeg[0]):
                signal = signal.unionByName(loaded.signals[c].df)
            scored = models.score_usability(signal, loaded.signals[eeg[0]].rate, eeg, a.movement, factory(a.model), a.features)
            export.write_usability(scored, out, eeg[0], eeg[-1], existing)


if __name__ == "__main__":
    main()
