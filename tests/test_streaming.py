from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lunaria.streaming import epochs


def test_epoch_aggregates(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    rows = [("a", "x", t0 + dt.timedelta(seconds=s), float(s)) for s in (0, 10, 31, 400)]
    spark.createDataFrame(rows, epochs.SAMPLES).write.parquet(str(tmp_path / "in"))
    s = epochs.read_samples(spark, str(tmp_path / "in"))
    q = epochs.epoch_stats(s).writeStream.format("memory").queryName("stats").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    out = spark.table("stats").orderBy("start").collect()
    assert [(r.n, r["min"], r["max"], r["mean"]) for r in out] == [(2, 0.0, 10.0, 5.0), (1, 31.0, 31.0, 31.0)]


def test_artifacts_and_sessions(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    rows = [("a", "x", t0 + dt.timedelta(seconds=s), 1.0) for s in (0, 10, 31, 800)]
    spark.createDataFrame(rows, epochs.SAMPLES).write.parquet(str(tmp_path / "in"))
    s = epochs.read_samples(spark, str(tmp_path / "in"))
    pulse = s.withColumn("quality", F.lit(0.9)).withColumn("ibi", F.when(F.second("ts") == 0, 800.0).otherwise(100.0))
    for name, df in (("art", epochs.artifact_epochs(pulse)), ("spells", epochs.sensor_sessions(s))):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").start()
        q.processAllAvailable()
        q.stop()
    assert [(r.valid_ratio, r.is_artifact) for r in spark.table("art").orderBy("start").collect()] == [(0.5, False), (0.0, True)]
    assert [r.n for r in spark.table("spells").collect()] == [3]
