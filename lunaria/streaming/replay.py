"""A bounded table through a streaming job, so that recordings at rest get what live ones get."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.select import KEY
from ..scratch import folder

END = "__end"  # the channel of the sample that closes a replay


def replay(samples: DataFrame, job: Callable[[DataFrame, str], DataFrame], files_per_trigger: int = 8) -> DataFrame:
    """job(stream, lateness) over samples(recording_id, channel, sample_idx, ts, value), run to its end.

    The table is written to the shared folder and read as a stream, in any order of its files: the lateness
    that job gets is the table's span of time. Then the stream is taken up again with one sample behind all
    others, so that the watermark passes them and all stretches end. An empty table gives an empty result."""
    spark = samples.sparkSession
    base = f"{folder(spark)}/lunaria-{spark.sparkContext.applicationId}/replay-{uuid.uuid4().hex}"
    samples = samples.select(*KEY, "channel", F.col("sample_idx").cast("long").alias("sample_idx"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("double").alias("value"))
    samples.write.parquet(f"{base}/in")
    written = spark.read.schema(samples.schema).parquet(f"{base}/in")
    span = written.agg(*[F.max(k).alias(k) for k in KEY], F.max("ts").alias("ts"), F.expr("datediff(max(ts), min(ts))").alias("days")).first()
    days = (span.days or 0) + 2
    stream = spark.readStream.schema(samples.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{base}/in")
    out = job(stream, f"{days} days")

    def drain() -> None:
        out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()

    drain()
    if span.ts is not None:
        last = written.limit(1).select(*[F.lit(span[k]).cast(samples.schema[k].dataType).alias(k) for k in KEY], F.lit(END).alias("channel"), F.lit(0).cast("long").alias("sample_idx"), (F.lit(span.ts) + F.expr(f"INTERVAL {2 * days} DAYS")).alias("ts"), F.lit(0.0).alias("value"))
        last.write.mode("append").parquet(f"{base}/in")
        drain()
    return spark.read.schema(out.schema).parquet(f"{base}/out").where(F.col("channel") != END)
