"""Text formats: run-length stages, per-epoch scorings, lookups and catalogs. Line numbers are kept by
reading a file as one row and exploding its lines, so no order is lost to splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import AnnotationsMissing

SLEEP_STAGE, AROUSAL = "SLEEP_STAGE", "AROUSAL"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, line) of non-blank lines, numbered from 0 within each file."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    each = whole.select("path", F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))
    return each.where(F.trim("line") != "")


def _number(c: Column, kind: str, line: Column) -> Column:
    return F.coalesce(c.try_cast(kind), F.raise_error(F.concat(F.lit("not a number in: "), line)).cast(kind))


def read_runs(spark: SparkSession, path: str, annotation_type: str = SLEEP_STAGE) -> DataFrame:
    """(path, run_no, start_s, duration_s, label) of `start,duration,stage` lines. Only sleep stages
    come in this format."""
    if annotation_type != SLEEP_STAGE:
        raise AnnotationsMissing(f"{annotation_type} has no run-length format")
    f = F.split("line", ",")
    part = lambda k: F.trim(F.get(f, F.lit(k)))
    return lines(spark, path).select("path", F.col("line_no").cast("long").alias("run_no"), _number(part(0), "long", F.col("line")).alias("start_s"), _number(part(1), "long", F.col("line")).alias("duration_s"), part(2).alias("label"))


def read_scoring(spark: SparkSession, path: str) -> DataFrame:
    """(path, epoch_idx, sleep_stage, arousal) of lines with exactly two whole numbers, apart by blank or
    tab; another number of fields is an error rather than a silent shift."""
    f = F.split(F.trim("line"), r"[ \t]+")
    two = F.when(F.size(f) == 2, f).otherwise(F.raise_error(F.concat(F.lit("two fields expected: "), "line")).cast("array<string>"))
    x = lines(spark, path).withColumn("f", two)
    return x.select("path", F.col("line_no").cast("long").alias("epoch_idx"), _number(F.get("f", F.lit(0)), "int", F.col("line")).alias("sleep_stage"), _number(F.get("f", F.lit(1)), "int", F.col("line")).alias("arousal"))


def pick_annotation(scoring: DataFrame, annotation_type: str) -> DataFrame:
    """(path, epoch_idx, code) of one annotation type."""
    column = {SLEEP_STAGE: "sleep_stage", AROUSAL: "arousal"}.get(annotation_type)
    if column is None:
        raise AnnotationsMissing(annotation_type)
    return scoring.select("path", "epoch_idx", F.col(column).alias("code"))


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """(session_id, scoring_file) of a headerless CSV."""
    return spark.read.csv(path, schema="session_id string, scoring_file string")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A catalog CSV with header; columns are text, but for the known counts and measures."""
    df = spark.read.csv(path, header=True)
    number = [c for c in df.columns if c in ("length", "duration") or c.endswith(("_count", "_min", "_max", "_mean", "_std"))]
    return df.withColumns({c: F.col(c).try_cast("double") for c in number})
