"""Finding recordings and their scorings. Listings come from file metadata; contents stay unread."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import UnknownName
from ..operators.merge import attach_unique


def part(path: Column, k: int) -> Column:
    """The k-th path element from the end, 1 being the last."""
    return F.element_at(F.split(path, "/"), -k)


#: How (subject, session) follow from a recording's folder.
ID_RULES: dict[str, Callable[[Column], tuple[Column, Column]]] = {
    "parent_name": lambda p: (F.replace(part(p, 2), F.lit("_"), F.lit("")), F.replace(part(p, 1), F.lit("_"), F.lit(""))),
    "grandparent_parent": lambda p: (part(p, 3), part(p, 2)),
    "grandparent_name": lambda p: (part(p, 3), part(p, 1)),
    "constant_name": lambda p: (F.lit("s1"), part(p, 1)),
}


@dataclass(frozen=True)
class DatasetConfig:
    """A dataset: where its recordings are, how they are named, and how stages are coded."""

    name: str
    data_dir: str
    pattern: str = "*/*"
    id_rule: str = "grandparent_parent"
    scoring_pattern: str | None = None
    strip_prefix: str = ""
    mapping: dict[int, str] = field(default_factory=dict)


def folders(spark: SparkSession, config: DatasetConfig, suffix: str = "*.edf") -> DataFrame:
    """Distinct folders that match the dataset's pattern and hold a file of the format."""
    glob = f"{config.data_dir.rstrip('/')}/{config.pattern.strip('/')}/{suffix}"
    files = spark.read.format("binaryFile").load(glob).select("path")
    return files.select(F.regexp_replace("path", r"/[^/]*$", "").alias("folder")).distinct()


def scan(spark: SparkSession, config: DatasetConfig, suffix: str = "*.edf") -> DataFrame:
    """(dataset, recording_id, subject_id, session_id, folder); of folders with one id the last counts."""
    if config.id_rule not in ID_RULES:
        raise UnknownName(config.id_rule)
    subject, session = ID_RULES[config.id_rule](F.col("folder"))
    found = folders(spark, config, suffix).select(subject.alias("subject_id"), session.alias("session_id"), "folder")
    one = found.groupBy("subject_id", "session_id").agg(F.max("folder").alias("folder"))
    return one.select(F.lit(config.name).alias("dataset"), F.concat_ws("-", "subject_id", "session_id").alias("recording_id"), "subject_id", "session_id", "folder")


def scoring_path(recordings: DataFrame, config: DatasetConfig) -> DataFrame:
    """recordings with the scoring file that the dataset's pattern names ({subject_id}, {session_id})."""
    subject = F.regexp_replace("subject_id", f"^{config.strip_prefix}", "") if config.strip_prefix else F.col("subject_id")
    path = F.lit(config.scoring_pattern)
    for name, value in (("{subject_id}", subject), ("{session_id}", F.col("session_id"))):
        path = F.replace(path, F.lit(name), value)
    return recordings.withColumn("scoring_file", path)


def scoring_lookup(recordings: DataFrame, lookup: DataFrame) -> DataFrame:
    """recordings with the scoring file of their session; several are an error, none gives null."""
    return attach_unique(recordings, lookup, ["session_id"])


def with_scores(recordings: DataFrame, scored: DataFrame) -> DataFrame:
    """recordings with has_annotations; a recording without scores stays."""
    have = scored.select("recording_id").distinct().withColumn("has_annotations", F.lit(True))
    return recordings.join(have, "recording_id", "left").withColumn("has_annotations", F.coalesce("has_annotations", F.lit(False)))


def from_files(spark: SparkSession, glob: str) -> DataFrame:
    """(recording_id, path) of a file or folder glob: the last path element is the id."""
    files = spark.read.format("binaryFile").load(glob).select("path")
    return files.select(F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("recording_id"), "path")
