"""Tables that a job writes on its way and reads again, so that a lost executor repeats its own tasks alone."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .errors import LunariaError
from .sinks.policy import delete

_LOCAL: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir, or a local one where all runs in one process."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise LunariaError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="lunaria-")
    return _LOCAL[app]


class Kept:
    """A table that replaces the one before it: `put` writes a frame, reads it back and deletes the last."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, None

    def put(self, df: DataFrame) -> DataFrame:
        path = f"{folder(self.spark)}/lunaria-{self.spark.sparkContext.applicationId}/kept-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.drop()
        self.path = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        if self.path is not None:
            delete(self.spark, self.path)
            self.path = None
