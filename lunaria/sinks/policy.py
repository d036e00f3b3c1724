"""What happens to outputs that exist and to recordings that fail."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ExistingOutput


class Existing(Enum):
    RAISE = "errorifexists"
    SKIP = "ignore"
    OVERWRITE = "overwrite"
    APPEND = "append"

    def for_annotations(self) -> Existing:
        """Annotations are replaced as a whole: appending to them means overwriting them."""
        return Existing.OVERWRITE if self is Existing.APPEND else self


class OnError(Enum):
    RAISE = "raise"
    SKIP = "skip"


def exists(df: DataFrame, path: str) -> bool:
    """Whether a path holds something, asked of the file system that Spark would use."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a temporary table of this package's own."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def replace(df: DataFrame, new: str, path: str) -> None:
    """Puts a folder that was written as a whole in the place of another; the old one goes last."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    a, b, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (new, path, f"{path}.old"))
    fs = b.getFileSystem(conf)
    if not fs.rename(b, old) or not fs.rename(a, b):
        raise ExistingOutput(f"{new} could not be moved to {path}")
    fs.delete(old, True)


def write(df: DataFrame, path: str, existing: Existing = Existing.RAISE, form: str = "parquet", partition_by: tuple[str, ...] = (), **options: str) -> bool:
    """Writes df under a policy; False if it was skipped. An existing output is never deleted on failure."""
    if existing is not Existing.OVERWRITE and existing is not Existing.APPEND and exists(df, path):
        if existing is Existing.RAISE:
            raise ExistingOutput(path)
        return False
    df.write.format(form).mode(existing.value).options(**options).partitionBy(*partition_by).save(path)
    return True


def handle_errors(df: DataFrame, on_error: OnError, status: str = "error_message") -> DataFrame:
    """Rows whose status column is null are fine. SKIP leaves the others out; RAISE fails on the first."""
    if on_error is OnError.SKIP:
        return df.where(F.col(status).isNull())
    return df.where(F.when(F.col(status).isNull(), True).otherwise(F.raise_error(F.col(status)).cast("boolean")))
