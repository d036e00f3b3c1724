"""Train/test split by subject, the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def mixed(subject: str, seed: int):
    """An arithmetic hash of a whole-number subject id: plain products and remainders, so any engine
    can repeat it; below 2^31."""
    x = F.pmod(F.col(subject).cast("long"), F.lit(2147483647)) + F.lit(seed % 1000003 + 1)
    return F.pmod(F.pmod(x * 48271, F.lit(2147483647)) * 69621, F.lit(2147483647))


def split_subjects(rows: DataFrame, share: float, seed: int = 0, subject: str = "subj") -> DataFrame:
    """rows with set = 'test' for int(n x share) subjects, 'train' for the others. Subjects are ranked
    by their hash, over one row per subject; whole subjects go to one side."""
    ids = rows.where(F.col(subject).isNotNull()).select(subject).distinct()
    n = int(ids.count() * share)
    if n == 0:
        return rows.withColumn("set", F.lit("train"))
    if dict(rows.dtypes)[subject] == "string":
        order = F.xxhash64(F.lit(seed), subject)
    else:
        order = mixed(subject, seed)
    # the n smallest by hash: a top-n that needs no global sort of the subjects
    test = ids.withColumn("__h", order).orderBy("__h", subject).limit(n).select(subject, F.lit("test").alias("__set"))
    return rows.join(test, subject, "left").withColumn("set", F.coalesce("__set", F.lit("train"))).drop("__set")


def stratified_subjects(rows: DataFrame, share: float, by: str, seed: int = 0, subject: str = "subj") -> DataFrame:
    """As split_subjects within each value of `by` (an extension): int(n x share) subjects of each."""
    ids = rows.select(by, subject).distinct()
    w = Window.partitionBy(by).orderBy(F.xxhash64(F.lit(seed), subject), subject)
    size = ids.groupBy(by).agg(F.count(F.lit(1)).alias("__n"))
    ranked = ids.withColumn("__r", F.row_number().over(w)).join(size, by)
    test = ranked.where(F.col("__r") <= (F.col("__n") * share).cast("int")).select(by, subject, F.lit("test").alias("__set"))
    return rows.join(test, [by, subject], "left").withColumn("set", F.coalesce("__set", F.lit("train"))).drop("__set")
