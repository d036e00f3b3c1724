"""Rows by time rather than by position: as-of joins and the cover of intervals.

Both run over events in order of time. A recording's events are split into slices of time; each slice is a
window of its own, and what earlier slices leave to later ones (a last value, an open count) is carried on
over one row a slice. So a long recording, or one key with most of the rows, is many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import DuplicateChannel
from .select import KEY

#: Nanoseconds of a slice: an hour.
SLICE = 3_600_000_000_000


def _slice(at: str, size: int) -> Column:
    return F.expr(f"({at} - pmod({at}, {size}L)) div {size}L")


def asof_join(left: DataFrame, right: DataFrame, columns: Sequence[str], key: Sequence[str] = KEY, at: str = "ts_ns", tolerance: int | None = None, size: int = SLICE) -> DataFrame:
    """left(key, at, ...) with columns of right(key, at, columns): those of its last row at or before the row's
    time, null if there is none (or none within the tolerance). Of rows of right at one time the one with the
    largest columns counts. Times are longs of any unit; size is a slice in that unit. Rows of right without
    key or time are ignored; rows of left without stay, with nulls. Rows that repeat each get their answer."""
    if clash := set(columns) & set(left.columns):
        raise DuplicateChannel(", ".join(sorted(clash)))
    key, own = list(key), F.struct(*[F.col(c) for c in left.columns])
    given = right.dropna(subset=[*key, at]).select(*key, F.col(at).cast("long").alias("__at"), F.struct(*columns).alias("__v")).withColumn("__row", F.lit(None).cast(left.select(own.alias("r")).schema["r"].dataType))
    asked = left.select(*key, F.col(at).cast("long").alias("__at"), F.lit(None).cast(given.schema["__v"].dataType).alias("__v"), own.alias("__row"))
    both = given.unionByName(asked).withColumn("__slice", _slice("__at", size)).withColumn("__of", F.when(F.col("__v").isNotNull(), F.struct("__at", "__v")))
    upto = Window.partitionBy(*key, "__slice").orderBy("__at", F.col("__v").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("__last", F.last("__of", ignorenulls=True).over(upto)).where("__row is not null")
    before = Window.partitionBy(*key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.groupBy(*key, "__slice").agg(F.max("__of").alias("m")).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], F.col("__slice").alias("__s"), F.last("m", ignorenulls=True).over(before).alias("__earlier"))
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(key)] + [F.col("__slice").eqNullSafe(F.col("__s"))]
    last = F.coalesce("__last", "__earlier")
    if tolerance is not None:
        last = F.when(F.col("__at") - last["__at"] <= tolerance, last)
    return found.join(carried.where("__earlier is not null"), on, "left").select("__row.*", *[last["__v"][c].alias(c) for c in columns])


def covered(parts: DataFrame, key: Sequence[str] = KEY, start: str = "start_ns", end: str = "end_ns", size: int = SLICE) -> DataFrame:
    """(key, start, end, depth) of the stretches of time between the first start and the last end of each key's
    parts, and how many parts hold in each: 0 is a gap, 2 and more an overlap. Ends are excluded; parts that
    are empty or lack an end are ignored. Stretches that follow each other differ in depth."""
    key = list(key)
    own = parts.dropna(subset=[*key, start, end]).where(F.col(start) < F.col(end))
    events = own.select(*key, F.explode(F.array(F.struct(F.col(start).cast("long").alias("at"), F.lit(1).alias("d")), F.struct(F.col(end).cast("long").alias("at"), F.lit(-1).alias("d")))).alias("e"))
    turns = events.groupBy(*key, F.col("e.at").alias("__at")).agg(F.sum("e.d").alias("__d")).where("__d <> 0").withColumn("__slice", _slice("__at", size))
    by = Window.partitionBy(*key, "__slice").orderBy("__at")
    turns = turns.withColumns({"__run": F.sum("__d").over(by), "__next": F.lead("__at").over(by)})
    order = Window.partitionBy(*key).orderBy("__slice")
    slices = turns.groupBy(*key, "__slice").agg(F.sum("__d").alias("n"), F.min("__at").alias("first"))
    slices = slices.select(*key, "__slice", F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__open"), F.lead("first").over(order).alias("__after"))
    out = turns.join(slices, [*key, "__slice"]).withColumn("__to", F.coalesce("__next", "__after")).where("__to is not null")
    return out.select(*key, F.col("__at").alias(start), F.col("__to").alias(end), (F.col("__run") + F.col("__open")).alias("depth"))
