"""Catalogs, lookups and tables that are brought up to date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import AmbiguousLookup
from .select import KEY

SUCCESS, FAILED = "success", "failed"


def pending(recordings: DataFrame, catalog: DataFrame, key: Sequence[str] = KEY, retry_failed: bool = True) -> DataFrame:
    """Recordings still to be processed. By default failed ones are tried again; otherwise every
    recording that the catalog holds counts as done."""
    done = catalog.where(F.col("export_status") == SUCCESS) if retry_failed else catalog
    return recordings.join(done.select(*key), list(key), "left_anti")


def attach_unique(left: DataFrame, lookup: DataFrame, on: Sequence[str], check: bool = True) -> DataFrame:
    """Left join with a lookup that may hold one row per key. Several are an error, found by one
    aggregate over the lookup; none leaves nulls. Spark broadcasts the lookup if its size allows."""
    if check:
        twice = lookup.groupBy(*on).count().where("count > 1").limit(1).collect()
        if twice:
            raise AmbiguousLookup(str(twice[0].asDict()))
    return left.join(lookup, list(on), "left")


def combine_first(new: DataFrame, old: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of both by key: the new value wins, the old one fills in where the new is null or absent."""
    values = [c for c in dict.fromkeys([*new.columns, *old.columns]) if c not in on]
    n = new.select(*on, *[F.col(c).alias(f"__n_{c}") for c in new.columns if c not in on])
    o = old.select(*on, *[F.col(c).alias(f"__o_{c}") for c in old.columns if c not in on])

    def pick(c: str) -> Column:
        sides = [F.col(f"__{s}_{c}") for s, t in (("n", new), ("o", old)) if c in t.columns]
        return F.coalesce(*sides).alias(c)

    return n.join(o, list(on), "full_outer").select(*on, *map(pick, values))


def upsert(old: DataFrame, new: DataFrame, on: Sequence[str], version: Sequence[str] | None = None) -> DataFrame:
    """Union of both (columns that one lacks are null there), the latest row per key: new rows win over
    old ones, or, with version columns, the highest version wins. An aggregate, not a window: one row
    per key and task reaches the shuffle."""
    both = old.withColumn("__v", F.lit(0)).unionByName(new.withColumn("__v", F.lit(1)), allowMissingColumns=True)
    order = F.struct(*(version or []), "__v")
    rest = [c for c in both.columns if c not in (*on, "__v")]
    best = both.groupBy(*on).agg(F.max_by(F.struct(*rest), order).alias("__r"))
    return best.select(*on, *[F.col(f"__r.{c}").alias(c) for c in rest])
