"""Projections and filters over signal tables: long (channel, sample_idx, value) or wide (a column a channel).

Recording-wide values (counts, percentiles) come from an aggregate joined back, not from a window over
whole recordings: the aggregate is combined before the shuffle and its result is one row a recording.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ChannelCountMismatch, LunariaError, MissingChannel

KEY = ("recording_id",)
INDEX = "sample_idx"


def data_channels(wide: DataFrame, key: Sequence[str] = KEY) -> list[str]:
    """The columns of a wide signal that are channels."""
    return [c for c in wide.columns if c not in (*key, INDEX, "ts_ns", "dataset", "sample_rate")]


def with_time(df: DataFrame, rate: float, start_ns: int = 0) -> DataFrame:
    """Adds ts_ns = start + index x (1e9 / rate), truncated to whole nanoseconds."""
    return df.withColumn("ts_ns", (F.col(INDEX) * F.lit(1e9 / rate)).cast("long") + F.lit(start_ns).cast("long"))


def select_channels(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Channels by name: rows of a long table, columns of a wide one (in the order asked for)."""
    if "channel" in df.columns:
        return df.where(F.col("channel").isin(*names))
    if missing := [n for n in names if n not in df.columns]:
        raise MissingChannel(", ".join(missing))
    keep = [c for c in df.columns if c not in data_channels(df)]
    return df.select(*keep, *names)


def select_positions(wide: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Channels of a wide table by position."""
    names = data_channels(wide)
    if any(not -len(names) <= p < len(names) for p in positions):
        raise MissingChannel(f"positions {list(positions)} of {len(names)} channels")
    return select_channels(wide, [names[p] for p in positions])


def rename_channels(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Renames columns of a wide table, or the values of `channel` in a long one; channels need not align."""
    if "channel" not in df.columns:
        if missing := [n for n in names if n not in df.columns]:
            raise MissingChannel(", ".join(missing))
        return df.withColumnsRenamed(dict(names))
    return df.withColumn("channel", lookup(F.col("channel"), names, F.col("channel")))


def slice_samples(df: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Samples start <= index < stop; None leaves an end open."""
    if start is not None:
        df = df.where(F.col(INDEX) >= start)
    return df if stop is None else df.where(F.col(INDEX) < stop)


def mask_samples(df: DataFrame, mask: Column | str) -> DataFrame:
    """Samples where a boolean mask holds; a mask of another type is an error."""
    mask = F.col(mask) if isinstance(mask, str) else mask
    if not isinstance(df.select(mask.alias("m")).schema["m"].dataType, T.BooleanType):
        raise LunariaError("a mask must be boolean")
    return df.where(mask)


def assign_where(df: DataFrame, where: Column, channels: Sequence[str], value: Column | float) -> DataFrame:
    """Replaces the channels' values where a condition holds."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumns({c: F.when(where, v).otherwise(F.col(c)) for c in channels})


def slice_by_time(df: DataFrame, start_ns: int | None = None, end_ns: int | None = None) -> DataFrame:
    """Samples between two times, both included."""
    if start_ns is not None:
        df = df.where(F.col("ts_ns") >= start_ns)
    return df if end_ns is None else df.where(F.col("ts_ns") <= end_ns)


def lengths(df: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """(key, n_samples)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_samples"))


def roll(df: DataFrame, shift: int, key: Sequence[str] = KEY) -> DataFrame:
    """Moves every recording's samples on by shift, round its end."""
    out = df.join(lengths(df, key), list(key)).withColumn(INDEX, F.pmod(F.col(INDEX) + shift, F.col("n_samples")))
    return out.select(*df.columns)


def lookup(code: Column, mapping: Mapping, default) -> Column:
    """mapping[code], or the default for codes that are not in it (and for null)."""
    other = default if isinstance(default, Column) else F.lit(default)
    if not mapping:
        return other
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(table, code), other)


def map_labels(df: DataFrame, mapping: Mapping, default: str, code: str = "code", out: str = "label") -> DataFrame:
    return df.withColumn(out, lookup(F.col(code), mapping, default))


def composed(first: Mapping, second: Mapping, default: str) -> dict:
    """The mapping that applies first and then second."""
    return {k: second.get(v, default) for k, v in first.items()}


def scale_units(df: DataFrame, category: str, factor: float, categories: Mapping[str, str]) -> DataFrame:
    """Multiplies values of the channels of a category (volts to microvolts: 1e6)."""
    hit = [c for c, kind in categories.items() if kind == category]
    return df.withColumn("value", F.when(F.col("channel").isin(*hit), F.col("value") * factor).otherwise(F.col("value")))


def split_outputs(wide: DataFrame, outputs: Sequence[str]) -> dict[str, DataFrame]:
    """One single-channel table per output, by channel position; the numbers must agree."""
    names = data_channels(wide)
    if len(names) != len(outputs):
        raise ChannelCountMismatch(f"{len(outputs)} outputs for {len(names)} channels")
    rest = [c for c in wide.columns if c not in names]
    return {o: wide.select(*rest, F.col(c).alias("value")) for o, c in zip(outputs, names, strict=True)}


def drop_tail(df: DataFrame, length: int, key: Sequence[str] = KEY, index: str = INDEX) -> DataFrame:
    """Drops what follows the last whole multiple of length in each recording."""
    n = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    return df.join(n, list(key)).where(F.col(index) < F.expr(f"__n div {length} * {length}")).select(*df.columns)


#: Accuracy of the sketch that brackets a quantile; an exact answer lies within twice its error.
SKETCH = 1000


def quantiles(df: DataFrame, at: Sequence[float], value: str = "value", key: Sequence[str] = KEY) -> DataFrame:
    """(key, q0, q1, ...): exact quantiles with linear interpolation, a row for each recording that has a
    value. NaN sorts above all numbers, null is left out.

    No task holds a long recording's values. Recordings of at most 2 x SKETCH values are aggregated as they
    are; of longer ones a sketch brackets each quantile, values below the bracket are counted, and only the
    distinct values within it (some thousandths of a recording) are ranked.
    """
    key, few = list(key), F.col("__n") <= 2 * SKETCH  # a bracket would be narrower than the ranks next to it
    own = df.where(F.col(value).isNotNull()).select(*key, F.col(value).cast("double").alias("__v"))
    sizes = own.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    each = own.join(sizes.where(few).select(*key), key).groupBy(*key).agg(F.percentile("__v", F.array(*map(F.lit, at))).alias("__q"))
    short = each.select(*key, *[F.get("__q", F.lit(i)).alias(f"q{i}") for i in range(len(at))])
    return short.unionByName(_long_quantiles(own.join(sizes.where(~few), key), at, key))


def _long_quantiles(own: DataFrame, at: Sequence[float], key: list[str]) -> DataFrame:
    """quantiles of recordings of own(key, __v, __n) that are longer than 2 x SKETCH."""
    edges = [min(max(q + d, 0.0), 1.0) for q in at for d in (-2 / SKETCH, 2 / SKETCH)]
    found = own.groupBy(*key).agg(F.percentile_approx("__v", F.array(*map(F.lit, edges)), SKETCH).alias("__e"))
    near = own.join(found, key)
    place = [F.when(F.col("__v") < F.get("__e", F.lit(2 * i)), F.lit(-1)).when(F.col("__v") <= F.get("__e", F.lit(2 * i + 1)), F.lit(i)) for i in range(len(at))]
    # what lies below a bracket is one group of its recording and quantile, without its values
    each = near.select(*key, "__n", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.when(p >= 0, F.col("__v")).alias("v"), p.alias("p")) for i, p in enumerate(place)])).alias("x")).where("x.p is not null")
    counts = each.groupBy(*key, "__n", F.col("x.i").alias("__i"), F.col("x.v").alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    upto = F.sum("__c").over(Window.partitionBy(*key, "__i").orderBy(F.col("__v").asc_nulls_first()))
    ranked = counts.withColumn("__upto", upto)
    rank = F.element_at(F.array(*map(F.lit, at)), F.col("__i") + 1) * (F.col("__n") - 1)
    low, high = (F.min(F.when(F.col("__v").isNotNull() & (F.col("__upto") > r), F.col("__v"))) for r in (F.floor(rank), F.ceil(rank)))
    part = ranked.groupBy(*key, "__n", "__i").agg(low.alias("__a"), high.alias("__b"))
    share = rank - F.floor(rank)
    exact = part.select(*key, "__i", F.when(F.col("__a") == F.col("__b"), F.col("__a")).otherwise((1 - share) * F.col("__a") + share * F.col("__b")).alias("__q"))
    return exact.groupBy(*key).agg(*[F.max(F.when(F.col("__i") == i, F.col("__q"))).alias(f"q{i}") for i in range(len(at))])


def quartiles(df: DataFrame, value: str = "value", key: Sequence[str] = KEY) -> DataFrame:
    """(key, q25, q75), exact with linear interpolation."""
    return quantiles(df, (0.25, 0.75), value, key).select(*key, F.col("q0").alias("q25"), F.col("q1").alias("q75"))


def clip_iqr(df: DataFrame, k: float = 20.0, value: str = "value", key: Sequence[str] = KEY) -> DataFrame:
    """Holds values within [q25 - k IQR, q75 + k IQR] of their recording."""
    spread = k * (F.col("q75") - F.col("q25"))
    held = F.least(F.greatest(F.col(value), F.col("q25") - spread), F.col("q75") + spread)
    return df.join(quartiles(df, value, key), list(key), "left").withColumn(value, held).select(*df.columns)


def features_by_prefix(columns: Sequence[str], prefixes: Sequence[str]) -> list[str]:
    """Feature columns by prefix, sorted, so that their order does not depend on hashing."""
    return sorted(c for c in columns if any(c.startswith(p) for p in prefixes))


def with_annotations_only(recordings: DataFrame, annotations: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return recordings.join(annotations.select(*key), list(key), "left_semi")
