"""Movement measures of three accelerometer axes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .select import INDEX, KEY


def dynamic(wide: DataFrame, rate: float, axes: Sequence[str] = ("x", "y", "z"), key: Sequence[str] = KEY) -> DataFrame:
    """(key, index, magnitude, derivative): the vector's norm and its change per second, 0 at first."""
    x, y, z = (F.col(a) for a in axes)
    df = wide.select(*key, INDEX, F.sqrt(x * x + y * y + z * z).alias("magnitude"))
    step = F.col("magnitude") - F.lag("magnitude").over(Window.partitionBy(*key).orderBy(INDEX))
    return df.withColumn("derivative", F.coalesce(step * rate, F.lit(0.0)))


def gravity(wide: DataFrame, axes: Sequence[str] = ("x", "y", "z"), key: Sequence[str] = KEY) -> DataFrame:
    """(key, index, pitch, roll) in radians; negative zeros are made plain zeros."""
    x, y, z = (F.col(a) for a in axes)
    return wide.select(*key, INDEX, (F.atan2(-x, F.sqrt(y * y + z * z)) + 0.0).alias("pitch"), (F.atan2(y, z) + 0.0).alias("roll"))
