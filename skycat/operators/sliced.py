"""Running numbers and sums for keys that may hold a large share of all rows.

A plain window sorts a whole key in one task.  Here each key is cut in slices by a monotone
function of the order (say the month of a date): totals per slice are summed over the few
slices of a key, and only the rows inside one slice are sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_null_safe


def running_sum(df: DataFrame, keys: list[str], order: list[str], slice_of: Column, value: Column, name: str) -> DataFrame:
    """Sum of ``value`` over the rows of the key up to and including this one.

    ``slice_of`` must not decrease along ``order``.  Rows with a NULL key are a key of their own, and a
    NULL slice comes before all others.
    """
    rows = df.withColumns({"__slice": slice_of, "__value": value})
    totals = rows.groupBy(*keys, "__slice").agg(F.sum("__value").alias("__total"))
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "__slice", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(*keys, "__slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (join_null_safe(rows.withColumn("__inside", F.sum("__value").over(inside)), offsets, [*keys, "__slice"])
            .withColumn(name, F.col("__offset") + F.col("__inside"))
            .drop("__slice", "__value", "__inside", "__offset"))


def row_number(df: DataFrame, keys: list[str], order: list[str], slice_of: Column, name: str) -> DataFrame:
    """Position of each row in its key, from 1; ``order`` must be a total order."""
    return running_sum(df, keys, order, slice_of, F.lit(1).cast("long"), name)
