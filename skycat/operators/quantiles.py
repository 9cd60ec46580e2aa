"""Exact percentiles of groups of any size.

The built-in exact percentile keeps every distinct value of a group in one hash map.  Here a
mergeable sketch brackets each wanted rank, exact counts say how many values lie below the
bracket, and only the few values inside it are sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_null_safe

ACCURACY = 10000  # rank error of the sketch is at most group size / ACCURACY


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float], accuracy: int = ACCURACY) -> DataFrame:
    """One row per key with a linearly interpolated percentile per entry of ``probs``.

    NULL values are ignored; turn NaN into NULL before.  Keys with no value do not appear.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    names = list(probs)
    # wide enough for the error of the sketch and the neighbours needed to interpolate, as soon
    # as a group has twice as many values as the sketch; smaller groups are sorted as they are
    margin = 3.0 / accuracy
    edges = []
    for p in probs.values():
        edges += [max(0.0, p - margin), min(1.0, p + margin)]
    sketch = rows.groupBy(*keys).agg(F.count("*").alias("__n"),
                                     F.percentile_approx("__v", edges, accuracy).alias("__e"))

    def edge(i, side):
        open_end = edges[2 * i + side] in (0.0, 1.0)
        unbounded = F.lit(float("-inf") if side == 0 else float("inf"))
        return unbounded if open_end else F.when(F.col("__n") <= 2 * accuracy, unbounded).otherwise(F.col("__e")[2 * i + side])

    joined = join_null_safe(rows, sketch, keys)
    below = joined.groupBy(*keys).agg(F.any_value("__n").alias("__n"),
                                      *[F.count_if(F.col("__v") < edge(i, 0)).alias(f"__below{i}") for i in range(len(names))])
    inside = [F.when((F.col("__v") >= edge(i, 0)) & (F.col("__v") <= edge(i, 1)), F.lit(i)) for i in range(len(names))]
    # equal values are counted before they are sorted
    bracket = (joined.select(*keys, "__v", F.explode(F.array_compact(F.array(*inside))).alias("__i"))
               .groupBy(*keys, "__i", "__v").agg(F.count("*").alias("__c")))
    order = Window.partitionBy(*keys, "__i").orderBy("__v")
    upto = bracket.withColumn("__upto", F.sum("__c").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    prob = F.element_at(F.array(*[F.lit(float(p)) for p in probs.values()]), F.col("__i") + 1)
    start = F.element_at(F.array(*[F.col(f"__below{i}") for i in range(len(names))]), F.col("__i") + 1)
    ranked = join_null_safe(upto, below, keys).withColumns({"__rank": prob * (F.col("__n") - 1), "__last": start + F.col("__upto")})
    # the value at a zero-based rank is the first one whose running count exceeds the rank
    low = F.min(F.when(F.col("__last") > F.floor("__rank"), F.col("__v")))
    high = F.min(F.when(F.col("__last") > F.ceil("__rank"), F.col("__v")))
    part = F.any_value(F.col("__rank") - F.floor("__rank"))
    exact = F.coalesce(low + (high - low) * part, F.raise_error(F.lit("percentile outside its bracket")))
    per_prob = ranked.groupBy(*keys, "__i").agg(exact.alias("__q"))
    out = per_prob.groupBy(*keys).agg(*[F.max(F.when(F.col("__i") == i, F.col("__q"))).alias(n) for i, n in enumerate(names)])
    return out
