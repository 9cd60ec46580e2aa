"""Constraint reports: value rules, unique keys and references between tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def image_rules() -> dict[str, Column]:
    """Value rules of the image tables; a row breaks a rule when it is false or NULL."""
    return {"vbest": F.col("vbest").isin(0, 1, 2), "version": F.col("version") > 0,
            "ra": (F.col("ra") >= 0) & (F.col("ra") < 360), "dec": F.col("dec").between(-90, 90),
            "status": F.col("status").between(-1, 1), "sca": F.col("sca").between(1, 18)}


def validate_constraints(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Number of rows that break each rule, all counted in one pass."""
    counts = df.agg(F.count("*").alias("n_rows"), *[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n_broken")) for n in rules])
    return counts.select("n_rows", F.explode(pairs).alias("p")).select("p.rule", "p.n_broken", "n_rows")


def broken_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows with the list of the rules they break."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()]))
    return df.withColumn("broken", broken).filter(F.size("broken") > 0)


def validate_unique_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def validate_foreign_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their number of rows.

    The child is reduced to its distinct keys before the join, so a hot key costs nothing.
    """
    keys = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count("*").alias("n_rows"))
    return keys.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def union_all(tables: list[DataFrame]) -> DataFrame:
    """Tables of one kind stacked by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
