"""Joins on keys that may be NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Like a join on ``keys``, but a NULL key matches a NULL key; the keys of the left side stay."""
    other = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys])
    joined = left.join(other, match, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__right_{k}" for k in keys])
