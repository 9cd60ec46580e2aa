"""Columns for found spans: arrays of struct<kind: int, start: int, end: int>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` in order of start, then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in kinds])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    text = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(keyed, text), ",")


def number(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
