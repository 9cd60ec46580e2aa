"""Sky tiles from the data: a quadtree in right ascension and declination that splits where the rows are.

Eight squares of ninety degrees are the roots; a tile with more rows than wanted is split in four, down to a last level.  All work is on
counts per cell, never on the rows of a tile.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

ROOT_DEG = 90.0
DEEPEST = 20  # levels at most: tiles of a third of an arcsecond


def _index(angle: Column, level: int, last: int) -> Column:
    return F.least(F.floor(angle / (ROOT_DEG / (1 << level))), F.lit(last)).cast("long")


def quadtree_tiles(points: DataFrame, max_rows: int, deepest: int = 12, pos=("ra", "dec")) -> DataFrame:
    """rtid, level, ix, iy, n, ramin, ramax, decmin, decmax, cdec: tiles that cover the sky once, with at most ``max_rows`` points each
    unless they are of the deepest level.

    A point on a border belongs to the tile that begins there.  Points without a position are left out; without points there are the
    eight roots.  One row per occupied cell of the deepest level is the most that is ever shuffled.
    """
    if not 0 <= deepest <= DEEPEST:
        raise ValueError(f"deepest is a level from 0 to {DEEPEST}")
    ra, dec = (F.col(p).cast("double") for p in pos)
    placed = points.filter(ra.isNotNull() & dec.isNotNull())
    cells = placed.groupBy(_index(F.pmod(ra, F.lit(360.0)), deepest, (4 << deepest) - 1).alias("ix"), _index(dec + 90.0, deepest, (2 << deepest) - 1).alias("iy")) \
        .agg(F.count(F.lit(1)).alias("n"))
    finest = cut_lineage(cells)
    up = lambda c, level: F.shiftright(c, deepest - level)
    counts = [finest.groupBy(F.lit(level).alias("level"), up("ix", level).alias("ix"), up("iy", level).alias("iy")).agg(F.sum("n").alias("n")) for level in range(deepest + 1)]
    nodes = cut_lineage(reduce(DataFrame.unionByName, counts))
    split = nodes.filter((F.col("n") > max_rows) & (F.col("level") < deepest)).drop("n")
    four = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
    children = split.withColumn("__c", four).select((F.col("level") + 1).alias("level"), (F.col("ix") * 2 + F.col("__c.i")).alias("ix"), (F.col("iy") * 2 + F.col("__c.j")).alias("iy"))
    spark = points.sparkSession
    roots = spark.range(8).select(F.lit(0).alias("level"), (F.col("id") % 4).alias("ix"), F.floor(F.col("id") / 4).alias("iy"))
    leaves = roots.unionByName(children).join(split, ["level", "ix", "iy"], "left_anti").join(nodes, ["level", "ix", "iy"], "left_outer")
    size = F.lit(ROOT_DEG) / F.pow(F.lit(2.0), F.col("level"))
    return leaves.select(
        (F.col("level").cast("long") * (1 << 48) + F.col("iy") * (1 << 24) + F.col("ix")).alias("rtid"), F.col("level").cast("int").alias("level"), "ix", "iy",
        F.coalesce("n", F.lit(0)).cast("long").alias("n"), (F.col("ix") * size).alias("ramin"), ((F.col("ix") + 1) * size).alias("ramax"),
        (F.col("iy") * size - 90.0).alias("decmin"), ((F.col("iy") + 1) * size - 90.0).alias("decmax"), ((F.col("iy") + 0.5) * size - 90.0).alias("cdec"))


def quadtree_neighbors(tiles: DataFrame) -> DataFrame:
    """Pairs (rtid, neighbor) of tiles that share an edge or a corner, of one level or of different ones, also across the meridian.

    A tile's neighbour of its own size or larger holds one of the eight cells around it, so it is that cell or one of its
    ancestors: an equi-join.  Smaller neighbours are the same pairs from the other side.
    """
    steps = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0)]
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps]))
    level = F.col("level")
    wide = F.call_function("shiftleft", F.lit(4).cast("long"), level)
    cells = tiles.select("rtid", "level", "ix", "iy").withColumn("__s", around).select(
        "rtid", "level", F.pmod(F.col("ix") + F.col("__s.i"), wide).alias("ix"), (F.col("iy") + F.col("__s.j")).alias("iy"))
    cells = cells.filter((F.col("iy") >= 0) & (F.col("iy") < F.call_function("shiftleft", F.lit(2).cast("long"), level)))
    ancestors = cells.withColumn("__up", F.explode(F.sequence(F.lit(0), level))).select(
        "rtid", (level - F.col("__up")).alias("level"), F.call_function("shiftright", F.col("ix"), F.col("__up")).alias("ix"),
        F.call_function("shiftright", F.col("iy"), F.col("__up")).alias("iy"))
    larger = ancestors.join(tiles.select(F.col("rtid").alias("neighbor"), "level", "ix", "iy"), ["level", "ix", "iy"]).select("rtid", "neighbor")
    larger = larger.filter("rtid <> neighbor")
    return larger.unionByName(larger.select(F.col("neighbor").alias("rtid"), F.col("rtid").alias("neighbor"))).distinct()
