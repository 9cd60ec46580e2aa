"""The nearest neighbour of each row in numpy, tile by tile.

A left row lies in one tile, a right row in every tile that its circle touches.  A tile is many radii wide, so few rows are copied, and what
leaves it is one row for each left row: pairs are never rows of a table.  Within a tile the right rows are sorted by the cells of a grid; the cells
are small where the tile is crowded, and left rows that find nothing as near as that are looked up again in wider ones.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILE_RADII = (16, 8, 4, 2)  # widths of a tile, in radii
TILE_ROWS = 1_000_000  # right rows that a tile may hold; it is narrower where there are more, down to two radii
ROWS_AT_ONCE = 200_000  # rows that are worked on together, besides the right rows of one tile
PAIRS_AT_ONCE = 1_000_000
PARTITION_ROWS = 1_000_000
WIDER = 3.0  # from one look to the next
CELL_ROWS = 6.0  # right rows that the first circle is meant to hold: one left row in 400 finds none

Distance = Callable[[np.ndarray, ...], np.ndarray]


def tile_width(rights: DataFrame, radius: float, cells: Callable[[DataFrame, float], DataFrame], tile: list[str], most: float = float("inf")) -> tuple[float, int]:
    """The widest tile that holds ``TILE_ROWS`` right rows at most, and the rows of all tiles.  ``cells`` gives rows their tiles of some width."""
    for radii in TILE_RADII:
        width = max(min(radii * radius, most), 2 * radius)
        counts = cells(rights, width).groupBy(*tile).agg(F.count("*").alias("n"))
        highest, rows = counts.agg(F.max("n"), F.sum("n")).first()
        if (highest or 0) <= TILE_ROWS:
            break
    return width, rows or 0


def look_up(tile: np.ndarray, u: np.ndarray, v: np.ndarray, cosine: np.ndarray, is_right: np.ndarray, radius: float, distance: Distance,
            turn: float | None = None, squared: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(left rows, right rows): the places of all left rows, and of their nearest right row of the tile within ``radius``, -1 where there is none.

    ``distance`` takes u, v and cosine of left rows, and u, v of right rows; it must not be less than the difference in v, nor than that in u times
    the cosine (with ``squared``, their squares).  Of equal distances the first row is taken.  ``turn`` is the length of a circle that u goes round.
    """
    fine = np.isfinite(u) & np.isfinite(v) & (cosine > 0)
    left, right = np.flatnonzero(~is_right), np.flatnonzero(is_right & fine)
    nearest = np.full(len(u), -1)
    if not len(right):
        return left, nearest[left]
    tiles = int(tile.max()) + 1
    for i in (u, v):  # a place to count from
        first = np.zeros(tiles)
        first[tile[right][::-1]] = i[right][::-1]
        if i is u:
            x = u - first[tile]
        else:
            y = v - first[tile]
    if turn:
        x = np.mod(x + turn / 2, turn) - turn / 2
    flat = np.ones(tiles)
    np.minimum.at(flat, tile[fine & ~is_right], cosine[fine & ~is_right])
    right_x = x[right]
    if turn:  # the rows next to the seam stand on both sides of it
        seam = turn / 2 - (radius / flat * 1.001)[tile[right]]
        low, high = right_x < -seam, right_x > seam
        right, right_x = np.concatenate([right, right[low], right[high]]), np.concatenate([right_x, right_x[low] + turn, right_x[high] - turn])
    right_tile, right_y = tile[right], y[right]
    n = np.bincount(right_tile, minlength=tiles)
    spread = []
    for at in (right_x, right_y):
        lowest, highest = np.full(tiles, np.inf), np.full(tiles, -np.inf)
        np.minimum.at(lowest, right_tile, at)
        np.maximum.at(highest, right_tile, at)
        spread.append(np.where(n > 0, highest - lowest, 0.0))
    reach = np.clip(np.sqrt(CELL_ROWS * spread[0] * flat * spread[1] / (np.pi * np.maximum(n, 1))), radius / 1024, radius)
    reach = np.where(reach < radius / 2, reach, radius)
    active = left[fine[left] & (n[tile[left]] > 0)]
    while len(active):
        used = np.zeros(tiles, bool)
        used[tile[active]] = True
        some = used[right_tile]
        at, here = right[some], right_tile[some]
        high = reach * (1 + 1e-6)
        wide = high / flat
        rx, ry = np.floor(right_x[some] / wide[here]).astype(np.int64), np.floor(right_y[some] / high[here]).astype(np.int64)
        lx, ly = np.floor(x[active] / wide[tile[active]]).astype(np.int64), np.floor(y[active] / high[tile[active]]).astype(np.int64)
        x0, y0 = min(rx.min(), lx.min()) - 1, min(ry.min(), ly.min()) - 1
        columns, rows = int(max(rx.max(), lx.max()) - x0 + 2), int(max(ry.max(), ly.max()) - y0 + 2)
        key = (here * columns + rx - x0) * rows + ry - y0
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        middle = (tile[active] * columns + lx - x0) * rows + ly - y0
        middle = middle[:, None] + np.array([-rows, 0, rows])  # the cells of a column lie next to each other
        begin, end = np.searchsorted(key, middle - 1), np.searchsorted(key, middle + 1, "right")
        count = end - begin
        total = np.cumsum(count.sum(axis=1))
        found = np.zeros(len(active), bool)
        a = 0
        while a < len(active):
            done = total[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(total, done + PAIRS_AT_ONCE, "right")))
            c = count[a:b].ravel()
            mine = np.repeat(np.arange(a, b), count[a:b].sum(axis=1))
            if len(mine):
                place = at[np.arange(len(mine)) + np.repeat(begin[a:b].ravel() - np.cumsum(c) + c, c)]
                own = active[mine]
                far = distance(u[own], v[own], cosine[own], u[place], v[place])
                first = np.flatnonzero(np.diff(mine, prepend=-1))
                size = np.diff(np.append(first, len(mine)))
                best = np.minimum.reduceat(far, first)
                who = mine[first]
                least = np.minimum.reduceat(np.where(far == np.repeat(best, size), place, len(u)), first)
                near = best <= reach[tile[active[who]]] ** (2 if squared else 1)
                nearest[active[who[near]]] = least[near]
                found[who[near]] = True
            a = b
        active = active[~found & (reach[tile[active]] < radius)]
        reach = np.where(reach * WIDER < radius / 2, reach * WIDER, radius)
    return left, nearest[left]


def _numbers(columns: list[pa.Array]) -> np.ndarray:
    """A number for each row that goes up where one of the columns changes."""
    change = np.zeros(len(columns[0]), bool)
    for c in columns:
        code = pc.fill_null(pc.dictionary_encode(c).indices, -1).to_numpy(zero_copy_only=False)
        change[1:] |= code[1:] != code[:-1]
    return np.cumsum(change)


def nearest(left: DataFrame, right: DataFrame, right_rows: int, tile: list[str], uv: tuple[str, str], right_uv: tuple[str, str], radius: float, distance: Distance,
            order: list[Column], turn: float | None = None, squared: bool = False) -> DataFrame:
    """(l, r): each row of ``left`` and its nearest row of ``right`` of the same tile as structs; r is null where none lies within ``radius``.

    Both frames have the columns ``tile``, which are not among the structs.  ``order`` are expressions of r: the first of equal distances is
    taken.  With ``turn`` u and v are angles on a sphere.  See ``look_up``.
    """
    struct = lambda df: F.struct(*[F.col(c) for c in df.columns if c not in tile])
    kind = lambda df: df.select(struct(df)).schema[0].dataType
    rights = right.select(*tile, F.lit(True).alias("is_right"), F.lit(None).cast(kind(left)).alias("l"), struct(right).alias("r"))
    both = rights.unionByName(left.select(*tile, F.lit(False).alias("is_right"), struct(left).alias("l"), F.lit(None).cast(kind(right)).alias("r")))

    def matched(table: pa.Table) -> pa.RecordBatch:
        numbers = [table.column(c).to_numpy() for c in ("u", "v", "cosine")]
        a, b = look_up(_numbers([table.column(c).combine_chunks() for c in tile]), *numbers, table.column("is_right").to_numpy(), radius, distance, turn, squared)
        l, r = (table.column(c).combine_chunks() for c in "lr")
        return pa.RecordBatch.from_arrays([l.take(pa.array(a)), r.take(pa.array(b, mask=b < 0))], ["l", "r"])

    def run(batches):
        held, new, kept = [], 0, 0
        for batch in batches:
            held.append(batch)
            new += len(batch)
            if new < max(ROWS_AT_ONCE, kept):
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            yield matched(table)
            # right rows come first: those of the last tile may be met by left rows still to come
            number = _numbers([table.column(c).combine_chunks() for c in tile])
            stay = table.filter(pa.array((number == number[-1]) & table.column("is_right").to_numpy()))
            held, new, kept = stay.to_batches(), 0, len(stay)
        if new:
            yield matched(pa.Table.from_batches(held))

    parts = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), (left.count() + right_rows) // PARTITION_ROWS)
    dealt = both.repartition(parts, *tile).sortWithinPartitions(*tile, F.desc("is_right"), *order)
    u, v = (F.when(F.col("is_right"), F.col(f"r.{b}")).otherwise(F.col(f"l.{a}")).cast("double") for a, b in zip(uv, right_uv))
    cosine = F.when(F.col("is_right") | F.lit(turn is None), 1.0).otherwise(F.cos(F.radians(F.col(f"l.{uv[1]}"))))
    return dealt.select(*tile, "is_right", u.alias("u"), v.alias("v"), cosine.alias("cosine"), "l", "r").mapInArrow(run, both.select("l", "r").schema)
