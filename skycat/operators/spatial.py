"""Positional joins written as equi-joins on sky cells.

The sky is cut in zones of height ``h`` in declination and, inside a zone, in cells of
about ``h`` in right ascension.  One side keeps its own cell, the other side is repeated
for every cell its search circle touches, so each pair within the radius meets in exactly
one cell: no duplicates to drop, no cross join.  Adaptive execution splits hot cells.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import (chord2, chord2_limit, chord2_to_deg, col, in_convex_polygon, position_chord2,
                                  unit_vector)
from ..session import cut_lineage

MIN_CELL_DEG = 1e-4  # cells of an uncrowded sky
FINEST_CELL_DEG = 2e-6  # zones and cells stay exact whole numbers in doubles, and are much wider than the margin
POLE_DEG = 89.9  # zones beyond are a single ring-shaped cell
CAP_DEG = 89.0
MARGIN_DEG = 1e-9  # widens the cell search against rounding; the exact test comes after


def cell_height(radius_deg: float) -> float:
    """Height of the cells of a positional join: the smallest whose rows meet few others than those in reach, however crowded the sky."""
    return max(2.0 * radius_deg, FINEST_CELL_DEG)


def zone_of(dec, h: float) -> Column:
    return F.floor((col(dec) + 90.0) / h)


def zone_scale(zone: Column, h: float) -> Column:
    """Cells per degree of right ascension in a zone; the same for both sides of a join."""
    dec = zone * h - 90.0
    return F.when(F.abs(dec) > POLE_DEG, 0.0).otherwise(F.cos(F.radians(dec)) / h)


def cell_of(ra, zone: Column, h: float) -> Column:
    return F.floor(col(ra) * zone_scale(zone, h))


def with_cell(df: DataFrame, ra: str, dec: str, h: float, zone: str = "zone", cell: str = "cell") -> DataFrame:
    """Add the zone and cell of each row."""
    return df.withColumn(zone, zone_of(dec, h)).withColumn(cell, cell_of(ra, F.col(zone), h))


def with_touched_cells(df: DataFrame, ra: str, dec: str, radius_deg, h: float,
                       zone: str = "zone", cell: str = "cell") -> DataFrame:
    """Repeat each row for every cell that its circle touches.

    ``radius_deg`` is a number or the name of a column.
    """
    reach = col(radius_deg) * (1 + 1e-9) + MARGIN_DEG
    zones = F.sequence(zone_of(F.greatest(F.lit(-90.0), F.col(dec) - reach), h),
                       zone_of(F.least(F.lit(90.0), F.col(dec) + reach), h))
    # half width in right ascension of the circle; the whole ring when it holds a pole
    ratio = F.sin(F.radians(F.least(reach, F.lit(90.0)))) / F.cos(F.radians(F.col(dec)))
    half = F.when(F.abs(F.col(dec)) + reach >= 90.0, 180.0).otherwise(
        F.degrees(F.asin(F.least(F.lit(1.0), ratio))) + MARGIN_DEG)
    low, high = F.col(ra) - F.col("__half"), F.col(ra) + F.col("__half")
    scale = F.col("__scale")

    def cells(first, last):
        return F.sequence(F.floor(first * scale), F.floor(last * scale))

    full = F.lit(360.0)
    touched = (F.when(F.col("__half") >= 180.0, cells(F.lit(0.0), full))
               .when(low < 0, F.array_union(cells(F.lit(0.0), high), cells(low + 360.0, full)))
               .when(high >= 360.0, F.array_union(cells(low, full), cells(F.lit(0.0), high - 360.0)))
               .otherwise(cells(low, high)))
    return (df.withColumn("__half", half)
            .withColumn(zone, F.explode(zones))
            .withColumn("__scale", zone_scale(F.col(zone), h))
            .withColumn(cell, F.explode(touched))
            .drop("__half", "__scale"))


def sky_join_all_pairs(left: DataFrame, right: DataFrame, radius_deg: float, left_pos=("ra", "dec"),
                       right_pos=("ra0", "dec0"), on: list[tuple[str, str]] = (), repeat: str = "right",
                       how: str = "inner", distance: str | None = "dist_deg", keep=None, cell_deg: float | None = None,
                       crowded: bool = False) -> DataFrame:
    """All pairs of rows with a separation of at most ``radius_deg``.

    ``repeat`` names the side that is copied to the cells it touches: take the smaller
    one.  ``on`` lists further pairs of columns that must be equal.  ``keep`` is an extra
    predicate tested inside the join.  ``cell_deg`` asks for larger cells, which copy fewer rows where the
    sky is not crowded.  ``crowded`` first counts how crowded the repeated side is: cells much smaller than the circle copy more of its rows, but
    rows meet fewer that are not in reach.  With ``how`` set to ``left_outer``, ``left_anti`` or
    ``left_semi`` the right side must be the repeated one.  Column names of the two sides
    must differ.
    """
    if how != "inner" and repeat != "right":
        raise ValueError("only the right side can be repeated in an outer, semi or anti join")
    h = max(cell_height(radius_deg), cell_deg or 0.0)
    merge = (lambda df: df.hint("merge")) if crowded else (lambda df: df)  # Spark does not see how many copies there are: it would broadcast them
    if crowded:
        h = min(h, _crowded_cell(right if repeat == "right" else left, right_pos if repeat == "right" else left_pos, radius_deg))

    def keyed(df, pos, tag, copied):
        x, y, z = unit_vector(*pos)
        df = df.withColumns({f"__{tag}x": x, f"__{tag}y": y, f"__{tag}z": z})
        names = {"zone": f"__{tag}zone", "cell": f"__{tag}cell"}
        return merge(with_touched_cells(df, *pos, radius_deg, h, **names)) if copied else with_cell(df, *pos, h, **names)

    a = keyed(left, left_pos, "a", repeat == "left")
    b = keyed(right, right_pos, "b", repeat == "right")
    c2 = chord2(["__ax", "__ay", "__az"], ["__bx", "__by", "__bz"])
    match = (F.col("__azone") == F.col("__bzone")) & (F.col("__acell") == F.col("__bcell"))
    for p, q in on:
        match = match & (F.col(p) == F.col(q))
    match = match & (c2 <= chord2_limit(radius_deg))
    if keep is not None:
        match = match & keep
    joined = a.join(b, match, how)
    if distance and how in ("inner", "left_outer"):
        joined = joined.withColumn(distance, chord2_to_deg(c2))
    return joined.drop(*[f"__{t}{n}" for t in "ab" for n in ("x", "y", "z", "zone", "cell")])


CROWDS = ((64.0, 0.5), (16.0, 1.0))  # rows around a row, from which on cells have such a part of the radius


def _crowded_cell(df: DataFrame, pos, radius_deg: float) -> float:
    """Height of the cells for the crowding around the rows: how many share the cell of one, of the usual height."""
    h = cell_height(radius_deg)
    counts = with_cell(df.select(*pos), *pos, h, "__zone", "__cell").groupBy("__zone", "__cell").agg(F.count("*").cast("double").alias("n"))
    n, squares = counts.agg(F.sum("n"), F.sum(F.col("n") * F.col("n"))).first()
    around = squares / n if n else 0.0
    return next((max(part * radius_deg, FINEST_CELL_DEG) for least, part in CROWDS if around > least), h)


def sky_join_nearest(left: DataFrame, right: DataFrame, radius_deg: float, left_key: str, right_key: str,
                     left_pos=("ra", "dec"), right_pos=("ra0", "dec0"), on=(), keep_right: list[str] = ()) -> DataFrame:
    """Nearest right row within the radius for each left row, NULL where there is none.

    Uses the flat distance with cos(dec) of the left position, as the forced-photometry
    light curves do; equal distances go to the smaller key.  A flat distance is shorter than the true
    one where the right row lies nearer the equator: squared, by at most cos(|dec| - radius) / cos(dec).
    Up to ``CAP_DEG`` the true distance preselects with that bound; the caps around the poles, where
    it has no end, are joined by declination.  Left rows that are equal in all columns stay apart.
    """
    from .nearest import nearest, tile_width

    flat = flat_distance_deg(*left_pos, *right_pos)
    near = flat <= radius_deg
    rights = right.filter(F.col(right_key).isNotNull()).select(*dict.fromkeys([right_key, *right_pos, *[q for _, q in on], *keep_right]))
    at_cap = F.abs(F.col(left_pos[1])) > CAP_DEG
    low = max(0.0, CAP_DEG - radius_deg)
    wide = radius_deg * math.sqrt(max(1.0, math.cos(math.radians(low)) / math.cos(math.radians(CAP_DEG)))) * (1 + 1e-6)
    same = [f"__on{i}" for i in range(len(on))]
    tile = ["__zone", "__cell", *same]
    known = rights.withColumns({n: F.col(q) for n, (_, q) in zip(same, on)}).dropna(subset=[*right_pos, *same])

    def tiles(df, width):
        return with_touched_cells(df, *right_pos, min(wide, 180.0), width, "__zone", "__cell")

    h, rows = tile_width(known, wide, tiles, tile, WIDEST_TILE_DEG)
    lefts = with_cell(left.filter(~F.coalesce(at_cap, F.lit(False))), *left_pos, h, "__zone", "__cell").withColumns({n: F.col(p) for n, (p, _) in zip(same, on)})
    pairs = nearest(lefts, tiles(known, h), rows, tile, left_pos, right_pos, radius_deg, _flat_distances, [F.col(f"r.{c}") for c in (right_key, *keep_right)], 360.0)
    # names of the two sides may be the same here and there
    best = lambda at, r: F.struct(at.alias("dist_deg"), *[F.col(f"{r}{c}").alias(c) for c in (right_key, *keep_right)])
    between = flat_distance_deg(*[F.col(f"l.{c}") for c in left_pos], *[F.col(f"r.{c}") for c in right_pos])
    body = pairs.select("l.*", F.when(F.col("r").isNotNull(), best(between, "r.")).alias("__best"))

    band = lambda c: F.floor(F.col(c) / radius_deg)
    caps = rights.filter(F.abs(F.col(right_pos[1])) > low - MARGIN_DEG)
    caps = caps.withColumn("__band", F.explode(F.array(*[band(right_pos[1]) + d for d in (-1, 0, 1)])))
    match = (band(left_pos[1]) == F.col("__band")) & near
    for p, q in on:
        match = match & (F.col(p) == F.col(q))
    lefts = left.filter(at_cap).groupBy(*left.columns).agg(F.count(F.lit(1)).alias("__copies"))
    polar = lefts.join(caps, match, "left_outer").drop("__band")
    polar = polar.groupBy(*left.columns, "__copies").agg(F.min(F.when(F.col(right_key).isNotNull(), best(flat, ""))).alias("__best"))
    polar = polar.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).drop("__copies", "__copy")
    return body.unionByName(polar).select(*left.columns, "__best.*")


WIDEST_TILE_DEG = 5.0


def _flat_distances(ra, dec, cosine, ra2, dec2):
    """``flat_distance_deg`` in numpy, the same numbers."""
    turned = np.fmod(ra2 - ra + 540.0, 360.0)
    u, v = (np.where(turned < 0, np.fmod(turned + 360.0, 360.0), turned) - 180.0) * cosine, dec2 - dec
    return np.sqrt(u * u + v * v)


def flat_distance_deg(ra, dec, ra2, dec2) -> Column:
    """Pythagorean distance on the tangent plane at (ra, dec), short way round in ra."""
    dra = F.pmod(col(ra2) - col(ra) + 540.0, F.lit(360.0)) - 180.0
    u, v = dra * F.cos(F.radians(col(dec))), col(dec2) - col(dec)
    return F.sqrt(u * u + v * v)


def cone_search(df: DataFrame, ra: float, dec: float, radius_deg: float, pos=("ra", "dec")) -> DataFrame:
    """Rows within ``radius_deg`` of a position, nearest first.

    The declination band and the right ascensions that the cone reaches are plain range predicates, so they
    reach the Parquet scan; a cone that holds a pole reaches all right ascensions.
    """
    ra_c, dec_c = pos
    c2 = position_chord2(ra_c, dec_c, ra, dec)
    band = F.col(dec_c).between(dec - radius_deg - MARGIN_DEG, dec + radius_deg + MARGIN_DEG)
    if abs(dec) + radius_deg < 90.0 - MARGIN_DEG:
        half = math.degrees(math.asin(min(1.0, math.sin(math.radians(radius_deg)) / math.cos(math.radians(dec))))) + MARGIN_DEG
        low, high = ra - half, ra + half
        reach = F.col(ra_c).between(low, high)
        if low < 0.0:
            reach = reach | (F.col(ra_c) >= low + 360.0)
        if high >= 360.0:
            reach = reach | (F.col(ra_c) <= high - 360.0)
        band = band & reach
    return df.filter(band & (c2 <= chord2_limit(radius_deg))).withColumn("dist_deg", chord2_to_deg(c2)).orderBy("dist_deg")


def batch_cone_search(positions: DataFrame, catalog: DataFrame, radius_deg: float, position_pos=("ra", "dec"),
                      catalog_pos=("ra0", "dec0")) -> DataFrame:
    """Catalogue rows around many positions at once."""
    return sky_join_all_pairs(positions, catalog, radius_deg, position_pos, catalog_pos, repeat="left")


FIRST_AT_ONCE = 500_000  # rows of a task that are cut down to the first of each key together
SORTED_IN_NUMPY = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _first_rows(key: str, k: int, order: list[str]):
    """At most the first ``k`` rows of each key among the rows of a task, as a function of Arrow batches; a key may come again later."""
    def first(table: pa.Table) -> pa.Table:
        keys = []
        for name in (key, *order):
            c = table.column(name).combine_chunks()
            keys += [c.is_valid().to_numpy(zero_copy_only=False), pc.fill_null(c, 0).to_numpy(zero_copy_only=False)]  # NULL first, NaN last
        at = np.lexsort(keys[::-1])
        known, value = (c[at] for c in keys[:2])
        new = np.ones(len(at), bool)
        new[1:] = (known[1:] != known[:-1]) | (value[1:] != value[:-1]) & ~((value[1:] != value[1:]) & (value[:-1] != value[:-1]))
        start = np.flatnonzero(new)
        rank = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
        return table.take(pa.array(at[rank < k]))

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= FIRST_AT_ONCE:
                table = first(pa.Table.from_batches(held))
                if 2 * len(table) > FIRST_AT_ONCE:  # mostly keys with few rows: waiting would not help
                    yield from table.to_batches()
                    table = table.slice(0, 0)
                held, rows = table.to_batches(), len(table)
        if rows:
            yield from first(pa.Table.from_batches(held)).to_batches()

    return run


def nearest_k(pairs: DataFrame, key: str, k: int, order: list[str]) -> DataFrame:
    """The first ``k`` rows of each key in the given order.

    Rows are cut down where they arise, a bounded number at a time, so what is sorted and shuffled follows the keys, not the pairs.  Columns
    that numpy does not sort take a first round per (key, hash slice) instead, which cuts a hot key down in many tasks.
    """
    last = Window.partitionBy(key).orderBy(*order)
    if {pairs.schema[c].dataType.simpleString() for c in (key, *order)} <= set(SORTED_IN_NUMPY):
        some = pairs.mapInArrow(_first_rows(key, k, order), pairs.schema)
    else:
        first = Window.partitionBy(key, "__slice").orderBy(*order)
        some = (pairs.withColumn("__slice", F.pmod(F.xxhash64(*order), F.lit(32)))
                .withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k).drop("__slice", "rank"))
    return some.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)


def overlapping_images(targets: DataFrame, images: DataFrame, radius_deg: float = 0.18) -> DataFrame:
    """Best images of the same filter that overlap the sky tile of each target.

    ``targets``: rid, fid, start_mjd, end_mjd and a tile as ra0, dec0 ... ra4, dec4.
    ``images``: other_rid, other_fid, other_mjd, vbest, status and a footprint as
    ra0, dec0 ... ra4, dec4.  The centre must be in the cone, and the centre or a corner of
    the image inside the tile.
    """
    corners = [n + str(i) for i in range(5) for n in ("ra", "dec")]
    a = targets.select("rid", "fid", "start_mjd", "end_mjd", *[F.col(c).alias("t_" + c) for c in corners])
    b = images.filter((F.col("vbest") > 0) & (F.col("status") > 0)).select(
        "other_rid", "other_fid", "other_mjd", *[F.col(c).alias("i_" + c) for c in corners])
    tile = [unit_vector(f"t_ra{i}", f"t_dec{i}") for i in range(1, 5)]
    inside = [in_convex_polygon(unit_vector(f"i_ra{i}", f"i_dec{i}"), tile) for i in range(5)]
    any_inside = inside[0] | inside[1] | inside[2] | inside[3] | inside[4]
    window = (F.col("other_mjd") >= F.col("start_mjd")) & (F.col("other_mjd") < F.col("end_mjd"))
    pairs = sky_join_all_pairs(a, b, radius_deg, ("t_ra0", "t_dec0"), ("i_ra0", "i_dec0"), on=[("fid", "other_fid")],
                               repeat="left", keep=window & (F.col("rid") != F.col("other_rid")))
    return pairs.filter(any_inside).select("rid", "other_rid", "other_mjd", "dist_deg")


def catalog_match_nearest_pixel(ref: DataFrame, sci: DataFrame, radius: float, compat: bool = False) -> DataFrame:
    """Nearest science source in pixel space for each reference source of the same image.

    ``ref``: image_id, ref_id, x, y, ...; ``sci``: image_id, sci_id, x, y, ....  ``compat``
    keeps the older preselection |dx| <= radius / sqrt(2), which loses some matches.
    """
    from .nearest import nearest, tile_width

    known = [df.filter(F.col("image_id").isNotNull() & (F.abs(F.col("x")) < float("inf")) & (F.abs(F.col("y")) < float("inf"))) for df in (ref.select("image_id", "ref_id", "x", "y"), sci)]
    tile, wide = ["__image", "__gx", "__gy"], radius * (1 + 1e-6)

    def tiles(df, width):
        cells = lambda c: F.sequence(F.floor((F.col(c) - wide) / width), F.floor((F.col(c) + wide) / width))
        return df.withColumn("__image", F.col("image_id")).withColumn("__gx", F.explode(cells("x"))).withColumn("__gy", F.explode(cells("y")))

    def distances(x, y, _, x2, y2):
        dx, dy = x - x2, y - y2
        d2 = dx * dx + dy * dy
        far = d2 > radius * radius
        if compat:
            # a nearest source outside the circle hides a farther one inside the strip: no effect on the minimum
            far |= np.abs(dx) > radius / math.sqrt(2.0)
        return np.where(far, np.inf, d2)

    h, rows = tile_width(known[1], radius, tiles, tile)
    lefts = known[0].withColumns({"__image": F.col("image_id"), "__gx": F.floor(F.col("x") / h), "__gy": F.floor(F.col("y") / h)})
    extra = [c for c in sci.columns if c not in ("image_id", "x", "y", "sci_id")]
    order = [F.col("r.sci_id"), F.desc("r.x"), F.desc("r.y"), *[F.col(f"r.{c}") for c in extra]]
    pairs = nearest(lefts, tiles(known[1], h), rows, tile, ("x", "y"), ("x", "y"), radius, distances, order, squared=True)
    dx, dy = F.col("l.x") - F.col("r.x"), F.col("l.y") - F.col("r.y")
    best = F.min(F.struct((dx * dx + dy * dy).alias("d2"), F.col("r.sci_id"), dx.alias("dx"), dy.alias("dy"), *[F.col(f"r.{c}") for c in extra]))
    return (pairs.filter("r IS NOT NULL").groupBy(F.col("l.image_id").alias("image_id"), F.col("l.ref_id").alias("ref_id")).agg(best.alias("b"))
            .select("image_id", "ref_id", "b.*").withColumn("distance", F.sqrt("d2")).drop("d2"))


def isolated_sources(sources: DataFrame, box: float, mag_limit: float, edge: float, naxis1: int, naxis2: int) -> DataFrame:
    """Bright sources away from the edges with no other source of the image in the box.

    ``sources``: image_id, src_id, x, y, mag.  A box count per grid cell would need all
    pairs; an anti join only tests for a neighbour.
    """
    inner = ((F.col("mag") <= mag_limit) & (F.col("x") > edge) & (F.col("x") < naxis1 - edge - 1)
             & (F.col("y") > edge) & (F.col("y") < naxis2 - edge - 1))
    keyed = sources.withColumns({"__gx": F.floor(F.col("x") / box), "__gy": F.floor(F.col("y") / box)})
    others = keyed.select(F.col("image_id").alias("o_image"), F.col("src_id").alias("o_id"), F.col("x").alias("o_x"),
                          F.col("y").alias("o_y"),
                          F.explode(F.array(*[F.col("__gx") + d for d in (-1, 0, 1)])).alias("o_gx"), "__gy")
    others = others.withColumn("o_gy", F.explode(F.array(*[F.col("__gy") + d for d in (-1, 0, 1)]))).drop("__gy")
    hit = ((F.col("image_id") == F.col("o_image")) & (F.col("__gx") == F.col("o_gx")) & (F.col("__gy") == F.col("o_gy"))
           & (F.col("src_id") != F.col("o_id"))
           & (F.abs(F.col("x") - F.col("o_x")) <= box) & (F.abs(F.col("y") - F.col("o_y")) <= box))
    return keyed.filter(inner).join(others, hit, "left_anti").drop("__gx", "__gy")


SPOTS_PER_LIST = 4096  # places that a row of a joined cell lists


def _crowded_reach(spots: DataFrame, radius: float) -> float | None:
    """A smaller reach in which most positions have a spot, where the spots are so crowded that the whole radius holds many.

    The crowding is that around the spots themselves: how many share the cell of one.
    """
    counts = spots.groupBy("image_id", F.floor(F.col("x") / radius), F.floor(F.col("y") / radius)).agg(F.count(F.lit(1)).alias("n"))
    n, squares = counts.agg(F.sum("n"), F.sum(F.col("n").cast("double") * F.col("n"))).first()
    density = (squares / n - 1.0) / radius ** 2 if n else 0.0
    reach = math.sqrt(6.0 / (math.pi * density)) if density > 0 else radius  # six spots within it: one position in 400 has none
    return reach if reach < radius / 2 else None


def _nearest_spot(dets: DataFrame, spots: DataFrame, reach: float) -> DataFrame:
    """``dets`` with the nearest spot nearer than ``reach`` as ``b`` (d2, truth_id), null where there is none.

    The spots are listed by cells of twice the reach, each in all cells that its circle touches, so a detection meets
    one list instead of a row for each pair; a cell with more than ``SPOTS_PER_LIST`` spots has several
    lists, and its detections a row for each.
    """
    h, wide = 2.0 * reach, reach * (1 + 1e-6)
    cells = lambda c: F.sequence(F.floor((F.col(c) - wide) / h), F.floor((F.col(c) + wide) / h))
    cell = ["t_image", "t_gx", "t_gy"]
    t = (spots.withColumnRenamed("image_id", "t_image").withColumn("t_gx", F.explode(cells("x"))).withColumn("t_gy", F.explode(cells("y")))
         .withColumn("__lists", F.ceil(F.count(F.lit(1)).over(Window.partitionBy(*cell)) / SPOTS_PER_LIST))
         .groupBy(*cell, F.pmod(F.xxhash64("x", "y"), "__lists").alias("__list"))
         .agg(F.sort_array(F.collect_list(F.struct("truth_id", "x", "y"))).alias("__spots"))
         .select(*cell, *[F.col("__spots." + c).alias("__" + c) for c in ("truth_id", "x", "y")]))
    at = dets.withColumns({"__gx": F.floor(F.col("x") / h), "__gy": F.floor(F.col("y") / h)})

    def d2(x, y):
        dx, dy = F.col("x") - x, F.col("y") - y
        return dx * dx + dy * dy

    hit = (F.col("image_id") == F.col("t_image")) & (F.col("__gx") == F.col("t_gx")) & (F.col("__gy") == F.col("t_gy"))
    joined = at.join(t, hit, "left_outer").withColumn("__d2s", F.zip_with("__x", "__y", d2)).withColumn("__d2", F.array_min("__d2s"))
    # the lists are in order of the ids: the first of equal distances has the least
    best = F.struct(F.col("__d2").alias("d2"), F.get("__truth_id", F.array_position("__d2s", F.col("__d2")).cast("int") - 1).alias("truth_id"))
    return joined.withColumn("b", F.when(F.col("__d2") < reach * reach, best)).select(*dets.columns, "b")


def truth_match(detections: DataFrame, truth: DataFrame, radius: float) -> DataFrame:
    """Label each detection true when an injected source lies nearer than ``radius`` pixels.

    ``detections``: image_id, det_id (numbered within an image), x, y, flux, flux_err; ``truth``: image_id,
    truth_id, x, y.  Detections without positive flux are left out, a zero error becomes 1e7.
    """
    dets = (detections.filter(F.col("flux") > 0)
            .withColumn("flux_err", F.when(F.col("flux_err") == 0, 1.0e7).otherwise(F.col("flux_err")))
            .withColumn("snr", F.col("flux") / F.col("flux_err")))
    # of several sources at one place, the least id is the match
    spots = (truth.filter("image_id IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL AND truth_id IS NOT NULL")
             .groupBy("image_id", "x", "y").agg(F.min("truth_id").alias("truth_id")))
    near = _crowded_reach(spots, float(radius))
    if near is None:
        found = _nearest_spot(dets, spots, float(radius))
    else:
        # most find their source close by; who does not looks at the whole circle
        first = cut_lineage(_nearest_spot(dets, spots, near))
        found = first.filter("b IS NOT NULL").unionByName(_nearest_spot(first.filter("b IS NULL").drop("b"), spots, float(radius)))
    best = F.min("b")
    keep = [c for c in dets.columns if c not in ("image_id", "det_id")]
    out = found.groupBy("image_id", "det_id").agg(
        *[F.any_value(c).alias(c) for c in keep], best.alias("b"))
    return out.select("image_id", "det_id", *keep, F.col("b.truth_id").alias("truth_id"), F.sqrt("b.d2").alias("distance"),
                      F.col("b").isNotNull().alias("is_true"))
