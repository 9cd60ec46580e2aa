"""Matches of sources with moving objects, whose positions are given along segments of time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import chord2, chord2_limit, chord2_to_deg, from_unit_vector, unit_vector
from .spatial import MIN_CELL_DEG, with_cell, with_touched_cells

MOST_STEPS = 100_000  # pieces of one segment: beyond, the segment must be given in shorter ones


def _between(start: str, stop: str, f):
    """The direction at the share ``f`` of the way along the chord from start to stop."""
    a, b = unit_vector(f"{start}_ra", f"{start}_dec"), unit_vector(f"{stop}_ra", f"{stop}_dec")
    v = [p + f * (q - p) for p, q in zip(a, b)]
    size = F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
    return [c / size for c in v]


def moving_object_matches(sources: DataFrame, segments: DataFrame, radius_deg: float, piece_deg: float | None = None) -> DataFrame:
    """sid, ss_id, dist_deg: for each source the moving object nearest to it at its own time, if one is within the radius.

    ``sources``: sid, mjdobs, ra, dec.  ``segments``: ss_id, start_mjd, start_ra, start_dec, stop_mjd, stop_ra, stop_dec; an object moves evenly
    along the chord from start to stop (start included, stop not), short against the sphere.  A segment is cut in
    pieces of about ``piece_deg``, each covered by the sky cells around it and valid for its part of the time, so a source meets
    few pieces: an equi-join on cells.  Equal distances go to the smaller ss_id.  Rows with missing values match nothing.
    """
    piece = piece_deg or max(4.0 * radius_deg, MIN_CELL_DEG)
    h = max(2.0 * (radius_deg + piece), MIN_CELL_DEG)
    whole = segments.dropna().filter("stop_mjd > start_mjd")
    length = chord2_to_deg(chord2(unit_vector("start_ra", "start_dec"), unit_vector("stop_ra", "stop_dec")))
    steps = F.least(F.ceil(length / piece), F.lit(MOST_STEPS)).cast("int")
    pieces = whole.withColumn("__steps", F.greatest(steps, F.lit(1))).withColumn("__i", F.explode(F.sequence(F.lit(0), F.col("__steps") - 1)))
    share = lambda d: (F.col("__i") + d) / F.col("__steps")
    time = lambda f: F.col("start_mjd") + f * (F.col("stop_mjd") - F.col("start_mjd"))
    ra, dec = from_unit_vector(*_between("start", "stop", share(0.5)))
    # the chord's pieces differ in angle; half of the longest is less than a piece
    reach = F.lit(radius_deg) + F.greatest(F.lit(piece), length / F.col("__steps"))
    pieces = pieces.select("*", ra.alias("__ra"), dec.alias("__dec"), F.when(F.col("__i") == 0, F.col("start_mjd")).otherwise(time(share(0))).alias("__from"),
                           F.when(F.col("__i") == F.col("__steps") - 1, F.col("stop_mjd")).otherwise(time(share(1))).alias("__to"), reach.alias("__reach"))
    pieces = with_touched_cells(pieces, "__ra", "__dec", "__reach", h, "__zone", "__cell").drop("__ra", "__dec", "__reach", "__i", "__steps")
    points = with_cell(sources.select("sid", "mjdobs", "ra", "dec").dropna(), "ra", "dec", h, "__szone", "__scell")
    f = (F.col("mjdobs") - F.col("start_mjd")) / (F.col("stop_mjd") - F.col("start_mjd"))
    c2 = chord2(unit_vector("ra", "dec"), _between("start", "stop", f))
    match = ((F.col("__zone") == F.col("__szone")) & (F.col("__cell") == F.col("__scell")) & (F.col("mjdobs") >= F.col("__from")) & (F.col("mjdobs") < F.col("__to"))
             & (c2 <= chord2_limit(radius_deg)))
    best = points.join(pieces, match).groupBy("sid").agg(F.min(F.struct(c2.alias("c2"), "ss_id")).alias("b"))
    return best.select("sid", F.col("b.ss_id").alias("ss_id"), chord2_to_deg(F.col("b.c2")).alias("dist_deg"))


def with_moving_objects(alerts: DataFrame, matches: DataFrame) -> DataFrame:
    """Alert packets with ``ssSource`` filled for the triggers that are a moving object; ``matches`` as ``moving_object_matches`` gives them."""
    found = matches.select(F.col("sid").alias("__sid"), F.struct(F.col("ss_id").cast("long").alias("ssObjectId")).alias("__ss"))
    joined = alerts.join(found, F.col("diaSourceId") == F.col("__sid"), "left_outer")
    return joined.withColumn("ssSource", F.coalesce("__ss", "ssSource")).select(alerts.columns)
