"""Area of overlap of convex quadrilaterals: as an expression over short arrays, and of many pairs at once in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.geometry import OFF_PLANE


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _side(p: Column, a: Column, b: Column) -> Column:
    """Positive where p lies left of the line from a to b."""
    return (b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"])


def polygon_area(points: Column) -> Column:
    """Signed area of a polygon given as an array of (x, y): positive when counter-clockwise."""
    n = F.size(points)
    terms = F.transform(points, lambda p, i: p["x"] * F.get(points, (i + 1) % n)["y"] - F.get(points, (i + 1) % n)["x"] * p["y"])
    return F.when(n > 2, 0.5 * F.aggregate(terms, F.lit(0.0), lambda s, v: s + v)).otherwise(0.0)


def _clip(df: DataFrame, edge: int) -> DataFrame:
    """Cut the polygon ``__s`` at one edge of ``__c``: keep the part on its left."""
    a, b = F.get("__c", F.lit(edge)), F.get("__c", F.lit((edge + 1) % 4))

    def pieces(p, i):
        q = F.get("__s", (i + 1) % F.size("__s"))
        dp, dq = _side(p, a, b), _side(q, a, b)
        t = dp / (dp - dq)
        cut = _point(p["x"] + t * (q["x"] - p["x"]), p["y"] + t * (q["y"] - p["y"]))
        crosses = ((dp > 0) & (dq < 0)) | ((dp < 0) & (dq > 0))
        return F.concat(F.when(dp >= 0, F.array(p)).otherwise(F.array_remove(F.array(p), p)),
                        F.when(crosses, F.array(cut)).otherwise(F.array_remove(F.array(p), p)))

    return df.withColumn("__s", F.flatten(F.transform("__s", pieces)))


def overlap_area(df: DataFrame, subject: Column, clip: Column, out: str) -> DataFrame:
    """Add the common area of two convex quadrilaterals (arrays of four (x, y))."""
    df = df.withColumns({"__s": subject, "__c": clip})
    # edges keep the inside on their left: turn the clip polygon round where needed
    df = df.withColumn("__c", F.when(polygon_area(F.col("__c")) < 0, F.reverse("__c")).otherwise(F.col("__c")))
    for edge in range(4):
        df = _clip(df, edge)
    return df.withColumn(out, F.abs(polygon_area(F.col("__s")))).drop("__s", "__c")


CORNERS = [f"{prefix}{axis}{i}" for prefix in ("", "o_") for i in range(1, 5) for axis in ("ra", "dec")]


def planes(ra0, dec0, *corners: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Both quadrilaterals of each pair as (x, y) by (corner, pair), on the tangent plane at (ra0, dec0) in arcseconds.

    ``corners`` as in ``CORNERS``; the same numbers as ``tan_deproject`` gives, NaN where something is missing.
    """
    values = np.radians([c.to_numpy(zero_copy_only=False) for c in (ra0, dec0, *corners)])
    d0, da, d = values[1], values[2::2] - values[0], values[3::2]
    along = np.cos(d) * np.cos(da)
    with np.errstate(divide="ignore", invalid="ignore"):
        toward = np.sin(d0) * np.sin(d) + np.cos(d0) * along
        x = np.degrees(np.cos(d) * np.sin(da) / toward) * 3600.0
        y = np.degrees((np.cos(d0) * np.sin(d) - np.sin(d0) * along) / toward) * 3600.0
        at = np.where(toward <= 0, OFF_PLANE, np.stack([x, y]))
    return at[:, :4], at[:, 4:]


def signed_areas(quads: np.ndarray) -> np.ndarray:
    """Areas of (x, y) by (corner, row): positive when counter-clockwise."""
    (x, y), (u, v) = quads, np.roll(quads, -1, axis=1)
    return 0.5 * (x * v - u * y).sum(axis=0)


def _turns(quads: np.ndarray) -> np.ndarray:
    """1 where all corners turn left, -1 where all turn right, 0 for others: a quadrilateral with a turn is convex and has an area."""
    (ax, ay) = np.roll(quads, -1, axis=1) - quads
    (bx, by) = np.roll(quads, -2, axis=1) - np.roll(quads, -1, axis=1)
    turn = ax * by - ay * bx
    return (turn > 0).all(axis=0).astype(int) - (turn < 0).all(axis=0)


def convex_common(subject: np.ndarray, clip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(area, known): the common areas of pairs of quadrilaterals, (x, y) by (corner, pair), many pairs at once.

    The edges of the subject are cut at each edge of the clip quadrilateral in turn, and one edge along it closes what is left.  ``known`` is False
    where a quadrilateral is not convex or has no area, and where rounding makes a border cross an edge more than once.
    """
    turn = _turns(clip)
    known = (_turns(subject) != 0) & (turn != 0)
    clip = np.where(turn < 0, clip[:, ::-1], clip)  # edges keep the inside on their left
    p, q = subject, np.roll(subject, -1, axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for k in range(4):
            at, along = clip[:, k], clip[:, (k + 1) % 4] - clip[:, k]
            dp, dq = (along[0] * (v[1] - at[1]) - along[1] * (v[0] - at[0]) for v in (p, q))
            leaves, enters = (dp >= 0) & (dq < 0), (dp < 0) & (dq >= 0)
            cut = p + dp / (dp - dq) * (q - p)
            known &= (leaves.sum(axis=0) <= 1) & (enters.sum(axis=0) <= 1)
            end, start = (np.where(m, cut, 0.0).sum(axis=1, keepdims=True) for m in (leaves, enters))
            q = np.where(leaves, cut, np.where((dp < 0) & (dq < 0), p, q))
            p = np.where(enters, cut, p)
            out = (dp < 0) & (dq < 0)
            p, q = np.where(out, 0.0, p), np.where(out, 0.0, q)
            p, q = np.concatenate([p, end], axis=1), np.concatenate([q, start], axis=1)
    return np.abs(0.5 * (p[0] * q[1] - q[0] * p[1]).sum(axis=0)), known


def _clipped_slowly(subject: np.ndarray, clip: np.ndarray) -> float:
    """Common area of two quadrilaterals (corner by (x, y)), edge by edge, as ``overlap_area``."""
    side = lambda p, a, b: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    area = lambda v: 0.5 * sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(v, v[1:] + v[:1])) if len(v) > 2 else 0.0
    points, corners = [tuple(v) for v in subject.tolist()], [tuple(v) for v in clip.tolist()]
    if area(corners) < 0:
        corners = corners[::-1]
    for a, b in zip(corners, corners[1:] + corners[:1]):
        left = []
        for p, q in zip(points, points[1:] + points[:1]):
            dp, dq = side(p, a, b), side(q, a, b)
            if dp >= 0:
                left.append(p)
            if dp > 0 > dq or dp < 0 < dq:
                t = dp / (dp - dq)
                left.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        points = left
    return abs(area(points))


def areas_type(*names: str) -> StructType:
    return StructType([StructField(n, DoubleType()) for n in names])


@F.arrow_udf(areas_type("overlap_area", "own_area"))
def _quad_overlap(*columns: pa.Array) -> pa.Array:
    own, other = planes(*columns)
    area, known = convex_common(own, other)
    there = np.isfinite(own).all(axis=(0, 1)) & np.isfinite(other).all(axis=(0, 1))
    for i in np.flatnonzero(there & ~known).tolist():
        area[i] = _clipped_slowly(own[:, :, i].T, other[:, :, i].T)
    return pa.StructArray.from_arrays([pa.array(v, mask=~there) for v in (area, np.abs(signed_areas(own)))], ["overlap_area", "own_area"])


def footprint_overlap_percent(pairs: DataFrame) -> DataFrame:
    """Percentage of each image covered by another footprint.

    ``pairs``: footprints ra0, dec0 ... ra4, dec4 and o_ra0, o_dec0 ... o_ra4, o_dec4.  Both are
    projected on the tangent plane at the centre of the first, in arcseconds.  Many pairs are clipped at once in numpy.
    """
    df = pairs.withColumn("__o", _quad_overlap(*[F.col(c).cast("double") for c in ("ra0", "dec0", *CORNERS)]))
    df = df.withColumn("overlap_area", F.col("__o.overlap_area"))
    return df.withColumn("percent", F.try_divide(100.0 * F.col("overlap_area"), F.col("__o.own_area"))).drop("__o")
