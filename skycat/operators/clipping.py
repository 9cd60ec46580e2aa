"""Common area of general polygons: concave ones, with holes, of several parts, by a sweep.

A polygon is an array of rings, a ring an array of (x, y); what lies in an odd number of rings is inside, so a ring within another is a
hole whatever its sense.  The sweep cuts the plane in slabs at all corners and crossings.  Within a slab no edges cross, so
in order of x they bound trapezoids, and counting edges tells which trapezoids lie in both polygons.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import tan_deproject
from .overlap import CORNERS, areas_type, convex_common, planes, signed_areas

RINGS = "array<array<struct<x:double,y:double>>>"


def edges_of(rings) -> np.ndarray:
    """(x0, y0, x1, y1) of all edges that are not level, upwards.  Rings with a missing value, or under three points, are left out."""
    out = []
    for ring in rings or []:
        points = np.array([(p["x"], p["y"]) if p is not None else (np.nan, np.nan) for p in ring or []], float).reshape(-1, 2)
        if len(points) < 3 or not np.isfinite(points).all():
            continue
        edges = np.concatenate([points, np.roll(points, -1, axis=0)], axis=1)
        edges = edges[edges[:, 1] != edges[:, 3]]
        down = edges[:, 1] > edges[:, 3]
        edges[down] = edges[down][:, [2, 3, 0, 1]]
        out.append(edges)
    return np.concatenate(out) if out else np.zeros((0, 4))


def _crossings(e: np.ndarray) -> np.ndarray:
    """Heights at which two edges cross."""
    i, j = np.triu_indices(len(e), 1)
    touch = (e[i, 1] < e[j, 3]) & (e[j, 1] < e[i, 3]) & (np.minimum(e[i, 0], e[i, 2]) <= np.maximum(e[j, 0], e[j, 2])) & (np.minimum(e[j, 0], e[j, 2]) <= np.maximum(e[i, 0], e[i, 2]))
    a, b = e[i[touch]], e[j[touch]]
    slope_a, slope_b = ((k[:, 2] - k[:, 0]) / (k[:, 3] - k[:, 1]) for k in (a, b))
    with np.errstate(divide="ignore", invalid="ignore"):
        y = (b[:, 0] - slope_b * b[:, 1] - a[:, 0] + slope_a * a[:, 1]) / (slope_a - slope_b)
    return y[np.isfinite(y) & (y > np.maximum(a[:, 1], b[:, 1])) & (y < np.minimum(a[:, 3], b[:, 3]))]


def areas(subject, clip) -> tuple[float, float, float]:
    """Area of the subject, of the clip polygon, and of what they share."""
    a, b = edges_of(subject), edges_of(clip)
    e, owner = np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)])
    if not len(e):
        return 0.0, 0.0, 0.0
    y = np.unique(np.concatenate([e[:, 1], e[:, 3], _crossings(e)]))
    low, high = y[:-1], y[1:]
    middle = (low + high) / 2
    x = e[:, 0] + (middle[:, None] - e[:, 1]) / (e[:, 3] - e[:, 1]) * (e[:, 2] - e[:, 0])
    x[(e[:, 1] > low[:, None]) | (e[:, 3] < high[:, None])] = np.inf
    order = np.argsort(x, axis=1, kind="stable")
    x, mine = np.take_along_axis(x, order, axis=1), owner[order]
    active = np.isfinite(x)
    with np.errstate(invalid="ignore"):
        width = np.where(active[:, 1:], x[:, 1:] - x[:, :-1], 0.0) * (high - low)[:, None]
    inside = [(np.cumsum((mine == k) & active, axis=1) % 2 == 1)[:, :-1] for k in (0, 1)]
    return tuple(float(width[m].sum()) for m in (inside[0], inside[1], inside[0] & inside[1]))


def _ring_edges(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, edge) of the edges of a whole column of rings, as ``edges_of`` makes them, without a Python object for each point."""
    rings, row_of_ring = pc.list_flatten(column), pc.list_parent_indices(column).to_numpy()
    points, ring = pc.list_flatten(rings), pc.list_parent_indices(rings).to_numpy()
    x, y = (f.to_numpy(zero_copy_only=False).astype(float) for f in points.flatten())
    bad = np.bincount(ring, ~(np.isfinite(x) & np.isfinite(y)), len(rings)) > 0
    good = ((np.bincount(ring, minlength=len(rings)) >= 3) & ~bad)[ring] if len(ring) else np.zeros(0, bool)
    x, y, ring = x[good], y[good], ring[good]
    first = np.flatnonzero(np.diff(ring, prepend=-1))
    after = np.arange(1, len(ring) + 1)
    after[np.append(first[1:], len(ring))[: len(first)] - 1] = first  # the last point of a ring goes back to its first
    edges = np.stack([x, y, x[after], y[after]], axis=1).reshape(-1, 4)
    level = edges[:, 1] == edges[:, 3]
    edges, row = edges[~level], row_of_ring[ring[~level]] if len(ring) else np.zeros(0, np.int64)
    down = edges[:, 1] > edges[:, 3]
    edges[down] = edges[down][:, [2, 3, 0, 1]]
    return row, edges


CELLS_AT_ONCE = 400_000  # slabs times edges of the pairs that are worked on together


def _sweep(e: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """(pairs, 3) areas as of ``areas`` for pairs of polygons with the same number of edges: e (pairs, edges, 4), owner (pairs, edges)."""
    i, j = np.triu_indices(e.shape[1], 1)
    a, b = e[:, i], e[:, j]
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = (e[:, :, 2] - e[:, :, 0]) / (e[:, :, 3] - e[:, :, 1])
        sa, sb = slope[:, i], slope[:, j]
        cross = (b[:, :, 0] - sb * b[:, :, 1] - a[:, :, 0] + sa * a[:, :, 1]) / (sa - sb)
        touch = (np.minimum(a[:, :, 0], a[:, :, 2]) <= np.maximum(b[:, :, 0], b[:, :, 2])) & (np.minimum(b[:, :, 0], b[:, :, 2]) <= np.maximum(a[:, :, 0], a[:, :, 2]))
        touch &= (cross > np.maximum(a[:, :, 1], b[:, :, 1])) & (cross < np.minimum(a[:, :, 3], b[:, :, 3]))  # False for what is not a number
    top = e[:, :, 3].max(axis=1, keepdims=True)
    # every pair has as many heights as the one with the most; slabs between equal heights have no area
    cross = np.sort(np.where(touch, cross, np.inf), axis=1)[:, : int(touch.sum(axis=1).max(initial=0))]
    y = np.sort(np.concatenate([e[:, :, 1], e[:, :, 3], np.where(np.isfinite(cross), cross, top)], axis=1), axis=1)
    low, high = y[:, :-1, None], y[:, 1:, None]
    e = e[:, None]
    x = e[..., 0] + ((low + high) / 2 - e[..., 1]) / (e[..., 3] - e[..., 1]) * (e[..., 2] - e[..., 0])
    x[(e[..., 1] > low) | (e[..., 3] < high)] = np.inf
    order = np.argsort(x, axis=2, kind="stable")
    x, mine = np.take_along_axis(x, order, axis=2), np.take_along_axis(np.broadcast_to(owner[:, None], x.shape), order, axis=2)
    active = np.isfinite(x)
    with np.errstate(invalid="ignore"):
        width = np.where(active[:, :, 1:], x[:, :, 1:] - x[:, :, :-1], 0.0) * (high - low)
    one, two = ((np.cumsum((mine == k) & active, axis=2) % 2 == 1)[:, :, :-1] for k in (0, 1))
    return np.stack([(width * m).sum(axis=(1, 2)) for m in (one, two, one & two)], axis=1)


def batch_areas(subject: pa.Array, clip: pa.Array) -> np.ndarray:
    """(rows, 3) areas as of ``areas`` for two columns of rings; rows with the same number of edges are swept together."""
    (row_a, a), (row_b, b) = _ring_edges(subject), _ring_edges(clip)
    out = np.zeros((len(subject), 3))
    row, owner, e = np.concatenate([row_a, row_b]), np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b])
    order = np.argsort(row, kind="stable")
    owner, e = owner[order], e[order]
    count = np.bincount(row, minlength=len(subject))
    start = np.cumsum(count) - count
    for n in np.unique(count[count > 0]).tolist():
        rows = np.flatnonzero(count == n)
        step = max(1, CELLS_AT_ONCE // (n * n * (n + 3)))
        for k in range(0, len(rows), step):
            part = rows[k:k + step]
            at = start[part][:, None] + np.arange(n)
            out[part] = _sweep(e[at], owner[at])
    return out


def overlap_areas(df: DataFrame, subject: str, clip: str) -> DataFrame:
    """``df`` with subject_area, clip_area and common_area of two columns of rings (``RINGS``), in Arrow batches.

    A null polygon has no area.  Polygons of a row are worked on together, so a row's cost grows with the square of its edges.
    """
    names = ["subject_area", "clip_area", "common_area"]

    def run(batches):
        for batch in batches:
            found = batch_areas(batch.column(subject), batch.column(clip))
            columns = [pa.array(found[:, i], pa.float64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    schema = df.select("*", *[F.lit(0.0).alias(n) for n in names]).schema
    return df.mapInArrow(run, schema)


def _plane_ring(prefix: str) -> Column:
    """The four corners on the tangent plane at (ra0, dec0), in arcseconds, as one ring."""
    points = []
    for i in range(1, 5):
        x, y = tan_deproject(f"{prefix}ra{i}", f"{prefix}dec{i}", 0.0, 0.0, "ra0", "dec0", 1 / 3600.0, 1 / 3600.0, 0.0)
        points.append(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))
    return F.array(F.array(*points))


@F.arrow_udf(areas_type("subject_area", "clip_area", "common_area"))
def _quad_areas(*columns: pa.Array) -> pa.Array:
    """Areas as of ``overlap_areas`` for footprints: convex ones are clipped, others swept."""
    own, other = planes(*columns)
    common, known = convex_common(own, other)
    found = np.stack([np.abs(signed_areas(own)), np.abs(signed_areas(other)), common])
    rest = np.flatnonzero(~known)
    if len(rest):
        found[:, rest] = batch_areas(*(_rings(quads[:, :, rest]) for quads in (own, other))).T
    return pa.StructArray.from_arrays([*map(pa.array, found)], ["subject_area", "clip_area", "common_area"])


def _rings(quads: np.ndarray) -> pa.Array:
    """A column of polygons of one ring each, from (x, y) by (corner, row)."""
    n = quads.shape[2]
    points = pa.StructArray.from_arrays([pa.array(v.T.ravel()) for v in quads], ["x", "y"])
    rings = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * 4, pa.int32()), points)
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1), pa.int32()), rings)


def footprint_overlaps(pairs: DataFrame, own_holes: str | None = None) -> DataFrame:
    """``pairs`` with percent, the share of the first footprint that the second covers, and other_percent, the share of the second.

    ``pairs``: footprints ra0, dec0 ... ra4, dec4 and o_ra0, o_dec0 ... o_ra4, o_dec4, which need not be convex; both are
    projected on the tangent plane at the centre of the first.  ``own_holes`` is a column of rings on that plane, in arcseconds,
    that are cut out of the first.  A footprint without area has no share (NULL).
    """
    if own_holes is None:
        found = _quad_areas(*[F.col(c).cast("double") for c in ("ra0", "dec0", *CORNERS)])
        out = pairs.withColumn("__areas", found).select(*pairs.columns, "__areas.*")
    else:
        own = F.concat(_plane_ring(""), F.coalesce(F.col(own_holes), F.array().cast(RINGS)))
        shaped = pairs.withColumns({"__own": own.cast(RINGS), "__other": _plane_ring("o_").cast(RINGS)})
        out = overlap_areas(shaped, "__own", "__other").drop("__own", "__other")
    share = lambda part: F.try_divide(100.0 * F.col("common_area"), F.when(F.col(part) > 0, F.col(part)))
    return out.withColumns({"percent": share("subject_area"), "other_percent": share("clip_area")}).drop("subject_area", "clip_area", "common_area")
