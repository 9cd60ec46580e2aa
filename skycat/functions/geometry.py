"""Spherical geometry as Column expressions.  Angles are in degrees."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

OFF_PLANE = -999999.0  # fixed value: pixel of a point more than 90 degrees from the tangent point


def col(c: Column | str | float) -> Column:
    """A Column from a name, a number or a Column."""
    if isinstance(c, Column):
        return c
    return F.col(c) if isinstance(c, str) else F.lit(float(c))


def wrap_ra(ra: Column) -> Column:
    """Right ascension in [0, 360)."""
    return F.when(ra < 0, ra + 360.0).when(ra >= 360.0, ra - 360.0).otherwise(ra)


def unit_vector(ra, dec) -> tuple[Column, Column, Column]:
    """Direction cosines of (ra, dec)."""
    a, d = F.radians(col(ra)), F.radians(col(dec))
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)


def from_unit_vector(x, y, z) -> tuple[Column, Column]:
    """(ra, dec) of a direction; ra is 0 at the poles."""
    x, y, z = col(x), col(y), col(z)
    dec = F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), z))))
    ra = F.degrees(F.atan2(y, x))
    # a tiny negative angle would round up to exactly 360
    wrapped = F.when(ra < 0, ra + 360.0).otherwise(ra)
    return F.when((x == 0) & (y == 0), F.lit(0.0)).when(wrapped >= 360.0, 0.0).otherwise(wrapped), dec


def chord2(a, b) -> Column:
    """Squared straight-line distance of two unit vectors given as column triples."""
    return sum(((col(p) - col(q)) * (col(p) - col(q)) for p, q in zip(a[1:], b[1:])),
               (col(a[0]) - col(b[0])) * (col(a[0]) - col(b[0])))


def chord2_limit(radius_deg: float) -> float:
    """The value of ``chord2`` at an angle of ``radius_deg``."""
    return (2.0 * math.sin(math.radians(radius_deg) / 2.0)) ** 2


def chord2_to_deg(c2: Column) -> Column:
    """Angle in degrees that belongs to a squared chord."""
    return F.degrees(2.0 * F.asin(F.least(F.lit(1.0), 0.5 * F.sqrt(c2))))


def position_chord2(ra1, dec1, ra2, dec2) -> Column:
    """Squared chord of two positions by half-angle sines: each angle is evaluated once."""
    da = F.pow(F.sin(F.radians(col(ra1) - col(ra2)) / 2.0), 2)
    dd = F.pow(F.sin(F.radians(col(dec1) - col(dec2)) / 2.0), 2)
    return 4.0 * (dd + F.cos(F.radians(col(dec1))) * F.cos(F.radians(col(dec2))) * da)


def angular_separation(ra1, dec1, ra2, dec2) -> Column:
    """Angle between two sky positions, accurate for small angles."""
    return chord2_to_deg(position_chord2(ra1, dec1, ra2, dec2))


def rotation_to_cd(cdelt1, cdelt2, crota2):
    """CD matrix (cd11, cd12, cd21, cd22) of a pixel scale and a rotation."""
    c, s = F.cos(F.radians(col(crota2))), F.sin(F.radians(col(crota2)))
    d1, d2 = col(cdelt1), col(cdelt2)
    return d1 * c, -d2 * s, d1 * s, d2 * c


def tan_project_cd(x, y, crpix1, crpix2, crval1, crval2, cd11, cd12, cd21, cd22):
    """Pixel to sky on the tangent plane; returns (ra, dec)."""
    u, v = col(x) - col(crpix1), col(y) - col(crpix2)
    xi = F.radians(col(cd11) * u + col(cd12) * v)
    eta = F.radians(col(cd21) * u + col(cd22) * v)
    d0 = F.radians(col(crval2))
    # direction in the frame whose first axis points to the meridian of the tangent point
    along = F.cos(d0) - eta * F.sin(d0)
    up = F.sin(d0) + eta * F.cos(d0)
    ra = wrap_ra(wrap_ra(col(crval1) + F.degrees(F.atan2(xi, along))))
    dec = F.degrees(F.atan2(up, F.sqrt(xi * xi + along * along)))
    return ra, dec


def tan_project(x, y, crpix1, crpix2, crval1, crval2, cdelt1, cdelt2, crota2):
    """As ``tan_project_cd`` with a pixel scale and a rotation angle."""
    return tan_project_cd(x, y, crpix1, crpix2, crval1, crval2, *rotation_to_cd(cdelt1, cdelt2, crota2))


def tan_deproject(ra, dec, crpix1, crpix2, crval1, crval2, cdelt1, cdelt2, crota2):
    """Sky to pixel on the tangent plane; returns (x, y), ``OFF_PLANE`` beyond 90 degrees."""
    d, d0 = F.radians(col(dec)), F.radians(col(crval2))
    da = F.radians(col(ra) - col(crval1))
    c, s = F.cos(F.radians(col(crota2))), F.sin(F.radians(col(crota2)))
    toward = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(da)
    xi = F.cos(d) * F.sin(da) / toward
    eta = (F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(da)) / toward
    x = col(crpix1) + F.degrees(xi * c + eta * s) / col(cdelt1)
    y = col(crpix2) + F.degrees(eta * c - xi * s) / col(cdelt2)
    off = toward <= 0
    return F.when(off, OFF_PLANE).otherwise(x), F.when(off, OFF_PLANE).otherwise(y)


def image_corner_pixels(naxis1, naxis2) -> list[tuple[Column, Column]]:
    """Zero-based pixel positions of the centre and the four corners of an image."""
    n1, n2 = col(naxis1).cast("double"), col(naxis2).cast("double")
    zero = F.lit(0.0)
    return [((n1 - 1) / 2, (n2 - 1) / 2), (zero, zero), (n1 - 1, zero), (n1 - 1, n2 - 1), (zero, n2 - 1)]


def in_convex_polygon(point, vertices) -> Column:
    """Is the unit vector ``point`` inside the spherical convex polygon?

    ``vertices`` are unit vectors in order around the polygon (either sense).  The
    point is inside when it lies on the same side of the great circle of each edge and
    on the polygon's half of the sphere.
    """
    return in_front_of_edges(point, *edge_vectors(vertices))


def edge_vectors(vertices) -> tuple[list[tuple[Column, Column, Column]], list[Column]]:
    """What ``in_front_of_edges`` needs of a polygon: a vector across each edge, and the sum of the vertices.

    A join of many points with many polygons should have them as columns, computed once for each polygon.
    """
    across = []
    for a, b in zip(vertices, list(vertices[1:]) + [vertices[0]]):
        ax, ay, az = (col(v) for v in a)
        bx, by, bz = (col(v) for v in b)
        across.append((ay * bz - az * by, az * bx - ax * bz, ax * by - ay * bx))
    return across, [sum((col(v[k]) for v in vertices[1:]), col(vertices[0][k])) for k in range(3)]


def in_front_of_edges(point, across, middle) -> Column:
    """``in_convex_polygon`` by the vectors of ``edge_vectors``, as columns or their names."""
    px, py, pz = (col(v) for v in point)
    facing = sum(p * col(m) for p, m in zip((px, py, pz), middle))
    sides = [px * col(x) + py * col(y) + pz * col(z) for x, y, z in across]
    return ((F.least(*sides) >= 0) | (F.greatest(*sides) <= 0)) & (facing > 0)
