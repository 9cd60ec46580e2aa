import math
import random

import pytest
from pyspark.sql import functions as F

from skycat.functions import geometry, healpix, naming, photometry, times
from skycat.operators import overlap, schedule
from tests import brute


def test_unit_vector_round_trip(spark):
    rows = [(0.0, 0.0), (359.999999, 1.0), (180.0, -89.9999), (0.0, 90.0), (12.5, -90.0), (270.0, 45.0)]
    df = spark.createDataFrame(rows, "ra double, dec double")
    x, y, z = geometry.unit_vector("ra", "dec")
    ra, dec = geometry.from_unit_vector(x, y, z)
    for r in df.select("ra", "dec", ra.alias("a"), dec.alias("d")).collect():
        assert r.d == pytest.approx(r.dec, abs=1e-6)
        if abs(r.dec) < 89.99999:
            assert (r.a - r.ra + 180) % 360 - 180 == pytest.approx(0, abs=1e-6)


def test_tangent_round_trip(spark):
    rnd = random.Random(1)
    rows = [(rnd.uniform(0, 4088), rnd.uniform(0, 4088), rnd.uniform(0, 360), rnd.uniform(-89, 89), rnd.uniform(0, 360)) for _ in range(200)]
    df = spark.createDataFrame(rows, "x double, y double, a double, d double, rot double")
    s = 0.11 / 3600
    ra, dec = geometry.tan_project("x", "y", 2044.5, 2044.5, "a", "d", s, s, "rot")
    sky = df.withColumns({"ra": ra, "dec": dec})
    bx, by = geometry.tan_deproject("ra", "dec", 2044.5, 2044.5, "a", "d", s, s, "rot")
    for r in sky.withColumns({"bx": bx, "by": by}).collect():
        assert 0 <= r.ra < 360
        assert (r.bx, r.by) == (pytest.approx(r.x, abs=1e-4), pytest.approx(r.y, abs=1e-4))


def test_point_behind_the_plane(spark):
    x, y = geometry.tan_deproject(F.lit(190.0), F.lit(0.0), 1.0, 1.0, 0.0, 0.0, 1e-4, 1e-4, 0.0)
    assert tuple(spark.range(1).select(x, y).first()) == (-999999.0, -999999.0)


def test_separation(spark):
    rows = [(10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 180.0, 0.0), (359.9999, 0.0, 0.0001, 0.0), (1.0, 89.9, 181.0, 89.9)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    for r in df.withColumn("s", geometry.angular_separation("a", "b", "c", "d")).collect():
        assert r.s == pytest.approx(brute.separation((r.a, r.b), (r.c, r.d)), abs=1e-7)


def test_polygon_sense_does_not_matter(spark):
    square = [(10.0, 10.0), (11.0, 10.0), (11.0, 11.0), (10.0, 11.0)]
    df = spark.createDataFrame([(10.5, 10.5, True), (12.0, 10.5, False), (10.01, 10.99, True), (190.5, -10.5, False)], "ra double, dec double, inside boolean")
    for order in (square, square[::-1]):
        corners = [geometry.unit_vector(F.lit(a), F.lit(d)) for a, d in order]
        got = df.withColumn("got", geometry.in_convex_polygon(geometry.unit_vector("ra", "dec"), corners)).collect()
        assert all(r.got == r.inside for r in got)


def test_healpix_known_pixels(spark):
    # face centres of the base pixels, and neighbours at order 1
    centres = [(45.0 + 90 * i, math.degrees(math.asin(2 / 3)), i) for i in range(4)]
    centres += [(90.0 * i, 0.0, 4 + i) for i in range(4)] + [(45.0 + 90 * i, -math.degrees(math.asin(2 / 3)) + 1e-9, 8 + i) for i in range(4)]
    df = spark.createDataFrame(centres, "ra double, dec double, px int")
    for r in df.withColumn("got", healpix.healpix_nested("ra", "dec", 0)).collect():
        assert r.got == r.px
    rnd = random.Random(2)
    points = spark.createDataFrame([(rnd.uniform(0, 360), math.degrees(math.asin(rnd.uniform(-1, 1)))) for _ in range(500)], "ra double, dec double")
    got = points.select(healpix.healpix_nested("ra", "dec", 9).alias("p9"), healpix.healpix_nested("ra", "dec", 6).alias("p6"))
    assert got.filter(healpix.coarser(F.col("p9"), 3) != F.col("p6")).count() == 0
    assert got.filter((F.col("p9") < 0) | (F.col("p9") >= 12 * 4 ** 9)).count() == 0


def test_alert_names(spark):
    rows = [(24, 1, "SKY24aaaaaaa"), (24, 2, "SKY24aaaaaab"), (30, 27, "SKY30aaaaaba"), (34, 8031810176, "SKY34zzzzzzz"),
            (34, 8031810177, "idoutofrange"), (23, 1, "notsupported"), (35, 1, "notsupported")]
    df = spark.createDataFrame(rows, "y int, s long, want string")
    assert all(r.got == r.want for r in df.withColumn("got", naming.alert_name("y", "s", "SKY")).collect())


def test_times(spark):
    df = spark.createDataFrame([("2026.365:07:22:37",), ("2000.001:12:00:00",)], "t string")
    got = [r.jd for r in df.select(times.timestamp_to_jd(times.doy_timestamp("t")).alias("jd")).collect()]
    assert got[1] == pytest.approx(2451545.0, abs=1e-9)
    assert got[0] == pytest.approx(2461405.5 + (7 * 3600 + 22 * 60 + 37) / 86400, abs=1e-6)


def test_detectors_land_on_their_reference_positions(spark):
    df = spark.createDataFrame([(*schedule.REFERENCE_POINTING, 0.0)], "ra double, dec double, pa double")
    got = {r.sca: r for r in schedule.sca_footprints(df, schedule.detector_offsets()).collect()}
    assert len(got) == 18
    for i, (ra, dec) in enumerate(zip(schedule.DETECTOR_RA, schedule.DETECTOR_DEC), start=1):
        assert (got[i].sca_ra0, got[i].sca_dec0) == (pytest.approx(ra, abs=1e-9), pytest.approx(dec, abs=1e-9))
        side = brute.separation((got[i].sca_ra1, got[i].sca_dec1), (got[i].sca_ra2, got[i].sca_dec2))
        assert side == pytest.approx(4087 * 0.11 / 3600, rel=1e-3)


def clip_area(a, b):
    """Area of the common part of two convex polygons on a fine grid."""
    def inside(p, poly):
        signs = [(q[0] - r[0]) * (p[1] - r[1]) - (q[1] - r[1]) * (p[0] - r[0]) for r, q in zip(poly, poly[1:] + poly[:1])]
        return all(s >= 0 for s in signs) or all(s <= 0 for s in signs)

    n = 200
    xs, ys = [p[0] for p in a], [p[1] for p in a]
    x0, x1, y0, y1 = min(xs), max(xs), min(ys), max(ys)
    hits = sum(inside(p, a) and inside(p, b) for i in range(n) for j in range(n)
               for p in [(x0 + (i + .5) * (x1 - x0) / n, y0 + (j + .5) * (y1 - y0) / n)])
    return hits * (x1 - x0) * (y1 - y0) / n ** 2


def test_overlap_area(spark):
    rnd = random.Random(5)
    square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    others = [[(x + dx, y + dy) for x, y in square] for dx, dy in [(0, 0), (0.5, 0.25), (2, 0), (1, 0), (-0.3, 0.9)]]
    for _ in range(4):
        c, s, dx, dy = math.cos(a := rnd.uniform(0, 6)), math.sin(a), rnd.uniform(-1, 1), rnd.uniform(-1, 1)
        others.append([(c * x - s * y + dx, s * x + c * y + dy) for x, y in square])
    others.append(others[1][::-1])
    poly = "array<struct<x: double, y: double>>"
    df = spark.createDataFrame([(i, square, o) for i, o in enumerate(others)], f"i int, a {poly}, b {poly}")
    for r in overlap.overlap_area(df, F.col("a"), F.col("b"), "area").collect():
        assert r.area == pytest.approx(clip_area(square, others[r.i]), abs=0.02)
