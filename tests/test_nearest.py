"""Nearest neighbours tile by tile against plain Python."""

import math
import random

import numpy as np
import pytest

from skycat.operators import nearest, spatial


def flat(ra, dec, ra2, dec2):
    u, v = ((ra2 - ra + 540.0) % 360.0 - 180.0) * math.cos(math.radians(dec)), dec2 - dec
    return math.sqrt(u * u + v * v)


@pytest.mark.parametrize("ra,dec,spread,radius", [(0.0, 20.0, 0.5, 0.1), (180.0, 0.0, 1e-4, 1.2e-5), (359.9, 88.99, 0.6, 0.2), (10.0, -88.5, 300.0, 0.3), (77.0, 45.0, 0.0, 1.0), (5.0, 3.0, 40.0, 20.0)])
def test_nearest_on_the_sky(spark, monkeypatch, ra, dec, spread, radius):
    monkeypatch.setattr(nearest, "ROWS_AT_ONCE", 40)
    monkeypatch.setattr(nearest, "PAIRS_AT_ONCE", 30)
    monkeypatch.setattr(nearest, "TILE_ROWS", 150)
    rng = random.Random(7)

    def some(n):
        return [(i, (ra + rng.uniform(-spread, spread)) % 360.0, max(-90.0, min(90.0, dec + rng.uniform(-1, 1) * min(spread, 1.5))), i % 2) for i in range(n)]

    a, b = some(150), some(150)
    b += [(b[0][0] - 1000, *b[0][1:]), (None, *a[0][1:]), (5000, None, dec, 0), (5001, ra, dec, None)]
    a += [a[0], (None, *a[1][1:]), (9000, None, dec, 0), (9001, ra, dec, None)]
    left = spark.createDataFrame(a, "a long, ra double, dec double, f long")
    right = spark.createDataFrame(b, "b long, ra0 double, dec0 double, g long").selectExpr("*", "concat('n', b) AS name")
    for on, fits in (((), lambda p, q: True), ([("f", "g")], lambda p, q: p[3] is not None and p[3] == q[3])):
        got = spatial.sky_join_nearest(left, right, radius, "a", "b", on=on, keep_right=["name"])
        assert got.columns == ["a", "ra", "dec", "f", "dist_deg", "b", "name"]
        want = []
        for p in a:
            near = [] if p[1] is None else [(flat(p[1], p[2], q[1], q[2]), q[0]) for q in b if q[0] is not None and q[1] is not None and fits(p, q)]
            near = [x for x in near if x[0] <= radius]
            want.append((p[0], min(near)[1] if near else None))
        rows = got.collect()
        key = lambda x: (str(x[0]), str(x[1]))
        assert sorted(((r["a"], r["b"]) for r in rows), key=key) == sorted(want, key=key)
        assert all(r["name"] == (None if r["b"] is None else f"n{r['b']}") and (r["dist_deg"] is None) == (r["b"] is None) for r in rows)


@pytest.mark.parametrize("compat", [False, True])
def test_nearest_in_pixels(spark, monkeypatch, compat):
    monkeypatch.setattr(nearest, "ROWS_AT_ONCE", 50)
    rng = random.Random(8)
    ref = [(i % 2, i // 2, rng.randrange(400) / 2, rng.randrange(400) / 2) for i in range(200)]
    ref += [(0, 3, 500.0, 500.0), (None, 1, 5.0, 5.0), (1, None, 6.0, 6.0), (0, 7, None, 1.0), (1, 8, float("nan"), 1.0)]
    sci = [(i % 2, 1000 + i % 300, rng.randrange(90) / 2, rng.randrange(400) / 2, float(i)) for i in range(900)]
    sci += [(0, 1, 505.0, 500.0, 1.0), (0, None, 501.0, 501.0, 1.0), (1, 2, float("nan"), 1.0, 1.0), (None, 2, 1.0, 1.0, 1.0)]
    r = spark.createDataFrame(ref, "image_id long, ref_id long, x double, y double")
    s = spark.createDataFrame(sci, "image_id long, sci_id long, x double, y double, flux double")
    got = {(g["image_id"], g["ref_id"]): (g["sci_id"], g["dx"], g["dy"], g["flux"], g["distance"]) for g in spatial.catalog_match_nearest_pixel(r, s, 12.0, compat).collect()}
    want = {}
    for image, k, x, y in ref:
        for i, j, u, v, flux in sci:
            if image is None or image != i or x is None or math.isnan(x) or math.isnan(u):
                continue
            d2 = (x - u) ** 2 + (y - v) ** 2
            if d2 <= 144.0 and (not compat or abs(x - u) <= 12.0 / math.sqrt(2.0)):
                found = (d2, -1 if j is None else j, x - u, y - v, flux)
                want[image, k] = min(want.get((image, k), found), found)
    assert {k: (None if v[1] == -1 else v[1], *v[2:], pytest.approx(math.sqrt(v[0]))) for k, v in want.items()} == got
    assert len(got) > 50


def test_crowded_tiles_are_looked_through_closely():
    rng = np.random.default_rng(1)
    n = 20_000
    u, v, tile = rng.uniform(0, 1, 2 * n), rng.uniform(0, 1, 2 * n), np.zeros(2 * n, int)
    right = np.arange(2 * n) < n
    compared = 0

    def distance(x, y, _, x2, y2):
        nonlocal compared
        compared += len(x)
        return np.hypot(x - x2, y - y2)

    left, found = nearest.look_up(tile, u, v, np.ones(2 * n), right, 0.1, distance)
    assert compared < 60 * n and (found >= 0).all() and len(left) == n  # all pairs in reach: 600 for each row
    some = slice(0, 200)
    every = np.hypot(u[left[some], None] - u[None, :n], v[left[some], None] - v[None, :n])
    assert (every.argmin(axis=1) == found[some]).all()
