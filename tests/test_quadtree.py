"""Tiles from the data, and moving objects."""

import math
import random

import pytest

from skycat.operators import moving, quadtree
from tests import brute


def sky(seed, n):
    rnd = random.Random(seed)
    out = [(i, rnd.uniform(0, 360), math.degrees(math.asin(rnd.uniform(-1, 1)))) for i in range(n)]
    out += [(n + i, 10 + rnd.gauss(0, 0.01), 20 + rnd.gauss(0, 0.01)) for i in range(n)]
    return out + [(-1, None, 1.0), (-2, 0.0, 90.0), (-3, 360.0, -90.0), (-4, 45.0, 45.0)]


def test_tiles_cover_the_sky_once(spark):
    rows = sky(1, 200)
    tiles = [r.asDict() for r in quadtree.quadtree_tiles(spark.createDataFrame(rows, "k long, ra double, dec double"), 25, 9).collect()]
    assert len({t["rtid"] for t in tiles}) == len(tiles) > 40
    assert sum((t["ramax"] - t["ramin"]) * (t["decmax"] - t["decmin"]) for t in tiles) == pytest.approx(360 * 180)
    for k, ra, dec in rows:
        if ra is not None:
            held = [t for t in tiles if t["ramin"] <= ra % 360 < t["ramax"] and (t["decmin"] <= dec < t["decmax"] or dec == 90 == t["decmax"])]
            assert len(held) == 1
            held[0]["seen"] = held[0].get("seen", 0) + 1
    assert all(t.get("seen", 0) == t["n"] for t in tiles)
    assert all(t["n"] <= 25 or t["level"] == 9 for t in tiles) and max(t["level"] for t in tiles) == 9
    split = {(t["level"] - 1, t["ix"] // 2, t["iy"] // 2) for t in tiles if t["level"]}
    for level, ix, iy in split:  # no tile is split without need
        assert sum(t["n"] for t in tiles if t["level"] > level and t["ix"] >> (t["level"] - level) == ix and t["iy"] >> (t["level"] - level) == iy) > 25


def test_neighbours_touch(spark):
    tiles = quadtree.quadtree_tiles(spark.createDataFrame(sky(2, 150), "k long, ra double, dec double"), 20, 8)
    box = {r["rtid"]: r for r in tiles.collect()}

    def touch(a, b):
        ra = a["ramin"] <= b["ramax"] and b["ramin"] <= a["ramax"] or a["ramin"] == 0 and b["ramax"] == 360 or b["ramin"] == 0 and a["ramax"] == 360
        return ra and a["decmin"] <= b["decmax"] and b["decmin"] <= a["decmax"]

    got = [tuple(r) for r in quadtree.quadtree_neighbors(tiles).collect()]
    assert len(got) == len(set(got)) and set(got) == {(i, j) for i, a in box.items() for j, b in box.items() if i != j and touch(a, b)}


def test_tiles_of_nothing(spark):
    tiles = quadtree.quadtree_tiles(spark.createDataFrame([], "ra double, dec double"), 10)
    assert sorted((r["ramin"], r["decmin"], r["n"]) for r in tiles.collect()) == [(i * 90.0, j * 90.0 - 90, 0) for i in range(4) for j in range(2)]
    with pytest.raises(ValueError):
        quadtree.quadtree_tiles(tiles, 10, 30)


def along(s, t):
    a, b = brute.vector(s[2], s[3]), brute.vector(s[5], s[6])
    f = (t - s[1]) / (s[4] - s[1])
    v = [p + f * (q - p) for p, q in zip(a, b)]
    n = math.sqrt(sum(c * c for c in v))
    return math.degrees(math.atan2(v[1], v[0])) % 360, math.degrees(math.asin(v[2] / n))


def test_moving_objects_against_all_pairs(spark):
    rnd, radius = random.Random(3), 0.2
    segments = []
    for i in range(60):
        ra, dec = rnd.choice([0.0, 359.9, 120.0]) + rnd.uniform(-1, 1), rnd.choice([89.0, 0.0, -45.0]) + rnd.uniform(-0.9, 0.9)
        t = rnd.uniform(0, 50)
        segments.append((i, t, ra % 360, dec, t + rnd.choice([1.0, 30.0]), (ra + rnd.uniform(-3, 3)) % 360, max(-90.0, min(90.0, dec + rnd.uniform(-3, 3)))))
    sources = []
    for i in range(900):
        s = rnd.choice(segments)
        t = rnd.choice([s[1], s[4], rnd.uniform(s[1] - 1, s[4] + 1)])
        ra, dec = along(s, t)
        sources.append((i, t, (ra + rnd.gauss(0, 0.1)) % 360, max(-90.0, min(90.0, dec + rnd.gauss(0, 0.1)))))
    want = {}
    for sid, t, ra, dec in sources:
        near = [(brute.separation((ra, dec), along(s, t)), s[0]) for s in segments if s[1] <= t < s[4]]
        near = [x for x in near if x[0] <= radius]
        if near:
            want[sid] = min(near)
    kinds = "ss_id long, start_mjd double, start_ra double, start_dec double, stop_mjd double, stop_ra double, stop_dec double"
    df = spark.createDataFrame([*segments, (900, 1.0, 1.0, 1.0, 1.0, 2.0, 2.0), (901, None, 1.0, 1.0, 2.0, 2.0, 2.0)], kinds)
    points = spark.createDataFrame([*sources, (5000, None, 1.0, 1.0)], "sid long, mjdobs double, ra double, dec double")
    for piece in (None, 0.05, 20.0):
        got = {r["sid"]: (r["dist_deg"], r["ss_id"]) for r in moving.moving_object_matches(points, df, radius, piece).collect()}
        assert set(got) == set(want) and len(want) > 300
        assert all(got[k][1] == want[k][1] and abs(got[k][0] - want[k][0]) < 1e-6 for k in want)


def test_alerts_name_their_moving_object(spark):
    alerts = spark.sql("SELECT id AS diaSourceId, CAST(NULL AS STRUCT<ssObjectId: BIGINT>) AS ssSource, 'x' AS other FROM range(3)")
    out = moving.with_moving_objects(alerts, spark.createDataFrame([(1, 77, 0.1)], "sid long, ss_id long, dist_deg double"))
    assert out.columns == alerts.columns
    assert {r["diaSourceId"]: r["ssSource"] and r["ssSource"]["ssObjectId"] for r in out.collect()} == {0: None, 1: 77, 2: None}
