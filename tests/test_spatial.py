import random

import pytest
from pyspark.sql import functions as F

from skycat.operators import spatial
from tests import brute


def cloud(seed, centre, spread, n):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ra = (centre[0] + rnd.uniform(-spread, spread)) % 360.0
        dec = max(-90.0, min(90.0, centre[1] + rnd.uniform(-spread, spread)))
        rows.append((i, ra, dec))
    return rows + [(n, *rows[0][1:])]  # a duplicate position


CASES = [((0.0, 10.0), 1.0, 0.2), ((180.0, -60.0), 0.01, 0.002), ((5.0, 90.0), 2.0, 0.6), ((200.0, -89.95), 0.3, 0.05),
         ((359.99, 89.0), 1.0, 0.1), ((100.0, 45.0), 0.001, 1e-5), ((10.0, 0.0), 1.0, 0.0)]


@pytest.mark.parametrize("centre,spread,radius", CASES)
@pytest.mark.parametrize("repeat", ["left", "right"])
def test_all_pairs_equals_brute_force(spark, centre, spread, radius, repeat):
    a, b = cloud(1, centre, spread, 80), cloud(2, centre, spread, 80)
    b = b + [(500, *a[0][1:]), (501, 0.0, 90.0), (502, 0.0, -90.0), (503, 360.0 - 1e-12, centre[1])]
    left = spark.createDataFrame(a, "a long, ra double, dec double")
    right = spark.createDataFrame(b, "b long, ra0 double, dec0 double")
    got = spatial.sky_join_all_pairs(left, right, radius, repeat=repeat).select("a", "b").collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == brute.all_pairs(a, b, radius)


def test_cells_of_a_crowded_sky_follow_the_radius(spark):
    radius = 1.2e-5
    assert spatial.cell_height(radius) <= 2.0 * radius * (1 + 1e-9)
    a, b = cloud(8, (180.0, 0.0), 1e-4, 120), cloud(9, (180.0, 0.0), 1e-4, 120)
    left, right = spark.createDataFrame(a, "a long, ra double, dec double"), spark.createDataFrame(b, "b long, ra0 double, dec0 double")
    for cell in (None, 1e-4):
        got = spatial.sky_join_all_pairs(left, right, radius, cell_deg=cell).select("a", "b").collect()
        assert sorted(map(tuple, got)) == sorted(brute.all_pairs(a, b, radius))


def test_anti_join_finds_the_unmatched(spark):
    a, b = cloud(3, (0.0, 0.0), 0.5, 100), cloud(4, (0.0, 0.0), 0.5, 30)
    left = spark.createDataFrame(a, "a long, ra double, dec double")
    right = spark.createDataFrame(b, "b long, ra0 double, dec0 double").drop("b")
    got = {r.a for r in spatial.sky_join_all_pairs(left, right, 0.05, how="left_anti").collect()}
    assert got == {x[0] for x in a} - {p[0] for p in brute.all_pairs(a, b, 0.05)}


def test_nearest(spark):
    a, b = cloud(5, (359.9, 20.0), 0.5, 60), cloud(6, (359.9, 20.0), 0.5, 60)
    left = spark.createDataFrame(a, "a long, ra double, dec double")
    right = spark.createDataFrame(b, "b long, ra0 double, dec0 double")
    got = {r.a: r.b for r in spatial.sky_join_nearest(left, right, 0.1, "a", "b").collect()}
    import math
    for k, ra, dec in a:
        d = {q[0]: math.hypot((((q[1] - ra) + 540) % 360 - 180) * math.cos(math.radians(dec)), q[2] - dec) for q in b}
        best = min(d, key=lambda q: (d[q], q))
        assert got[k] == (best if d[best] <= 0.1 else None)


def test_positional_join_has_no_nested_loop(spark, capsys):
    left = spark.range(1000).select(F.col("id").alias("a"), (F.col("id") % 360).cast("double").alias("ra"), F.lit(1.0).alias("dec"))
    right = spark.range(1000).select(F.col("id").alias("b"), (F.col("id") % 360).cast("double").alias("ra0"), F.lit(1.0).alias("dec0"))
    spatial.sky_join_all_pairs(left, right, 0.01).explain("formatted")
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_nearest_k(spark):
    df = spark.createDataFrame([(k, i, float(i % 7)) for k in range(2) for i in range(50)], "k long, i long, d double")
    got = [(r.k, r.rank, r.d, r.i) for r in spatial.nearest_k(df, "k", 9, ["d", "i"]).collect()]
    for k in range(2):
        want = sorted(((float(i % 7), i) for i in range(50)))[:9]
        assert sorted((d, i) for kk, _, d, i in got if kk == k) == want


@pytest.mark.parametrize("per_list", [2, 4096])
def test_truth_match_on_crowded_images(spark, monkeypatch, per_list):
    """The spots around a detection are one list, not a row each; crowded images are looked through closely first."""
    monkeypatch.setattr(spatial, "SPOTS_PER_LIST", per_list)
    rng = random.Random(5)
    truth = [(i % 2, 100 + i, rng.randrange(120) / 2, rng.randrange(120) / 2) for i in range(400)] + [(0, 1, 300.0, 300.0), (1, None, 10.0, 10.0), (None, 2, 1.0, 1.0)]
    dets = [(i % 2, i, rng.randrange(140) / 2, rng.randrange(140) / 2, 5.0, 1.0) for i in range(150)]
    dets += [(0, 900, 310.0, 310.0, 5.0, 0.0), (0, 901, 325.0, 300.0, 5.0, 1.0), (0, 902, 1.0, 1.0, -5.0, 1.0), (None, 903, 1.0, 1.0, 5.0, 1.0), (1, 904, None, 1.0, 5.0, 1.0)]
    t = spark.createDataFrame(truth, "image_id long, truth_id long, x double, y double")
    d = spark.createDataFrame(dets, "image_id long, det_id long, x double, y double, flux double, flux_err double")
    got = {r["det_id"]: (r["truth_id"], r["distance"], r["is_true"]) for r in spatial.truth_match(d, t, 25.0).collect()}
    want = {}
    for image, det, x, y, flux, _ in dets:
        if flux > 0:
            near = [((x - tx) ** 2 + (y - ty) ** 2, k) for i, k, tx, ty in truth if x is not None and k is not None and i is not None and i == image]
            near = [p for p in near if p[0] < 625.0]
            want[det] = (min(near)[1], pytest.approx(min(near)[0] ** 0.5), True) if near else (None, None, False)
    assert got == want and got[900][0] == 1 and got[901][0] is None
    spots = t.dropna().groupBy("image_id", "x", "y").agg(F.min("truth_id").alias("truth_id"))
    assert spatial._crowded_reach(spots, 25.0) < 12.5 and spatial._crowded_reach(spots.limit(0), 25.0) is None
    if per_list > 400:
        assert spatial._nearest_spot(d, spots, 25.0).count() == len(dets)


def test_cells_of_a_crowded_join_are_smaller_than_the_circle(spark, capsys):
    radius = 1.2e-5
    a, b = cloud(8, (180.0, 0.0), 1e-4, 400), cloud(9, (180.0, 0.0), 1e-4, 6000)
    left, right = spark.createDataFrame(a, "a long, ra double, dec double"), spark.createDataFrame(b, "b long, ra0 double, dec0 double")
    assert spatial._crowded_cell(right, ("ra0", "dec0"), radius) < radius < spatial._crowded_cell(left.limit(0), ("ra", "dec"), radius)
    for repeat in ("left", "right"):
        got = spatial.sky_join_all_pairs(left, right, radius, crowded=True, repeat=repeat).select("a", "b").collect()
        assert sorted(map(tuple, got)) == sorted(brute.all_pairs(a, b, radius))



@pytest.mark.parametrize("kind", ["long", "string"])
def test_nearest_k_cuts_pairs_down_where_they_arise(spark, monkeypatch, kind, capsys):
    monkeypatch.setattr(spatial, "FIRST_AT_ONCE", 100)
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(12)]), rng.choice([None, float("nan"), 1.0, 2.0, 2.5, -0.0]), rng.choice([None, *range(40)])) for _ in range(3000)]
    df = spark.createDataFrame(rows, f"k {'long' if kind == 'long' else 'string'}, d double, i long").coalesce(2)
    out = spatial.nearest_k(df, "k", 4, ["d", "i"])
    out.explain()
    assert capsys.readouterr().out.count("Exchange") == (1 if kind == "long" else 2)
    place = lambda v: (v is not None, v != v, 0.0 if v is None or v != v else float(v))
    got = {}
    for r in out.collect():
        got.setdefault(r["k"], []).append((r["rank"], place(r["d"]), place(r["i"])))
    for k in [None, *range(12)]:
        want = sorted((place(d), place(i)) for kk, d, i in rows if kk == k)[:4]
        assert sorted(got[k if k is None or kind == "long" else str(k)]) == [(n + 1, *w) for n, w in enumerate(want)]
    assert set(out.columns) == {"k", "d", "i", "rank"}
