import random

import pytest
from pyspark.sql import functions as F

from skycat.operators import associate
from tests import brute

SCHEMA = "sid long, field long, expid long, sca int, mjdobs double, ra double, dec double, fluxfit double"


def crowd(seed, centre, spread, n, batches=12):
    rnd = random.Random(seed)
    rows = []
    for sid in range(n):
        b = rnd.randrange(batches)
        rows.append(dict(sid=sid, field=rnd.randrange(2), expid=b // 3, sca=b % 3 + 1, mjdobs=float(b // 3 + 60000),
                         ra=(centre[0] + rnd.gauss(0, spread)) % 360, dec=centre[1] + rnd.gauss(0, spread), fluxfit=1.0))
    return rows


@pytest.mark.parametrize("spread,max_rows", [(0.2, 4000), (1.0, 4000), (4.0, 4000), (1.0, 20), (0.3, 10)])
def test_walk_equals_brute_force(spark, spread, max_rows):
    r = 1e-3
    rows = crowd(7, (0.0, 30.0), spread * r, 120) + [dict(x, sid=x["sid"] + 1000) for x in crowd(8, (50.0, -10.0), 0.2 * r, 40)]
    df = spark.createDataFrame([tuple(x[c.split()[0]] for c in SCHEMA.split(", ")) for x in rows], SCHEMA)
    got = associate.associate_within_field(df, r, max_group_rows=max_rows).collect()
    assert len(got) == len({tuple(g) for g in got})
    assert {tuple(g) for g in got} == brute.walk(rows, r)


@pytest.mark.parametrize("spread", [0.1, 2.0])
def test_known_objects_continue_the_walk(spark, spread):
    r = 1e-3
    rows = crowd(9, (359.9999, 5.0), spread * r, 80)
    df = spark.createDataFrame([tuple(x[c.split()[0]] for c in SCHEMA.split(", ")) for x in rows], SCHEMA)
    early, late = df.filter("expid < 2"), df.filter("expid >= 2")
    first = associate.associate_within_field(early, r)
    objects = associate.build_objects(first, early)
    second = associate.associate_within_field(late, r, objects)
    got = {tuple(x) for x in first.unionByName(second).collect()}
    assert got == brute.walk(rows, r)


def test_groups_hold_all_neighbours(spark):
    rnd = random.Random(3)
    points = [(i, (rnd.gauss(0, 2e-3)) % 360, 89.9 + rnd.gauss(0, 2e-3)) for i in range(100)]
    points += [(100 + i, 20 + rnd.gauss(0, 5e-3), rnd.gauss(0, 5e-3)) for i in range(100)]
    df = spark.createDataFrame(points, "k long, ra double, dec double")
    grp = {r.k: r.grp for r in associate.sky_groups(df, 5e-4).collect()}
    for a, b in brute.all_pairs(points, points, 5e-4):
        assert grp[a] == grp[b]


def test_friends_of_friends(spark):
    rnd = random.Random(4)
    points = [(i, (rnd.gauss(0, 2e-3)) % 360, 40 + rnd.gauss(0, 2e-3)) for i in range(150)]
    df = spark.createDataFrame(points, "k long, ra double, dec double")
    got = {}
    for r in associate.friends_of_friends(df, "k", 3e-4).collect():
        got.setdefault(r.group, set()).add(r.k)
    assert {frozenset(v) for v in got.values()} == brute.groups(points, 3e-4)
    assert all(g == min(v) for g, v in got.items())


def test_crowded_friends_are_not_paired_out(spark, monkeypatch):
    """Cells take part with their outermost points; all points are compared at the border of groups only."""
    rnd = random.Random(6)
    points = [(i, 20 + rnd.uniform(0, 4e-4), rnd.uniform(0, 4e-4)) for i in range(600)]
    sizes, join = [], associate.sky_join_all_pairs
    monkeypatch.setattr(associate, "sky_join_all_pairs", lambda left, *a, **k: (sizes.append(left.count()), join(left, *a, **k))[1])
    df = spark.createDataFrame(points, "k long, ra double, dec double")
    assert {r.group for r in associate.friends_of_friends(df, "k", 3e-4).collect()} == {0}
    assert sizes and max(sizes) <= 4 * 16


def test_friends_around_the_pole(spark):
    """Positions near the poles are nodes of their own: close ones are friends, far ones are not."""
    rnd = random.Random(5)
    points = [(i, rnd.uniform(0, 360), 90 - abs(rnd.gauss(0, 2e-3))) for i in range(120)] + [(200, 10.0, 90.0), (201, 250.0, 90.0), (202, 10.0, -90.0), (203, 10.0, 89.9999)]
    df = spark.createDataFrame(points, "k long, ra double, dec double")
    got = {}
    for r in associate.friends_of_friends(df, "k", 3e-4).collect():
        got.setdefault(r.group, set()).add(r.k)
    assert {frozenset(v) for v in got.values()} == brute.groups(points, 3e-4)


def test_across_fields(spark):
    objects = spark.createDataFrame([(1, 10, 1.0, 0.0), (2, 11, 1.00001, 0.0)], "aid long, field long, meanra double, meandec double")
    sources = spark.createDataFrame([(5, 11, 1.0, 0.0), (6, 12, 1.0, 0.0), (7, 10, 1.0, 0.0)], "sid long, field long, ra double, dec double")
    borders = spark.createDataFrame([(10, 11), (11, 10)], "rtid long, neighbor long")
    got = {tuple(r) for r in associate.associate_across_fields(objects, sources, borders, 1e-4).collect()}
    assert got == {(10, 1, 5), (11, 2, 7)}


def test_snapshot_pairs_never_collect_the_objects_in_the_driver(spark, capsys):
    """Objects are repeated for the cells they touch, which Spark's size check does not see."""
    objects = spark.createDataFrame([(i, 10.0 + i, 5.0) for i in range(20)], "aid long, ra0 double, dec0 double")
    sources = spark.createDataFrame([(i, 10.0 + i / 2, 5.0) for i in range(40)], "sid long, ra double, dec double")
    pairs, unmatched = associate.association_pairs_once(objects, sources, 0.01)
    assert sorted(map(tuple, pairs.collect())) == [(i // 2, i) for i in range(0, 40, 2)] and unmatched.count() == 20
    pairs.unionByName(unmatched.selectExpr("NULL AS aid", "sid")).explain()
    assert "Broadcast" not in capsys.readouterr().out
