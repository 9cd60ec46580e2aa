"""The walk of crowded groups by tiles of the sky, many levels a round."""

import numpy as np
import pytest

from skycat.functions.geometry import chord2_limit
from skycat.operators import associate
from skycat.operators import walk as w
from tests import brute
from tests.test_associate import SCHEMA, crowd


@pytest.mark.parametrize("centre, slabs, cells", [((0.0, 30.0), (4, 2, 1), 1), ((359.9999, -89.99), (2, 1), 2), ((10.0, -5.0), (8, 4, 2, 1), 4)])
def test_walk_by_tiles_equals_brute_force(spark, monkeypatch, centre, slabs, cells):
    r = 1e-3
    rows = crowd(11, centre, 20 * r, 250, batches=24)
    monkeypatch.setattr(associate, "SLABS", slabs)
    monkeypatch.setattr(associate, "TILE_CELLS", cells)
    monkeypatch.setattr(associate, "WALK_ROWS", 150)  # tiles of a partition are walked in several lots
    monkeypatch.setattr(associate, "_walk_by_levels", None)  # no round for a single level
    df = spark.createDataFrame([tuple(x[c.split()[0]] for c in SCHEMA.split(", ")) for x in rows], SCHEMA)
    got = [(x.field, x.aid, x.sid) for x in associate.associate_within_field(df, r, max_group_rows=1).collect()]
    assert len(got) == len(set(got)) and set(got) == brute.walk(rows, r)


def test_tiles_too_crowded_are_walked_by_levels(spark, monkeypatch):
    r = 1e-3
    rows = crowd(12, (40.0, 20.0), 6 * r, 80, batches=6)
    monkeypatch.setattr(associate, "TILE_ROWS", 1)
    monkeypatch.setattr(associate, "_walk_by_tiles", None)
    df = spark.createDataFrame([tuple(x[c.split()[0]] for c in SCHEMA.split(", ")) for x in rows], SCHEMA)
    got = {(x.field, x.aid, x.sid) for x in associate.associate_within_field(df, r, max_group_rows=1).collect()}
    assert got == brute.walk(rows, r)


def test_ids_that_repeat_are_walked_by_levels(spark):
    """A source that stands twice starts one object, and the groups without such sources are walked by tiles."""
    rows = [(1, 0, 1, 1, 1.0, 10.0, 0.0, 1.0)] * 2 + [(2, 0, 2, 1, 2.0, 10.0, 0.0005, 1.0), (3, 0, 1, 1, 1.0, 50.0, 0.0, 1.0), (4, 0, 2, 1, 2.0, 50.0, 0.0009, 1.0),
                                                   (5, 0, 3, 1, 3.0, 10.0, 0.0015, 1.0), (6, 0, 3, 1, 3.0, 50.0, 0.003, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((x.aid, x.sid) for x in associate.associate_within_field(df, 1e-3, max_group_rows=1).collect())
    assert got == [(1, 1), (1, 1), (1, 2), (3, 3), (3, 4), (5, 5), (6, 6)]


def test_objects_come_with_the_rows_that_start_them():
    r = 1e-3
    one = lambda *x: np.array(x, float)
    source, aid, objects, start = w.walk_rows(np.array([0, 1, 1]), np.zeros(3, int), np.array([0, 1, 2]), np.array([5, 6, 7]),
                                              one(10, 10, 20), one(0, r / 2, 0), one(3, 1, 1), chord2_limit(r), leveled=True)
    assert list(zip(source.tolist(), aid.tolist())) == [(1, 5), (2, 7)] and start.tolist() == [0, 2]
    assert objects.id[:2].tolist() == [5, 7] and objects.weight[:2].tolist() == [4, 1]


@pytest.mark.parametrize("few", [0, 100_000])
def test_points_are_not_shuffled_for_few_tiles(spark, monkeypatch, capsys, few):
    from skycat.operators import tiles as tiles_module

    monkeypatch.setattr(tiles_module, "FEW_TILES", few)
    grid = spark.range(36).selectExpr("id AS rtid", "id * 10D AS ramin", "id * 10D + 10D AS ramax", "-10D AS decmin", "10D AS decmax")
    points = spark.range(360).selectExpr("id", "CAST(id AS DOUBLE) AS ra", "CAST(id % 30 AS DOUBLE) - 15 AS dec")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = tiles_module.point_to_tile(points, grid)
        out.explain()
        assert ("BroadcastHashJoin" in capsys.readouterr().out) == (few > 0)
        assert {r["id"]: r["field"] for r in out.collect()} == {i: i // 10 if -10 <= i % 30 - 15 < 10 else None for i in range(360)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
