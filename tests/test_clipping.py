"""Common areas of general polygons against counting points and known shapes."""

import math
import random

import numpy as np
import pytest

from skycat.operators import clipping


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


SQUARE = [ring((0, 0), (10, 0), (10, 10), (0, 10))]


def test_known_areas():
    hole = [*SQUARE, ring((2, 2), (2, 8), (8, 8), (8, 2))]
    cases = [
        (SQUARE, SQUARE, (100, 100, 100)),
        (SQUARE, [SQUARE[0][::-1]], (100, 100, 100)),
        (SQUARE, [ring((5, 5), (15, 5), (15, 15), (5, 15))], (100, 100, 25)),
        (SQUARE, [ring((10, 0), (20, 0), (20, 10), (10, 10))], (100, 100, 0)),  # a shared edge
        (hole, SQUARE, (64, 100, 64)),
        (hole, [ring((3, 3), (7, 3), (7, 7), (3, 7))], (64, 16, 0)),  # within the hole
        (hole, hole, (64, 64, 64)),
        ([ring((0, 0), (10, 0), (10, 10), (5, 1), (0, 10))], [ring((0, 5), (10, 5), (10, 10), (0, 10))], (55, 50, 2 * 0.5 * 5 * 25 / 9)),  # concave
        ([ring((0, 0), (4, 0), (4, 4), (0, 4)), ring((6, 6), (8, 6), (8, 8), (6, 8))], SQUARE, (20, 100, 20)),  # two parts
        ([ring((0, 0), (10, 10), (10, 0), (0, 10))], SQUARE, (50, 100, 50)),  # a bow tie
        (None, SQUARE, (0, 100, 0)), ([None, ring((0, 0), (1, 1))], [[None, None, None]], (0, 0, 0)),
        ([ring((0, 0), (float("nan"), 1), (1, 1))], SQUARE, (0, 100, 0)),
    ]
    for a, b, want in cases:
        assert clipping.areas(a, b) == pytest.approx(want, abs=1e-9), (a, b)
        assert clipping.areas(b, a) == pytest.approx((want[1], want[0], want[2]), abs=1e-9)


def inside(x, y, rings):
    odd = np.zeros(len(x), bool)
    for r in rings:
        for p, q in zip(r, r[1:] + r[:1]):
            (x0, y0), (x1, y1) = (p["x"], p["y"]), (q["x"], q["y"])
            if y0 != y1:
                odd ^= ((y0 > y) != (y1 > y)) & (x < x0 + (y - y0) / (y1 - y0) * (x1 - x0))
    return odd


def test_random_polygons_against_points():
    rnd, rng = random.Random(2), np.random.default_rng(2)
    x, y = rng.uniform(-2, 2, 200_000), rng.uniform(-2, 2, 200_000)

    def star(cx, cy, size, n):
        return ring(*[(cx + size * rnd.uniform(0.3, 1) * math.cos(t), cy + size * rnd.uniform(0.3, 1) * math.sin(t)) for t in np.arange(n) * 2 * np.pi / n])

    for _ in range(25):
        a = [star(rnd.uniform(-0.5, 0.5), rnd.uniform(-0.5, 0.5), 1.2, rnd.randint(3, 14)), star(0, 0, 0.3, 5)]
        b = [star(rnd.uniform(-0.5, 0.5), rnd.uniform(-0.5, 0.5), 1.2, rnd.randint(3, 14))]
        want = [16 * float(m.mean()) for m in (inside(x, y, a), inside(x, y, b), inside(x, y, a) & inside(x, y, b))]
        assert clipping.areas(a, b) == pytest.approx(want, abs=0.06)


def test_columns_of_polygons(spark):
    df = spark.createDataFrame([(1, SQUARE, [ring((5, 5), (15, 5), (15, 15), (5, 15))], "x"), (2, None, SQUARE, None)],
                               f"k int, a {clipping.RINGS}, b {clipping.RINGS}, area string")
    got = {r["k"]: r for r in clipping.overlap_areas(df, "a", "b").collect()}
    assert (got[1]["common_area"], got[1]["area"], got[2]["clip_area"], got[2]["common_area"]) == (25.0, "x", 100.0, 0.0)


def test_footprints_with_a_hole(spark):
    corners = [(-0.1, -0.1), (0.1, -0.1), (0.1, 0.1), (-0.1, 0.1)]
    row = {"ra0": 50.0, "dec0": 0.0, "o_ra0": 50.1, "o_dec0": 0.0}
    for i, (x, y) in enumerate(corners, 1):
        row |= {f"ra{i}": 50 + x, f"dec{i}": y, f"o_ra{i}": 50.1 + x, f"o_dec{i}": y}
    row["holes"] = [ring((-36, -36), (36, -36), (36, 36), (-36, 36))]
    df = spark.createDataFrame([row], ", ".join(f"{k} {clipping.RINGS if k == 'holes' else 'double'}" for k in row))
    whole, cut = (clipping.footprint_overlaps(df, h).first() for h in (None, "holes"))
    assert whole["percent"] == pytest.approx(50, abs=1e-3) and whole["other_percent"] == pytest.approx(50, abs=1e-3)
    assert cut["percent"] == pytest.approx(100 * (259200 - 36 * 72) / (518400 - 72 * 72), abs=2e-3)


def test_a_batch_of_pairs_equals_them_one_by_one():
    import pyarrow as pa

    kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    rnd = random.Random(5)

    def corner():
        return rnd.choice([(rnd.uniform(0, 10), rnd.uniform(0, 10)), (rnd.randint(0, 4), rnd.randint(0, 4)), (rnd.uniform(0, 10), float("nan") if rnd.random() < 0.05 else 3)])

    def polygon():
        rings = [ring(*[corner() for _ in range(rnd.choice([2, 3, 4, 4, 6]))]) for _ in range(rnd.randint(0, 3))]
        return rnd.choice([rings, rings, rings, [None, *rings, [None, *ring((1, 1), (2, 2), (3, 1))]], None])

    a, b = ([polygon() for _ in range(400)] for _ in range(2))
    want = [clipping.areas(p, q) for p, q in zip(a, b)]
    assert clipping.batch_areas(pa.array(a, kind), pa.array(b, kind)) == pytest.approx(np.array(want), abs=1e-9)
    assert clipping.batch_areas(pa.array(a, kind).slice(100, 50), pa.array(b, kind).slice(100, 50)) == pytest.approx(np.array(want[100:150]), abs=1e-9)
    assert clipping.batch_areas(pa.array([None], kind), pa.array([[]], kind)).tolist() == [[0.0, 0.0, 0.0]]
    assert len(clipping.batch_areas(pa.array([], kind), pa.array([], kind))) == 0


def test_convex_footprints_are_clipped_many_at_once(spark):
    from skycat.operators import overlap

    rng = np.random.default_rng(3)
    n = 3000
    turn, size = np.sort(rng.uniform(0, 2 * np.pi, (2, 4, n)), axis=1), rng.uniform(5, 10, (2, 1, n))
    quads = np.stack([size * np.cos(turn), size * np.sin(turn)], axis=1) + rng.uniform(-8, 8, (2, 2, 1, n))
    quads[:, :, :, ::3] = quads[:, :, ::-1, ::3]  # the other sense
    square = np.array([[-1.0, 1.0, 1.0, -1.0], [-1.0, -1.0, 1.0, 1.0]])[:, :, None]
    quads[0, :, :, :500], quads[1, :, :, :500] = square, square + rng.integers(-2, 3, (2, 1, 500))  # edges and corners in common
    quads[0, :, :, :500] += rng.normal(0, 1e-12, (2, 4, 500))
    quads[0, :, 1, 500:600] = quads[0, :, 3, 500:600]  # no quadrilateral
    area, known = overlap.convex_common(*quads)
    assert not known[500:600].any() and np.delete(known, np.s_[500:600]).all()
    swept = clipping.batch_areas(*map(clipping._rings, quads))[:, 2]
    assert np.abs(area - swept)[known].max() < 1e-9 and (area > 0).sum() > 1000
    assert max(abs(overlap._clipped_slowly(quads[0, :, :, i].T, quads[1, :, :, i].T) - swept[i]) for i in range(700)) < 1e-9


def test_odd_footprints(spark):
    """Concave, crossed, missing and far-off corners beside plain ones; a footprint's shares follow its own areas."""
    from skycat.operators import overlap

    def pair(k, own, other):
        return (k, 10.0, 20.0, *own, *other)

    box = [9.9, 19.9, 10.1, 19.9, 10.1, 20.1, 9.9, 20.1]
    dart = [9.9, 19.9, 10.1, 19.9, 9.95, 19.95, 9.9, 20.1]
    rows = [pair(0, box, box), pair(1, box, dart), pair(2, dart, box), pair(3, box, [None, *box[1:]]), pair(4, [10.0] * 8, box), pair(5, box, [*box[:2], 190.0, -20.0, *box[4:]])]
    columns = ["k", "ra0", "dec0", *overlap.CORNERS]
    df = spark.createDataFrame(rows, ", ".join(f"{c} {'long' if c == 'k' else 'double'}" for c in columns))
    got = {r["k"]: r for r in clipping.footprint_overlaps(df).collect()}
    assert got[0]["percent"] == pytest.approx(100) and got[0]["other_percent"] == pytest.approx(100)
    assert got[1]["other_percent"] == pytest.approx(100) and got[1]["percent"] == pytest.approx(got[2]["other_percent"]) and 0 < got[1]["percent"] < 50
    assert got[3]["percent"] == 0 and got[3]["other_percent"] is None and got[4]["percent"] is None and got[5]["percent"] is not None
    share = {r["k"]: r["percent"] for r in overlap.footprint_overlap_percent(df).collect()}
    assert share[0] == pytest.approx(100) and share[2] == pytest.approx(100) and share[3] is None and share[4] is None
