"""Whitening and hard negatives against plain Python."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skycat.llm import hard_negatives, vectors, whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def table(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if extra:
        for name in ("x", "w", "n", "times", "weight", "piece", "block", "bucket", "rank", "anchor_id", "twin", "score"):
            df = df.withColumn(name, F.lit(name))
    return df


def some(seed=1, n=160, dims=6, labels=3, lengths=True):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dims)) * (np.exp(rng.normal(size=(n, 1))) if lengths else 1) / 4
    rows = [(i, [float(np.float32(c)) for c in x], int(rng.integers(labels))) for i, x in enumerate(v)]
    rows += [(n + i, rows[7][1], rows[7][2]) for i in range(n // 2)]  # one vector for a third of the rows
    return rows


def odd(rows):
    """Rows that take no part, and repeated ones."""
    d = len(rows[0][1])
    return rows + [(900, None, 1), (901, [None] + [0.5] * (d - 1), 1), (902, [math.nan] + [0.5] * (d - 1), 1), (903, [math.inf] + [0.5] * (d - 1), 1), (904, [], 1),
                   (905, [0.25] * (d - 1), 1), rows[3], (rows[4][0], rows[5][1], 2), (1000, [0.0] * d, 0), (1001, [-0.0] * d, 1)]


# -- whitening ------------------------------------------------------------------------------------


def expected(rows, weights):
    dims = max(len(r[1]) for r in rows if r[1])
    part = [r for r in rows if r[1] and len(r[1]) == dims and all(c is not None and math.isfinite(c) for c in r[1])]
    x = [tuple(math.floor(256 * float(np.float32(c))) for c in r[1]) for r in part]
    fit = x if weights == "count" else sorted(set(x))
    a = np.array(fit, float)
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    v = (a - a.mean(0)).T @ (a - a.mean(0)) / n
    e, u = np.linalg.eigh(v)
    return part, x, n, s, e[::-1], u[:, ::-1], np.trace(v)


@pytest.mark.parametrize("weights", ["one", "count"])
@pytest.mark.parametrize("extra", [False, True])
def test_whitening(spark, weights, extra):
    rows = odd(some()) + [(None, [0.5] * 6, None)]
    part, x, n, s, e, u, trace = expected(rows, weights)
    got = whitening.whitened(table(spark, rows, extra), weights).collect()
    assert len(got) == 4 * len(part)
    want = sorted(((r[0] is None, r[0] or 0, tuple(q)) for r, q in zip(part, x)))
    signs = {}
    for c in range(4):
        mine = sorted((r for r in got if r["component"] == c + 1), key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0, r["deviation"]))
        order = sorted(((null, i, sum((n * a - b) ** 2 for a, b in zip(q, s)), q) for null, i, q in want))
        for r, (_, _, gap, q) in zip(mine, order):
            w = float((np.array(q) - np.array(s) / n) @ u[:, c] / math.sqrt(e[c]))
            signs.setdefault(c, math.copysign(1, w * r["whitened"]))
            assert r["n"] == n and r["deviation"] == gap and abs(r["whitened"] - signs[c] * w) < 1e-9
            assert abs(r["explained"] - e[c] / trace) < 1e-12 and r["identity_error"] < 1e-9


def test_whitening_of_little(spark):
    assert whitening.whitened(table(spark, [])).count() == 0
    assert whitening.whitened(table(spark, [(1, None, 1), (2, [], 1)])).count() == 0
    alone = whitening.whitened(table(spark, [(1, [0.5, 0.25], 1), (2, [0.5, 0.25], 1)])).collect()
    assert len(alone) == 4 and all(r["n"] == 1 and r["deviation"] == 0 and r["whitened"] is None and r["explained"] is None for r in alone)
    line = whitening.whitened(table(spark, [(i, [i / 8, 0.5, 0.5], 1) for i in range(5)])).collect()
    assert {r["component"] for r in line} == {1, 2, 3}
    assert all((r["whitened"] is None) == (r["component"] > 1) and r["identity_error"] < 1e-9 for r in line)


def test_deviation_beyond_64_bits():
    model = whitening.Model(1 << 40, np.zeros(2, np.int64), np.eye(2), np.ones(2), 2.0)
    gap, fits = model.deviation(np.array([[1, 0], [1 << 20, 5]]))
    assert fits.tolist() == [False, False]
    model.n = 1 << 30
    gap, fits = model.deviation(np.array([[1, 2], [1 << 20, 5]]))
    assert fits.tolist() == [True, False] and gap[0] == 5 << 60


# -- hard negatives -------------------------------------------------------------------------------


def mined(rows, is_anchor, positives=5, negatives=3):
    dims = max(len(r[1]) for r in rows if r[1])
    part = [(i, lab, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v, lab in rows
            if i is not None and lab is not None and v and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for i, lab, x in sorted(set(part)):
        if not is_anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), j, other) for j, other, y in part if j != i)
        for p, j, _ in [s for s in scored if s[2] == lab][:positives]:
            fit = [(s, k) for s, k, other in scored if other != lab and 50 * -p <= 100 * -s <= 95 * -p][:negatives]
            out += [(i, j, r + 1, k, -p, -s) for r, (s, k) in enumerate(fit)]
    return sorted(out)


def run(df, every, **kw):
    rows = hard_negatives.prepared(df)
    found = hard_negatives.hard_negatives(rows, rows.filter(F.col("vec_id") % every == 0), **kw).collect()
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in found)


@pytest.mark.parametrize("extra", [False, True])
def test_hard_negatives(spark, extra):
    rows = odd(some(2)) + [(None, [0.5] * 6, 1), (50, [0.5] * 6, None)]
    got = run(table(spark, rows, extra), 10, piece_rows=40, block_anchors=7)
    assert got == mined(rows, lambda i: i % 10 == 0) and got


def test_hard_negatives_with_repeated_anchors(spark):
    rows = some(3, 60)
    rows += [rows[10], rows[20], (30, rows[31][1], rows[31][2])]
    assert run(table(spark, rows), 10) == mined(rows, lambda i: i % 10 == 0)


def test_hard_negatives_of_little(spark):
    assert run(table(spark, []), 1) == []
    assert run(table(spark, [(1, None, 1), (2, [0.5], None)]), 1) == []
    assert run(table(spark, [(50, [0.5], 1)]), 50) == []
    assert run(table(spark, [(50, [0.5], 1), (51, [0.5], 1)]), 50) == []  # no other label
    assert run(table(spark, [(50, [0.5], 1), (51, [-0.5], 1), (52, [-0.4], 2), (53, [0.4], 2)]), 50) == []  # below zero no score fits
    assert run(table(spark, [(1, [0.5], 1)]), 50) == []


def test_pruning_loses_nothing_and_prunes():
    rng = np.random.default_rng(4)
    pruned = 0
    for trial in range(60):
        n, d = int(rng.integers(1, 400)), int(rng.integers(1, 9))
        x = rng.integers(-200, 200, (n, d))
        if trial % 3 == 0:
            x[rng.random(n) < 0.3] = x[0]
        piece = hard_negatives.Piece(rng.permutation(n), rng.integers(0, 3, n), x)
        q = x[0] if trial % 2 else rng.integers(-200, 200, d)
        scores = piece.x @ q
        assert (piece.scores(slice(None), q) == scores).all()
        for least in (float(scores.max()), float(np.median(scores)), 0.0, -5.0):
            found = piece.candidates(q, least)
            assert set(np.flatnonzero(scores >= least)) <= set(found)
            pruned += n - len(found)
        some_rows = np.arange(n)
        want = sorted(some_rows, key=lambda i: (-scores[i], piece.ids[i]))[:5]
        assert piece.first(some_rows, scores, 5).tolist() == [int(i) for i in want]
    assert pruned > 1000


def test_products_beyond_doubles_are_exact():
    x = np.array([[(1 << 30) + 1, 1], [1 << 30, 3]])
    piece = hard_negatives.Piece(np.arange(2), np.zeros(2), x)
    assert piece.scores(slice(None), x[0]).tolist() == [int(a * int(x[0][0]) + b) for a, b in x.tolist()]


def test_quantised(spark):
    rows = vectors.quantised(table(spark, odd(some(5, 20))).select("vec_id", "embedding"), "embedding").collect()
    assert not {r["vec_id"] for r in rows} & {900, 901, 902, 903, 904, 905}
    assert {tuple(r["x"]) for r in rows if r["vec_id"] in (1000, 1001)} == {(0,) * 6}
