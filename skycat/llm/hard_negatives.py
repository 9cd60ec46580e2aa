"""Hard negatives by coordinate pruning.

Rows are dealt into buckets of about one length, buckets into pieces, anchors into blocks, and each piece meets each block
in a task of its own.  A piece holds, for every coordinate, its unit vectors in order of that coordinate.  A row that
reaches a score with an anchor has a cosine of at least that score over both lengths, which leaves
each coordinate a feasible range around the anchor's own.  The ranges of the anchor's largest coordinates, its focus, are cut from
the sorted lists; only rows in all of them are verified by the exact inner product.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written
from .vectors import SCALE, quantised

FOCUS = 3
LENGTH_RATIO = 1.1  # lengths within one bucket
PIECE_ROWS = 8192
BLOCK_ANCHORS = 4096
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # a negative's score in percent of the positive's
SLACK = 1e-9  # feasible ranges are that much wider, so rounding loses no row


class Piece:
    """Rows of one length bucket, in order of id, with a sorted list for each coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        lengths = np.sqrt((self.x.astype(np.float64) ** 2).sum(axis=1))
        self.longest = float(lengths.max(initial=0.0))
        unit = self.x / np.where(lengths > 0, lengths, 1.0)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(unit, self.order, axis=0)
        # doubles hold a product exactly if no partial sum can pass 2 ** 53
        self.largest = float(np.abs(self.x).max(initial=0))
        self.as_double = self.x.astype(np.float64)

    def scores(self, rows: np.ndarray | slice, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products."""
        if self.largest * float(np.abs(anchor).max(initial=0)) * len(anchor) < 2.0 ** 53:
            return (self.as_double[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.x[rows] @ anchor

    def candidates(self, anchor: np.ndarray, least: float, focus: int = FOCUS) -> np.ndarray:
        """Places of all rows whose product with ``anchor`` can be ``least`` or more."""
        length = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
        if least <= 0:
            return np.arange(len(self.ids))
        if length * self.longest <= 0 or least / (length * self.longest) > 1 + SLACK:
            return np.zeros(0, np.int64)
        cos = min(1.0, least / (length * self.longest))
        unit = anchor / length
        seen = np.zeros(len(self.ids), np.int8)
        coordinates = np.argsort(-np.abs(unit), kind="stable")[:focus]
        for f in coordinates:
            q = float(unit[f])
            reach = np.sqrt(max(0.0, 1 - q * q) * max(0.0, 1 - cos * cos))
            low = -1.0 if -q >= cos else q * cos - reach
            high = 1.0 if q >= cos else q * cos + reach
            a, b = np.searchsorted(self.sorted[:, f], [low - SLACK, high + SLACK], side="left")
            seen[self.order[a:b, f]] += 1
        return np.flatnonzero(seen == len(coordinates))

    def first(self, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places among ``rows`` (in order of id) of the ``k`` best scores, ties by id."""
        if len(rows) > 4 * k:
            bar = np.partition(scores, len(scores) - k)[len(scores) - k]
            above, ties = np.flatnonzero(scores > bar), np.flatnonzero(scores == bar)
            some = np.concatenate([above, ties[:k]])
        else:
            some = np.arange(len(rows))
        return some[np.lexsort((rows[some], -scores[some]))][:k]

    def best_same(self, anchor_id: int, label: int, anchor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best other rows of the label."""
        mine = (self.labels == label) & (self.ids != anchor_id)
        if not mine.any():
            return self.ids[:0], self.ids[:0]
        # rows far out on the strongest coordinate set the bar
        f = int(np.argmax(np.abs(anchor)))
        way = self.order[:, f] if anchor[f] < 0 else self.order[::-1, f]
        seeds = way[:64 * k][mine[way[:64 * k]]]
        least = -np.inf
        if len(seeds) >= k:
            got = self.scores(seeds, anchor)
            least = float(np.partition(got, len(got) - k)[len(got) - k])
        rows = self.candidates(anchor, least)
        rows = rows[mine[rows]]
        scores = self.scores(rows, anchor)
        top = self.first(rows, scores, k)
        return self.ids[rows[top]], scores[top]


def _dealt(rows: DataFrame, piece_rows: int) -> tuple[DataFrame, int]:
    """``rows`` with ``piece``, rows of about one length, and the number of pieces.  There are a few hundred buckets, whatever the table."""
    square = F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    rows = rows.withColumn("bucket", F.when(square == 0, -1).otherwise(F.floor(F.log(square) / (2 * np.log(LENGTH_RATIO)))).cast("int"))
    counts = rows.groupBy("bucket").count().orderBy("bucket").collect()
    first, size, total = {}, {}, 0
    for bucket, n in counts:
        first[bucket], size[bucket] = total, max(1, -(-n // piece_rows))
        total += size[bucket]
    table = lambda d: F.create_map(*[F.lit(x) for pair in d.items() for x in pair])[F.col("bucket")]
    if not counts:
        return rows.withColumn("piece", F.lit(0)), 0
    return rows.withColumn("piece", (table(first) + F.pmod(F.xxhash64("vec_id", "x"), table(size))).cast("int")).drop("bucket"), total


def _piece(part: pd.DataFrame) -> Piece:
    return Piece(part["vec_id"].to_numpy(np.int64), part["label"].to_numpy(np.int64), np.stack(part["x"].to_numpy()).astype(np.int64))


def _meet(rows: DataFrame, pieces: int, anchors: DataFrame, blocks: int, run, schema: str) -> DataFrame:
    """``run(piece, anchors)`` for each piece and block."""
    left = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = anchors.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    columns = [x.split()[0] for x in schema.split(",")]

    def both(part: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = run(_piece(part), asked) if len(part) and len(asked) else []
        return pd.DataFrame(found, columns=columns)

    return left.groupBy("piece", "block").cogroup(right.groupBy("piece", "block")).applyInPandas(both, schema)


def _ranked(df: DataFrame, by: list[str], score: str, name: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(name))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def prepared(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, x of the rows that take part."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    return quantised(rows.filter("vec_id IS NOT NULL AND label IS NOT NULL"), "embedding", scale)


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   piece_rows: int = PIECE_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for ``anchors`` and ``rows`` (vec_id, label, x, of ``prepared``).

    An anchor's positives are the best ``positives`` rows of its label with another id; a positive's negatives the best
    ``negatives`` rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score.  Scores are
    inner products, exact within 64 bits; ties go to the smaller id.  A row that stands twice counts twice, but an
    anchor that stands twice is asked once; anchors that share an id but not label and vector are asked one by one.  A label
    without other rows has no positives, and a positive without rows in its range no negatives: neither
    appears.  Empty tables give an empty table.  No row is skipped: pruning only leaves out rows that cannot reach the score.
    """
    kept = written(rows.select("vec_id", "label", "x"))
    dealt, pieces = _dealt(kept, piece_rows)
    asked = written(anchors.select("vec_id", "label", "x").distinct().select(
        F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"), F.col("x").alias("anchor"), F.xxhash64("label", "x").alias("twin")))
    blocks = max(1, -(-asked.count() // block_anchors))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("anchor_id", "twin"), F.lit(blocks)).cast("int"))
    schema = "anchor_id long, twin long, positive_id long, positive_score long"
    if not pieces:
        return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")

    def same(piece: Piece, part: pd.DataFrame) -> list[tuple]:
        out = []
        for a, twin, label, x in zip(part["anchor_id"], part["twin"], part["anchor_label"], part["anchor"]):
            ids, scores = piece.best_same(a, label, np.asarray(x, np.int64), positives)
            out += [(a, twin, i, s) for i, s in zip(ids.tolist(), scores.tolist())]
        return out

    found = _ranked(_meet(dealt, pieces, asked, blocks, same, schema), ["anchor_id", "twin"], "positive_score", "positive_id", positives)
    found = written(found.select("anchor_id", "twin", F.struct(F.col("rank").alias("place"), "positive_id", "positive_score").alias("p"))
                    .groupBy("anchor_id", "twin").agg(F.array_sort(F.collect_list("p")).alias("pairs")))

    def other(piece: Piece, part: pd.DataFrame) -> list[tuple]:
        out = []
        for a, twin, label, x, pairs in zip(part["anchor_id"], part["twin"], part["anchor_label"], part["anchor"], part["pairs"]):
            x = np.asarray(x, np.int64)
            ranges = [(p["place"], p["positive_id"], p["positive_score"], -(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in pairs]
            ranges = [r for r in ranges if r[3] <= r[4]]
            if not ranges:
                continue
            rows_ = piece.candidates(x, float(min(r[3] for r in ranges)))
            rows_ = rows_[piece.labels[rows_] != label]
            scores = piece.scores(rows_, x)
            for place, positive, score, least, most in ranges:
                fit = np.flatnonzero((scores >= least) & (scores <= most))
                top = fit[piece.first(rows_[fit], scores[fit], negatives)]
                out += [(a, twin, place, positive, score, i, s) for i, s in zip(piece.ids[rows_[top]].tolist(), scores[top].tolist())]
        return out

    schema = "anchor_id long, twin long, place int, positive_id long, positive_score long, negative_id long, negative_score long"
    mined = _meet(dealt, pieces, asked.join(found, ["anchor_id", "twin"]), blocks, other, schema)
    mined = _ranked(mined, ["anchor_id", "twin", "place"], "negative_score", "negative_id", negatives)
    return mined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
