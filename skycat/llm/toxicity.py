"""Toxicity: a linear classifier over hashed character n-grams, scaled by naive Bayes log-count ratios.

Presence of a 3-, 4- or 5-character gram is a feature.  The log ratio of its smoothed document
frequencies in the two classes, counted over all labelled training rows on the cluster, scales it;
a logistic regression over the scaled features is fitted on a bounded sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release_memory, slices, texts

GRAMS = (3, 4, 5)
BITS = 20
SAMPLE_PER_CLASS = 1500
BROADCAST_ROWS = 1_000_000
MULTIPLIER = np.uint32(0x9E3779B1)


@dataclass
class Model:
    """Weight of each gram bucket (ratio times regression), the ratio, which gives a text's length, and the intercept; ``learned`` is False without rows of both classes."""

    weights: np.ndarray
    ratio: np.ndarray
    intercept: float
    learned: bool = True

    def logit(self, found: np.ndarray) -> float:
        length = float(np.sqrt((self.ratio[found].astype(np.float64) ** 2).sum()))
        return float(self.weights[found].sum(dtype=np.float64)) / max(length, 1e-6) + self.intercept


def gram_sets(items: list[str], bits: int = BITS) -> list[np.ndarray]:
    """Sorted distinct buckets of each text's grams; texts are lower-cased and stand between spaces."""
    padded = [f" {x.lower()} " for x in items]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(x) for x in padded])
    hashes, h = [], np.zeros(len(codes), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        # the hash of the gram of n characters that starts at each place
        last = codes[n - 1:]
        h = (h[:len(last)] ^ last) * MULTIPLIER
        h ^= h >> np.uint32(15)
        if n in GRAMS:
            hashes.append(((h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)).astype(np.uint32))
    seen, out, start = np.zeros(1 << bits, bool), [], 0
    for end in ends:
        for n, h in zip(GRAMS, hashes):
            seen[h[start:max(start, end - n + 1)]] = True
        found = np.flatnonzero(seen)
        seen[found] = False
        out.append(found.astype(np.uint32))
        start = end
    return out


def in_training(doc_id: Column) -> Column:
    """False for the held-out fifth of ids; a null id counts as the empty text and is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 != 0


def _frequencies(batches, bits):
    """Documents with each bucket, by class, summed over the task."""
    counts = np.zeros((2, 1 << bits), np.int64)
    for batch in slices(batches):
        for found, label in zip(gram_sets(texts(batch), bits), batch.column("toxic").to_pylist()):
            counts[label, found] += 1
    buckets = np.flatnonzero(counts.any(axis=0))
    for part in np.array_split(buckets, max(1, len(buckets) >> 16)):
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(counts[0, part]), pa.array(counts[1, part])],
                                         ["bucket", "clean", "toxic"])


def _features(batches, bits):
    for batch in slices(batches):
        sets = [x.tobytes() for x in gram_sets(texts(batch), bits)]
        yield pa.RecordBatch.from_arrays([pa.array(batch.column("toxic").to_pylist(), pa.int32()), pa.array(sets, pa.binary())],
                                         ["toxic", "buckets"])


def regress(sets: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, rounds: int = 60, ridge: float = 1e-4) -> Model:
    """Logistic regression over the scaled features of unit length, balanced between the classes, by accelerated gradient descent.

    Text by text over dense vectors, so that memory is that of the sets themselves.
    """
    scale = [1 / max(float(np.sqrt((ratio[s] ** 2).sum())), 1e-6) for s in sets]
    share = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())

    def forward(w):
        scaled = w * ratio
        return np.array([scaled[s].sum() * c for s, c in zip(sets, scale)])

    def backward(e):
        g = np.zeros(len(ratio))
        for s, c, x in zip(sets, scale, e):
            g[s] += c * x  # the buckets of a set are distinct
        return g * ratio

    seen = np.zeros(len(ratio), bool)
    for s in sets:
        seen[s] = True
    u, steepest = seen / max(1.0, float(np.sqrt(seen.sum()))), 0.0
    for _ in range(6):
        u = backward(share * forward(u))
        steepest = float(np.linalg.norm(u))
        u /= max(steepest, 1e-12)
    step = 1 / (0.3 * steepest + ridge + 0.25)
    w = last_w = np.zeros(len(ratio))
    b = last_b = 0.0
    for k in range(rounds):
        ahead = k / (k + 3)
        w_ahead, b_ahead = w + ahead * (w - last_w), b + ahead * (b - last_b)
        e = (1 / (1 + np.exp(-np.clip(forward(w_ahead) + b_ahead, -30, 30))) - labels) * share
        last_w, last_b = w, b
        w, b = w_ahead - step * (backward(e) + ridge * w_ahead), b_ahead - step * float(e.sum())
    return Model((w * ratio).astype(np.float32), ratio.astype(np.float32), float(b))


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS, sample_per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Learn from ``docs`` (doc_id, text) joined with ``labels`` (doc_id, toxic 0 or 1) outside the held-out fifth.

    Frequencies cover every labelled training row; at most ``sample_per_class`` rows of each class
    (those with the smallest id hashes) go to the driver for the regression, and one count per
    bucket, 2 ** ``bits`` at most.  Rows with a null id or label are not used.  Without rows of both
    classes the model has only an intercept, the smoothed share of toxic rows, and is not ``learned``.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & in_training(F.col("doc_id")))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    prior = float(np.log((toxic + 1) / (clean + 1)))
    if not clean or not toxic:
        return Model(*np.zeros((2, 1 << bits), np.float32), prior, learned=False)
    side = F.broadcast(known) if clean + toxic <= BROADCAST_ROWS else known
    rows = docs.select("doc_id", "text").join(side, "doc_id").select("text", "toxic")
    counted = rows.mapInArrow(lambda b: _frequencies(b, bits), "bucket int, clean long, toxic long")
    counted = counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    freq = np.ones((2, 1 << bits))
    for row, name in enumerate(("clean", "toxic")):
        freq[row, counted["bucket"].to_numpy()] += counted[name].to_numpy()
    ratio = np.log(freq[1] / (toxic + 2)) - np.log(freq[0] / (clean + 2))
    picked = None
    for label in (0, 1):
        part = known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_per_class)
        picked = part if picked is None else picked.unionByName(part)
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "toxic")
    sample = sample.mapInArrow(lambda b: _features(b, bits), "toxic int, buckets binary").toArrow()
    labels, sets = sample["toxic"].to_pylist(), sample["buckets"].to_pylist()
    if set(labels) != {0, 1}:
        return Model(*np.zeros((2, 1 << bits), np.float32), prior, learned=False)
    order = sorted(range(len(sets)), key=lambda i: (labels[i], sets[i]))  # the same sums whatever task came first
    model = regress([np.frombuffer(sets[i], np.uint32) for i in order], np.array([labels[i] for i in order]), ratio)
    del counted, freq, sample, sets
    release_memory()
    return model


def score(model: Model, bits: int = BITS):
    """A Column function: the probability that a text is toxic; a null text counts as empty."""
    @F.pandas_udf("double")
    def scored(column: pd.Series) -> pd.Series:
        items, out, start = [x or "" for x in column], [], 0
        while start < len(items):
            stop, total = start, 0
            while stop < len(items) and (stop == start or total + len(items[stop]) <= 1 << 20):
                total += len(items[stop])
                stop += 1
            out += [model.logit(found) for found in gram_sets(items[start:stop], bits)]
            start = stop
        return pd.Series(1 / (1 + np.exp(-np.clip(np.array(out, float), -500, 500))))

    return scored


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted; other columns are never read.

    Repeated rows get equal scores; an empty table gives an empty table; null texts count as empty.
    """
    scored = score(fit(docs, labels))
    rows = docs.select("doc_id", (~in_training(F.col("doc_id"))).alias("held_out"), scored(F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is under one half.

    All rows stay if the training labels, or the documents they belong to, lack one of the two
    classes: there is nothing to tell toxic texts by.
    """
    model = fit(docs, labels)
    return docs.filter(score(model)(F.col("text")) < 0.5) if model.learned else docs
