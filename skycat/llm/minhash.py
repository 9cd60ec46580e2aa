"""Near-duplicates by MinHash: banded universal hash minima, verified links, components by large-star and small-star.

Documents with equal shingle sets form a class at once, by a digest of the set.  The least document id
stands for its class, and only these representatives are banded.  Candidates in a bucket are
taken as a star around one member, and once more with another centre where a bucket still
spans several components, so a group of near copies costs its size, not its square.  What is then left
is compared member by member.  Pairs are made only if three tests pass inside the join: sizes, one-bit
signatures of the minima, and a bound from odd sketches.  Every link is confirmed on full sets.

An odd sketch holds, for each of 1024 slots, whether an odd number of a set's shingles fall in it.  Each slot
in which two sketches differ needs a shingle that only one set has, so the bound never loses a link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard
from .common import BROADCAST_ROWS, MAX_BYTES, mix, slices, small, texts, without, written
from .words import shingle_sets

WORDS = 5
PERCENT = 80
BANDS = 32
ROWS = 4
STAR_ROUNDS = 2
SALTS = 16
# of 128 one-bit signatures, a pair at the threshold differs in 12.8 on average, deviation 3.4: five deviations
MOST_BITS = 30
SKETCH = [f"o{i}" for i in range(16)]
TESTED = ["id", "n", "b0", "b1", *SKETCH]

_RNG = np.random.default_rng(20240229)
FACTORS = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def minima(s: np.ndarray) -> np.ndarray:
    """The least value of each universal hash over a set."""
    out = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 2048):
        np.minimum(out, (s[i:i + 2048, None] * FACTORS + SHIFTS).min(axis=0), out=out)
    return out


def bands(m: np.ndarray) -> np.ndarray:
    """One key per band, of its rows and its number."""
    rows, key = (m >> np.uint64(24)).reshape(BANDS, ROWS), np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return key.view(np.int64)


def _signatures(words: int):
    def run(batches):
        for batch in slices(batches):
            n, d0, d1, b0, b1, keys, odd = [], [], [], [], [], [], []
            for s in shingle_sets(texts(batch), words):
                m = minima(s) if len(s) else None
                bits = np.packbits((mix(m) & np.uint64(1)).astype(np.uint8)).view(np.int64) if len(s) else (0, 0)
                n.append(len(s))
                d0.append(int(mix(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                d1.append(int(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                b0.append(int(bits[0]))
                b1.append(int(bits[1]))
                keys.append(bands(m).tolist() if len(s) else [])
                slots = np.bincount((mix(s + np.uint64(1)) >> np.uint64(54)).astype(np.int64), minlength=64 * len(SKETCH)) & 1
                odd.append(np.packbits(slots.astype(np.uint8)).view(np.int64))
            cols = [pa.array(x, pa.int64()) for x in (n, d0, d1, b0, b1, *np.array(odd).T)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols, pa.array(keys, pa.list_(pa.int64()))],
                                             ["doc_id", "n", "d0", "d1", "b0", "b1", *SKETCH, "keys"])

    return run


def _verify(words: int, percent: int):
    def run(batches):
        for batch in slices(batches, "left", MAX_BYTES // 4):
            a, b = texts(batch, "left"), texts(batch, "right")
            distinct = list(dict.fromkeys(a))
            left = dict(zip(distinct, shingle_sets(distinct, words)))
            ok, start = [], 0
            while start < len(b):  # the right texts in parts, whatever their length
                stop, size = start + 1, len(b[start])
                while stop < len(b) and size + len(b[stop]) <= MAX_BYTES // 4:
                    size += len(b[stop])
                    stop += 1
                for x, y in zip(a[start:stop], shingle_sets(b[start:stop], words)):
                    both = len(np.intersect1d(left[x], y, assume_unique=True))
                    ok.append(both > 0 and 100 * both >= percent * (len(left[x]) + len(y) - both))
                start = stop
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column("u").filter(keep), batch.column("v").filter(keep)], ["u", "v"])

    return run


def linked(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (u, v: document ids, written) whose full sets reach the threshold; only texts of candidates are shuffled."""
    needed = pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct()
    side = F.broadcast(needed) if pairs.count() <= BROADCAST_ROWS else needed
    held = written(docs.select(F.col("doc_id").alias("id"), "text").join(side, "id", "left_semi"))
    both = pairs.join(held.select(F.col("id").alias("v"), F.col("text").alias("right")), "v")
    both = both.join(held.select(F.col("id").alias("u"), F.col("text").alias("left")), "u")
    return both.select("u", "v", "left", "right").mapInArrow(_verify(words, percent), "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """node, label of every node of ``edges`` (u, v): the least id of its component, by alternating large-star and small-star.

    Large-star connects the larger neighbours of a node with the least neighbour, small-star the
    smaller ones and the node itself.  Both keep components and end in stars; each round is written
    to the shared folder, and an unchanged edge set ends the loop.
    """
    oriented = lambda df: df.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, seen = written(oriented(edges)), None
    while True:
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen or not mark[0]:
            break
        seen = mark
        around = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = around.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small_ = large.join(least, "u")
        before, now = now, written(oriented(small_.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small_.select("u", F.col("m").alias("v")))))
        discard(before)
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _close(a: str, b: str, percent: int):
    """What linked pairs satisfy: sizes and odd sketches (always), and signatures (within five deviations)."""
    differ = lambda names: sum(F.bit_count(F.col(f"{a}.{x}").bitwiseXOR(F.col(f"{b}.{x}"))) for x in names)
    near = 100 * F.least(f"{a}.n", f"{b}.n") >= percent * F.greatest(f"{a}.n", f"{b}.n")
    # shared >= t * all gives (100 + percent) * one-sided shingles <= (100 - percent) * both sizes
    bound = (100 + percent) * differ(SKETCH) <= (100 - percent) * (F.col(f"{a}.n") + F.col(f"{b}.n"))
    return near & (differ(["b0", "b1"]) <= MOST_BITS) & bound


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id integer, text; other columns are left out): doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * shared >= ``percent`` * all shingles; ``component_id`` is the least id
    that links reach.  A text without words is linked with nothing.  Rows with one id and different
    texts count as one document with several sets.  A row without id is linked with nothing, has no
    component and is kept.  An empty table gives an empty table.  A pair at the threshold shares
    no band with probability 5e-8 (0.8 ** 4 a band, 32 bands).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = written(rows.mapInArrow(_signatures(words), "doc_id long, n long, d0 long, d1 long, b0 long, b1 long, " + "".join(f"{x} long, " for x in SKETCH) + "keys array<long>"))
    usable = made.filter("n > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("n", "d0", "d1").agg(F.min("doc_id").alias("id"), *[F.first(x).alias(x) for x in ("b0", "b1", *SKETCH, "keys")])
    classes = written(classes)
    # an id with several sets ties its classes together
    one = F.struct("n", "d0", "d1")
    spread = usable.groupBy("doc_id").agg(F.min(one).alias("a"), F.max(one).alias("b")).filter("a <> b").select("doc_id")
    tied = usable.join(spread, "doc_id", "left_semi").join(classes.select("n", "d0", "d1", "id"), ["n", "d0", "d1"])
    edges = tied.select(F.col("doc_id").alias("u"), F.col("id").alias("v"))

    # only ids travel with the bands; what pairs are tested by is joined to members of shared buckets
    flat = classes.select("id", F.explode("keys").alias("key"))
    full = flat.groupBy("key").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("key")
    members = written(flat.join(full, "key"))
    marks = written(classes.select(*TESTED).join(members.select("id").distinct(), "id", "left_semi"))
    labels = None
    for number in range(STAR_ROUNDS + 1):
        if labels is not None:
            members_now = members.join(labels, F.col("id") == F.col("node"), "left").withColumn("label", F.coalesce("label", "id")).drop("node")
            several = members_now.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a < b").select("key")
            members = written(members_now.join(several, "key").drop("label"))
            if members.isEmpty():
                break
        at = members.join(marks, "id")
        at = at if labels is None else at.join(labels, F.col("id") == F.col("node"), "left").drop("node")
        at = at.withColumn("label", F.col("id") if labels is None else F.coalesce("label", "id"))
        if number < STAR_ROUNDS:
            pick = F.min_by(F.struct(*TESTED, "label"), F.xxhash64("id", F.lit(number)))
            centre = at.groupBy("key").agg(pick.alias("c")).select("key", "c.*")
            pairs = at.alias("x").join(centre.alias("y"), "key").filter(F.col("x.label") != F.col("y.label"))
        else:
            # members outside their bucket's largest component, against all members of other components
            sizes = at.groupBy("key", "label").agg(F.count(F.lit(1)).alias("k"))
            major = sizes.groupBy("key").agg(F.max_by("label", F.struct("k", "label")).alias("major"))
            minor = at.join(major, "key").filter("label <> major").drop("major").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            every = at.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
            pairs = minor.alias("x").join(every.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.salt") == F.col("y.salt")) & (F.col("x.label") != F.col("y.label")) & _close("x", "y", percent))
        pairs = pairs.filter(_close("x", "y", percent)).select(F.greatest("x.id", "y.id").alias("v"), F.least("x.id", "y.id").alias("u")).distinct()
        found = linked(written(pairs), rows, words, percent)
        known = edges if labels is None else labels.select(F.col("node").alias("u"), F.col("label").alias("v"))
        labels = written(components(known.unionByName(found)))
    ids = made.join(classes.select("n", "d0", "d1", "id"), ["n", "d0", "d1"], "left")
    ids = ids.join(labels, F.col("id") == F.col("node"), "left")
    component = F.when(F.col("n") > 0, F.coalesce("label", "id")).otherwise(F.col("doc_id"))
    out = ids.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each component, that of the least id; of rows that repeat an id one stays.

    Rows without id or without words stay.
    """
    judged = written(near_duplicates(docs, words, percent).filter("doc_id IS NOT NULL AND n_shingles > 0"))
    rest = without(docs, judged.filter("NOT kept"))
    again = small(judged.filter("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"))
    return rest.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(
        rest.join(again, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id"]))
