"""Long repeats by a run-length compressed Burrows-Wheeler index.

A byte goes if a string of 200 bytes that covers it also starts anywhere else.  An index over the whole
corpus would have to be built in one place, so the corpus is first dealt into parts that cannot
match each other:

* Every window of 200 bytes has an anchor, the first of its 32-byte strings with the least hash.  Equal
  windows have equal anchors.  A maximal run of windows with one anchor place is a unit, at most 368 bytes.
* Units whose anchor occurs once repeat nowhere and are never stored.  Equal units with one anchor are counted; if there are
  two, all their windows repeat.
* Anchors with several different units go to the index: one copy of each unit, dealt by anchor, with
  overlapping units of a document joined.  Each part sorts its suffixes, keeps the runs of its Burrows-Wheeler
  transform, and samples at both ends of every run the length of the match with the
  neighbouring suffix.  Inside a run that length is one less than at the place before, so one pass over
  the text streams all match lengths from the samples.  Windows that match 200 bytes repeat.
* Anchors with too many different units for a part are dealt again by longer anchors, at last by whole windows, which
  leaves equal units only.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, slices, texts, written
from .words import POWERS

LENGTH = 200
GRAMS = (32, 104, 200)  # bytes of an anchor, round by round; the last is a whole window
GRAM = GRAMS[0]
PART_BYTES = 1 << 20
MOST_UNITS = 4_000
HOT_SHARE = 1000  # a unit with more than a thousandth of all occurrences is hot; there are fewer than a thousand such units
SLICE = 1 << 20
BLOCK = 1 << 20
PLACE_BITS = np.uint64(21)  # a block and its overlap

_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
SEPARATOR = 0xFF  # never a byte of UTF-8


class Sums:
    """Hashes of all substrings of some bytes, from sums of powers."""

    def __init__(self, data: np.ndarray):
        up, self.down = POWERS.to(len(data))
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * up, out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.down[start] + (end - start).astype(np.uint64))

    def grams(self, n: int) -> np.ndarray:
        return mix((self.total[n:] - self.total[:-n]) * self.down[:len(self.total) - n] + np.uint64(n))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size, out = 1, x
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def units(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, anchor and digest of every unit of a text, block by block."""
    out = []
    for at in range(0, max(1, len(raw) - length + 1), BLOCK):
        data = np.frombuffer(raw[at:at + BLOCK + length - 1], np.uint8)
        if len(data) < length:
            break
        sums = Sums(data)
        grams = sums.grams(gram)
        # the least hash, and of equal ones the first place
        low = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
        least = _sliding_min((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - gram + 1) & low
        first = np.flatnonzero(np.diff(least.astype(np.int64), prepend=-1))
        end = np.append(first[1:], len(least))
        out.append((first + at, end - first, grams[least[first].astype(np.int64)], sums.of(first, end + length - 1)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


# -- the index of one part ------------------------------------------------------------------------


def _keys(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.as_strided(padded, (len(text), 8), (1, 1)).copy().view(">u8").ravel().astype(np.uint64)


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the suffixes in order of their first ``depth`` bytes or more, and their ranks, equal if those are; by prefix doubling."""
    n = len(text)
    key = _keys(text)
    order = np.argsort(key, kind="stable").astype(np.int32)  # a part is far below 2 ** 31 bytes
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    del key
    group = np.flatnonzero(new).astype(np.int32)[np.cumsum(new, dtype=np.int32) - 1]  # a group's rank is its first place in the order
    rank = np.empty(n, np.int32)
    rank[order] = group
    h = 8
    while h < depth:
        # only suffixes that share their rank are sorted on
        size = np.diff(np.append(np.flatnonzero(new), n))
        open_ = np.flatnonzero(np.repeat(size > 1, size))
        if not len(open_):
            break
        place = order[open_]
        behind = place + h
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1)
        both = (group[open_].astype(np.uint64) << np.uint64(32)) | (second + 1).astype(np.uint64)
        del behind, second
        by = np.argsort(both, kind="stable")
        order[open_] = place[by]
        both = both[by]
        starts = np.concatenate([[True], both[1:] != both[:-1]])
        new[open_] = starts
        group[open_] = open_[np.flatnonzero(starts)[np.cumsum(starts, dtype=np.int32) - 1]]
        rank[order[open_]] = group[open_]
        h *= 2
    return order, rank


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Bytes that the suffixes at a and b share, up to ``most``."""
    padded = np.concatenate([text, np.full(most + 8, SEPARATOR, np.uint8)])
    out, active, at = np.zeros(len(a), np.int32), np.arange(len(a)), 0
    while len(active) and at < most:
        same = padded[a[active, None] + at + np.arange(16)] == padded[b[active, None] + at + np.arange(16)]
        run = np.where(same.all(axis=1), 16, same.argmin(axis=1))
        out[active] += run
        active, at = active[run == 16], at + 16
    return np.minimum(out, most)


@dataclass
class RunIndex:
    """The runs of a Burrows-Wheeler transform, and the match lengths sampled at their ends in order of place."""

    heads: np.ndarray  # the byte of each run, -1 for the suffix that is the whole text
    lengths: np.ndarray  # of the runs
    place: np.ndarray
    reach: np.ndarray  # how far into the text the samples up to each place match

    def statistics(self, start: int, stop: int) -> np.ndarray:
        """Match lengths at the places from start to stop, streamed from the samples."""
        place = np.arange(start, stop)
        sample = np.searchsorted(self.place, place, side="right") - 1
        return np.where(sample >= 0, np.maximum(self.reach[sample] - place, 0), 0) if len(self.place) else np.zeros(len(place), np.int64)


def run_index(text: np.ndarray, length: int = LENGTH) -> RunIndex:
    """The index of ``text``, whose segments end with the separator; matches count as far as ``length`` is concerned.

    The suffix order is only needed while the runs are found: what is kept grows with the number of runs.
    """
    depth = 8
    while depth < length:
        depth *= 2
    if len(text) < 2:
        none = np.zeros(0, np.int64)
        return RunIndex(np.full(len(text), -1, np.int16), np.ones(len(text), np.int64), none, none)
    order, rank = suffix_order(text, depth)
    transform = np.where(order > 0, text[order - 1].astype(np.int16), np.int16(-1))
    pair = rank[order]
    deep = pair[1:] == pair[:-1]  # neighbours that agree as deep as was sorted
    border = transform[1:] != transform[:-1]  # between two runs
    first = np.concatenate([[0], np.flatnonzero(border) + 1])
    sampled = np.flatnonzero(border & ~deep)
    shared = _common(text, order[sampled], order[sampled + 1], depth)
    deep = np.flatnonzero(deep)
    # the last suffix of one run, the first of the next
    place = np.concatenate([order[sampled], order[sampled + 1], order[deep], order[deep + 1]]).astype(np.int64)
    value = np.concatenate([shared, shared, np.full(2 * len(deep), depth)]) + place
    by = np.lexsort((value, place))
    place, value = place[by], value[by]
    last = np.append(place[1:] != place[:-1], True)  # the longest of a place
    return RunIndex(transform[first], np.diff(np.append(first, len(text))), place[last], np.maximum.accumulate(value[last]) if len(place) else value)


def match_lengths(text: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For every place, the longest match of its suffix with another suffix, as far as ``length`` is concerned."""
    return run_index(text, length).statistics(0, len(text))


def repeats(rows: list[tuple], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each unit (document key, start, bytes), the runs of its windows, relative to it, that match another place of the part."""
    order = sorted(range(len(rows)), key=lambda i: rows[i][:2])
    segments, at_of, size = [], [0] * len(rows), 0
    last_doc, last_end, base = None, -1, 0
    for i in order:
        doc, start, raw = rows[i]
        if doc == last_doc and start <= last_end:
            more = raw[last_end - start:] if start + len(raw) > last_end else b""
        else:
            if segments:
                segments.append(bytes([SEPARATOR]))
                size += 1
            last_doc, last_end, base, more = doc, start, size - start, raw
        segments.append(more)
        size += len(more)
        last_end = max(last_end, start + len(raw))
        at_of[i] = base + start
    text = np.frombuffer(b"".join(segments), np.uint8)
    long_ = match_lengths(text, length) >= length
    out = []
    for (_, _, raw), at in zip(rows, at_of):
        edge = np.flatnonzero(np.diff(long_[at:at + len(raw) - length + 1].astype(np.int8), prepend=0, append=0))
        out.append(list(zip(edge[0::2].tolist(), edge[1::2].tolist())))
    return out


# -- on the cluster -------------------------------------------------------------------------------

_RUN_LIST = "array<struct<a:int,b:int>>"
_WANTED = "array<struct<start:int,n:int,anchor:long,unit:long,crowded:boolean>>"
_RUNS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _raw(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column's bytes, null as none."""
    return [t.encode("utf-8", "surrogatepass") for t in texts(batch)] if column == "text" else [r or b"" for r in batch.column(column).to_pylist()]


def _find_units(length: int, gram: int, column: str):
    def run(batches):
        for batch in slices(batches, column, most=SLICE):
            found = [units(raw, length, gram) for raw in _raw(batch, column)]
            count = [len(f[0]) for f in found]
            start, n, anchor, unit = (np.concatenate([f[i] for f in found]) for i in range(4))
            row = pa.array(np.repeat(np.arange(len(found)), count))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(row), batch.column("th").take(row), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)),
                 pa.array(anchor.view(np.int64)), pa.array(unit.view(np.int64))], ["doc_id", "th", "start", "n", "anchor", "unit"])

    return run


def _cut(length: int, column: str):
    """The bytes of the listed units of each text."""
    def run(batches):
        for batch in slices(batches, column, most=SLICE):
            rows, out = [], {"start": [], "anchor": [], "unit": [], "crowded": [], "raw": []}
            for i, (data, wanted) in enumerate(zip(_raw(batch, column), batch.column("wanted").to_pylist())):
                for w in wanted or []:
                    rows.append(i)
                    for k in ("start", "anchor", "unit", "crowded"):
                        out[k].append(w[k])
                    out["raw"].append(data[w["start"]:w["start"] + w["n"] + length - 1])
            at = pa.array(rows, pa.int64())
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("th").take(at), *[pa.array(v, t) for v, t in zip(out.values(), kinds)]],
                                             ["doc_id", "th", *out])

    return run


def _index(length: int):
    """One part through the index: anchor, unit and the unit's repeated windows."""
    def run(table: pa.Table) -> pa.Table:
        docs = zip(*(table.column(c).to_pylist() for c in ("doc_id", "th")))
        keys = [(d is not None, d or 0, t) for d, t in docs]
        # a row that stands twice brings its units twice
        held = dict(zip(zip(table.column("anchor").to_pylist(), table.column("unit").to_pylist()), zip(keys, table.column("start").to_pylist(), table.column("raw").to_pylist())))
        found = repeats(list(held.values()), length)
        runs = pa.array([[{"a": a, "b": b} for a, b in f] for f in found], _RUNS)
        return pa.table({"anchor": pa.array([a for a, _ in held], pa.int64()), "unit": pa.array([u for _, u in held], pa.int64()), "runs": runs})

    return run


def _settle(keep_texts: bool):
    """Rows without candidates are done; of the others the text stays."""
    def run(batches):
        for batch in slices(batches, most=SLICE):
            out = {"n_bytes": [], "kept_sha256": [], "kept": [], "text": []}
            for t, raw, wanted in zip(texts(batch), _raw(batch, "text"), batch.column("wanted").to_pylist()):
                done = wanted is None
                row = (len(raw), hashlib.sha256(raw).hexdigest(), raw if keep_texts else None, None) if done else (None, None, None, t)
                for k, v in zip(out, row):
                    out[k].append(v)
            kinds = [pa.int64(), pa.string(), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), *[pa.array(v, t) for v, t in zip(out.values(), kinds)], batch.column("wanted")],
                                             ["doc_id", "th", *out, "wanted"])

    return run


def _strip(length: int, keep_texts: bool):
    """Remaining bytes of each text without the windows in ``runs``."""
    def run(batches):
        for batch in slices(batches, most=SLICE):
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
            for data, runs in zip(_raw(batch, "text"), batch.column("runs").to_pylist()):
                kept, at, spans, gone, last = [], 0, 0, 0, -1
                for a, b in ((r["a"], r["b"] + length - 1) for r in runs or []):  # in order of their starts
                    if a > last:
                        kept.append(data[at:a])
                        spans += 1
                        gone += b - a
                        at = last = b
                    elif b > last:
                        gone += b - last
                        at = last = b
                kept.append(data[at:])
                rest = b"".join(kept)
                for k, v in zip(out, (len(data), gone, spans, hashlib.sha256(rest).hexdigest(), rest if keep_texts else None)):
                    out[k].append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(v, t) for v, t in zip(out.values(), kinds)]], ["doc_id", *out])

    return run


def _candidates(rows: DataFrame, column: str, length: int, gram: int, most_units: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The occurrences of units whose anchor occurs twice, the different ones with their number, and per row the units to cut from it.

    ``rows`` has doc_id, th and ``column``.  Rows without occurrences are missing in the last table.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "th", column).mapInArrow(_find_units(length, gram, column), f"doc_id {kind}, th long, start int, n int, anchor long, unit long")
    shared = written(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("anchor"))
    held = written(found.join(shared, "anchor"))
    # first() of all four comes from one occurrence
    distinct = written(held.groupBy("anchor", "unit").agg(F.count(F.lit(1)).alias("times"), *[F.first(c).alias(c) for c in ("doc_id", "th", "start", "n")]))
    kinds = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    wanted = F.struct("start", "n", "anchor", "unit", (F.col("kinds") > most_units).alias("crowded"))
    picked = distinct.join(kinds, "anchor").select("doc_id", "th", wanted.alias("w"))
    seen = held.select("doc_id", "th").distinct().withColumn("w", F.lit(None).cast(picked.schema["w"].dataType))
    info = picked.unionByName(seen).groupBy("doc_id", "th").agg(F.collect_list("w").cast(_WANTED).alias("wanted"))
    return held, distinct, info


def _same():
    return F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t"))


def _side(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("doc_id", "_d").withColumnRenamed("th", "_t")


def _cut_schema(rows: DataFrame) -> str:
    return f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, th long, start int, anchor long, unit long, crowded boolean, raw binary"


def _judged(held: DataFrame, distinct: DataFrame, cut: DataFrame, length: int, grams: tuple[int, ...], most_units: int, part_bytes: int) -> DataFrame:
    """doc_id, th, runs (array of window starts [a, b), in order) of every row with a repeated window."""
    size = {r["crowded"]: r["bytes"] for r in cut.groupBy("crowded").agg(F.sum(F.octet_length("raw")).alias("bytes")).collect()}
    parts = max(1, -(-(size.get(False) or 0) // part_bytes))
    some = cut.filter("NOT crowded").withColumn("part", F.pmod(F.xxhash64("anchor"), F.lit(parts)))
    matched = some.groupBy("part").applyInArrow(_index(length), "anchor long, unit long, runs array<struct<a:int,b:int>>")
    if size.get(True):
        rows = written(cut.filter("crowded").dropDuplicates(["anchor", "unit"]).select(F.col("anchor").alias("doc_id"), F.col("unit").alias("th"), "raw"))
        held_, distinct_, info = _candidates(rows, "raw", length, grams[1], most_units)
        cut_ = written(rows.join(_side(info), _same()).drop("_d", "_t").mapInArrow(_cut(length, "raw"), _cut_schema(rows)))
        deeper = _judged(held_, distinct_, cut_, length, grams[1:], most_units, part_bytes)
        matched = matched.unionByName(deeper.select(F.col("doc_id").alias("anchor"), F.col("th").alias("unit"), "runs"))
    # a unit that occurs twice repeats as a whole
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b"))).cast(_RUN_LIST)
    judged = written(distinct.filter("times > 1").select("anchor", "unit", "times", whole.alias("runs")).unionByName(
        distinct.filter("times = 1").join(matched.filter(F.size("runs") > 0), ["anchor", "unit"]).select("anchor", "unit", "times", "runs")))
    # hot units, fewer than a thousand, meet their occurrences without a shuffle
    total = held.count()
    hot = F.broadcast(judged.filter(F.col("times") * HOT_SHARE > total).drop("times"))
    rest = judged.filter(F.col("times") * HOT_SHARE <= total).drop("times")
    placed = held.join(hot, ["anchor", "unit"]).unionByName(held.join(hot.drop("runs"), ["anchor", "unit"], "left_anti").join(rest, ["anchor", "unit"]))
    spans = placed.select("doc_id", "th", F.transform("runs", lambda r: F.struct((r["a"] + F.col("start")).alias("a"), (r["b"] + F.col("start")).alias("b"))).alias("runs"))
    return spans.groupBy("doc_id", "th").agg(F.sort_array(F.flatten(F.collect_set("runs"))).cast(_RUN_LIST).alias("runs"))


def repeated_windows(docs: DataFrame, length: int = LENGTH, most_units: int = MOST_UNITS, part_bytes: int = PART_BYTES, grams: tuple[int, ...] = GRAMS) -> DataFrame:
    """doc_id, th, runs (array of window starts [a, b)) of every text with a repeated window; ``docs`` has doc_id, th, text."""
    held, distinct, info = _candidates(docs, "text", length, grams[0], most_units)
    cut = written(docs.join(_side(info), _same()).drop("_d", "_t").select("doc_id", "th", "text", "wanted").mapInArrow(_cut(length, "text"), _cut_schema(docs)))
    return _judged(held, distinct, cut, length, grams, most_units, part_bytes)


def deduplicated(docs: DataFrame, length: int = LENGTH, keep_texts: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are left out): doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept.

    ``kept`` holds the bytes that stay (null without ``keep_texts``, which saves storing texts that are done early), ``n_spans``
    counts maximal removed runs.  A null text counts as empty; texts under ``length`` bytes stay whole; rows that repeat a
    text of that length lose it all; ids may be null or repeated; an empty table gives an empty table.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    grams = tuple(g for g in GRAMS if g < length) + (length,)
    held, distinct, info = _candidates(rows, "text", length, grams[0], MOST_UNITS)
    joined = rows.join(_side(info), _same(), "left").drop("_d", "_t")
    settled = written(joined.mapInArrow(_settle(keep_texts), f"doc_id {kind}, th long, n_bytes long, kept_sha256 string, kept binary, text string, wanted {_WANTED}"))
    cut = written(settled.filter(F.size("wanted") > 0).mapInArrow(_cut(length, "text"), _cut_schema(rows)))
    runs = _judged(held, distinct, cut, length, grams, MOST_UNITS, PART_BYTES)
    live = settled.filter("text IS NOT NULL").select("doc_id", "th", "text").join(_side(runs), _same(), "left").drop("_d", "_t")
    stripped = live.mapInArrow(_strip(length, keep_texts), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    zero = F.lit(0).cast("long")
    done = settled.filter("text IS NULL").select("doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), "kept_sha256", "kept")
    return done.unionByName(stripped)
