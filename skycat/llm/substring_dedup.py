"""Repeated passages by suffix automata over shards of the corpus.

A word goes if a window of 35 words that covers it also starts anywhere else.  One automaton over the whole corpus could
neither be built nor broadcast, so the reference is cut into shards that cannot match each other:

* Every window has an anchor, the first of its short word runs with the least hash, so equal windows have equal
  anchors.  A maximal run of windows with one anchor place is a unit.  Units whose anchor occurs once repeat nowhere and
  are never stored.
* Equal units are counted; of two or more, all windows repeat.
* Anchors with several different units make the reference: one copy of each unit, dealt to shards of bounded size by
  anchor.  Each shard builds its suffix automaton and streams its stretches of documents through it.  The matching statistic
  of a word is the longest run of words up to it that the shard holds twice; where it reaches the length of a window, the
  window repeats.
* Anchors with too many different units for a shard are dealt again by longer anchors, at last by whole windows, which
  leaves equal units only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, slices, texts, written
from .words import POWERS, word_hashes

WINDOW = 35
ANCHORS = (10, 24, 35)  # words of an anchor, round by round; the last is a whole window
SHARD_UNITS = 1_000  # different units of one anchor that a shard takes
SHARD_WORDS = 1 << 16
HOT_SHARE = 1000  # a unit with more than a thousandth of all occurrences is hot; there are fewer than a thousand such units
SLICE = 1 << 20
BLOCK = 1 << 19
PLACE_BITS = np.uint64(20)  # a block and its overlap
_WANTED = "array<struct<start:int,n:int,anchor:long,unit:long,crowded:boolean>>"
_RUNS = "array<struct<a:int,b:int>>"


# -- units ----------------------------------------------------------------------------------------


def _exact() -> np.ndarray:
    """A byte's place in the word alphabet, 0 for white space; capitals stay apart."""
    table = np.arange(1, 257, dtype=np.int64)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
    return table


EXACT = _exact()


def of_texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and the borders of the texts among them."""
    return word_hashes(texts(batch), EXACT)


def of_words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The same from words that are hashed already."""
    raw = batch.column("words").to_pylist()
    return np.frombuffer(b"".join(raw), np.uint64), np.concatenate([[0], np.cumsum([len(r) // 8 for r in raw], dtype=np.int64)])


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (width - size)], x[width - size:]) if size < width else x


def units(tokens: np.ndarray, at: np.ndarray, window: int = WINDOW, gram: int = ANCHORS[0]) -> tuple[np.ndarray, ...]:
    """Owner, first window, number of windows, anchor and digest of every unit; ``at`` holds the borders of the sequences."""
    out = []
    low = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    for base in range(0, max(0, len(tokens) - window + 1), BLOCK):
        part = tokens[base:base + BLOCK + window - 1]
        up, down = POWERS.to(len(part))
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up, out=total[1:])
        grams = mix((total[gram:] - total[:-gram]) * down[:len(part) - gram + 1] + np.uint64(gram))
        place = (_least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), window - gram + 1) & low).astype(np.int64)
        start = np.arange(len(place))
        owner = np.searchsorted(at, start + base, side="right") - 1
        inside = start + base + window <= at[owner + 1]
        start, place, owner = start[inside], place[inside], owner[inside]
        if not len(start):
            continue
        first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1) | (owner[1:] != owner[:-1])]))
        n = np.diff(np.append(first, len(start)))
        start, owner, anchor = start[first], owner[first], grams[place[first]]
        size = n + window - 1
        digest = mix((total[start + size] - total[start]) * down[start] + size.astype(np.uint64))
        out.append((owner, start + base - at[owner], n, anchor.view(np.int64), digest.view(np.int64)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*out))


# -- the automaton --------------------------------------------------------------------------------


class SuffixAutomaton:
    """The suffix automaton of several sequences, with the number of places each state's strings end at."""

    def __init__(self, sequences):
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]
        for sequence in sequences:
            state = 0
            for token in sequence:
                state = self._extend(state, token)
                self.count[state] += 1
        by_length = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        for state in reversed(by_length):
            self.count[self.link[state]] += self.count[state]
        # the longest suffix of a state's strings that ends at two places or more
        self.twice = [0] * len(self.link)
        for state in by_length:
            self.twice[state] = self.length[state] if self.count[state] > 1 else self.twice[self.link[state]]

    def _state(self, length: int, link: int, edges: dict) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def _split(self, state: int, token, target: int) -> int:
        """The target of ``token`` for strings no longer than one more than ``state``'s."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(token) == target:
            self.next[state][token] = copy
            state = self.link[state]
        return copy

    def _extend(self, state: int, token) -> int:
        if token in self.next[state]:
            return self._split(state, token, self.next[state][token])
        new = self._state(self.length[state] + 1, 0, {})
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, token, self.next[state][token])
        return new

    def statistics(self, sequence) -> list[int]:
        """For each token the longest run up to it that ends at two places of the reference or more."""
        state, matched, out = 0, 0, []
        for token in sequence:
            while state and token not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if token in self.next[state]:
                state = self.next[state][token]
                matched += 1
            out.append(min(matched, self.twice[state]))
        return out


def repeats(reference: list[np.ndarray], window: int = WINDOW) -> list[list[dict]]:
    """For each sequence of the reference the runs [a, b) of its windows that it or another one holds at another place."""
    tokens = [r.tolist() for r in reference]
    automaton = SuffixAutomaton(tokens)
    out = []
    for sequence in tokens:
        long_ = np.array(automaton.statistics(sequence)[window - 1:]) >= window
        edge = np.flatnonzero(np.diff(long_.astype(np.int8), prepend=0, append=0))
        out.append([{"a": a, "b": b} for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist())])
    return out


# -- on the cluster -------------------------------------------------------------------------------


def _find(source, window: int, gram: int, column: str):
    def run(batches):
        for batch in slices(batches, column, SLICE):
            owner, start, n, anchor, unit = units(*source(batch), window, gram)
            row = pa.array(owner)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(row), batch.column("th").take(row), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)),
                                              pa.array(anchor), pa.array(unit)], ["doc_id", "th", "start", "n", "anchor", "unit"])

    return run


def _cut(source, window: int, column: str):
    """The words of the wanted units."""
    def run(batches):
        for batch in slices(batches, column, SLICE):
            tokens, at = source(batch)
            out = {"anchor": [], "unit": [], "crowded": [], "words": []}
            for base, wanted in zip(at.tolist(), batch.column("wanted").to_pylist()):
                for w in wanted or []:
                    for k in ("anchor", "unit", "crowded"):
                        out[k].append(w[k])
                    a = base + w["start"]
                    out["words"].append(tokens[a:a + w["n"] + window - 1].tobytes())
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out))

    return run


def _shard(window: int):
    """One shard: its automaton, and the repeated windows of its units."""
    def run(table: pa.Table) -> pa.Table:
        held = dict(zip(zip(table["anchor"].to_pylist(), table["unit"].to_pylist()), table["words"].to_pylist()))  # a row that stands twice brings its units twice
        runs = repeats([np.frombuffer(w, np.uint64) for w in held.values()], window)
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        return pa.table({"anchor": pa.array([a for a, _ in held], pa.int64()), "unit": pa.array([u for _, u in held], pa.int64()), "runs": pa.array(runs, kind)})

    return run


def _candidates(rows: DataFrame, source, column: str, window: int, gram: int, shard_units: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The occurrences of units whose anchor occurs twice, the different ones with their number, and per row the units to cut from it.

    ``rows`` has doc_id, th and ``column``.  Rows without occurrences are missing in the last table.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "th", column).mapInArrow(_find(source, window, gram, column), f"doc_id {kind}, th long, start int, n int, anchor long, unit long")
    shared = written(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("anchor"))
    held = written(found.join(shared, "anchor"))
    # first() of all four comes from one occurrence
    distinct = written(held.groupBy("anchor", "unit").agg(F.count(F.lit(1)).alias("times"), *[F.first(c).alias(c) for c in ("doc_id", "th", "start", "n")]))
    kinds = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    wanted = F.struct("start", "n", "anchor", "unit", (F.col("kinds") > shard_units).alias("crowded"))
    picked = distinct.join(kinds, "anchor").select("doc_id", "th", wanted.alias("w"))
    seen = held.select("doc_id", "th").distinct().withColumn("w", F.lit(None).cast(picked.schema["w"].dataType))
    info = picked.unionByName(seen).groupBy("doc_id", "th").agg(F.collect_list("w").cast(_WANTED).alias("wanted"))
    return held, distinct, info


def _same(a: str = "doc_id", b: str = "th") -> Column:
    return F.col(a).eqNullSafe(F.col("_d")) & (F.col(b) == F.col("_t"))


def _side(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("doc_id", "_d").withColumnRenamed("th", "_t")


def _judged(held: DataFrame, distinct: DataFrame, cut: DataFrame, window: int, anchors: tuple[int, ...], shard_units: int, shard_words: int) -> DataFrame:
    """doc_id, th, runs of every row with a repeated window."""
    size = cut.groupBy("crowded").agg(F.sum(F.octet_length("words")).alias("bytes")).collect()
    size = {r["crowded"]: r["bytes"] for r in size}
    shards = max(1, -(-(size.get(False) or 0) // (8 * shard_words)))
    matched = cut.filter("NOT crowded").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard") \
        .applyInArrow(_shard(window), f"anchor long, unit long, runs {_RUNS}")
    if size.get(True):
        rows = written(cut.filter("crowded").dropDuplicates(["anchor", "unit"]).select(F.col("anchor").alias("doc_id"), F.col("unit").alias("th"), "words"))
        held_, distinct_, info = _candidates(rows, of_words, "words", window, anchors[1], shard_units)
        cut_ = rows.join(_side(info), _same()).drop("_d", "_t").mapInArrow(_cut(of_words, window, "words"), "anchor long, unit long, crowded boolean, words binary")
        deeper = _judged(held_, distinct_, written(cut_), window, anchors[1:], shard_units, shard_words)
        matched = matched.unionByName(deeper.select(F.col("doc_id").alias("anchor"), F.col("th").alias("unit"), "runs"))
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b")))
    judged = distinct.filter("times > 1").select("anchor", "unit", "times", whole.cast(_RUNS).alias("runs")).unionByName(
        distinct.filter("times = 1").join(matched.filter(F.size("runs") > 0), ["anchor", "unit"]).select("anchor", "unit", "times", "runs"))
    judged = written(judged)
    total = held.count()
    # hot units, fewer than a thousand, meet their occurrences without a shuffle
    hot = F.broadcast(judged.filter(F.col("times") * HOT_SHARE > total).drop("times"))
    rest = judged.filter(F.col("times") * HOT_SHARE <= total).drop("times")
    placed = held.join(hot, ["anchor", "unit"]).unionByName(held.join(hot.drop("runs"), ["anchor", "unit"], "left_anti").join(rest, ["anchor", "unit"]))
    spans = placed.select("doc_id", "th", F.transform("runs", lambda r: F.struct((r["a"] + F.col("start")).alias("a"), (r["b"] + F.col("start")).alias("b"))).alias("runs"))
    return spans.groupBy("doc_id", "th").agg(F.sort_array(F.flatten(F.collect_set("runs"))).cast(_RUNS).alias("runs"))


def _settle(keep_texts: bool):
    """Rows without candidates are done; of the others the text stays."""
    def run(batches):
        for batch in slices(batches, most=SLICE):
            n, digest, kept, text = [], [], [], []
            for t, wanted in zip(texts(batch), batch.column("wanted").to_pylist()):
                done = wanted is None
                words = t.encode("utf-8", "surrogatepass").split() if done else []
                rest = b" ".join(words)
                n.append(len(words) if done else None)
                digest.append(hashlib.sha256(rest).hexdigest() if done else None)
                kept.append(rest if done and keep_texts else None)
                text.append(None if done else t)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.binary()),
                                              pa.array(text, pa.string()), batch.column("wanted")], ["doc_id", "th", "n_words", "kept_sha256", "kept", "text", "wanted"])

    return run


def _strip(window: int, keep_texts: bool):
    """The words outside of the runs of windows."""
    def run(batches):
        for batch in slices(batches, most=SLICE):
            out = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
            for t, runs in zip(texts(batch), batch.column("runs").to_pylist()):
                words = t.encode("utf-8", "surrogatepass").split()
                left, at, gone = [], 0, 0
                for r in runs or []:  # in order of their starts
                    a, b = max(r["a"], at), r["b"] + window - 1
                    if b > a:
                        left += words[at:a]
                        gone += b - a
                        at = b
                rest = b" ".join(left + words[at:])
                for k, v in zip(out, (len(words), gone, hashlib.sha256(rest).hexdigest(), rest if keep_texts else None)):
                    out[k].append(v)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(v, t) for v, t in zip(out.values(), kinds)]], ["doc_id", *out])

    return run


def deduplicated(docs: DataFrame, window: int = WINDOW, anchors: tuple[int, ...] = ANCHORS, shard_units: int = SHARD_UNITS, shard_words: int = SHARD_WORDS,
                 keep_texts: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are left out): doc_id, n_words, n_removed, kept_sha256, kept.

    Words are runs of other characters than space and the control characters from tab to carriage return.  ``kept`` holds
    the words that stay, joined by one space, as UTF-8; it is null without ``keep_texts``, which saves storing texts that are done
    early.  A null text counts as empty; texts under ``window`` words stay whole; rows that repeat a longer
    text lose it all, rows of one id and text too; ids may be null or repeated; an empty table gives an empty table.
    Words are compared by 64-bit hashes, units by 128 bits.  ``anchors`` ends with ``window``.
    """
    if list(anchors) != sorted(set(anchors)) or anchors[-1] != window:
        raise ValueError("anchors grow up to the length of a window")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    held, distinct, info = _candidates(rows, of_texts, "text", window, anchors[0], shard_units)
    joined = rows.join(_side(info), _same(), "left").drop("_d", "_t")
    settled = written(joined.mapInArrow(_settle(keep_texts), f"doc_id {kind}, th long, n_words long, kept_sha256 string, kept binary, text string, wanted {_WANTED}"))
    cut = written(settled.filter(F.size("wanted") > 0).mapInArrow(_cut(of_texts, window, "text"), "anchor long, unit long, crowded boolean, words binary"))
    runs = _judged(held, distinct, cut, window, anchors, shard_units, shard_words)
    live = settled.filter("text IS NOT NULL").select("doc_id", "th", "text").join(_side(runs), _same(), "left").drop("_d", "_t")
    stripped = live.mapInArrow(_strip(window, keep_texts), f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept binary")
    done = settled.filter("text IS NULL").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256", "kept")
    return done.unionByName(stripped)
