"""Repeated passages by suffix automata against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skycat.llm import substring_dedup, words
from tests.llm import data


def stripped(items: list[str | None], window: int):
    split = [(t or "").encode().split() for t in items]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        yield len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()


def got(docs, **kw):
    rows = substring_dedup.deduplicated(docs, **kw).collect()
    for r in rows:
        assert r["kept"] is None or hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows)


def want(docs, window):
    rows = docs.collect()
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0, *w) for r, w in zip(rows, stripped([r["text"] for r in rows], window)))


@pytest.mark.parametrize("extra", [False, True])
def test_repeated_passages(spark, extra):
    docs = data.documents(spark, extra)
    expected = want(docs, 35)
    assert got(docs) == got(docs, keep_texts=False) == expected
    assert any(x[3] for x in expected) and any(0 < x[3] < x[2] for x in expected)


def crowd(rng):
    """A passage with other words around it in every document, and a group of copies."""
    passage = data.prose(rng, 12).split()
    rows = [" ".join([data.prose(rng, rng.randint(0, 9)), *passage[: rng.randint(8, 12)], data.prose(rng, rng.randint(0, 9))]) for _ in range(60)]
    return rows + [rows[0]] * 40 + ["a b " * 30, "b a " * 10, "a " * 50]


@pytest.mark.parametrize("units", [1, 3, 1000])
def test_crowded_anchors_are_dealt_again(spark, units):
    rng = random.Random(units)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(crowd(rng))], data.SCHEMA).repartition(4)
    expected = want(docs, 8)
    assert got(docs, window=8, anchors=(3, 5, 8), shard_units=units, shard_words=50) == expected
    assert sum(x[3] for x in expected) > 400


def test_of_nothing(spark):
    assert got(data.empty(spark)) == []
    none = data.documents(spark).filter("text IS NULL OR text = ''")
    assert got(none) == want(none, 35)
    with pytest.raises(ValueError):
        substring_dedup.deduplicated(none, window=20)


def test_automaton():
    rng = random.Random(2)
    for _ in range(200):
        sequences = [[rng.choice("ab" if rng.random() < 0.7 else "abc") for _ in range(rng.randint(0, 30))] for _ in range(rng.randint(1, 5))]
        seen = Counter(tuple(s[i:j]) for s in sequences for j in range(len(s) + 1) for i in range(j))
        other = [rng.choice("abcd") for _ in range(30)]
        automaton = substring_dedup.SuffixAutomaton(sequences)
        for s in [*sequences, other]:
            longest = [max([j - i for i in range(j) if seen[tuple(s[i:j])] > 1], default=0) for j in range(1, len(s) + 1)]
            assert automaton.statistics(s) == longest
        assert len(automaton.link) <= 2 * sum(map(len, sequences)) + 1


def test_units_cover_every_window_once(monkeypatch):
    rng = random.Random(4)
    for block in (64, 1 << 19):
        monkeypatch.setattr(substring_dedup, "BLOCK", block)
        texts = [data.prose(rng, rng.randint(0, 90)) for _ in range(12)] + ["x " * 80, "", data.prose(rng, 700)]
        tokens, at = words.word_hashes(texts, substring_dedup.EXACT)
        owner, start, n, anchor, unit = substring_dedup.units(tokens, at, 12, 4)
        covered = sorted((o, s + i) for o, s, k in zip(owner, start, n) for i in range(k))
        assert covered == [(o, i) for o, t in enumerate(texts) for i in range(len(t.split()) - 11)]
        # equal windows have equal anchors
        by_window = {}
        for o, s, k, a in zip(owner, start, n, anchor):
            for i in range(k):
                key = tuple(texts[o].split()[s + i:s + i + 12])
                assert by_window.setdefault(key, a) == a


def test_capitals_and_other_spaces_stay_apart(spark):
    one = " ".join(f"Word{i}" for i in range(40))
    docs = spark.createDataFrame([(1, one, "", "", 1), (2, one.lower(), "", "", 1), (3, one.replace(" ", " "), "", "", 1), (4, one.replace(" ", "\t\r\n\x0b\x0c"), "", "", 1)], data.SCHEMA)
    assert {r["doc_id"] for r in substring_dedup.deduplicated(docs).filter(F.col("n_removed") > 0).collect()} == {1, 4}


def test_word_hashes_in_blocks(monkeypatch):
    rng = random.Random(6)
    items = [data.prose(rng, 200), "", " \n", "x" * 3000, "a " * 500, "ré\tB", data.prose(rng, 50)]
    whole = words.word_hashes(items)
    monkeypatch.setattr(words, "BLOCK", 64)
    parts = words.word_hashes(items)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    assert [int(x) for x in np.diff(parts[1])] == [len(t.encode().split()) for t in items]
