"""The other operators against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skycat.llm import decontaminate, minhash, pieces, secrets, suffix_dedup, token_tree, toxicity, words
from tests.llm import data


def by_id(rows, *names):
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0, *(r[n] for n in names)) for r in rows), key=str)


# -- long repeats ---------------------------------------------------------------------------------


def stripped(raws: list[bytes], length: int):
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        gone = gone[:len(r)]
        kept = bytes(c for c, g in zip(r, gone) if not g)
        yield len(r), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("extra", [False, True])
def test_long_repeats(spark, extra):
    docs = data.documents(spark, extra)
    rows = docs.collect()
    want = list(stripped([(r["text"] or "").encode() for r in rows], 200))
    got = by_id(suffix_dedup.deduplicated(docs).collect(), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(((r["doc_id"] is not None, r["doc_id"] or 0, *w) for r, w in zip(rows, want)), key=str)
    assert any(w[1] for w in want)


def test_long_repeats_of_nothing(spark):
    assert suffix_dedup.deduplicated(data.empty(spark)).count() == 0
    assert suffix_dedup.deduplicated(data.documents(spark).filter("text IS NULL OR text = ''")).filter("n_bytes > 0").count() == 0


def test_crowded_anchors_give_the_same(spark):
    rng = random.Random(1)
    passage = data.prose(rng, 90)
    rows = [(i, data.prose(rng, rng.randint(0, 30)) + passage[: 300 + 3 * i] + data.prose(rng, 20), "en", "s", 1) for i in range(30)]
    docs = spark.createDataFrame(rows, data.SCHEMA).withColumn("th", F.xxhash64("text"))
    tables = []
    for most in (10_000, 2):
        runs = suffix_dedup.repeated_windows(docs.select("doc_id", "th", "text"), most_units=most)
        tables.append({r["doc_id"]: {x for s in r["runs"] for x in range(s["a"], s["b"])} for r in runs.collect()})
    assert tables[0] == tables[1] and tables[0]


def test_index_of_a_part():
    rng = random.Random(3)
    for _ in range(60):
        length = rng.choice([8, 20, 40])
        base = bytes(rng.choice(b"ab") for _ in range(300))
        rows = []
        for d in range(rng.randint(1, 6)):
            at = rng.randint(0, 200)
            raw = bytearray(base[at:at + rng.randint(length, 100)])
            raw[rng.randrange(len(raw))] = ord("c")
            rows.append(((True, d, 0), 0, bytes(raw)))
        seen = Counter(r[i:i + length] for _, _, r in rows for i in range(len(r) - length + 1))
        for (_, _, r), runs in zip(rows, suffix_dedup.repeats(rows, length)):
            assert [seen[r[i:i + length]] > 1 for i in range(len(r) - length + 1)] == [any(a <= i < b for a, b in runs) for i in range(len(r) - length + 1)]


def test_the_index_grows_with_the_runs_not_the_text():
    rng = random.Random(5)
    base = bytes(rng.choice(b"abcd") for _ in range(400)) + b"\xff"
    for copies in (2, 40):
        text = np.frombuffer(base * copies, np.uint8)
        index = suffix_dedup.run_index(text, 200)
        assert int(index.lengths.sum()) == len(text) and (index.heads[1:] != index.heads[:-1]).all()
        assert len(index.heads) < 600 and len(index.heads) == len(index.lengths)
        whole = suffix_dedup.match_lengths(text, 200)
        assert (np.concatenate([index.statistics(i, min(i + 100, len(text))) for i in range(0, len(text), 100)]) == whole).all()


def test_units_over_block_borders(monkeypatch):
    rng = random.Random(2)
    raw = bytes(rng.choice(b"abcd") for _ in range(3000)) * 2
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1000)
    start, n, anchor, _ = suffix_dedup.units(raw)
    assert n.sum() == len(raw) - 199 and (np.sort(start)[1:] == np.cumsum(n)[:-1]).all()


# -- secrets --------------------------------------------------------------------------------------


def plain_secrets(text: str):
    out = []
    word = "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    for m in re.finditer(word + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


@pytest.mark.parametrize("extra", [False, True])
def test_secret_rules(spark, extra):
    docs = data.documents(spark, extra)
    got = by_id(secrets.digest(secrets.scan(docs)).collect(), "n_assign", "n_access", "n_hex", "base_sha256")
    want = []
    for r in docs.collect():
        found = plain_secrets(r["text"] or "")
        n = Counter(k for _, k, _ in found)
        text = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in found)
        want.append((r["doc_id"] is not None, r["doc_id"] or 0, n[0], n[1], n[2], hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert secrets.scan(data.empty(spark)).count() == 0


def findings(rng: random.Random, n: int):
    chars = "ABCDEFGHJKabcdefghijk0123456789"
    items, lengths, labels = [], [], []
    for i in range(n):
        secret = i % 2
        core = "".join(rng.choice(chars) for _ in range(rng.randint(18, 200))) if secret else "".join(rng.choice(["er", "tion", "ing", "st"]) for _ in range(rng.randint(8, 60)))
        items.append(("key = " if secret else "the ") + "\0" + core + " and")
        lengths.append(len(core))
        labels.append(secret)
    return items, lengths, np.array(labels)


def test_network_tells_findings_from_prose():
    items, lengths, labels = findings(random.Random(4), 400)
    net = secrets.train(items, lengths, labels)
    unseen, n, truth = findings(random.Random(9), 200)
    p = secrets.predict(net, unseen, n)
    assert ((p > 0.5) == truth).mean() > 0.95
    # one at a time or together: the same scores
    assert np.allclose(p[:5], np.concatenate([secrets.predict(net, [a], [b]) for a, b in zip(unseen[:5], n[:5])]))


def test_scores_do_not_depend_on_neighbours():
    """One unbroken run of 300,000 characters has more rows than go through the network at once, and so have many of 450."""
    rng = random.Random(3)
    run = lambda n: "".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(n))
    for seed in range(4):
        shapes = ((128, secrets.DIMS), (secrets.WIDTH * (secrets.DIMS + 1), secrets.FILTERS), (secrets.FILTERS,), (secrets.FILTERS,), (1,))
        weights = np.random.default_rng(seed)
        net = secrets.Network(*[weights.normal(0, 0.3, s) for s in shapes])
        for sizes in ([20, 300_000, 500, 40], [450 + i % 50 for i in range(512)]):
            items = ["key = \0" + run(n) + " and" for n in sizes]
            alone = [secrets.forward(net, *secrets.encode([x], [n]), 1)[0][0] for x, n in zip(items, sizes)]
            assert np.allclose(secrets.predict(net, items, sizes), alone, rtol=0, atol=1e-9)


def test_threshold_keeps_the_recall_of_held_out_findings(spark):
    rng = random.Random(5)
    held = [rng.uniform(1e-5, 0.4) for _ in range(400)]
    rows = [(i, [(0, 9, True, True, p), (9, 20, True, False, 0.999), (20, 30, False, True, 0.9)]) for i, p in enumerate(held)]
    scored = spark.createDataFrame(rows, "doc_id bigint, scored array<struct<start:int,end:int,labelled:boolean,held:boolean,p:double>>")
    least = secrets.threshold(scored)
    assert sum(p >= least for p in held) >= 0.98 * len(held) and sum(p > least * 1.02 for p in held) < 0.98 * len(held)
    trained = secrets.threshold(scored.withColumn("scored", F.filter("scored", lambda c: ~c["held"])))
    assert trained == 0.999 and secrets.threshold(scored.limit(0)) == 1.0


def test_held_out_surroundings_are_marked_and_not_trained_on(spark):
    rng = random.Random(6)
    rows = [(i, f"{data.prose(rng, 8)} token={rng.getrandbits(128):032x} then {'erationtioning' * 2} end {data.prose(rng, 9)}", "en", "s", 1) for i in range(60)]
    found = secrets.find(spark.createDataFrame(rows, data.SCHEMA))
    flat = found.select(F.explode("found").alias("c")).select("c.*", (F.pmod(F.xxhash64("c.around"), F.lit(5)) == 0).alias("held"))
    want = Counter((r["start"], r["end"], r["labelled"], r["held"]) for r in flat.collect())
    net = secrets.fit(found)
    got = Counter((c["start"], c["end"], c["labelled"], c["held"]) for r in secrets.scores(found, net).collect() for c in r["scored"])
    assert got == want and {k[3] for k in want} == {True, False}
    without = found.withColumn("found", F.filter("found", lambda c: F.pmod(F.xxhash64(c["around"]), F.lit(5)) != 0))
    assert (secrets.fit(without).out == net.out).all() and secrets.fit(found, most_around=10) is None


def test_learned_spans_never_replace_rules(spark):
    rng = random.Random(6)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(32)) for _ in range(80)]
    rows = [(i, f"some {data.prose(rng, 8)} token={h} then {'erationtioning' * 2} end", "en", "s", 1) for i, h in enumerate(hexes)]
    rows += [(500, "credential " + "".join(rng.choice("0123456789ABCDEF") for _ in range(32)), "en", "s", 1)]
    docs = spark.createDataFrame(rows, data.SCHEMA)
    got = {r["doc_id"]: {(s["start"], s["kind"], s["end"]) for s in r["spans"]} for r in secrets.scan(docs).collect()}
    for r in docs.collect():
        assert {s for s in got[r["doc_id"]] if s[1] < 3} == set(plain_secrets(r["text"]))
    redacted = {r["doc_id"]: r for r in secrets.redact(docs).collect()}
    assert len(redacted) == len(rows) and not any(h in redacted[i]["text"] for i, h in enumerate(hexes))
    assert all(r["n_chars"] == len(r["text"]) for i, r in redacted.items() if secrets.MARK in r["text"])


def test_redaction_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, 'password="abcdef123456" here', 28, "a", "b", "c", "d"), (2, "nothing", 7, "a", "b", "c", "d")],
                                 "doc_id bigint, text string, n_chars int, _found string, _text_hash string, found string, `row` string")
    got = {r["doc_id"]: r for r in secrets.redact(docs).collect()}
    assert secrets.redact(docs).columns == docs.columns
    assert "abcdef" not in got[1]["text"] and got[1]["n_chars"] == len(got[1]["text"]) and tuple(got[2])[1:3] == ("nothing", 7)
    assert all(tuple(r)[3:] == ("a", "b", "c", "d") for r in got.values())


# -- segmentations --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    with open(pieces.MODEL, "rb") as f:
        return pieces.Vocabulary(f.read())


def all_paths(text: str, v):
    ids = {v.bytes_of[i].decode(): i for i in range(len(v.bytes_of)) if v.weight[i] < 0}
    out = {}

    def go(at, path, weight):
        if at == len(text):
            out[tuple(path)] = weight
        for end in range(at + 1, len(text) + 1):
            if text[at:end] in ids:
                go(end, [*path, ids[text[at:end]]], weight + v.weight[ids[text[at:end]]])

    go(0, [], 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {k: float(np.exp(w - total)) for k, w in out.items()}


def test_draws_follow_the_weights_without_replacement(vocabulary):
    share = all_paths(" that", vocabulary)
    n = 20_000
    drawn, rest, lat = pieces.sample(["that"] * n, np.arange(n), pieces.Lattices(vocabulary), 3)
    ids = [[tuple(x.tolist()) for x in np.split(flat, border[1:-1])] for flat, border in (pieces.piece_ids(p, lat, vocabulary, n) for p in drawn)]
    first, pairs = Counter(ids[0]), Counter(zip(ids[0], ids[1]))
    top = sorted(share, key=lambda k: -share[k])[:3]
    for a in top:
        assert abs(first[a] / n - share[a]) < 5 * (share[a] / n) ** 0.5 + 1e-3
        for b in top:
            if a != b:
                want = share[a] * share[b] / (1 - share[a])
                assert abs(pairs[a, b] / n - want) < 5 * (want / n) ** 0.5 + 1e-3
    assert all(len({a, b, c}) == 3 for a, b, c in zip(*ids))
    assert all(abs(p - np.log(share[k])) < 1e-9 for k, p in zip(ids[1], drawn[1].logp))
    assert (drawn[0].noisy >= drawn[1].noisy).all() and (drawn[1].noisy >= drawn[2].noisy).all() and (drawn[2].noisy >= rest).all()


def test_inclusion_scores_weigh_to_one(vocabulary):
    n = 20_000
    drawn, rest, _ = pieces.sample(["that"] * n, np.arange(n), pieces.Lattices(vocabulary), 2)
    total = sum(np.exp(p.logp) / -np.expm1(-np.exp(p.logp - rest)) for p in drawn)
    assert abs(total.mean() - 1) < 0.01


def test_round_trip_looks_at_every_sample(vocabulary):
    items = ["that man", "the other one", ""]
    paths, _, lat = pieces.sample(items, np.arange(3), pieces.Lattices(vocabulary), 2)
    ids = [pieces.piece_ids(p, lat, vocabulary, 3) for p in paths]
    drawn = [~np.isnan(p.noisy) for p in paths]
    assert pieces.round_trips(ids, drawn, items, vocabulary) == [True] * 3 and not drawn[1][2]
    flat, border = ids[1]
    flat[border[1]] = flat[border[1] + 1] = vocabulary.byte_ids[65]  # a wrong second sample
    assert pieces.round_trips(ids, drawn, items, vocabulary) == [True, False, True]


def test_lattices_kept_from_slice_to_slice(vocabulary):
    rng = random.Random(8)
    items = [data.prose(rng, 60) + " é\u4e2d" for _ in range(12)]
    keys = np.arange(12)
    whole, rest, lat = pieces.sample(items, keys, pieces.Lattices(vocabulary), 3)
    for most in (0, 400, 1 << 20):
        held = pieces.Lattices(vocabulary, most)
        for i, t in enumerate(items):
            one, last, own = pieces.sample([t], keys[i:i + 1], held, 3)
            for p, q in zip(whole, one):
                flat, border = pieces.piece_ids(p, lat, vocabulary, 12)
                assert flat[border[i]:border[i + 1]].tolist() == pieces.piece_ids(q, own, vocabulary, 1)[0].tolist()
                assert abs(p.logp[i] - q.logp[0]) < 1e-9
            assert abs(rest[i] - last[0]) < 1e-9


def test_lattices_grow_in_place(vocabulary):
    held = pieces.Lattices(vocabulary, 1000)
    first, rows = held.of([" one", " two", " one"])
    source, logp = first.source.copy(), first.logp.copy()
    more, again = held.of([" three", " one"])
    assert rows.tolist() == [0, 1, 0] and again.tolist() == [2, 0] and list(held.numbers) == [" one", " two", " three"]
    assert np.shares_memory(first.logp, more.logp) and (more.source[:len(source)] == source).all() and (more.logp[:len(logp)] == logp).all()
    alone = pieces.lattice([" one", " two", " three"], vocabulary)
    assert all((getattr(alone, name) == getattr(more, name)).all() for name in held.room)


def test_spelled_characters_among_pieces(vocabulary):
    items = ["a\U0001F9FF\u4e2d\uE000b", "\uE000", "that"]
    paths, _, lat = pieces.sample(items, np.arange(3), pieces.Lattices(vocabulary), 1)
    flat, border = pieces.piece_ids(paths[0], lat, vocabulary, 3)
    assert [vocabulary.decode(flat[border[i]:border[i + 1]].tolist()) for i in range(3)] == [" " + x for x in items]


def test_round_trip_of_all_samples(spark, vocabulary):
    docs = data.documents(spark, True)
    texts = Counter((r["doc_id"], r["text"] or "") for r in docs.collect())
    rows = pieces.encode(docs, k=3).collect()
    seen = Counter()
    for r in rows:
        assert len({bytes(s["ids"]) for s in r["samples"]}) == len(r["samples"]) >= 1
        decoded = {vocabulary.decode(np.frombuffer(s["ids"], "<i4").tolist())[1:] for s in r["samples"]}
        assert len(decoded) == 1
        seen[r["doc_id"], decoded.pop()] += 1
    assert seen == texts
    again = {(r["doc_id"], *(bytes(s["ids"]) for s in r["samples"])) for r in pieces.encode(docs.repartition(1), k=3).collect()}
    assert again == {(r["doc_id"], *(bytes(s["ids"]) for s in r["samples"])) for r in rows}
    assert all(r["round_trip"] for r in rows) and pieces.encode(data.empty(spark)).count() == 0
    back = pieces.decode(pieces.encode(docs).selectExpr("doc_id", "samples[0].ids AS ids"), "ids").collect()
    assert Counter((r["doc_id"], r["decoded"]) for r in back) == texts
    assert pieces.digest(pieces.encode(docs)).count() == len(rows)


# -- near-duplicates ------------------------------------------------------------------------------


def brute_components(rows, n, percent):
    sets = []
    for r in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")) if x]
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    label = {r["doc_id"]: r["doc_id"] for r in rows if r["doc_id"] is not None}
    links = [(a["doc_id"], b["doc_id"]) for a, x in zip(rows, sets) for b, y in zip(rows, sets)
             if None not in (a["doc_id"], b["doc_id"]) and x and 100 * len(x & y) >= percent * len(x | y)]
    for _ in rows:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return [(r["doc_id"] is not None, r["doc_id"] or 0, len(s), label.get(r["doc_id"], None) if s else r["doc_id"]) for r, s in zip(rows, sets)]


@pytest.mark.parametrize("extra", [False, True])
def test_near_duplicates(spark, extra):
    docs = data.documents(spark, extra)
    got = minhash.near_duplicates(docs, words=4).collect()
    assert by_id(got, "n_shingles", "component_id") == sorted(brute_components(docs.collect(), 4, 80), key=str)
    assert all(r["kept"] == (r["component_id"] in (None, r["doc_id"])) for r in got)


def test_chains_of_near_copies(spark):
    """Each text links with the next, the ends do not; members fail with their bucket's first centre."""
    rng = random.Random(8)
    base = data.prose(rng, 200).split()
    rows = []
    for i in range(40):
        base = [*base]
        base[(37 * i) % 200] = f"edit{i}"
        rows.append((1000 - i, " ".join(base), "en", "s", 1))
    docs = spark.createDataFrame(rows, data.SCHEMA)
    got = minhash.near_duplicates(docs, words=4).collect()
    assert by_id(got, "n_shingles", "component_id") == sorted(brute_components(docs.collect(), 4, 80), key=str)


def test_exhaustive_pass_alone_gives_the_same(spark, monkeypatch):
    rng = random.Random(8)
    base = data.prose(rng, 150).split()
    rows = [(i, " ".join(w if rng.random() > 0.04 else f"x{i}" for w in base), "en", "s", 1) for i in range(25)]
    docs = spark.createDataFrame(rows, data.SCHEMA)
    want = sorted(brute_components(docs.collect(), 4, 80), key=str)
    for rounds in (0, 1):
        monkeypatch.setattr(minhash, "STAR_ROUNDS", rounds)
        assert by_id(minhash.near_duplicates(docs, words=4).collect(), "n_shingles", "component_id") == want


def test_components_of_paths_and_cycles(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r["node"]: r["label"] for r in minhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100, 102: 100}


def test_one_of_each(spark):
    docs = data.documents(spark, True)
    left = minhash.one_of_each(docs)
    assert left.columns == docs.columns
    ids = Counter(r["doc_id"] for r in left.collect())
    assert ids[None] == 1 and max(ids.values()) == 1 and {7, 8}.isdisjoint(ids) and 3 in ids
    assert minhash.one_of_each(data.empty(spark)).count() == 0


def test_word_hashes_follow_the_words():
    items = ["A b\x0bC", "", "  a  ", " x a b c"]
    hashes, at = words.word_hashes(items)
    names = [w for t in items for w in re.split(r"[\x20\x09-\x0D]+", t.lower()) if w]
    assert at.tolist() == [0, 3, 3, 4, 8] and len(names) == 8
    assert len({(n, h) for n, h in zip(names, hashes.tolist())}) == len(set(names)) == len(set(hashes.tolist()))


# -- decontamination ------------------------------------------------------------------------------


def test_decontamination(spark):
    rng = random.Random(11)
    items = [data.prose(rng, 40) for _ in range(5)] + ["two words", "", None]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").withColumn("doc_id", F.lit("clash"))
    swap = items[1].split()
    for i in (4, 11, 18, 27, 33):
        swap[i] = "other"
    texts = [data.prose(rng, 300), data.prose(rng, 50) + " " + "".join(c.upper() if c < "\x80" else c for c in items[0]) + " " + data.prose(rng, 50), data.prose(rng, 20) + "; " + " ".join(swap),
             " ".join(items[2].split()[:9]), items[3], "", None, "two words"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, items[0])], "doc_id bigint, text string").withColumn("item_id", F.lit(1))
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.overlaps(docs, bench).collect()}
    assert set(found) == {(1, 0), (2, 1), (4, 3), (7, 5), (None, 0)}
    assert found[1, 0]["agree"] == 20 and found[2, 1]["agree"] >= 16
    assert sorted(str(r["doc_id"]) for r in decontaminate.clean(docs, bench).collect()) == sorted(["0", "3", "5", "6", "None"])
    assert decontaminate.overlaps(docs, bench.limit(0)).count() == 0 and decontaminate.overlaps(docs.limit(0), bench).count() == 0


def test_masks_cover_all_placements_of_substitutions():
    import itertools
    import math

    for n in range(1, decontaminate.SPAN + 1):
        placed = [sum(1 << (i + o) for i, c in enumerate(m) if c == "1") for m in decontaminate.masks_of(n) for o in range(n - len(m) + 1)]
        for changed in itertools.combinations(range(n), n - math.ceil(decontaminate.AGREE * n)):
            assert any(not p & sum(1 << i for i in changed) for p in placed), (n, changed)
    assert all(m[0] == m[-1] == "1" for m in decontaminate.ALL) and len(decontaminate.ALL) < 64


def test_short_items_match_whole_documents_only(spark):
    bench = spark.createDataFrame([(0, "One"), (1, "two, words"), (2, "three short words")], "item_id bigint, text string")
    texts = ["one", " ONE! ", "one one", "one word", "Two words", "words two", "two words more", "a three short words b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(docs, bench).collect()} == {(0, 0), (1, 0), (4, 1), (7, 2)}
    with pytest.raises(ValueError):
        decontaminate.overlaps(docs, bench, span=21)
    with pytest.raises(ValueError):
        decontaminate.overlaps(docs, bench, agree=0.7)


def test_very_long_items_and_documents(spark):
    rng = random.Random(13)
    item = data.prose(rng, 20_000).split()
    far = data.prose(rng, 25_000).split()
    docs = [" ".join(far[:12_000] + item[9_000:9_030] + far[12_000:]), " ".join(far), " ".join(item), " ".join(item[-15:])]
    bench = spark.createDataFrame([(0, " ".join(item)), (1, data.prose(rng, 40))], "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]): r["agree"] for r in decontaminate.overlaps(spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string"), bench).collect()}
    assert found == {(0, 0): 20, (2, 0): 20}


def test_random_texts_against_brute_force(spark):
    """Few different words, so that there are chance overlaps of all degrees."""
    rng = random.Random(14)
    some = lambda n: [rng.choice("abcd") for _ in range(n)]
    items = [some(n) for n in (1, 2, 3, 4, 5, 7, 9, 12, 14, 17, 20, 22, 30)]
    docs = [some(rng.randint(0, 60)) for _ in range(60)] + [items[0], items[1]]
    for item in items[2:]:
        for _ in range(8):
            swapped = [rng.choice("abcd") if rng.random() < 0.15 else c for c in item]
            docs.append(some(rng.randint(0, 30)) + swapped + some(rng.randint(0, 30)))
    want = {}
    for d, doc in enumerate(docs):
        for i, item in enumerate(items):
            n = min(20, len(item))
            if len(item) < 3:
                best = n if doc == item else 0
            else:
                best = max((sum(0 <= a + s + x < len(doc) and doc[a + s + x] == item[a + x] for x in range(n))
                            for a in range(len(item) - n + 1) for s in range(-a - n + 1, len(doc) - a)), default=0)
            if best and best >= 0.8 * n:
                want[d, i] = best
    frame = lambda rows, name: spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], f"{name} bigint, text string")
    found = {(r["doc_id"], r["item_id"]): r["agree"] for r in decontaminate.overlaps(frame(docs, "doc_id"), frame(items, "item_id")).collect()}
    assert found == want and len(want) > 100


def test_the_bit_map_grows_with_the_benchmark():
    assert [decontaminate.slot_bits(n) for n in (0, 1000, 1 << 18, 1 << 20, 1 << 24, 1 << 40)] == [22, 22, 23, 25, 28, 28]


def test_substitutions_in_items_of_all_lengths(spark):
    """The worst placements for seeds without gaps, others at random, items cut by the document's end, and one substitution too many."""
    import math

    rng = random.Random(7)
    items, rows, want = [], [], set()
    for n in [*range(decontaminate.LEAST, 21), 45]:
        item = [f"w{n}x{i}" for i in range(n)]
        items.append((n, " ".join(item)))
        start, m = (11, 20) if n == 45 else (0, n)
        most = m - math.ceil(0.8 * m)
        even = [start + (i + 1) * m // (most + 1) for i in range(most)]
        for changed in [even, *[rng.sample(range(start, start + m), most) for _ in range(6)], [*range(start + m - most, start + m)], [*range(start, start + most + 1)]]:
            text = [x if i not in changed and start <= i < start + m else f"other{rng.getrandbits(40)}" for i, x in enumerate(item)]
            if len(changed) <= most:
                want.add((len(rows), n))
            if changed == [*range(start + m - most, start + m)]:
                rows.append((len(rows), " ".join(["before"] * 3 + text[start:start + m - most])))  # the document ends inside the stretch
            else:
                rows.append((len(rows), data.prose(rng, 5) + ". " + " ".join(text) + ", " + data.prose(rng, 5)))
    docs, bench = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(docs, bench).collect()} == want


def test_agreement_by_hand():
    doc, item = np.arange(50, dtype=np.uint64), np.arange(10, 40, dtype=np.uint64)
    item[3] = item[12] = 999
    assert decontaminate.agreement(doc, item, 10, 20) == (19, 20)
    assert decontaminate.agreement(doc, item[:5], 10, 20) == (4, 5)
    assert decontaminate.agreement(doc, item, 45, 20) == (0, 20)


# -- token counts ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def counter():
    with open(token_tree.VOCABULARY, "rb") as f:
        return token_tree.Counter(f.read())


def test_edits_keep_the_count(counter):
    rng = random.Random(1)
    parts = ["a", "b", "foo", " ", "  ", "\n", "'", "'s", "re", "1", "23", "!", "é", "\t", "?!", " the"]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 20, 200, 900])))
        tree = token_tree.build(text, counter)
        for _ in range(4):
            a = rng.randint(0, len(text))
            b = min(len(text), a + rng.choice([0, 0, 1, 5, 50]))
            text, _ = token_tree.edit(text, tree, a, b, "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 2, 10, 80]))), counter)
            assert tree.tokens[1] == len(counter.encoding.encode_ordinary(text)) and tree.chars[1] == len(text)


def test_an_edit_reads_little(counter):
    text = data.prose(random.Random(3), 20_000)
    tree = token_tree.build(text, counter)
    _, read = token_tree.edit(text, tree, 50_000, 50_010, "new words here", counter)
    assert read < 400


def test_counts_on_the_cluster(spark, counter):
    docs = data.documents(spark, True)
    before = token_tree.trees(token_tree.sample_edits(docs)).withColumn("n_tokens", token_tree.n_tokens())
    assert all(r["n_tokens"] == len(counter.encoding.encode_ordinary(r["text"] or "")) for r in before.collect())
    for r in token_tree.updated(before).withColumn("n", token_tree.n_tokens()).collect():
        assert r["n"] == len(counter.encoding.encode_ordinary(r["text"])) and r["text"].endswith(" [end]")
    assert token_tree.counted(docs).count() == docs.count() and token_tree.counted(data.empty(spark)).count() == 0


def test_odd_edits(spark):
    rows = [(1, "hello world again", [(3, 8, "XY"), (5, 12, None), (-4, 2, ">"), (90, 99, "<"), None]), (2, None, None), (3, "abc", [(2, 1, "-")])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, edits array<struct<start:int,end:int,text:string>>")
    got = {r["doc_id"]: r["text"] for r in token_tree.updated(token_tree.trees(df)).collect()}
    # the second edit starts inside the first and so at its end
    assert got == {1: ">lXYagain<", 2: "", 3: "ab-c"}


# -- toxicity -------------------------------------------------------------------------------------


def test_toxicity_learns_only_from_training_rows(spark):
    import zlib

    rng = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        bad = i % 3 == 0
        text = data.prose(rng, rng.randint(20, 60))
        rows.append((i, text + (" you vile troll " if bad else " kind words ") + data.prose(rng, 10), "en", "s", 1))
        held = zlib.crc32(str(i).encode()) % 5 == 0
        labels.append((i, 1, int(bad) if not held else 1 - int(bad)))  # wrong where they must not be read
    docs = spark.createDataFrame(rows, data.SCHEMA)
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity(docs, table).collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id bigint, toxic int")
    docs = data.documents(spark, True)
    assert toxicity.toxicity(docs, none).count() == docs.count()
    assert toxicity.toxicity(data.empty(spark), none).count() == 0


@pytest.mark.parametrize("rows", [[], [(1, None), (None, 1), (2, 7)], [(i, 1) for i in range(20)], [(i, 0) for i in range(20)], [(0, 0), (1, 0), (6, 1), (1001, 1)]])
def test_nothing_is_toxic_without_two_classes_to_learn_from(spark, rows):
    """No labels, unusable ones, one class only, and toxic labels only of documents that are held out (6) or missing (1001)."""
    docs = data.documents(spark, True)
    left = toxicity.clean(docs, spark.createDataFrame(rows, "doc_id bigint, toxic int"))
    assert left.columns == docs.columns and Counter(r["doc_id"] for r in left.collect()) == Counter(r["doc_id"] for r in docs.collect())


def test_gram_sets_by_hand():
    assert len(toxicity.gram_sets(["ab"])[0]) == 3  # " ab", "ab ", " ab "
    together, alone = toxicity.gram_sets(["ab", "", "Abc d"]), [toxicity.gram_sets([t])[0] for t in ("ab", "", "aBc d")]
    assert all((a == b).all() for a, b in zip(together, alone))


def test_scores_against_plain_python(spark):
    """The grams, their log-count ratios and the score of each text, computed one by one."""
    rng = random.Random(21)
    rows = [(i, data.prose(rng, 12) + (" vile troll" if i % 3 == 0 else " kind words"), "en", "s", 1) for i in range(90)]
    docs = spark.createDataFrame(rows, data.SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)], "doc_id bigint, quality int, toxic int")
    bits, mask = toxicity.BITS, 0xFFFFFFFF

    def grams(text):
        padded, out = f" {text.lower()} ", set()
        for start in range(len(padded)):
            h = 0
            for n, c in enumerate(padded[start:start + 5], 1):
                h = ((h ^ ord(c)) * 0x9E3779B1) & mask
                h ^= h >> 15
                if n >= 3:
                    out.add(((h * 0x85EBCA6B) & mask) >> (32 - bits))
        return out

    import zlib

    train = [(grams(r[1]), int(r[0] % 3 == 0)) for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    counts = [Counter(g for s, y in train if y == label for g in s) for label in (0, 1)]
    n = [sum(y == label for _, y in train) for label in (0, 1)]
    model = toxicity.fit(docs, labels)
    for g in list(counts[0] | counts[1])[:300]:
        want = np.log((counts[1][g] + 1) / (n[1] + 2)) - np.log((counts[0][g] + 1) / (n[0] + 2))
        assert abs(model.ratio[g] - want) < 1e-5
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()}
    for i, text, *_ in rows:
        found = grams(text)
        length = sum(float(model.ratio[g]) ** 2 for g in found) ** 0.5
        want = 1 / (1 + np.exp(-(sum(float(model.weights[g]) for g in found) / length + model.intercept)))
        assert abs(got[i] - want) < 1e-5
    assert all((got[i] >= 0.5) == (i % 3 == 0) for i in range(90))
