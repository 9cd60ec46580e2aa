"""Personal data, quality rules and the archive against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

from skycat.llm import pii, quality, warc
from tests.llm import data

EMPTY = hashlib.sha256(b"").hexdigest()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text: str) -> list[tuple[int, int, int]]:
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_rules_find_what_plain_patterns_find(spark):
    for extra in (False, True):
        docs = data.documents(spark, extra)
        got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["base_sha256"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in pii.digest(pii.scan(docs)).collect())
        want = []
        for r in docs.collect():
            found = base(r["text"] or "")
            text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in found)
            n = Counter(k for _, k, _ in found)
            want.append((r["doc_id"] is None, r["doc_id"] or 0, hashlib.sha256(text.encode()).hexdigest(), n[0], n[1], n[2], n[3]))
        assert got == sorted(want)


def test_empty_table_of_documents(spark):
    assert pii.digest(pii.scan(data.empty(spark))).count() == 0
    assert quality.quality(data.empty(spark)).count() == 0


def test_trees_learn_and_add_spans(spark):
    rows = [(i, f"write to user{i}@host{i}.example.org or ref {i}12-{i}4455 {i}99 now", "en", "s", 1) for i in range(60)]
    rows += [(100 + i, f"call +1 555 {100 + i} 4567 today, serial {1000000 + 7 * i} x", "en", "s", 1) for i in range(60)]
    docs = spark.createDataFrame(rows, data.SCHEMA)
    found = pii.find(docs)
    model = pii.fit(found)
    assert model is not None
    # the expression is the model's own probability
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.sql import functions as F

    flat = found.select(F.explode("found").alias("c")).select("c.*")
    both = model.transform(flat.withColumn("a", F.col("features")).withColumn("features", array_to_vector("features")))
    rows = both.select(vector_to_array("probability")[1].alias("p"), pii.probability(model, F.col("a")).alias("q")).collect()
    assert rows and all(abs(r["p"] - r["q"]) < 1e-9 for r in rows)
    kept = {(r["doc_id"], s["kind"], s["start"], s["end"]) for r in pii.scan(docs).collect() for s in r["spans"]}
    for r in docs.collect():
        assert {(r["doc_id"], k, a, b) for a, k, b in base(r["text"])} <= kept


def counts(text: str):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    again = {j for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(again), failed


def test_quality_counts(spark):
    for extra in (False, True):
        docs = data.documents(spark, extra)
        got = quality.quality(docs).collect()
        want = sorted((r["doc_id"] is None, r["doc_id"] or 0, *counts(r["text"] or "")) for r in docs.collect())
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == want
        assert not any(r["kept"] for r in got if r["base_failed"])


def test_distance_is_zero_for_the_same_shares_and_one_for_others(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(quality.js_distance(F.array(F.lit(0.25), F.lit(0.75)), [0.25, 0.75]).alias("same"),
                                quality.js_distance(F.array(F.lit(1.0), F.lit(0.0)), [0.0, 1.0]).alias("other")).first()
    assert row["same"] < 1e-9 and abs(row["other"] - 1) < 1e-9


def test_distant_text_is_not_kept(spark):
    text = "the of and to in a is that for it was on are as with be by at from or " * 3
    varied = [text + " ".join(f"w{chr(97 + i % 26)}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(60)) for i in range(20)]
    shout = " ".join(f"Q{j}Z!!##" for j in range(120))
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate([*varied, shout])], data.SCHEMA)
    assert {r["doc_id"]: r["kept"] for r in quality.quality(docs, most_distant=0.5).collect()}[20] is False


def archive(spark, tmp_path, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, header string")
    path = str(tmp_path / f"a{len(rows)}")
    warc.write_archive(warc.page_records(pages), path)
    return path


def test_archive_gives_back_every_record(spark, tmp_path):
    big, other = "é" * 600, "b" * 1000
    rows = [(1, "http://a", big, "h"), (2, "http://b\r\nX: y", big, "h"), (3, None, other, "h"), (4, "u", "small", "h"), (5, "u", "small", "h"),
            (6, "u", None, "h"), (7, "u", "", "h"), (None, "u", other, "h"), (9, "u", big, "h"), (9, "u", big, "h")]
    path = archive(spark, tmp_path, rows)
    back = warc.read_archive(spark, path).collect()
    assert len(back) == len(rows)
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h, _ in rows})
    by = sorted(((r["record_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in back), key=str)
    sha = lambda s: hashlib.sha1((s or "").encode()).hexdigest()
    kind = {1: ("revisit", 9), 2: ("revisit", 9), 0: ("revisit", 3)}
    assert by == sorted(((i or 0, *kind.get(i or 0, ("response", None)), len((h or "").encode()), sha(h)) for i, _, h, _ in rows), key=str)
    for r in back:
        record, head = bytes(r["record"]), bytes(r["header"])
        assert record.startswith(head) and head.endswith(b"\r\n\r\n") and head.count(b"\r\n\r\n") == 1
        body = b"" if r["record_type"] == "revisit" else bytes(r["payload"])
        assert record == head + body + b"\r\n\r\n" and f"Content-Length: {len(body)}\r\n".encode() in head
        assert r["header_digest"] == r["payload_digest"] and b"\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n" in head


def test_another_digest_in_a_header_is_noticed(spark, tmp_path):
    import pytest
    from pyspark.sql import functions as F

    path = archive(spark, tmp_path, [(1, "u", "x" * 2000, "h"), (2, "u", "y" * 2000, "h")])
    spark.read.parquet(f"{path}/payloads").write.parquet(f"{tmp_path}/c/payloads")
    wrong = F.encode(F.regexp_replace(F.decode("header", "UTF-8"), "sha1:.", "sha1:z"), "UTF-8")
    spark.read.parquet(f"{path}/headers").withColumn("header", F.when(F.decode("header", "UTF-8").contains("urn:page:2"), wrong).otherwise(F.col("header"))).write.parquet(f"{tmp_path}/c/headers")
    with pytest.raises(Exception, match="record 2 has another digest"):
        warc.read_archive(spark, f"{tmp_path}/c").select("record").collect()


def test_damaged_payload_is_noticed(spark, tmp_path):
    import pytest
    from pyspark.sql import functions as F

    path = archive(spark, tmp_path, [(1, "u", "x" * 2000, "h")])
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"y"))
    bad.write.parquet(f"{tmp_path}/b/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{tmp_path}/b/headers")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(spark, f"{tmp_path}/b").select("payload_bytes").collect()


def test_empty_archive(spark, tmp_path):
    assert warc.read_archive(spark, archive(spark, tmp_path, [])).count() == 0
