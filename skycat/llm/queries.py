"""The registered queries: each applies one operator to its whole table; ORACLES has the SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, hard_negatives, minhash, pieces, pii, quality, secrets, substring_dedup, suffix_dedup, token_tree, toxicity, warc, whitening
from .common import new_folder, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


# every window of 200 bytes as its hexadecimal digits, counted over the whole table
@_query("op1_suffix_dedup", """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS body FROM documents),
h AS (SELECT r, doc_id, lower(hex(body)) AS x, octet_length(body) AS n FROM d),
w AS (SELECT r, i, md5(substr(x, 2 * i + 1, 400)) AS k FROM (SELECT r, x, unnest(range(0, n - 199)) AS i FROM h WHERE n >= 200)),
s AS (SELECT r, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
g AS (SELECT r, i, sum(CASE WHEN i > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS span
      FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM s)),
c AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM g GROUP BY r, span),
p AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS kept_from FROM c),
k AS (SELECT p.r, sum(b - a) AS gone, count(*) AS spans, max(b) AS last,
      string_agg(substr(x, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a) AS head FROM p JOIN h ON h.r = p.r GROUP BY p.r)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM h LEFT JOIN k ON k.r = h.r""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(read(spark, sf_dir, "documents"), keep_texts=False).drop("kept")


@_query("op2_pii")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.scan(read(spark, sf_dir, "documents")))


@_query("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(read(spark, sf_dir, "documents")))


@_query("op4_sentencepiece")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(pieces.encode(read(spark, sf_dir, "documents")))


@_query("op5_minhash_near_dedup", r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 4 THEN [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]
                                            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
    e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    r(doc_id, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, p.b FROM r JOIN p ON r.reached = p.a)
    SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.reached) AS component_id, s.doc_id = min(r.reached) AS kept
    FROM s JOIN r ON r.doc_id = s.doc_id GROUP BY s.doc_id, len(s.s)""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), words=4)


@_query("op6_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@_query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_tree.counted(read(spark, sf_dir, "documents"))


@_query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def _quality_sql() -> str:
    langs, listed = (", ".join(f"'{x}'" for x in xs) for xs in (quality.COMMON, quality.LISTED))
    listed = f"[{listed}]"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, lang, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM d),
x AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
y AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS times FROM x),
z AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM y WHERE times > 1) GROUP BY r),
l AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
c AS (SELECT w.r, doc_id, lang, coalesce(lang IN ({langs}), true) AS known, w, length(t) AS n, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
      length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines, coalesce(z.n, 0) AS n_repeat_words,
      length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) AS upper, length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) AS digits,
      length(regexp_replace(t, '[\\p{{L}}\\p{{M}}0-9\\x20\\x09-\\x0D]', '', 'g')) AS other FROM w LEFT JOIN z ON z.r = w.r LEFT JOIN l ON l.r = w.r),
k AS (SELECT r, lang, n, n_words, unnest([n - upper - digits - (n - word_chars) - other, upper, digits, n - word_chars, other]) AS v, unnest(range(0, 5)) AS bin FROM c),
m AS (SELECT r, word, count(*) AS v FROM (SELECT r, unnest(w) AS word FROM c) WHERE list_contains({listed}, word) GROUP BY r, word),
q AS (SELECT r, word, v FROM m UNION ALL SELECT c.r, '', greatest(0, n_words - coalesce(s, 0)) FROM c LEFT JOIN (SELECT r, sum(v) AS s FROM m GROUP BY r) o ON o.r = c.r),
rk AS (SELECT lang, bin, sum(v) / sum(sum(v)) OVER (PARTITION BY lang) AS share FROM k WHERE lang IN ({langs}) GROUP BY lang, bin),
rs AS (SELECT lang, word, sum(v) AS v FROM q JOIN c ON c.r = q.r WHERE lang IN ({langs}) GROUP BY lang, word),
rw AS (SELECT g.lang, g.word, coalesce(rs.v, 0) / (SELECT sum(v) FROM rs AS o WHERE o.lang = g.lang) AS share
       FROM (SELECT * FROM (SELECT DISTINCT lang FROM rs), (SELECT DISTINCT word FROM q)) g LEFT JOIN rs ON rs.lang = g.lang AND rs.word = g.word),
jk AS (SELECT k.r, rk.lang, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + share)) ELSE 0 END + CASE WHEN share > 0 THEN share * log2(2 * share / (p + share)) ELSE 0 END) / 2 AS d
       FROM (SELECT r, bin, v / CAST(greatest(n, 1) AS DOUBLE) AS p FROM k) k JOIN rk ON rk.bin = k.bin GROUP BY k.r, rk.lang),
-- a reference word that a text has not adds half its share
jw AS (SELECT a.r, a.lang, (a.d + b.total - a.seen) / 2 AS d FROM
        (SELECT q.r, rw.lang, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + share)) ELSE 0 END + CASE WHEN share > 0 THEN share * log2(2 * share / (p + share)) ELSE 0 END) AS d, sum(share) AS seen
         FROM (SELECT q.r, word, v / CAST(greatest(n_words, 1) AS DOUBLE) AS p FROM q JOIN c ON c.r = q.r) q JOIN (SELECT lang, word, share FROM rw) rw ON rw.word = q.word GROUP BY q.r, rw.lang) a
        JOIN (SELECT lang, sum(share) AS total FROM rw GROUP BY lang) b ON b.lang = a.lang),
dist AS (SELECT jk.r, min((sqrt(greatest(0, jk.d)) + sqrt(greatest(0, jw.d))) / 2) AS d FROM jk JOIN jw ON jw.r = jk.r AND jw.lang = jk.lang GROUP BY jk.r)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (known AND n >= {quality.MIN_CHARS} AND coalesce(d, 0) > {quality.MOST_DISTANT}) AS kept
FROM c LEFT JOIN dist ON dist.r = c.r"""


@_query("op9_quality_rules", _quality_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents")).drop("distance", "language")


@_query("op10_warc_archive", r"""
    WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, encode(coalesce(html, '')) AS body FROM pages),
    h AS (SELECT page_id, url, html, octet_length(body) AS n, sha1(body) AS d, sha256(body) AS k FROM p),
    w AS (SELECT *, max(page_id) OVER (PARTITION BY k, n) AS holder FROM h),
    r AS (SELECT *, n >= 1000 AND holder <> page_id AS again FROM w),
    t AS (SELECT *, concat('WARC/1.1', e, 'WARC-Type: ', CASE WHEN again THEN 'revisit' ELSE 'response' END, e, 'WARC-Record-ID: <urn:page:', page_id, '>', e,
            'WARC-Date: 1970-01-01T00:00:00Z', e, 'WARC-Target-URI: ', regexp_replace(url, '[[:cntrl:]]', ' ', 'g'), e, 'WARC-Payload-Digest: sha1:', d, e,
            CASE WHEN again THEN concat('WARC-Refers-To: <urn:page:', holder, '>', e, 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest', e) ELSE '' END,
            'Content-Type: text/html; charset=utf-8', e, 'Content-Length: ', CASE WHEN again THEN 0 ELSE n END, e, e, CASE WHEN again THEN '' ELSE html END, e, e) AS record
          FROM r, (SELECT chr(13) || chr(10) AS e))
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN again THEN holder END AS refers_to, sha256(record) AS record_sha256
    FROM t""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    warc.write_archive(warc.page_records(read(spark, sf_dir, "pages")), folder)
    back = warc.read_archive(spark, folder)
    return back.selectExpr("record_id AS page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "sha2(record, 256) AS record_sha256")


# eigenvectors: not in SQL
@_query("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(read(spark, sf_dir, "embeddings"))


@_query("op12_substring_dedup", r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    k AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, unnest([md5(array_to_string(w[i:i + 34], ' ')) FOR i IN range(1, len(w) - 33)]) AS k FROM d WHERE len(w) >= 35),
    s AS (SELECT r, i FROM k WHERE k IN (SELECT k FROM k GROUP BY k HAVING count(*) > 1)),
    g AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS j FROM s),
    x AS (SELECT r, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS word FROM d),
    t AS (SELECT x.r, string_agg(word, ' ' ORDER BY x.j) FILTER (WHERE g.j IS NULL) AS kept, count(g.j) AS gone FROM x LEFT JOIN g ON g.r = x.r AND g.j = x.j GROUP BY x.r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN t ON t.r = d.r""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(read(spark, sf_dir, "documents"), keep_texts=False).drop("kept")


@_query("op13_hard_negatives", """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(c AS DOUBLE)) FOR c IN embedding] AS x
               FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                 AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
    s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
    n AS (SELECT p.a, p.b AS positive, p.score AS top, s.b AS negative, s.score, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS r
          FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
    SELECT a AS anchor_id, positive AS positive_id, CAST(r AS INTEGER) AS rank, negative AS negative_id, top AS positive_score, score AS negative_score FROM n WHERE r <= 3""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.prepared(read(spark, sf_dir, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(rows, rows.filter("vec_id % 50 = 0"))
