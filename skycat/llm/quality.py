"""Quality rules: repetition and length counts, and the divergence of a text from its language.

Only DataFrame functions are used.  The counts of a text stay in its row: no text is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# Common words of each language.
COMMON = {
    "en": "the of and to in a is that for it was on are as with be by at from or an this which not".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas sur au avec ce il".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más".split(),
}
LISTED = list(dict.fromkeys(w for words in COMMON.values() for w in words))

SPACE = r"[\x20\x09-\x0D]+"
# the largest mean of the two Jensen-Shannon distances that passes, and the shortest text that is judged by them
MOST_DISTANT = 0.28
MIN_CHARS = 200
MIN_WORDS = 50


def _size(c: Column) -> Column:
    return F.size(c).cast("long")


def _without(t: Column, chars: str) -> Column:
    """Number of characters that are left of ``t`` without those of the class ``chars``."""
    return F.char_length(F.regexp_replace(t, f"[{chars}]+", "")).cast("long")


def _sum(c: Column) -> Column:
    return F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of a row's counts: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, classes, common.

    ``classes`` counts lower-case letters and marks without case, upper-case letters, digits, white space
    and other characters; ``common`` counts the words of ``LISTED``.  A null text is the empty text.
    """
    t, w, x, s, d, r = (F.col(c) for c in ("_t", "_w", "_x", "_s", "_d", "_r"))
    rows = docs.select("doc_id", "lang", F.coalesce(text, F.lit("")).alias("_t"))
    rows = rows.withColumn("_w", F.array_remove(F.split(t, SPACE), ""))
    # every word is hashed once, and the hashes of neighbours make those of the three-word windows; only a text in which
    # one repeats has them sorted, so that equal windows are neighbours
    rows = rows.withColumn("_x", F.transform(w, lambda v: F.xxhash64(v)))
    window = lambda i: F.xxhash64(F.get(x, i), F.get(x, i + 1), F.get(x, i + 2))
    rows = rows.withColumn("_h", F.when(F.size(x) >= 3, F.transform(F.sequence(F.lit(0), F.size(x) - 3), window))
                           .otherwise(F.array().cast("array<bigint>")))
    placed = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), placed)
                           .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    twin = lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])
    lines = F.filter(F.split(t, "\n"), lambda x: F.trim(x, F.lit(" \t\n\x0b\f\r")) != "")
    listed = F.filter(w, lambda x: x.isin(LISTED))
    rows = rows.select(
        "doc_id", "lang", "_t", "_w",
        F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"])).alias("_d"),
        lines.alias("_l"),
        F.concat(F.lit(" "), F.array_join(listed, "  "), F.lit(" ")).alias("_c"),
        F.array_join(w, "").alias("_j"))
    # most characters are lower-case letters and white space; the other classes are counted in what is left
    rows = rows.withColumn("_r", F.regexp_replace("_j", "[a-z]+", ""))
    covered = F.transform(d, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(d, j + 1) - p, F.lit(3))).cast("long"))
    n, inside, left = (F.char_length(c).cast("long") for c in (t, F.col("_j"), r))
    digits, upper, other = left - _without(r, "0-9"), _without(r, r"^\p{Lu}"), _without(r, r"\p{L}\p{M}0-9")
    return rows.select(
        "doc_id", "lang", n.alias("n_chars"), _size(w).alias("n_words"), inside.alias("word_chars"),
        (left - _without(r, "#*$%&|<>")).alias("n_symbols"),
        (_size(F.col("_l")) - _size(F.array_distinct("_l"))).alias("n_dup_lines"),
        _sum(covered).alias("n_repeat_words"),
        F.array(inside - upper - digits - other, upper, digits, n - inside, other).alias("classes"),
        F.array(*[F.floor((F.length("_c") - F.length(F.replace(F.col("_c"), F.lit(f" {x} "), F.lit("")))) / (len(x) + 2)).cast("long")
                  for x in LISTED]).alias("common"))


def references(counted: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Shares of the character classes and of the common words (the last share: all other words) per language, over all its rows.

    One row for each language of ``COMMON`` comes to the driver, whatever the number of documents.
    """
    sums = [F.sum(F.get("classes", F.lit(i))).alias(f"k{i}") for i in range(5)]
    sums += [F.sum(F.get("common", F.lit(i))).alias(f"c{i}") for i in range(len(LISTED))]
    out = {}
    for r in counted.filter(F.col("lang").isin(list(COMMON))).groupBy("lang").agg(F.sum("n_words").alias("n"), *sums).collect():
        classes, common = [r[f"k{i}"] for i in range(5)], [r[f"c{i}"] for i in range(len(LISTED))]
        if r["n"] and sum(classes):
            out[r["lang"]] = [x / sum(classes) for x in classes], [x / r["n"] for x in [*common, max(0, r["n"] - sum(common))]]
    return out


def js_distance(p: Column, q: list[float]) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of an array of shares from fixed shares."""
    part = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
    both = F.zip_with(p, F.array(*[F.lit(float(x)) for x in q]), lambda a, b: part(a, b) + part(b, a))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(both, F.lit(0.0), lambda a, x: a + x) / 2))


def quality(docs: DataFrame, most_distant: float = MOST_DISTANT, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang; other columns are left out): the counts, base_failed, distance, language, kept.

    A text fails the base rules with fewer than ``min_words`` words or if more than half of its words
    stand in repeated three-word windows.  ``distance`` is the smallest, over the language references,
    of the mean of two Jensen-Shannon distances (character classes, common words), 0 without a
    reference.  Texts of at least ``min_chars`` characters that are further than ``most_distant`` from
    every language are not kept.  Only the languages of ``COMMON`` (en, de, fr, es) have references: the distance does not
    reject a row of another language, which the base rules alone judge.  A row whose language is null or one of
    the four is judged by the nearest of them, whichever it names.  Null and empty texts fail the base rules; repeated
    rows give repeated results; an empty table gives an empty one.
    """
    counted = written(counts(docs))
    refs = references(counted)
    share = lambda c, n: F.transform(c, lambda x: x / F.greatest(n, F.lit(1)).cast("double"))
    rest = F.greatest(F.lit(0).cast("long"), F.col("n_words") - _sum(F.col("common")))
    rows = counted.withColumn("_k", share(F.col("classes"), F.col("n_chars"))) \
        .withColumn("_m", share(F.concat("common", F.array(rest)), F.col("n_words")))
    near = [F.struct(((js_distance(F.col("_k"), k) + js_distance(F.col("_m"), m)) / 2).alias("distance"), F.lit(lang).alias("language"))
            for lang, (k, m) in sorted(refs.items())]
    nothing = F.struct(F.lit(0.0).alias("distance"), F.lit(None).cast("string").alias("language"))
    rows = rows.withColumn("_n", reduce(lambda a, b: F.when(b["distance"] < a["distance"], b).otherwise(a), near) if near else nothing)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    known = F.coalesce(F.col("lang").isin(list(COMMON)), F.lit(True))
    distant = known & (F.col("n_chars") >= min_chars) & (F.col("_n.distance") > most_distant)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                       (~failed & ~distant).alias("kept"), F.col("_n.distance").alias("distance"), F.col("_n.language").alias("language"))
