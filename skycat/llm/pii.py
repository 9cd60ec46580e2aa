"""Personal data: fixed rules, and boosted trees that judge the spans of wider generators.

Only DataFrame functions and the trees of ``pyspark.ml`` are used.  The rules and the generators run over the
texts once; what they find is written to the shared folder.  The trees learn on a bounded sample
of the candidates (one that overlaps a rule's match is a labelled finding) and are then evaluated as a
plain expression inside each row, so nothing but the sample and a histogram is shuffled.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans
from .common import written

KINDS = ["email", "ip", "card", "phone", "learned"]

# The rules' patterns.  Possessive repeats and looks behind keep them linear on long runs and change no match:
# what a repeat gives up could not match what follows, and a start inside a run fails where the run's start failed.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# The generators: wider than the rules, and free to overlap.
GENERATORS = [
    r"[^\x20\x09-\x0D@<>]{1,64}+@[^\x20\x09-\x0D@<>]{1,255}+",
    r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,64}+\x20?[\[(]?(?:at|@)[\])]?\x20?[A-Za-z0-9-]{2,64}+\x20?[\[(]?(?:dot|\.)[\])]?\x20?[A-Za-z]{2,10}+",
    r"(?<![0-9])[+(]?[0-9](?:[\x20()./-]{0,2}+[0-9]){6,}+",
    r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{0,4}+){3,7}+",
    r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}",
    r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}+",
]
# which characters a text needs for a generator to find anything
NEEDS = ["@", r"@|\b(?:at|dot)\b", "[0-9]", ":", "[0-9]", "[0-9]"]
CONTEXTS = [r"mail|contact|write to|@", r"tel|phone|call|fax|mobil", r"card|visa|account|iban|pay|konto|cuenta|carte", r"\bip\b|host|server|addr|login"]
FEATURES = ["generator", "length", "digits", "letters", "separators", "dots", "luhn", "plus", "joined_left", "joined_right", "mail", "tel", "card", "net"]

CONTEXT = 32
SAMPLE_PER_CLASS = 2000
TREES = 12
DEPTH = 3
PRECISION = 0.9
BINS = 100

NO_SPANS = "array<struct<start:int,end:int,text:string>>"


def located(t: Column, pattern: str, needs: str) -> Column:
    """start, end (code points) and text of the leftmost non-overlapping matches: the lengths of the matches and of what lies between."""
    found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(t, pattern, -1), F.lit(1), F.size(found))
    pairs = F.zip_with(between, found, lambda gap, text: F.struct(F.length(gap).alias("gap"), F.length(text).alias("n"), text.alias("text")))

    def add(acc, x):
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), (start + x["n"]).alias("end"), x["text"].alias("text"))
        return F.struct((start + x["n"]).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    empty = F.array().cast(NO_SPANS)
    total = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")), add, lambda acc: acc["out"])
    return F.when(t.rlike(needs), total).otherwise(empty)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Whether a string of at most 19 digits passes Luhn's check; longer and empty ones do not."""
    back = F.reverse(digits)
    digit = lambda i: F.substring(back, i + 1, F.lit(1)).cast("int")
    part = lambda i: F.when(i % 2 == 0, digit(i)).otherwise(2 * digit(i) - F.when(digit(i) > 4, 9).otherwise(0))
    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + part(i))
    return F.when(F.length(digits).between(1, 19), total % 10 == 0).otherwise(F.lit(False))


def rule_spans(t: Column) -> Column:
    """array<struct<kind,start,end>> of the matches that pass."""
    small = lambda p: F.coalesce((F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))).try_cast("int") <= 255), F.lit(False))
    checks = [
        (EMAIL, "@", lambda s: F.lit(True)),
        (IP, r"[0-9]\.[0-9]", lambda s: F.forall(F.split(s["text"], r"\."), small)),
        (CARD, "[0-9]", lambda s: F.length(_digits(s["text"])).between(14, 19) & luhn(_digits(s["text"]))),
        (PHONE, r"\+[0-9]", lambda s: F.length(_digits(s["text"])).between(10, 15)),
    ]
    parts = []
    for kind, (pattern, needs, check) in enumerate(checks):
        passed = F.filter(located(t, pattern, needs), check)
        parts.append(_of_kind(passed, kind))
    return F.concat(*parts)


def _of_kind(found: Column, kind: int) -> Column:
    return F.transform(found, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _described(t: Column, rules: Column, generator: int):
    def run(s):
        text, digits = s["text"], _digits(s["text"])
        left = F.lower(F.substring(t, F.greatest(s["start"] - CONTEXT + 1, F.lit(1)), F.least(s["start"], F.lit(CONTEXT))))
        right = F.substring(t, s["end"] + 1, F.lit(1))
        values = [F.lit(generator), F.length(text), F.length(digits), F.length(F.regexp_replace(text, r"[^\p{L}]+", "")),
                  F.length(F.regexp_replace(text, r"[^\x20().:/@-]+", "")), F.length(F.regexp_replace(text, r"[^.]+", "")), luhn(digits).cast("int"),
                  text.startswith("+").cast("int"), left.rlike(r"[\p{L}0-9]$").cast("int"), right.rlike(r"[\p{L}0-9]").cast("int"),
                  *[left.rlike(c).cast("int") for c in CONTEXTS]]
        hit = F.exists(rules, lambda r: (r["start"] < s["end"]) & (r["end"] > s["start"]))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), hit.alias("labelled"),
                        F.array(*[v.cast("double") for v in values]).alias("features"))

    return run


def _candidates(t: Column, rules: Column) -> Column:
    return F.concat(*[F.transform(located(t, pattern, needs), _described(t, rules, g))
                      for g, (pattern, needs) in enumerate(zip(GENERATORS, NEEDS))])


def find(docs: DataFrame) -> DataFrame:
    """doc_id, rules, found of every row, in one pass over the texts."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_t")).withColumn("rules", rule_spans(F.col("_t")))
    return written(rows.select("doc_id", "rules", _candidates(F.col("_t"), F.col("rules")).alias("found")))


def _held_out(c: Column) -> Column:
    return F.pmod(F.xxhash64(c["features"]), F.lit(5)) == 0


def fit(found: DataFrame, sample_per_class: int = SAMPLE_PER_CLASS):
    """Boosted trees over at most ``sample_per_class`` candidates of each class in order of a hash; None without both classes."""
    flat = found.select(F.explode("found").alias("c")).filter(~_held_out(F.col("c"))).select("c.features", F.col("c.labelled").cast("double").alias("label"))
    # equal rows once, so that copies of a text do not crowd out the rest
    flat = flat.groupBy("features", "label").agg(F.count(F.lit(1)).alias("n")).withColumn("h", F.xxhash64("features"))
    picked = [flat.filter(F.col("label") == k).orderBy("h", "features").limit(sample_per_class) for k in (0.0, 1.0)]
    sample = written(picked[0].unionByName(picked[1]).select("label", array_to_vector("features").alias("features")))
    if sample.select("label").distinct().count() < 2:
        return None
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7).fit(sample)


def _tree(node, features: Column) -> Column:
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    go_left = F.get(features, F.lit(int(split.featureIndex()))) <= F.lit(float(split.threshold()))
    return F.when(go_left, _tree(node.leftChild(), features)).otherwise(_tree(node.rightChild(), features))


def probability(model, features: Column) -> Column:
    """The boosted trees as one expression over an array of features."""
    margin = F.lit(0.0)
    for weight, tree in zip(model.treeWeights, model.trees):
        margin = margin + F.lit(float(weight)) * _tree(tree._call_java("rootNode"), features)
    return 1 / (1 + F.exp(-2 * margin))


def threshold(scored: DataFrame, precision: float = PRECISION) -> float:
    """The lowest score, one half at least, from which on ``precision`` of the candidates are findings; over all held-out rows."""
    flat = scored.select(F.explode("scored").alias("c")).filter("c.held_out")
    bins = flat.groupBy(F.floor(F.col("c.p") * BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c.labelled").cast("long")).alias("k")).collect()
    best, n, k = 1.0, 0, 0
    for r in sorted(bins, key=lambda r: -r["bin"]):
        n, k = n + r["n"], k + r["k"]
        if r["bin"] >= BINS // 2 and k >= precision * n:
            best = r["bin"] / BINS
    return best


def scan(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are left out): doc_id, spans array<struct<kind,start,end>>.

    ``kind`` indexes ``KINDS``; places are code points, the end exclusive.  Rule matches always stay; a
    candidate over the threshold that overlaps none of them is added as ``learned``.  Null and empty
    texts have no spans; repeated rows give repeated results; an empty table, or one whose
    candidates are all of one class, gives rule matches only.
    """
    found = find(docs)
    model = fit(found)
    if model is None:
        return found.select("doc_id", F.col("rules").alias("spans"))
    judged = lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["labelled"].alias("labelled"), _held_out(c).alias("held_out"),
                                probability(model, c["features"]).alias("p"))
    scored = written(found.select("doc_id", "rules", F.transform("found", judged).alias("scored")))
    least = threshold(scored, precision)
    new = F.array_distinct(_of_kind(F.filter("scored", lambda c: ~c["labelled"] & (c["p"] >= least)), 4))
    return scored.select("doc_id", F.concat("rules", new).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, counts of each rule, base_sha256, spans as text, n_learned."""
    base = F.filter("spans", lambda s: s["kind"] < 4)
    return scanned.select("doc_id", *[spans.number(F.col("spans"), i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])],
                          F.sha2(spans.joined(base, KINDS), 256).alias("base_sha256"), spans.joined(F.col("spans"), KINDS).alias("spans"),
                          spans.number(F.col("spans"), 4).alias("n_learned"))
