"""Secret scan: fixed rules plus a character convolutional network over every candidate and its context.

One pass over the texts finds the rule matches and the candidates with the characters around them
and writes these small rows to the shared folder.  The network is trained in numpy on a bounded
sample of them: a candidate that overlaps a rule match is a labelled finding.  The threshold
is taken from the scores of the findings in a fifth of all surroundings, which is never trained on.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import spans
from .common import release_memory, slices, texts, written

KINDS = ["assign", "access", "hex", "learned"]
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

# candidates: long unbroken strings, and what follows a name that sounds like a credential
LONG = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
NAMED = re.compile(r"""(?<![a-z])(?:key|pass|pwd|auth|cred|secret|token|bearer)[a-z_]*["']?\x20?[:= ]\x20?["']?([A-Za-z0-9+/_.=-]{6,})""", re.A)

CONTEXT = 24
WINDOW = 64
STRIDE = 56
GROUP = 4096  # rows that go through the network at once
SAMPLE_PER_CLASS = 1500
MOST_AROUND = 4096
RECALL = 0.98
BINS = 100  # in each unit of the log-odds


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the rule matches, in code points."""
    found = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text)]
    return found + [(2, m.start(), m.end()) for m in HEX.finditer(text)]


def candidates(text: str, rules: list[tuple[int, int, int]]) -> list[tuple[int, int, bool]]:
    """(start, end, overlaps a rule match) of every candidate."""
    found = {(m.start(), m.end()) for m in LONG.finditer(text)}
    found.update(m.span(1) for m in NAMED.finditer(text))
    found.update((a, b) for _, a, b in rules)
    covered = sorted((a, b) for _, a, b in rules)
    starts, reach = [a for a, _ in covered], np.maximum.accumulate([b for _, b in covered] or [0])
    out = []
    for a, b in sorted(found):
        i = int(np.searchsorted(starts, b)) if starts else 0  # rules that start before the candidate ends
        out.append((a, b, bool(i and reach[i - 1] > a)))
    return out


# -- the network ----------------------------------------------------------------------------------


@dataclass
class Network:
    """Embedding, one convolution of width 5, the maximum over all places, and a logistic output."""

    embed: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    shift: np.ndarray


WIDTH, DIMS, FILTERS = 5, 8, 24


def encode(items: list[str], lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character classes (rows of WINDOW), marks of the candidate itself, and the item of each row.

    An item is left context, candidate, right context; long ones become several overlapping rows, so all their characters count.
    """
    rows, marks, owner = [], [], []
    for i, (item, length) in enumerate(zip(items, lengths)):
        codes = np.minimum(np.frombuffer(item.encode("utf-32-le", "surrogatepass"), np.uint32), 127).astype(np.int64)
        left = item.find("\0") + 1
        mark = np.zeros(len(codes))
        mark[left:left + length] = 1
        codes, mark = np.delete(codes, left - 1), np.delete(mark, left - 1)
        for start in range(0, max(1, len(codes) - WINDOW + STRIDE), STRIDE):
            c, m = codes[start:start + WINDOW], mark[start:start + WINDOW]
            rows.append(np.pad(c, (0, WINDOW - len(c))))
            marks.append(np.pad(m, (0, WINDOW - len(m))))
            owner.append(i)
    return np.array(rows, np.int64).reshape(-1, WINDOW), np.array(marks).reshape(-1, WINDOW), np.array(owner, np.int64)


def pooled(net: Network, codes, marks):
    """What the filters see at every place of every row, their answers, and each row's maxima."""
    x = np.concatenate([net.embed[codes], marks[:, :, None]], axis=2)
    cols = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1).transpose(0, 1, 3, 2).reshape(len(codes), WINDOW - WIDTH + 1, -1)
    act = np.maximum(cols @ net.kernel + net.bias, 0)
    return cols, act, act.max(axis=1)


def answer(net: Network, top) -> np.ndarray:
    """The probability of each item from the maxima over all its places."""
    return 1 / (1 + np.exp(-np.clip(top @ net.out + net.shift[0], -30, 30)))


def forward(net: Network, codes, marks, owner, items: int):
    cols, act, best = pooled(net, codes, marks)
    top = np.zeros((items, FILTERS))
    np.maximum.at(top, owner, best)
    return answer(net, top), (cols, act, best, top)


def train(items: list[str], lengths: list[int], labels: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Network:
    """Adam on the log loss, classes weighted equally; the same rows give the same network."""
    rng = np.random.default_rng(seed)
    shapes = ((128, DIMS), (WIDTH * (DIMS + 1), FILTERS), (FILTERS,), (FILTERS,), (1,))
    net = Network(*[rng.normal(0, 0.3, s) if i in (0, 1, 3) else np.zeros(s) for i, s in enumerate(shapes)])
    params = [net.embed, net.kernel, net.bias, net.out, net.shift]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum())) * len(labels)
    for _ in range(epochs):
        order = rng.permutation(len(items))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            codes, marks, owner = encode([items[i] for i in pick], [lengths[i] for i in pick])
            p, (cols, act, best, top) = forward(net, codes, marks, owner, len(pick))
            e = (p - labels[pick]) * weight[pick] / len(pick)
            d_top = e[:, None] * net.out
            # the gradient goes to the rows and places that gave the maximum
            d_best = np.where((best == top[owner]) & (best > 0), d_top[owner], 0)
            place = act.argmax(axis=1)
            row = np.arange(len(codes))
            d_kernel, d_embed = np.zeros_like(net.kernel), np.zeros_like(net.embed)
            for f in range(FILTERS):
                taken = cols[row, place[:, f]]
                d_kernel[:, f] = d_best[:, f] @ taken
                back = (d_best[:, f, None] * net.kernel[:, f]).reshape(-1, WIDTH, DIMS + 1)[:, :, :DIMS]
                np.add.at(d_embed, codes[row[:, None], place[:, f, None] + np.arange(WIDTH)], back)
            grads = [d_embed, d_kernel, d_best.sum(axis=0), top.T @ e, np.array([e.sum()])]
            t += 1
            for p_, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p_ -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return net


def predict(net: Network, items: list[str], lengths: list[int]) -> np.ndarray:
    """The score of every item, whatever stands beside it: a long candidate's many rows go through the network in groups, its maxima are kept over all of them."""
    out = []
    for at in range(0, len(items), 512):
        part = items[at:at + 512]
        codes, marks, owner = encode(part, lengths[at:at + 512])
        top = np.zeros((len(part), FILTERS))
        for lo in range(0, len(codes), GROUP):
            sel = slice(lo, lo + GROUP)
            np.maximum.at(top, owner[sel], pooled(net, codes[sel], marks[sel])[2])
        out.append(answer(net, top))
    return np.concatenate(out) if out else np.zeros(0)


# -- on the cluster -------------------------------------------------------------------------------

FOUND = "rules array<struct<kind:int,start:int,end:int>>, found array<struct<start:int,end:int,labelled:boolean,around:string>>"


def _find(batches):
    for batch in slices(batches):
        rules, found = [], []
        for text in texts(batch):
            r = rule_spans(text)
            rules.append([{"kind": k, "start": a, "end": b} for k, a, b in r])
            found.append([{"start": a, "end": b, "labelled": hit,
                           "around": text[max(0, a - CONTEXT):a].replace("\0", " ") + "\0" + text[a:b] + text[b:b + CONTEXT].replace("\0", " ")}
                          for a, b, hit in candidates(text, r)])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rules, _RULES), pa.array(found, _CANDIDATES)], ["doc_id", "rules", "found"])


_RULES = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
_CANDIDATES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("labelled", pa.bool_()), ("around", pa.string())]))


def _score(net: Network):
    def run(batches):
        for batch in batches:
            found = batch.column("found").to_pylist()
            flat = [c for row in found for c in row]
            p = predict(net, [c["around"] for c in flat], [c["end"] - c["start"] for c in flat]).tolist()
            at, out = 0, []
            for row in found:
                out.append([{"start": c["start"], "end": c["end"], "labelled": c["labelled"], "held": c["held"], "p": x} for c, x in zip(row, p[at:at + len(row)])])
                at += len(row)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rules"), pa.array(out, _SCORED)], ["doc_id", "rules", "scored"])

    return run


_SCORED = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("labelled", pa.bool_()), ("held", pa.bool_()), ("p", pa.float64())]))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, rules, found of every row (one pass over the texts), as a table in the shared folder."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.select("doc_id", "text").mapInArrow(_find, f"doc_id {kind}, {FOUND}"))


def held_out(around: Column) -> Column:
    """True for the fifth of all surroundings, by hash, that is never trained on; copies of a text are on the same side."""
    return F.pmod(F.xxhash64(around), F.lit(5)) == 0


def fit(found: DataFrame, sample_per_class: int = SAMPLE_PER_CLASS, most_around: int = MOST_AROUND) -> Network | None:
    """Train on at most ``sample_per_class`` candidates of each class, in order of a hash; None without both classes.

    Held-out candidates are never trained on, nor are those with more than ``most_around`` characters
    (with their context), which bounds what the driver collects; they are scored like all others.
    """
    flat = found.select(F.explode("found").alias("c")).select("c.*").filter(~held_out(F.col("around"))).withColumn("h", F.xxhash64("around"))
    rows = []
    for labelled in (True, False):
        part = flat.filter(F.col("labelled") == labelled).select("h", "around", (F.col("end") - F.col("start")).alias("n"), "labelled")
        # one row of each surrounding: copies of a text teach nothing new
        rows += part.filter(F.length("around") <= most_around).groupBy("h").agg(F.first("around").alias("around"), F.first("n").alias("n"), F.first("labelled").alias("labelled")) \
            .orderBy("h").limit(sample_per_class).collect()
    if len({r["labelled"] for r in rows}) < 2:
        return None
    net = train([r["around"] for r in rows], [r["n"] for r in rows], np.array([int(r["labelled"]) for r in rows]))
    release_memory()
    return net


def scores(found: DataFrame, net: Network) -> DataFrame:
    """doc_id, rules and ``scored``, all candidates with their probabilities, as a table in the shared folder."""
    kind = found.schema["doc_id"].dataType.simpleString()
    marked = found.withColumn("found", F.transform("found", lambda c: c.withField("held", held_out(c["around"]))))
    return written(marked.mapInArrow(_score(net), f"doc_id {kind}, rules array<struct<kind:int,start:int,end:int>>, "
                                     "scored array<struct<start:int,end:int,labelled:boolean,held:boolean,p:double>>"))


def threshold(scored: DataFrame, recall: float = RECALL) -> float:
    """The highest score, to a hundredth of the log-odds, that keeps ``recall`` of the held-out findings (labelled candidates); it can be under one half.

    From a histogram over all rows.  If no finding is held out, all findings count; without findings it is 1.
    """
    flat = scored.select(F.explode("scored").alias("c")).filter("c.labelled").select("c.held", "c.p")
    bins = flat.groupBy("held", F.floor(F.log(F.col("p") / (1 - F.col("p"))) * BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("p").alias("least")).collect()
    bins = [r for r in bins if r["held"]] or bins
    total, kept = sum(r["n"] for r in bins), 0
    for r in sorted(bins, key=lambda r: -r["bin"]):
        kept += r["n"]
        if kept >= recall * total:
            return r["least"]
    return 1.0


def scan(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are left out): doc_id, spans array<struct<kind,start,end>>.

    ``kind`` indexes ``KINDS``; places are code points, the end exclusive.  Rule matches always stay;
    the network adds candidates from the threshold on that overlap none of them.
    Null and empty texts have no spans; repeated rows give repeated results; an empty table, or one
    without rule matches to learn from, gives rule matches only.
    """
    found = find(docs)
    net = fit(found)
    if net is None:
        return found.select("doc_id", F.col("rules").alias("spans"))
    scored = scores(found, net)
    least = threshold(scored, recall)
    new = F.filter("scored", lambda c: ~c["labelled"] & (c["p"] >= least))
    new = F.transform(new, lambda c: F.struct(F.lit(3).alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return scored.select("doc_id", F.concat("rules", new).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, counts of each rule, base_sha256, spans as text, n_learned."""
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return scanned.select("doc_id", *[spans.number(F.col("spans"), i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
                          F.sha2(spans.joined(base, KINDS), 256).alias("base_sha256"), spans.joined(F.col("spans"), KINDS).alias("spans"),
                          spans.number(F.col("spans"), 3).alias("n_learned"))


MARK = "[SECRET]"


def _masked(text: str, found) -> str:
    out, at = [], 0
    for a, b in sorted((s["start"], s["end"]) for s in found):
        if b > at:
            out.append(text[at:a] + MARK if a >= at else "")  # spans that overlap share a mark
            at = b
    return "".join(out) + text[at:]


@F.pandas_udf(StringType())
def masked(text: pd.Series, found: pd.Series) -> pd.Series:
    return pd.Series([t if t is None or f is None else _masked(t, f) for t, f in zip(text, found)], dtype=object)


def redact(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """``docs`` with every secret of ``text`` replaced by ``MARK``; a column ``n_chars`` follows the text, the others stay, whatever their names.

    Spans are joined by the text's hash, so null and repeated ids do not matter; only texts with findings have any.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64("text").alias("hash"))
    scanned = scan(rows.select(F.col("hash").alias("doc_id"), F.col("row.text").alias("text")), recall).filter(F.size("spans") > 0)
    found = written(scanned.groupBy("doc_id").agg(F.first("spans").alias("found")).withColumnRenamed("doc_id", "hash"))
    out = rows.join(found, "hash", "left").withColumn("text", F.when(F.col("found").isNull(), F.col("row.text")).otherwise(masked("row.text", "found")))
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(F.col("found").isNull(), F.col("row.n_chars")).otherwise(F.char_length("text").cast(kind))
    return out.select(*[c.alias(name) for name, c in columns.items()])
