"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a run of tokens: only the tokens at its ones are hashed, so texts that
differ at the ignored places still meet.  Hashes of the benchmark and of the documents are joined on
equality; around each hit the two texts are laid side by side, and the stretch counts if enough of its tokens agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, slices, texts, without, written
from .words import PLAIN, word_hashes

SPAN = 20
AGREE = 0.8
SLOT_BITS = 22, 28  # least and most bits of a slot of the bit map: half a megabyte to 32 MB
SLOTS_PER_SEED = 16
LEAST = 3  # shorter items overlap only with documents of the same tokens and no others
SLICE = 1 << 20

# Masks of items of eight tokens and more, the first without gaps, and further ones by the least length of an item.
# Together they leave a seed in a stretch wherever the substitutions lie that AGREE allows; a test goes through all placements.
MASKS = ["11111111", "1101100111001", "111010010100111", "10110111001011", "1110100110010101"]
LIGHTER = {15: ["11100010111", "1100010100111", "111011011", "11001010001101", "10010110000111", "1111111"],
           12: ["111001011", "1110111", "110010010101"],
           8: ["111011", "11000111", "101100101"]}


def masks_of(n: int) -> list[str]:
    """The masks for a stretch of ``n`` tokens.  Under eight tokens they are the whole stretch, or all but one token if ``AGREE`` allows that."""
    if n >= 8:
        return MASKS + next(masks for least, masks in LIGHTER.items() if n >= least)
    if AGREE * n > n - 1:
        return ["1" * n]
    return ["1" * (n - 1)] + ["1" * i + "0" + "1" * (n - 1 - i) for i in range(1, n - 1)]


ALL = list(dict.fromkeys(m for n in (*range(SPAN, 0, -1),) for m in masks_of(n)))
USES = np.array([[m in masks_of(n) for n in range(SPAN + 1)] for m in ALL])
_FACTORS = mix(np.arange(1, SPAN + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def seeds(tokens: np.ndarray, number: int) -> np.ndarray:
    """Hashes of the seeds of mask ``ALL[number]`` from each token on, over text borders too."""
    mask = ALL[number]
    h = np.full(max(0, len(tokens) - len(mask) + 1), number + 1, np.uint64)
    part = np.empty_like(h)
    for o, c in enumerate(mask):
        if c == "1":
            np.multiply(tokens[o:o + len(h)], _FACTORS[o], out=part)
            h += part
    return mix(h)


def owners(places: np.ndarray, at: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The text of each place, and whether the seed lies within it; ``at`` holds the texts' borders among the tokens."""
    owner = np.searchsorted(at, places, side="right") - 1
    return owner, places + len(ALL[number]) <= at[owner + 1]


def agreement(doc: np.ndarray, item: np.ndarray, shift: int, span: int = SPAN) -> tuple[int, int]:
    """Equal tokens in the best stretch of ``span`` tokens of the item (all of it if shorter), and the stretch's length,
    where token i of the item lies on token i + shift of the document."""
    n, place = min(span, len(item)), np.arange(len(item)) + shift
    inside = (place >= 0) & (place < len(doc))
    total = np.zeros(len(item) + 1, np.int64)
    np.cumsum(inside & (doc[np.clip(place, 0, len(doc) - 1)] == item), out=total[1:])
    return int((total[n:] - total[:len(total) - n]).max()), n


LONGEST = max(map(len, ALL))
ROWS = 1 << 14  # seeds that leave a task at once


def _around(tokens: np.ndarray, places: np.ndarray, owner: np.ndarray, at: np.ndarray, span: int) -> tuple[np.ndarray, pa.Array]:
    """All tokens that a stretch with a seed at each place can reach within its text, and where they begin."""
    lo, hi = np.maximum(places - span, at[owner]), np.minimum(places + span + LONGEST, at[owner + 1])
    return lo, pa.array([tokens[a:b].tobytes() for a, b in zip(lo, hi)], pa.binary())


def _item_seeds(span: int):
    def run(batches):
        for batch in slices(batches, most=SLICE):
            tokens, at = word_hashes(texts(batch), PLAIN)
            stretch = np.minimum(np.diff(at), min(span, SPAN))
            for number in range(len(ALL)):
                hashes = seeds(tokens, number)
                places = np.arange(len(hashes))
                owner, fits = owners(places, at, number)
                keep = fits & USES[number][stretch[owner]]
                for cut in range(0, int(keep.sum()), ROWS):
                    place, own = places[keep][cut:cut + ROWS], owner[keep][cut:cut + ROWS]
                    first, around = _around(tokens, place, own, at, span)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes[place].view(np.int64)), pa.array(np.full(len(place), number, np.int32)), batch.column("item_id").take(pa.array(own)),
                         pa.array((place - first).astype(np.int32)), around], ["seed", "mask", "item_id", "item_at", "item"])

    return run


def _doc_seeds(map_of, bits: int, used: list[int], span: int):
    def found(hashes: np.ndarray) -> np.ndarray:
        present, hit = np.frombuffer(map_of.value, np.uint8), np.arange(len(hashes))
        for low in (64 - bits, 64 - 2 * bits):
            slot = ((hashes[hit] >> np.uint64(low)) & np.uint64((1 << bits) - 1)).astype(np.int64)
            hit = hit[((present[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(bool)]
        return hit

    def run(batches):
        for batch in slices(batches, most=SLICE):
            tokens, at = word_hashes(texts(batch), PLAIN)
            for number in used:
                hashes = seeds(tokens, number)
                places = found(hashes)
                owner, fits = owners(places, at, number)
                if len(ALL[number]) < LEAST:
                    fits &= np.diff(at)[owner] == len(ALL[number])
                for cut in range(0, int(fits.sum()), ROWS):
                    place, own = places[fits][cut:cut + ROWS], owner[fits][cut:cut + ROWS]
                    first, around = _around(tokens, place, own, at, span)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes[place].view(np.int64)), batch.column("doc_id").take(pa.array(own)), pa.array((place - first).astype(np.int32)), around],
                        ["seed", "doc_id", "hit_at", "around"])

    return run


def _check(span: int, agree: float):
    def run(batches):
        for batch in (part for some in slices(batches, "around", SLICE) for part in slices([some], "item", SLICE)):
            rows = zip(*(batch.column(c).to_pylist() for c in ("around", "item", "hit_at", "item_at")))
            found = [agreement(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), x - y, span) for a, b, x, y in rows]
            keep = pa.array([same >= agree * n for same, n in found])
            cols = [batch.column("doc_id"), batch.column("item_id"), pa.array([x for x, _ in found], pa.int32()), pa.array([n for _, n in found], pa.int32())]
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in cols], ["doc_id", "item_id", "agree", "span"])

    return run


def slot_bits(seeds: int) -> int:
    """Bits of a slot for a benchmark of that many seeds.  Up to 16 million seeds a document seed that is none meets two taken slots
    by chance in at most 1.4 % of cases; beyond, the map does not grow, so more of them reach the join, which is exact."""
    return min(max((SLOTS_PER_SEED * seeds).bit_length(), SLOT_BITS[0]), SLOT_BITS[1])


def _present(items: DataFrame, bits: int) -> tuple[bytes, list[int]]:
    """Bits for the two slots that each benchmark seed falls in (2 ** ``bits`` of them), and the numbers of the masks in use."""
    slot = F.explode(F.array(*[F.shiftrightunsigned("seed", low).bitwiseAND((1 << bits) - 1) for low in (64 - bits, 64 - 2 * bits)]))
    words = items.select(slot.alias("slot"), F.expr("shiftleft(1L, mask)").alias("masks")).groupBy(F.shiftright("slot", 6).alias("word")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("bits"), F.bit_or("masks").alias("masks")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    masks = int(np.bitwise_or.reduce(words["masks"].to_numpy(), initial=0))
    return out.tobytes(), [i for i in range(len(ALL)) if masks >> i & 1]


def overlaps(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, agree: float = AGREE) -> DataFrame:
    """doc_id, item_id, n_hits, agree, span of each document (doc_id, text) and benchmark item (item_id, text) that overlap.

    Tokens are runs of letters, digits and non-ASCII characters, A-Z as a-z.  An overlap is a stretch of
    ``span`` tokens of the item (all of it if shorter) laid on the document without gaps, with at least
    the share ``agree`` of equal tokens, where a seed in or beside the stretch meets.  With a ``span``
    up to ``SPAN`` and an ``agree`` of at least ``AGREE`` every such stretch has a seed, so none is missed.  ``agree`` is the
    best stretch's number of equal tokens, ``n_hits`` the number of seeds that lead to one.  Null and
    empty texts overlap with nothing, a very long text or item sends only the tokens around its seeds, null ids stay null,
    repeated rows add up in ``n_hits``, and an empty table on either side gives an empty table.

    A bit map of the benchmark's seeds spares most document seeds the shuffle; the join itself is left to Spark.
    """
    if not (1 <= span <= SPAN and AGREE <= agree <= 1):
        raise ValueError(f"span is at most {SPAN} and agree at least {AGREE}")
    kinds = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    items = benchmark.select("item_id", "text").mapInArrow(_item_seeds(span), f"seed long, mask int, item_id {kinds[1]}, item_at int, item binary")
    items = written(items.distinct())
    bits = slot_bits(items.count())
    present, used = _present(items, bits)
    present = docs.sparkSession.sparkContext.broadcast(present)
    hits = docs.select("doc_id", "text").mapInArrow(_doc_seeds(present, bits, used, span), f"seed long, doc_id {kinds[0]}, hit_at int, around binary")
    found = hits.join(items.drop("mask"), "seed").mapInArrow(_check(span, agree), f"doc_id {kinds[0]}, item_id {kinds[1]}, agree int, span int")
    return found.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_hits"), F.max("agree").alias("agree"), F.max("span").alias("span"))


def clean(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, agree: float = AGREE) -> DataFrame:
    """The rows of ``docs``, all columns, without those whose text overlaps a benchmark item; rows without id stay."""
    return without(docs, overlaps(docs, benchmark, span, agree))
