"""Edit-aware token counts: a segment tree over the pre-tokens of a document.

The tokenizer splits a text into pre-tokens and each pre-token into tokens on its own, so the count
of a text is the sum over its pre-tokens.  A leaf of the tree holds a run of pre-tokens, as their
characters and their tokens; inner nodes hold sums.  An edit re-encodes from a little before it
until the new pre-tokens meet an old leaf border again, and updates the sums above.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

# Fixed value: the pre-token pattern of the vocabulary file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LEAF = 32
CACHE = 1_000_000


class Counter(dict):
    """Token counts of pre-tokens; forgets them when they become many."""

    def __init__(self, vocabulary: bytes, pattern: str = PATTERN):
        super().__init__()
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("counter", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[piece] = n = len(self.encoding.encode_ordinary(piece))
        return n

    def leaves(self, pieces: list[str], leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of each run of ``leaf`` pre-tokens."""
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.arange(0, len(pieces), leaf)
        return (np.add.reduceat(np.fromiter(map(len, pieces), np.int64, len(pieces)), at),
                np.add.reduceat(np.fromiter(map(self.__getitem__, pieces), np.int64, len(pieces)), at))


class Tree:
    """Two arrays of sums, ``chars`` and ``tokens``, in heap order: node k has the children 2k and 2k + 1, node 1 is the root."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self.size = len(chars) // 2

    @classmethod
    def of(cls, chars: np.ndarray, tokens: np.ndarray) -> Tree:
        size = 1 << max(0, (len(chars) - 1).bit_length())
        nodes = np.zeros((2, 2 * size), np.int64)
        nodes[0, size:size + len(chars)], nodes[1, size:size + len(tokens)] = chars, tokens
        while size > 1:
            size //= 2
            nodes[:, size:2 * size] = nodes[:, 2 * size:4 * size:2] + nodes[:, 2 * size + 1:4 * size:2]
        return cls(nodes[0], nodes[1])

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place`` (the last one with characters, at the end) and its first character."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if place - start >= self.chars[node] and self.chars[node + 1]:
                start += int(self.chars[node])
                node += 1
        return node - self.size, start

    def put(self, first: int, chars: np.ndarray, tokens: np.ndarray) -> None:
        """Replace the leaves from ``first`` and the sums above them."""
        lo, hi = self.size + first, self.size + first + len(chars) - 1
        self.chars[lo:hi + 1], self.tokens[lo:hi + 1] = chars, tokens
        while lo > 1:
            lo, hi = lo // 2, hi // 2
            for sums in (self.chars, self.tokens):
                sums[lo:hi + 1] = sums[2 * lo:2 * hi + 1:2] + sums[2 * lo + 1:2 * hi + 2:2]


def build(text: str, counter: Counter) -> Tree:
    return Tree.of(*counter.leaves(counter.pattern.findall(text)))


def edit(text: str, tree: Tree, start: int, end: int, new: str, counter: Counter) -> tuple[str, int]:
    """Replace text[start:end] by ``new`` in text and tree; returns the text and the number of pre-tokens read again.

    A pre-token is settled by the text up to two pre-tokens after it, so reading starts at the leaf of
    the second pre-token before the edit or earlier, and stops at the first old leaf border behind the edit
    that is also a border of the new pre-tokens.
    """
    text, shift = text[:start] + new + text[end:], len(new) - (end - start)
    leaf, at = tree.find(max(0, start - 1))
    for _ in range(2):  # a leaf has one pre-token at least: two leaves back are two pre-tokens back
        if leaf:
            leaf, at = tree.find(max(0, at - 1))
    last, border = leaf, at + int(tree.chars[tree.size + leaf])
    total, pieces, place = int(tree.chars[1]), [], at
    for m in counter.pattern.finditer(text, at):
        pieces.append(m[0])
        place = m.end()
        # old borders that the new pre-tokens have passed
        while border < total and (border < end or border + shift < place):
            last += 1
            border += int(tree.chars[tree.size + last])
        if border < total and border >= end and border + shift == place and place >= start + len(new):
            break
    else:
        last = tree.size - 1
        while last > leaf and not tree.chars[tree.size + last]:
            last -= 1
    room = last - leaf + 1
    chars, tokens = counter.leaves(pieces, max(1, -(-len(pieces) // room)))
    pad = (0, room - len(chars))
    tree.put(leaf, np.pad(chars, pad), np.pad(tokens, pad))
    return text, len(pieces)


# -- on the cluster -------------------------------------------------------------------------------


def _vocabulary(path: str) -> bytes:
    """The vocabulary file, read by the driver and sent along with the tasks: half a megabyte, whatever the input."""
    with open(path, "rb") as f:
        return f.read()


def trees(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """All columns of ``docs`` and ``chars``, ``tokens`` (array<bigint>), the tree of each row's text; columns of these names are replaced.

    A null text counts as empty and has a tree of one empty leaf.
    """
    data = docs.sparkSession.sparkContext.broadcast(_vocabulary(vocabulary))
    kept = docs.drop("chars", "tokens")

    def run(batches):
        counter = Counter(data.value)
        for batch in slices(batches):
            made = [build(t, counter) for t in texts(batch)]
            sums = [pa.array([x.tolist() for x in part], pa.list_(pa.int64())) for part in ([t.chars for t in made], [t.tokens for t in made])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums], [*batch.schema.names, "chars", "tokens"])

    return kept.mapInArrow(run, _schema(kept) + ", chars array<bigint>, tokens array<bigint>")


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)


def updated(edited: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Apply column ``edits`` (array<struct<start,end,text>>, code points of the text as it was) to text, chars and tokens; adds ``reread``.

    Edits are applied in order of start; one that begins inside the one before begins at its end, and
    places outside the text are moved to its ends.  Null edits are none, a null replacement is empty.
    """
    data = edited.sparkSession.sparkContext.broadcast(_vocabulary(vocabulary))
    kept = edited.drop("reread")

    def run(batches):
        counter = Counter(data.value)
        for batch in slices(batches):
            out = {"text": [], "chars": [], "tokens": [], "reread": []}
            for text, edits, chars, tokens in zip(texts(batch), *(batch.column(c).to_pylist() for c in ("edits", "chars", "tokens"))):
                tree, read, clear = Tree(np.array(chars), np.array(tokens)), 0, 0
                plan = []
                for e in sorted((e for e in edits or [] if e and e["start"] is not None and e["end"] is not None), key=lambda e: (e["start"], e["end"])):
                    a = min(max(e["start"], clear), len(text))
                    clear = b = min(max(a, e["end"]), len(text))
                    plan.append((a, b, e["text"] or ""))
                for a, b, new in reversed(plan):  # from the end, so the places before stay right
                    text, n = edit(text, tree, a, b, new, counter)
                    read += n
                for k, v in zip(out, (text, tree.chars.tolist(), tree.tokens.tolist(), read)):
                    out[k].append(v)
            kinds = {"text": pa.string(), "chars": pa.list_(pa.int64()), "tokens": pa.list_(pa.int64()), "reread": pa.int64()}
            names = [*batch.schema.names, "reread"]
            yield pa.RecordBatch.from_arrays([pa.array(out[n], kinds[n]) if n in out else batch.column(n) for n in names], names)

    return kept.mapInArrow(run, _schema(kept) + ", reread bigint")


def n_tokens(column: str = "tokens"):
    """The root of the tree; the root of a tree with one leaf is that leaf."""
    return F.get(column, F.lit(1))


def sample_edits(docs: DataFrame) -> DataFrame:
    """``docs`` with ``edits``: of each text, a passage is cut at a place that its id gives, another doubled, and a mark put at the end."""
    n = F.char_length(F.coalesce("text", F.lit(""))).cast("int")
    place = lambda k: F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(n, F.lit(1)).cast("long")).cast("int")
    cut, copy = place(1), place(2)
    one = lambda a, b, t: F.struct(a.alias("start"), b.alias("end"), t.alias("text"))
    return docs.withColumn("edits", F.array(one(cut, cut + 40, F.lit("")), one(copy, copy, F.substring("text", copy + 1, F.lit(25))), one(n, n, F.lit(" [end]"))))


def counted(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Token counts of each row's text before and after ``sample_edits``: doc_id, n_tokens, n_tokens_edited, n_chars_edited, reread."""
    before = trees(sample_edits(docs.select("doc_id", "text")), vocabulary).withColumn("n_tokens", n_tokens())
    after = updated(before, vocabulary)
    return after.select("doc_id", "n_tokens", n_tokens().alias("n_tokens_edited"), F.get("chars", F.lit(1)).alias("n_chars_edited"), "reread")
