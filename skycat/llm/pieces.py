"""SentencePiece segmentations sampled without replacement.

A text's segmentations are the paths through the lattice of its vocabulary pieces.  Gumbel top-k
draws k distinct paths: every path has its log-probability plus Gumbel noise, and the k largest are
wanted, without listing all paths.  The A* search goes down from the whole set of paths.  A set's
largest noisy value is Gumbel noise around the set's total weight, which a backward pass over
the lattice gives exactly; it is the bound under which a set waits.  Opening the best waiting set
splits it by its next piece: the piece that keeps the maximum is drawn by the pieces' shares, and all
others stay behind as one set, whose maximum is Gumbel noise truncated at the value just opened.
So one path costs one draw for each of its pieces, and all texts of a slice advance together in numpy.

A piece never crosses from a word into the following blank (checked on loading), so the lattice
of a text is the chain of the lattices of its words, and equal words of a slice share theirs.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from dataclasses import dataclass, fields
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, slices, texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
K = 2
NEAR = 256  # numbers of the characters with the smallest code points
SEED = 17
SLICE = 3 << 17
HELD_EDGES = 1 << 20  # edges of word lattices that a worker keeps from slice to slice
BLANK = "▁"
# a word with the blanks before it, blanks at the end of a line, or a line end
UNITS = re.compile(r" *[^ \n]+| +|\n")
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """The model's pieces as a trie over character numbers, with a log-weight for each piece.

    The model holds merge ranks, not probabilities; a piece of rank r weighs 1 / (r + 2.7), as
    frequencies fall with rank.  A byte of the fallback weighs as much as the last piece.
    """

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.bytes_of, self.byte_ids, plain = [b""] * n, np.full(256, -1), []
        for i in range(n):
            name = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(name[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(name[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                if BLANK in name.lstrip(BLANK) or "\n" in name or " " in name:
                    raise ValueError(f"piece {i} crosses words")
                self.bytes_of[i] = name.replace(BLANK, " ").encode()
                plain.append((name.replace(BLANK, " "), i, sp.get_score(i)))
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no byte fallback")
        ranked = sorted(plain, key=lambda x: -x[2])
        sizes = np.fromiter(map(len, self.bytes_of), np.int64, n)
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.byte_start, self.byte_size = np.cumsum(sizes) - sizes, sizes
        self.weight = np.zeros(n)
        self.weight[[i for _, i, _ in ranked]] = -np.log(np.arange(len(ranked)) + 2.7)
        self.byte_weight = -np.log(n + 2.7)
        chars = sorted({ord(c) for name, _, _ in plain for c in name})
        self.number = np.full(0x110000, -1, np.int32)
        self.number[chars] = np.arange(len(chars))
        self.width = len(chars)
        moves, accepted = {}, {}
        for name, i, _ in plain:
            state = 0
            for c in name:
                state = moves.setdefault(state * self.width + int(self.number[ord(c)]), len(moves) + 1)
            accepted[state] = i
        self.keys = np.array(sorted(moves), np.int64)
        self.next = np.array([moves[k] for k in self.keys.tolist()], np.int64)
        self.accept = np.full(len(moves) + 1, -1, np.int64)
        self.accept[list(accepted)] = list(accepted.values())
        # the first two characters of a piece are looked up directly: most walks end there
        self.one = np.full(self.width + 1, -1, np.int64)  # the last entry is that of characters in no piece
        self.two = np.full((NEAR, NEAR), -1, np.int64)
        for key, child in moves.items():
            state, number = divmod(key, self.width)
            if state == 0:
                self.one[number] = child
        parent = {child: number for number, child in enumerate(self.one.tolist()) if child >= 0}
        for key, child in moves.items():
            state, number = divmod(key, self.width)
            if state in parent and parent[state] < NEAR and number < NEAR:
                self.two[parent[state], number] = child

    def move(self, state: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The state behind a character, -1 if no piece goes on with it."""
        key = state * self.width + number
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[place] == key) & (number >= 0), self.next[place], -1)

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode()

    def decoded(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all pieces in a row, and the number of bytes before each piece (one entry more than pieces)."""
        size = self.byte_size[ids]
        end = np.cumsum(size)
        place = np.repeat(self.byte_start[ids] - end + size, size)
        place += np.arange(len(place))
        return self.all_bytes[place].tobytes(), np.concatenate([[0], end])


@dataclass
class Lattice:
    """Edges of many units in order of their first node: unit u has the nodes first[u] .. first[u] + its length."""

    first: np.ndarray
    end: np.ndarray  # per node: is it the last of its unit
    ptr: np.ndarray  # edges of node s: ptr[s]:ptr[s + 1]
    source: np.ndarray
    target: np.ndarray
    piece: np.ndarray  # piece id, or -1 - code point for a character written as bytes
    logp: np.ndarray  # of the edge, given that a path is at its node
    until: np.ndarray  # running share of the edges of a node, infinite at the last


def _placed(values: np.ndarray, place: np.ndarray) -> np.ndarray:
    out = np.empty_like(values)
    out[place] = values
    return out


def lattice(units: list[str], v: Vocabulary) -> Lattice:
    lengths = np.fromiter(map(len, units), np.int64, len(units))
    codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
    first = np.cumsum(lengths + 1) - lengths - 1
    unit = np.repeat(np.arange(len(units)), lengths)
    node = np.arange(len(codes)) + unit
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # characters from here to the unit's end
    numbers = v.number[codes].astype(np.int64)
    src, step, piece = [], [], []
    at, depth = np.arange(len(codes)), 0
    while len(at):
        last = numbers[at + depth]
        if depth == 0:
            state = v.one[last]
        elif depth == 1:
            first_number = numbers[at]
            near = (first_number < NEAR) & (last < NEAR) & (last >= 0)
            child = np.full(len(at), -1)
            child[near] = v.two[first_number[near], last[near]]
            child[~near] = v.move(state[~near], last[~near])
            state = child
        else:
            state = v.move(state, last)
        ok = state >= 0
        at, state = at[ok], state[ok]
        depth += 1
        done = v.accept[state] >= 0
        src.append(at[done])
        step.append(np.full(int(done.sum()), depth))
        piece.append(v.accept[state[done]])
        more = left[at] > depth
        at, state = at[more], state[more]
    alone = np.ones(len(codes), bool)
    alone[src[0] if src else []] = False
    alone = np.flatnonzero(alone)  # characters that are no piece are written as their bytes
    src.append(alone)
    step.append(np.ones(len(alone), np.int64))
    piece.append(-1 - codes[alone].astype(np.int64))
    # edges in order of their source, of one source in order of length: the order in which they were found
    held = np.bincount(np.concatenate(src), minlength=len(codes))
    free, order = np.cumsum(held) - held, []
    for s in src:
        order.append(free[s])
        free[s] += 1
    order = np.concatenate(order)
    src, step, piece = (_placed(np.concatenate(x), order) for x in (src, step, piece))
    weight = v.weight[np.maximum(piece, 0)]
    spelled = np.flatnonzero(piece < 0)
    weight[spelled] = (1 + sum(codes[src[spelled]] >= x for x in (0x80, 0x800, 0x10000))) * v.byte_weight
    nodes = len(codes) + len(units)
    source, target = node[src], node[src] + step
    ptr = np.zeros(nodes + 1, np.int64)
    np.cumsum(np.bincount(source, minlength=nodes), out=ptr[1:])
    # total log-weight of the paths from a node to its unit's end, from the end backwards
    total = np.zeros(nodes)
    far = left[src]
    by_far = np.argsort(far.astype(np.uint16) if far.max(initial=0) < 1 << 16 else far, kind="stable")
    cuts = np.flatnonzero(np.diff(far[by_far], prepend=-1))
    for lo, hi in zip(cuts, [*cuts[1:], len(by_far)]):
        e = by_far[lo:hi]
        heads = np.flatnonzero(np.diff(source[e], prepend=-1))
        total[source[e[heads]]] = np.logaddexp.reduceat(weight[e] + total[target[e]], heads)
    logp = np.minimum(weight + total[target] - total[source], 0.0)
    until = np.exp(logp)
    more = np.flatnonzero(np.diff(ptr) > 1)
    edge, rounds = ptr[more] + 1, np.diff(ptr)[more] - 1
    while len(edge):  # node by node, so that it does not matter which units stand together
        until[edge] += until[edge - 1]
        go = rounds > 1
        edge, rounds = edge[go] + 1, rounds[go] - 1
    until[ptr[1:][np.diff(ptr) > 0] - 1] = np.inf
    end = np.zeros(nodes, bool)
    end[first + lengths] = True
    return Lattice(first, end, ptr, source.astype(np.int32), target.astype(np.int32), piece.astype(np.int32), logp, until)


class Lattices:
    """The lattices of the words met so far, so that a word that returns in a later slice needs no new one."""

    def __init__(self, v: Vocabulary, held_edges: int = HELD_EDGES):
        self.v, self.held_edges = v, held_edges
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = defaultdict(itertools.count().__next__)  # a new word gets the next number
        self.all = lattice([], self.v)
        self.room = {f.name: getattr(self.all, f.name) for f in fields(Lattice)}

    def _append(self, name: str, values: np.ndarray, start: int) -> np.ndarray:
        """An array of the lattice with ``values`` from ``start`` on, in place if there is room for them."""
        stop = start + len(values)
        if stop > len(self.room[name]):
            room = np.empty(max(stop, 2 * start, self.held_edges), values.dtype)  # memory that is not written is not taken
            room[:start] = self.room[name][:start]
            self.room[name] = room
        self.room[name][start:stop] = values
        return self.room[name][:stop]

    def of(self, units: list[str]) -> tuple[Lattice, np.ndarray]:
        """One lattice that holds all ``units``, and the place of each among its units."""
        if len(self.all.source) > self.held_edges:
            self._forget()
        before = len(self.numbers)
        rows = np.fromiter(map(self.numbers.__getitem__, units), np.int64, len(units))
        if len(self.numbers) > before:
            more = lattice(list(itertools.islice(self.numbers, before, None)), self.v)
            nodes, edges = len(self.all.end), len(self.all.source)
            more.first += nodes
            more.ptr += edges
            more.source += np.int32(nodes)
            more.target += np.int32(nodes)
            start = {"first": before, "end": nodes, "ptr": nodes}  # the last entry of ptr is the first of what follows
            self.all = Lattice(**{n: self._append(n, getattr(more, n), start.get(n, edges)) for n in self.room})
        return self.all, rows


def uniform(key: np.ndarray, number) -> np.ndarray:
    """Numbers in (0, 1) that depend on the key and the number only."""
    return ((mix(key + np.asarray(number).astype(np.uint64) * GOLDEN) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def walk(lat: Lattice, node: np.ndarray, key: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Draw a path from each node to its unit's end: walker, step and edge of every piece, in order of walker and step."""
    who, steps, edges, rounds = [], [], [], []
    active, length = np.flatnonzero(~lat.end[node]), np.zeros(len(node), np.int64)
    node, step = node[active], step[active]
    while len(active):
        rounds.append(np.full(len(active), len(rounds)))
        length[active] += 1
        u = uniform(key[active], step)
        e = lat.ptr[node]
        late = np.flatnonzero(u > lat.until[e])
        while len(late):
            e[late] += 1
            late = late[u[late] > lat.until[e[late]]]
        who.append(active)
        steps.append(step)
        edges.append(e)
        node = lat.target[e].astype(np.int64)
        go = ~lat.end[node]
        active, node, step = active[go], node[go], step[go] + 1
    if not who:
        return (np.zeros(0, np.int64),) * 3
    who = np.concatenate(who)
    place = (np.cumsum(length) - length)[who] + np.concatenate(rounds)
    return _placed(who, place), _placed(np.concatenate(steps), place), _placed(np.concatenate(edges), place)


def below(top: np.ndarray, mean: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel noise around ``mean`` truncated at ``top``."""
    return top - np.logaddexp(0.0, top - mean + np.log(-np.log(u)))


@dataclass
class Path:
    """One drawn path for each text that has it: its pieces in order, and what waits beside each piece."""

    text: np.ndarray  # per piece
    unit: np.ndarray  # place of the word, over all texts
    step: np.ndarray
    edge: np.ndarray
    before: np.ndarray  # log-probability of the path up to the piece
    waiting: np.ndarray  # noisy maximum of the set left behind at the piece; minus infinity if none
    noisy: np.ndarray  # per text: its own noisy value, nan if the text has no such path
    logp: np.ndarray  # per text


def _finish(lat: Lattice, n: int, text, unit, step, edge, noisy, fresh, keys, salt) -> Path:
    """Log-probabilities along the paths, and noise for the sets beside the pieces marked ``fresh``."""
    logp = lat.logp[edge]
    run = np.cumsum(logp)
    starts = np.searchsorted(text, np.arange(n))
    base = np.where(starts > 0, run[np.maximum(starts, 1) - 1], 0.0)
    before = run - logp - base[text]
    rest = -np.expm1(logp)  # share of the other pieces
    waiting = np.full(len(edge), -np.inf)
    open_ = np.flatnonzero(fresh & (rest > 1e-15))
    node = lat.source[edge[open_]]
    open_ = open_[lat.ptr[node + 1] - lat.ptr[node] > 1]
    u = uniform(keys[text[open_]] ^ salt, unit[open_] * 1048583 + step[open_])
    waiting[open_] = below(noisy[text[open_]], before[open_] + np.log(rest[open_]), u)
    total = np.bincount(text, logp, n)
    return Path(text, unit, step, edge, before, waiting, noisy, np.where(np.isnan(noisy), np.nan, total))


def _branch(lat: Lattice, edge: np.ndarray, taken: list[list[int]], draw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Another edge at the node of each ``edge``, drawn by the shares of those not taken yet, and the share of what is left then."""
    node = lat.source[edge]
    start, stop = lat.ptr[node], lat.ptr[node + 1]
    size = stop - start
    first = np.cumsum(size) - size
    share = np.exp(lat.logp[np.repeat(start - first, size) + np.arange(int(size.sum()))])
    share[first + edge - start] = 0.0
    for i, (there, own) in enumerate(zip(taken, edge.tolist())):
        for e in there:
            share[first[i] + e - start[i]] = 0.0
        there.append(own)
    total = np.add.reduceat(share, first) if len(first) else np.zeros(0)
    place, last = first.copy(), first + size - 1
    seen, late = share[place].copy(), np.arange(len(place))
    while len(late):
        late = late[(seen[late] < draw[late] * total[late]) & (place[late] < last[late])]
        place[late] += 1
        seen[late] += share[place[late]]
    while (none := np.flatnonzero((share[place] == 0) & (total > 0) & (place > first))).size:  # rounding went past the last one
        place[none] -= 1
    for there, e in zip(taken, (start + place - first).tolist()):
        there.append(e)
    share[place] = 0.0
    return start + place - first, np.add.reduceat(share, first) if len(first) else np.zeros(0)


def sample(items: list[str], keys: np.ndarray, held: Lattices, k: int = K) -> tuple[list[Path], np.ndarray, Lattice]:
    """Up to ``k`` distinct paths for every text, largest noisy value first, and per text the value of the best path not drawn."""
    found, count = [], []
    for t in items:
        words = UNITS.findall(" " + t) if t else []
        count.append(len(words))
        found += words
    n = len(items)
    lat, rows = held.of(found)
    del found
    text_of = np.repeat(np.arange(n), count)
    start_of = np.cumsum(count) - count
    local = np.arange(len(rows)) - start_of[text_of]
    keys = mix(keys.astype(np.uint64) + GOLDEN)
    unit_key = lambda salt: mix((keys ^ mix(np.array([salt], np.uint64))[0])[text_of] + local.astype(np.uint64))
    noisy = -np.log(-np.log(uniform(keys, 1)))  # all paths together weigh 1
    who, step, edge = walk(lat, lat.first[rows], unit_key(0), np.zeros(len(rows), np.int64))
    text = text_of[who]
    paths = [_finish(lat, n, text, local[who], step, edge, noisy, np.ones(len(edge), bool), keys, np.uint64(1))]
    taken: dict[tuple[int, int, int], list[int]] = {}
    while True:
        # the best waiting set of each text
        best, where, which = np.full(n, -np.inf), np.full(n, -1), np.full(n, -1)
        for p, path in enumerate(paths):
            if not len(path.edge):
                continue
            top, heads = np.full(n, -np.inf), np.flatnonzero(np.diff(path.text, prepend=-1))
            top[path.text[heads]] = np.maximum.reduceat(path.waiting, heads)
            better = top > best
            hit = np.flatnonzero(better[path.text] & (path.waiting == top[path.text]))[::-1]
            best[better], which[better] = top[better], p
            where[path.text[hit]] = hit  # the first of equal ones
        if len(paths) >= k:
            return paths, best, lat
        number = len(paths)
        noisy = np.where(np.isfinite(best), best, np.nan)
        chosen = np.flatnonzero(np.isfinite(best))
        draw = uniform(keys ^ np.uint64(7919 * number), 3)
        again = uniform(keys ^ np.uint64(7919 * number), 5)
        branch, at_unit, at_step = np.full(n, -1), np.full(n, -1), np.zeros(n, np.int64)
        for p, path in enumerate(paths):
            of = chosen[which[chosen] == p]
            j = where[of]
            branch[of], rest = _branch(lat, path.edge[j], [taken.setdefault((t, p, i), []) for t, i in zip(of.tolist(), j.tolist())], draw[of])
            at_unit[of], at_step[of] = path.unit[j], path.step[j]
            more = rest > 0
            path.waiting[j] = -np.inf
            path.waiting[j[more]] = below(best[of[more]], path.before[j[more]] + np.log(rest[more]), again[of[more]])
        # the new path: the old one up to the branch, the branch, and a fresh walk from there
        kept = []
        for p, path in enumerate(paths):
            mine = np.flatnonzero((which[path.text] == p) & (branch[path.text] >= 0))
            mine = mine[mine < where[path.text[mine]]]
            kept.append(np.stack([path.text[mine], path.unit[mine], path.step[mine], path.edge[mine], np.zeros(len(mine), np.int64)]))
        kept.append(np.stack([chosen, at_unit[chosen], at_step[chosen], branch[chosen], np.zeros(len(chosen), np.int64)]))
        go = np.flatnonzero((branch[text_of] >= 0) & (local >= at_unit[text_of]))
        here = local[go] == at_unit[text_of[go]]
        node = np.where(here, lat.target[np.maximum(branch, 0)][text_of[go]], lat.first[rows[go]])
        who, step, edge = walk(lat, node, unit_key(number)[go], np.where(here, at_step[text_of[go]] + 1, 0))
        kept.append(np.stack([text_of[go[who]], local[go[who]], step, edge, np.ones(len(who), np.int64)]))
        # of one text, the parts come in order of its path: at most one old path's start, the branch, the walk
        sizes = [np.bincount(part[0], minlength=n) for part in kept]
        free, place = np.cumsum(sum(sizes)) - sum(sizes), []
        for part, size in zip(kept, sizes):
            place.append(free[part[0]] + np.arange(part.shape[1]) - (np.cumsum(size) - size)[part[0]])
            free = free + size
        place, parts = np.concatenate(place), np.concatenate(kept, axis=1)
        parts = np.stack([_placed(row, place) for row in parts])
        paths.append(_finish(lat, n, parts[0], parts[1], parts[2], parts[3], noisy, parts[4] == 1, keys, np.uint64(number + 1)))


def piece_ids(path: Path, lat: Lattice, v: Vocabulary, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The piece ids of all texts' paths in a row, fallback characters as bytes, and the borders of the texts."""
    piece, text = lat.piece[path.edge], path.text
    odd = np.flatnonzero(piece < 0)
    if len(odd):
        codes, which = np.unique(piece[odd], return_inverse=True)
        spelled = [v.byte_ids[list(chr(-1 - c).encode())] for c in codes.tolist()]
        size_of = np.fromiter(map(len, spelled), np.int64, len(spelled))
        size = size_of[which]
        sizes = np.ones(len(piece), np.int64)
        sizes[odd] = size
        out = np.repeat(piece, sizes)
        # of each byte of a spelled character: its place in the output, and among the bytes of all codes
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        place = np.repeat(np.cumsum(sizes)[odd] - size, size) + at
        out[place] = np.concatenate(spelled)[np.repeat((np.cumsum(size_of) - size_of)[which], size) + at]
        piece, text = out, np.repeat(text, sizes)
    return piece.astype("<i4"), np.searchsorted(text, np.arange(n + 1))


def round_trips(ids: list[tuple[np.ndarray, np.ndarray]], drawn: list[np.ndarray], items: list[str], v: Vocabulary) -> list[bool]:
    """Whether all drawn samples of each text, decoded, are the text again."""
    want = [b" " + t.encode() if t else b"" for t in items]
    out = [True] * len(items)
    for (flat, border), there in zip(ids, drawn):
        raw, before = v.decoded(flat)
        place = before[border].tolist()
        for i in np.flatnonzero(there).tolist():
            out[i] = out[i] and raw[place[i]:place[i + 1]] == want[i]
    return out


# -- on the cluster -------------------------------------------------------------------------------

SAMPLES = "array<struct<ids:binary,n_pieces:int,logp:double,inclusion:double>>"
_SAMPLES = pa.list_(pa.struct([("ids", pa.binary()), ("n_pieces", pa.int32()), ("logp", pa.float64()), ("inclusion", pa.float64())]))


def _model(path: str) -> bytes:
    """The model file, read by the driver and sent with the tasks: half a megabyte, whatever the input."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, k: int = K, seed: int = SEED, model: str = MODEL) -> DataFrame:
    """doc_id, ``samples`` and ``round_trip`` of every row of ``docs`` (doc_id, text; other columns are left out).

    A sample has the piece ids (32-bit little-endian), the log-probability of the segmentation and
    its inclusion score: the probability that its noisy value exceeds that of the best segmentation
    not drawn, by which sums over the samples are weighted.  The samples are distinct, fewer than ``k`` where the text
    has no more segmentations, and depend on id, text and seed only, not on partitions or order.
    ``round_trip`` tells whether every sample, decoded, is the text again.  Null and empty texts have one empty sample; rows with equal id and text get equal samples.
    """
    data = docs.sparkSession.sparkContext.broadcast(_model(model))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", F.lit(seed)).alias("key"))

    def run(batches):
        v = _vocabulary(data.value)
        held = Lattices(v)
        for batch in slices(batches, most=SLICE):
            items, keys = texts(batch), batch.column("key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            paths, rest, lat = sample(items, keys, held, k)
            ids = [piece_ids(p, lat, v, len(items)) for p in paths]
            raw = [flat.tobytes() for flat, _ in ids]
            border = [b.tolist() for _, b in ids]
            score = [-np.expm1(-np.exp(np.minimum(p.logp - rest, 700))) for p in paths]
            out = [[{"ids": raw[j][4 * border[j][i]:4 * border[j][i + 1]], "n_pieces": border[j][i + 1] - border[j][i], "logp": float(p.logp[i]), "inclusion": float(score[j][i])}
                    for j, p in enumerate(paths) if not np.isnan(p.noisy[i])] for i in range(len(items))]
            same = round_trips(ids, [~np.isnan(p.noisy) for p in paths], items, v)
            done = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, _SAMPLES), pa.array(same)], ["doc_id", "samples", "round_trip"])
            del items, paths, rest, lat, ids, raw, border, score, out  # the next slice shall not find them in memory
            yield done

    return rows.mapInArrow(run, f"doc_id {kind}, samples {SAMPLES}, round_trip boolean")


@lru_cache(maxsize=1)
def _vocabulary(model: bytes) -> Vocabulary:
    """The vocabulary, built once in a Python worker."""
    return Vocabulary(model)


def decode(encoded: DataFrame, ids: str, model: str = MODEL) -> DataFrame:
    """``encoded`` with ``decoded``, the text of the piece ids in column ``ids`` (without the blank that encoding puts first); null stays null."""
    data = encoded.sparkSession.sparkContext.broadcast(_model(model))

    @F.pandas_udf("string")
    def run(column):
        v = _vocabulary(data.value)
        return column.map(lambda b: None if b is None else v.decode(np.frombuffer(b, "<i4").tolist())[1:])

    return encoded.withColumn("decoded", run(F.col(ids)))


def digest(encoded: DataFrame) -> DataFrame:
    """doc_id, number of samples, sizes, digests, log-probabilities and inclusion scores in order of the draws, round_trip."""
    each = lambda f: F.transform("samples", f)
    return encoded.select("doc_id", F.size("samples").alias("n_samples"), each(lambda s: s["n_pieces"]).alias("n_pieces"), each(lambda s: F.sha2(s["ids"], 256)).alias("ids_sha256"),
                       each(lambda s: s["logp"]).alias("logp"), each(lambda s: s["inclusion"]).alias("inclusion"), "round_trip")
