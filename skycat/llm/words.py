"""Hashes of words and of word shingles, for many texts at once in numpy."""

from __future__ import annotations

import numpy as np

from .common import mix

_SPACE = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    return table


def _spaced() -> np.ndarray:
    """A byte's place in the word alphabet, 0 for white space; A-Z count as a-z."""
    table = _lower().astype(np.int64) + 1
    table[_SPACE] = 0
    return table


def _plain() -> np.ndarray:
    """Like ``_spaced``, but all ASCII characters other than letters and digits separate words."""
    table = _lower().astype(np.int64) + 1
    for i in range(128):
        if not chr(i).isalnum():
            table[i] = 0
    return table


SPACED, PLAIN = _spaced(), _plain()
_VALUES = np.concatenate([np.zeros(1, np.uint64), mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))])
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2 ** 64
_BACK = pow(_BASE, -1, 1 << 64)


BLOCK = 1 << 20  # bytes hashed at once
KEEP = 1 << 21  # powers that stay in memory


class Powers:
    """Powers of the base and of its inverse, as far as they have been needed, up to ``KEEP``; more are made anew."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) >= n:
            return self.up[:n], self.down[:n]
        size = max(n, 1 << 20)
        up, down = (np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (_BASE, _BACK))
        if size <= KEEP:
            self.up, self.down = up, down
        return up[:n], down[:n]


POWERS = Powers()


def _blocks(data: np.ndarray, table: np.ndarray):
    """Borders of blocks of about ``BLOCK`` bytes that end behind a separator; the last byte is one."""
    at = 0
    while at < len(data):
        stop, step = min(at + BLOCK, len(data)), 4096
        while stop < len(data) and table[data[stop - 1]]:
            found = np.flatnonzero(table[data[stop:stop + step]] == 0)
            stop += int(found[0]) + 1 if len(found) else min(step, len(data) - stop)
            step *= 2
        yield at, stop
        at = stop


def word_hashes(items: list[str], table: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and for each text the number of words before it (one entry more than texts)."""
    raw = [x.encode("utf-8", "surrogatepass") for x in items]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    hashes, places = [], []
    for at, stop in _blocks(data, table):
        letters = table[data[at:stop]]
        edge = np.flatnonzero(np.diff(letters > 0, prepend=False))  # the last byte separates, so starts and ends alternate
        starts, ends = edge[0::2], edge[1::2]
        up, down = POWERS.to(stop - at)
        total = np.zeros(stop - at + 1, np.uint64)
        np.cumsum(_VALUES[letters] * up, out=total[1:])
        hashes.append(mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
        places.append(starts + at)
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), np.concatenate([[0], np.cumsum(sizes)]))


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words, over text borders too."""
    out = np.full(max(0, len(hashes) - n + 1), n, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i:len(hashes) - n + 1 + i])
    return out


def shingle_sets(items: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``n``-word shingles; a text of fewer words has one shingle, one without words none."""
    hashes, at = word_hashes(items)
    runs, out = chained(hashes, n), []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= n:
            out.append(np.unique(runs[a:b - n + 1]))
        else:
            out.append(chained(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out
