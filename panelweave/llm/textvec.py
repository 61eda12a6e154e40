"""Words, lines and shingles of Arrow text columns as numpy arrays.

A column is worked through in slices of about ``BLOCK`` bytes, so temporaries
stay small whatever the length of a batch; only a single text longer than that
makes a larger slice. Tokens are byte ranges of the slice; their 64-bit hashes
come from prefix sums of a polynomial, without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Temporaries take some 65 times as many bytes, and a Python worker keeps much of what it has touched.
BLOCK = 1 << 17
BASE = 0x9E3779B97F4A7C15
U64 = np.uint64

#: Bytes that separate words: space, and tab to carriage return.
SPACES = b" \t\n\x0b\x0c\r"
IS_WORD = np.ones(256, bool)
IS_WORD[list(SPACES)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Letters and digits, and all bytes of characters beyond ASCII.
IS_ALNUM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * BLOCK)
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                table = np.full(size, base, U64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))
        return self.up, self.down


POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser on 64-bit values; returns a new array."""
    h = h ^ (h >> U64(33))
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, bytes and offsets (from 0) of each slice; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + BLOCK, "right")) - 1)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def runs(mask: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal true runs, cut where a text begins."""
    n = len(mask)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begin = mask.copy()
    begin[1:] &= ~mask[:-1]
    end = mask.copy()
    end[:-1] &= ~mask[1:]
    inner = offs[1:-1]
    at = inner[inner < n]
    begin[at] = mask[at]
    at = inner[inner > 0] - 1
    end[at] = mask[at]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def count_in(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How many bytes of each text the mask marks."""
    return np.diff(np.searchsorted(np.flatnonzero(mask), offs))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, cuts: tuple[int, ...] = ()):
    """64-bit hash of each byte range; ranges are in order and do not overlap.

    With ``cuts`` also a row per cut with the hashes of the ranges' first so
    many bytes, different from every range's own; 0 where a range is no longer.
    """
    out = np.empty(len(starts), U64)
    heads = np.zeros((len(cuts), len(starts)), U64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + BLOCK, "right")))
        base = int(starts[a])
        part = data[base : int(ends[b - 1])].astype(U64)
        up, down = POWERS.to(len(part) + 1)
        part += U64(1)
        part *= up[: len(part)]
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(part, out=total[1:])
        s, e = starts[a:b] - base, ends[a:b] - base
        out[a:b] = (total[e] - total[s]) * down[s]
        for row, n in zip(heads, cuts):
            longer = np.flatnonzero(e - s > n)
            at = s[longer]
            row[a + longer] = mix(((total[at + n] - total[at]) * down[at]) ^ U64(n << 56))
        a = b
    out = mix(out)
    return (out, heads) if cuts else out


def words(data: np.ndarray, offs: np.ndarray, kind: np.ndarray = IS_WORD):
    """Starts, ends and, per text, the index of its first word (one more at the end)."""
    starts, ends = runs(kind[data], offs)
    return starts, ends, np.searchsorted(starts, offs)


def owners(first: np.ndarray) -> np.ndarray:
    """Text number of each item, from the index of each text's first item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def rolled(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` neighbours, without regard to text ends."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    out = h[:n].copy()
    for j in range(1, k):
        out *= U64(BASE)
        out += h[j : j + n]
    return mix(out)


def windows(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Index and hash of every run of ``k`` items that stays inside its text."""
    made = rolled(h, k)
    owner = owners(first)[: len(made)]
    at = np.flatnonzero(first[1:][owner] - np.arange(len(made)) >= k)
    return at, made[at]


def repeated(owner: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two masks: values found again in the same text, and all but one of each such value."""
    key = h ^ mix(owner.astype(U64) + U64(1))
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    again, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
    later[order[1:]] = same
    again[order[1:]] |= same
    again[order[:-1]] |= same
    return again, later


def covered(at: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask of the items inside a run of ``width`` that begins at one of ``at``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.subtract.at(edge, np.minimum(at + width, n), 1)
    return np.cumsum(edge[:n]) > 0


def distinct_sets(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values, sorted, and the index where each text's set begins."""
    parts = [np.unique(h[a:b]) for a, b in zip(first[:-1], first[1:])]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return (np.concatenate(parts) if parts else h[:0]), np.concatenate(([0], np.cumsum(sizes)))


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per slice: first row, end row, and the texts' distinct ``k``-word shingles.

    A-Z are lowered. A text with fewer words has its whole sequence as the one
    shingle; a text without words has none.
    """
    for lo, hi, data, offs in slices(column):
        starts, ends, first = words(data, offs)
        h = hashes(LOWER[data], starts, ends)
        at, made = windows(h, first, k)
        begin = np.searchsorted(at, first)
        short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < k))
        if len(short):
            whole = np.array([rolled(h[first[i] : first[i + 1]], first[i + 1] - first[i])[0] for i in short], U64)
            whole ^= mix(np.diff(first)[short].astype(U64))
            made = np.insert(made, begin[short], whole)
            begin = np.concatenate(([0], np.cumsum(np.diff(begin) + np.isin(np.arange(hi - lo), short))))
        yield lo, hi, *distinct_sets(made, begin)
