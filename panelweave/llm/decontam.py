"""Benchmark decontamination by spaced-seed hashing.

A mask keeps some token positions of a short span and ignores the rest, so a
substituted token only spoils the masks that keep its position. The hashes of
benchmark items and documents are joined; around every hit the two token
sequences are laid side by side and their equal tokens counted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelweave.llm import textvec as tv
from panelweave.llm.arrow import map_batches, texts, written
from panelweave.operators.groups import null_safe_join

#: Kept positions. Together they hit every window of 15 tokens with up to 3 substitutions.
MASKS = ((0, 2, 3, 5, 6, 7), (0, 2, 6, 7, 8, 10), (0, 2, 3, 7, 8, 9), (0, 1, 2, 3, 4, 7))
WINDOW, PERCENT = 15, 80
SPAN = 1 + max(map(max, MASKS))
#: Items of fewer tokens are too short for these masks and have their own.
LEAST = 12
#: The filter of benchmark hashes has two to this many bits, whatever the benchmark's size.
BITS = 27


def short_masks(n: int) -> list[tuple[int, tuple[int, ...]]]:
    """Masks for a whole item of n tokens, moved to begin at 0, each with the place in the item that it begins at.

    With ``wrong`` differing tokens allowed, positions fall into ``wrong + 2``
    classes in turn, and a mask keeps two of them: some mask keeps no wrong one.
    """
    classes = n - -(-n * PERCENT // 100) + 2
    kept = [[o for o in range(n) if o % classes in pair] for pair in combinations(range(classes), 2)]
    return [(k[0], tuple(o - k[0] for o in k)) for k in kept]


SHORT = {n: short_masks(n) for n in range(1, LEAST)}
#: Enters a mask's hashes, so that those of different masks differ.
NUMBERS = {mask: i + 1 for i, mask in enumerate(dict.fromkeys([*MASKS, *[m for n in SHORT for _, m in SHORT[n]]]))}


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the letter-and-digit runs, A-Z lowered, and the index of each text's first."""
    starts, ends, first = tv.words(data, offs, tv.IS_ALNUM)
    return tv.hashes(tv.LOWER[data], starts, ends), first


def _hashed(h: np.ndarray, at: np.ndarray | slice, n: int, mask: tuple[int, ...]) -> np.ndarray:
    """Hashes of a mask at the first n token positions, or at those of ``at`` among them."""
    made = np.full(n, NUMBERS[mask], np.uint64)[at]
    for o in mask:
        made *= np.uint64(tv.BASE)
        made += h[o : o + n][at]
    return made


def seeds(
    h: np.ndarray, first: np.ndarray, masks: Sequence[tuple[int, ...]] = MASKS
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per mask: token positions at which it fits in a text, and its hashes there."""
    owner = tv.owners(first)
    for mask in masks:
        n = len(h) - mask[-1]
        if n <= 0:
            continue
        made = _hashed(h, slice(None), n, mask)
        at = np.flatnonzero(first[1:][owner[:n]] - np.arange(n) > mask[-1])
        yield at, tv.mix(made[at])


def _seeds_of_items(h: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Distinct hashes of each text as an item: of all places if it is long, else of its own masks."""
    size, owner = np.diff(first), tv.owners(first)
    of, made = [np.empty(0, np.int64)], [h[:0]]
    for at, found in seeds(h, first):
        long = size[owner[at]] >= LEAST
        of.append(owner[at[long]])
        made.append(found[long])
    for n in SHORT:
        which = np.flatnonzero(size == n)
        for begin, mask in SHORT[n] if len(which) else ():
            of.append(which)
            made.append(tv.mix(_hashed(h, first[which] + begin, len(h) - mask[-1], mask)))
    of, made = np.concatenate(of), np.concatenate(made)
    return [np.unique(made[of == i]) for i in range(len(size))]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    edge = pa.array(np.concatenate(([0], np.cumsum([len(p) for p in parts]))), pa.int32())
    values = np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(edge, pa.array(values, pa.int64()))


def item_seeds(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """``item``, its ``tokens`` and its distinct ``seeds``."""

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        for lo, hi, data, offs in tv.slices(batch.column(1)):
            h, first = tokens(data, offs)
            yield {
                item: batch.column(0)[lo:hi],
                "tokens": _lists([h[a:b] for a, b in zip(first[:-1], first[1:])]),
                "seeds": _lists(_seeds_of_items(h, first)),
            }

    kind = items.schema[item].dataType.simpleString()
    schema = f"{item} {kind}, tokens array<bigint>, seeds array<bigint>"
    return map_batches(items, [item, texts(items, text)], make, schema)


def _filter(hashes: DataFrame):
    """Broadcast bitmap of the ``seed`` column: two to the ``BITS`` bits, gathered as set words."""
    cell = F.shiftrightunsigned("seed", 64 - BITS)
    words = hashes.select(F.shiftrightunsigned(cell, 5).alias("word"), (cell % 32).cast("int").alias("bit"))
    words = words.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit)) as set"))
    table = words.toArrow()
    bitmap = np.zeros(1 << (BITS - 5), np.uint32)
    bitmap[table.column("word").to_numpy()] = table.column("set").to_numpy().astype(np.uint32)
    return hashes.sparkSession.sparkContext.broadcast(bitmap)


def _regions(docs: DataFrame, bitmap, masks: Sequence[tuple[int, ...]], key: str, text: str) -> DataFrame:
    """Stretches of documents around hashes of the masks that the filter lets through.

    One row per stretch: key, ``start`` (token number), ``tokens`` from one
    window before its first hit to one after its last, and distinct ``seeds``.
    """

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        for lo, hi, data, offs in tv.slices(batch.column(1)):
            h, first = tokens(data, offs)
            at, made = [], []
            for a, m in seeds(h, first, masks):
                cell = m >> np.uint64(64 - BITS)
                bit = bitmap.value[(cell >> np.uint64(5)).astype(np.int64)] >> (cell & np.uint64(31)).astype(np.uint32)
                hit = np.flatnonzero(bit & np.uint32(1))
                at.append(a[hit])
                made.append(m[hit])
            if not sum(map(len, at)):
                continue
            at, made = np.concatenate(at), np.concatenate(made)
            order = np.argsort(at, kind="stable")
            at, made = at[order], made[order]
            of = tv.owners(first)[at]
            cut = np.flatnonzero((np.diff(at) > 2 * WINDOW) | (np.diff(of) > 0)) + 1
            begin, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(at)]))
            of = of[begin]
            left = np.maximum(at[begin] - WINDOW, first[of])
            right = np.minimum(at[end - 1] + SPAN + WINDOW, first[of + 1])
            yield {
                key: batch.column(0)[lo:hi].take(pa.array(of)),
                "start": left - first[of],
                "tokens": _lists([h[a:b] for a, b in zip(left, right)]),
                "seeds": _lists([np.unique(made[a:b]) for a, b in zip(begin, end)]),
            }

    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, start bigint, tokens array<bigint>, seeds array<bigint>"
    return map_batches(docs, [key, texts(docs, text)], make, schema)


def best_overlap(a: np.ndarray, b: np.ndarray, window: int = WINDOW, percent: int = PERCENT) -> tuple[int, int, int]:
    """Most equal tokens in a window of the two sequences side by side, and its places in both.

    A sequence ``b`` shorter than the window is its own window. (0, 0, 0) if
    no window reaches ``percent``.
    """
    window = min(window, len(b))
    need = -(-window * percent // 100)
    order = np.argsort(b, kind="stable")
    low, high = np.searchsorted(b[order], a, "left"), np.searchsorted(b[order], a, "right")
    count = high - low
    i = np.repeat(np.arange(len(a)), count)
    j = order[np.repeat(low - np.cumsum(count) + count, count) + np.arange(len(i))]
    turn = i - j
    rank = np.lexsort((i, turn))
    i, j, turn = i[rank], j[rank], turn[rank]
    best = (0, 0, 0)
    cut = np.flatnonzero(np.diff(turn)) + 1
    for lo, hi in zip([0, *cut], [*cut, len(turn)]):
        if hi - lo < need:
            continue
        at = i[lo:hi]
        inside = np.searchsorted(at, at + window) - np.arange(hi - lo)
        k = int(inside.argmax())
        if inside[k] >= need and inside[k] > best[0]:
            best = (int(inside[k]), int(at[k]), int(j[lo + k]))
    return best


def leaks(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """Pairs of a document and a benchmark item with a common passage.

    A passage is a window of 15 tokens (or a whole shorter item) of which at
    least 80 percent agree in place. Gives key, item, ``matched`` (most equal
    tokens in a window), ``doc_token`` and ``item_token`` (where the first such
    window begins). Items of fewer than 5 tokens have to agree whole; null and
    empty texts have no tokens. Rows repeated under one key or item count
    as one, and null keys or items match as keys of their own.
    """
    made = written(item_seeds(items, item, text), "items")
    hashes = made.select(F.col(item), F.explode("seeds").alias("seed")).distinct()
    # documents are hashed only by masks that some item has
    lengths = made.select(F.size("tokens").alias("n")).where(F.col("n").between(1, LEAST - 1)).distinct().collect()
    masks = list(dict.fromkeys([*MASKS, *[mask for (n,) in sorted(lengths) for _, mask in SHORT[n]]]))
    regions = written(_regions(docs, _filter(hashes), masks, key, text), "regions")
    hits = regions.select(key, "start", F.explode("seeds").alias("seed"))
    met = hits.join(hashes, "seed").select(key, "start", item).distinct()
    place = met.withColumnsRenamed({key: "__key", "start": "__start"})
    pairs = null_safe_join(regions.drop("seeds"), place, {key: "__key", "start": "__start"}, "inner").distinct()
    whole = made.select(F.col(item).alias("__item"), F.col("tokens").alias("item_tokens"))
    pairs = null_safe_join(pairs, whole, {item: "__item"}, "inner")

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        get = lambda column, i: column[i].values.to_numpy()
        a, b = batch.column("tokens"), batch.column("item_tokens")
        found = np.array([best_overlap(get(a, i), get(b, i)) for i in range(len(a))], np.int64).reshape(-1, 3)
        keep = pa.array(found[:, 0] > 0)
        columns = {
            key: batch.column(key),
            item: batch.column(item),
            "matched": pa.array(found[:, 0]),
            "doc_token": pa.array(batch.column("start").to_numpy() + found[:, 1]),
            "item_token": pa.array(found[:, 2]),
        }
        yield {n: c.filter(keep) for n, c in columns.items()}

    kinds = [f"{c} {df.schema[c].dataType.simpleString()}" for df, c in ((docs, key), (items, item))]
    schema = ", ".join([*kinds, "matched bigint", "doc_token bigint", "item_token bigint"])
    found = map_batches(pairs, [key, "start", "tokens", item, "item_tokens"], make, schema)
    best = F.max(F.struct("matched", (-F.col("doc_token")).alias("d"), (-F.col("item_token")).alias("i"))).alias("m")
    return (
        found.groupBy(key, item)
        .agg(best)
        .select(key, item, "m.matched", (-F.col("m.d")).alias("doc_token"), (-F.col("m.i")).alias("item_token"))
    )
