"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is logistic in its
words and their stems, a document's is the noisy-or of its sentences: it is toxic if at least
one sentence is. The weights are learned from document labels alone, and the
sentence probabilities then tell where the offence stands.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelweave.llm import textvec as tv
from panelweave.llm.arrow import map_batches, texts, written

#: Words and their beginnings are hashed to two to this many cells; cell 0 stands for none.
BITS = 20
#: Lengths in bytes of the beginnings that tell words of one stem.
STEMS = (4, 5, 6, 7, 8)
#: Training documents of either label at most, and words of one at most.
SAMPLE, LONGEST = 3000, 4096
IS_END = np.zeros(256, bool)
IS_END[list(b".!?\n")] = True


def held_out(key: str = "doc_id") -> Column:
    """True for the fifth of the ids that never serve to learn; false for a null id."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def sentences(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells of all words, a row for the words and one per stem length; index of each sentence's first word; each text's first sentence; begins and ends in bytes.

    A sentence goes to a full stop, exclamation or question mark, line end or
    the text's end, and has a word. Words are letter-and-digit runs, A-Z lowered.
    """
    starts, ends, first = tv.words(data, offs, tv.IS_ALNUM)
    whole, heads = tv.hashes(tv.LOWER[data], starts, ends, STEMS)
    cell = (np.vstack((whole[None], heads)) >> np.uint64(64 - BITS)).astype(np.int32)
    part = np.searchsorted(np.flatnonzero(IS_END[data]), starts)
    new = np.ones(len(starts), bool)
    new[1:] = part[1:] != part[:-1]
    new[first[:-1][first[:-1] < len(starts)]] = True
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(starts)) - 1
    own = np.searchsorted(begin, first)
    base = np.repeat(offs[:-1], np.diff(own))
    return cell, begin, own, starts[begin] - base, (ends[last] if len(ends) else ends) - base


@dataclass
class Model:
    """Cells with a weight, their weights, and the weight of every sentence."""

    cells: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        dense = np.zeros(1 << BITS, np.float32)
        dense[self.cells] = self.weights
        dense[0] = 0
        return dense


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, weight: np.ndarray, steps: int = 200) -> Model:
    """Learns from bags of (cells, first word of each sentence) and document labels.

    Words and stems that stand in clearly more toxic documents get a weight,
    and so do the words that have such a stem, which may be harmless. Weights
    follow the weighted noisy-or likelihood with a quadratic penalty.
    """
    nothing = Model(np.empty(0, np.int64), np.empty(0), -30.0)
    if not len(bags) or toxic.min() == toxic.max():
        return nothing
    count = np.zeros((2, 1 << BITS))
    for (cells, _), y in zip(bags, toxic):
        count[int(y), np.unique(cells)] += 1
    n = np.array([(~toxic).sum(), toxic.sum()])
    rate = (count + 0.5) / (n[:, None] + 1)
    pooled = (count.sum(0) + 1) / (n.sum() + 2)
    z = (rate[1] - rate[0]) / np.sqrt(pooled * (1 - pooled) * (1 / n[0] + 1 / n[1]))
    clear = (z > 4) & (count[1] >= 3)
    clear[0] = False
    if not clear.any():
        return nothing
    odds = np.where(clear, np.log(rate[1]) - np.log(rate[0]), 0.0)
    tied = np.concatenate([cells[0, clear[cells[1:]].any(0)] for cells, _ in bags])
    clear[tied[count.sum(0)[tied] >= 3]] = True
    clear[0] = False
    chosen = np.flatnonzero(clear)
    odds = odds[chosen] / len(STEMS)
    place = np.full(1 << BITS, -1)
    place[chosen] = np.arange(len(chosen))
    sizes = np.array([len(b) for _, b in bags])
    edge = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    doc = np.repeat(np.arange(len(bags)), sizes)
    rows, cols, at = [], [], 0
    for cells, begin in bags:
        for word in place[cells]:
            hit = np.flatnonzero(word >= 0)
            rows.append(at + np.searchsorted(begin, hit, "right") - 1)
            cols.append(word[hit])
        at += len(begin)
    rows, cols = np.concatenate(rows), np.concatenate(cols)
    theta = np.append(odds, -np.log(sizes.mean()) - 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    penalty = np.append(np.full(len(chosen), 1e-4), 0.0)
    for step in range(1, steps + 1):
        s = np.bincount(rows, theta[:-1][cols], minlength=len(doc)) + theta[-1]
        none = np.add.reduceat(_softplus(s), edge)  # minus the log chance of no toxic sentence
        p = -np.expm1(-none)
        pull = np.where(toxic, -np.exp(-none) / np.maximum(p, 1e-9), 1.0) * weight
        each = pull[doc] / (1 + np.exp(-s))
        grad = np.append(np.bincount(cols, each[rows], minlength=len(chosen)), each.sum()) / weight.sum()
        grad += penalty * theta
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        theta = theta - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Model(chosen, theta[:-1], float(theta[-1]))


def learn(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, longest: int = LONGEST
) -> Model:
    """Fits on at most ``sample`` labelled documents of either label, none held out.

    They are taken in the order of a hash of the key; documents of equal text
    count once. Those of over ``longest`` words, or 64 times as many characters,
    do not serve to learn; they are scored like others. Documents weigh
    as much as their label's share of all labelled rows. An id labelled twice
    is toxic if one of its labels says so.
    """
    marks = labels.where(F.col(key).isNotNull() & F.col("toxic").isNotNull() & ~held_out(key))
    marks = marks.groupBy(F.col(key).alias("__key")).agg(F.max("toxic").alias("toxic"))
    totals = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    order = [F.xxhash64("__key"), "__key"]
    picked = [marks.where(F.col("toxic") == y).orderBy(*order).limit(sample) for y in (0, 1)]
    picked = written(picked[0].unionByName(picked[1]), "sample")
    known = docs.select(F.col(key), texts(docs, text)).join(picked, F.col(key) == F.col("__key"))

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        lists = lambda parts: pa.array(parts, pa.list_(pa.int32()))
        for lo, hi, data, offs in tv.slices(batch.column(0)):
            cell, begin, own, _, _ = sentences(data, offs)
            edge = np.append(begin, cell.shape[1])[own]
            span = [slice(a, b) for a, b in zip(edge[:-1], edge[1:])]
            keep = np.diff(edge) <= longest
            columns = {
                "toxic": batch.column(1)[lo:hi],
                "print": pa.array([int(tv.mix(tv.rolled(cell[0, s].astype(np.uint64), s.stop - s.start)).view(np.int64)[0]) if s.stop > s.start else 0 for s in span]),
                "cells": lists([cell[:, s].ravel() for s in span]),
                "begins": lists([(begin[a:b] - c).astype(np.int32) for a, b, c in zip(own[:-1], own[1:], edge[:-1])]),
            }
            yield {n: c.filter(pa.array(keep)) for n, c in columns.items()}

    schema = "toxic int, print bigint, cells array<int>, begins array<int>"
    short = F.length("text") <= 64 * longest
    made = map_batches(known.where(short), ["text", F.col("toxic").cast("int").alias("toxic")], make, schema).toArrow()
    seen, bags, toxic = set(), [], []
    for y, mark, cells, begins in zip(*(made.column(n) for n in ("toxic", "print", "cells", "begins"))):
        if mark.as_py() not in seen and len(cells.values):
            seen.add(mark.as_py())
            bags.append((cells.values.to_numpy().reshape(1 + len(STEMS), -1), begins.values.to_numpy()))
            toxic.append(y.as_py() == 1)
    toxic = np.array(toxic, bool)
    counts = np.maximum(np.array([(~toxic).sum(), toxic.sum()]), 1)
    weight = np.array([totals.get(0, 0), totals.get(1, 0)]) / counts
    return fit(bags, toxic, weight[toxic.astype(int)] if len(toxic) else np.empty(0))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``score`` and ``predicted`` of every document, and where its toxic sentences stand.

    ``offending`` lists the sentences of probability 0.5 or more as begin:end
    in UTF-8 bytes; ``worst`` is the highest sentence probability. Null and
    empty texts have no sentence and score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        dense, bias = shared.value.table(), shared.value.bias
        for lo, hi, data, offs in tv.slices(batch.column(1)):
            cell, begin, own, left, right = sentences(data, offs)
            each = dense[cell].sum(0, dtype=float)
            s = np.add.reduceat(each, begin) + bias if len(begin) else np.empty(0)
            p = 1 / (1 + np.exp(-s))
            total = np.concatenate(([0.0], np.cumsum(_softplus(s))))
            made = -np.expm1(total[own[:-1]] - total[own[1:]])
            worst = np.zeros(hi - lo)
            np.maximum.at(worst, tv.owners(own), p)
            bad = np.flatnonzero(p >= 0.5)
            lists = [[] for _ in range(hi - lo)]
            for i, d in zip(bad.tolist(), tv.owners(own)[bad].tolist()):
                lists[d].append(f"{left[i]}:{right[i]}")
            yield {
                key: batch.column(0)[lo:hi],
                "score": made,
                "predicted": (made >= 0.5).astype(np.int32),
                "worst": worst,
                "offending": [",".join(x) for x in lists],
            }

    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, score double, predicted int, worst double, offending string"
    return map_batches(docs, [key, texts(docs, text)], make, schema).withColumn("held_out", held_out(key))


def judge(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, longest: int = LONGEST
) -> DataFrame:
    """Learns from the labels, within the bounds ``sample`` and ``longest``, and scores every document."""
    return score(docs, learn(docs, labels, key, text, sample, longest), key, text)
