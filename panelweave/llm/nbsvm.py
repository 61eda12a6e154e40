"""Quality classifier: naive Bayes log-count ratios scale n-gram indicators for a linear support vector machine.

An n-gram that stands in a document counts once. Its class ratio, the logarithm
of its smoothed share among good documents over that among bad ones, scales its
indicator; a document's scaled indicators have length one. A hinge-loss model is
fitted to them by dual coordinate descent, and its margins become probabilities
through a logistic curve fitted to margins of documents the model had not seen.

N-grams are words and word pairs, and runs of one to three word shapes: which
kinds of characters a word begins and ends with, its length, and whether it
repeats the word before. Shapes tell junk whose words were never seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelweave.llm import textvec as tv
from panelweave.llm.arrow import map_batches, texts, written
from panelweave.llm.toxicity import held_out

#: N-grams are hashed to two to this many cells.
BITS = 20
#: Training documents of either label at most, and words of one at most.
SAMPLE, LONGEST = 2500, 2048
#: Smoothing of the counts, and the penalty on a document's margin.
SMOOTH, PENALTY = 1.0, 1.0
#: Share of rows labelled good, as ``predicted`` reads the score.
THRESHOLD = 0.3
FOLDS = 3
#: Kind of each byte in a shape: letters and digits by class, a punctuation sign as itself.
KIND = np.arange(256, dtype=np.uint64)
KIND[48:58], KIND[65:91], KIND[97:123], KIND[128:192], KIND[192:] = 1, 2, 3, 4, 5


def cells(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells of each text, sorted, and where each text's begin (one more at the end)."""
    starts, ends, first = tv.words(data, offs)
    n = len(starts)
    if not n:
        return np.empty(0, np.int32), np.zeros(len(offs), np.int64)
    word = tv.hashes(data, starts, ends)
    owner = tv.owners(first)
    same = np.zeros(n, bool)
    same[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    at = lambda place: KIND[data[np.clip(place, starts, ends - 1)]]
    shape = np.zeros(n, np.uint64)
    for part in (at(starts), at(starts + 1), at(ends - 3), at(ends - 2), at(ends - 1), np.minimum(ends - starts, 12).astype(np.uint64), same.astype(np.uint64)):
        shape = shape * np.uint64(257) + part
    shape = tv.mix(shape)
    made, own = [], []
    for salt, (base, k) in enumerate(((word, 1), (word, 2), (shape, 1), (shape, 2), (shape, 3))):
        place, h = tv.windows(base, first, k)
        made.append(tv.mix(h ^ np.uint64((salt + 1) << 40)) >> np.uint64(64 - BITS))
        own.append(owner[place])
    key = np.unique((np.concatenate(own).astype(np.uint64) << np.uint64(BITS)) | np.concatenate(made))
    return (key & np.uint64((1 << BITS) - 1)).astype(np.int32), np.searchsorted(key, np.arange(len(offs), dtype=np.uint64) << np.uint64(BITS))


def ratios(rows: list[np.ndarray], good: np.ndarray, smooth: float = SMOOTH) -> np.ndarray:
    """Log-count ratio of every cell: smoothed share among good documents over that among bad ones."""
    count = np.full((2, 1 << BITS), smooth)
    for row, y in zip(rows, good):
        count[int(y), row] += 1
    log = np.log(count / count.sum(1, keepdims=True))
    ratio = log[1] - log[0]
    ratio[(count == smooth).all(0)] = 0  # never seen: no evidence
    return ratio


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, penalty: float = PENALTY, rounds: int = 60, close: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights, the bias last, and dual variables of the hinge-loss machine.

    Minimises half the squared weights plus ``penalty`` times the summed hinge
    losses; one dual variable after the other is set to its best value between
    0 and ``penalty``, in a fresh order each round, until none would move by
    more than ``close`` in gradient. ``y`` is 1 or -1; the bias is a feature of value 1.
    """
    w, alpha = np.zeros(size + 1), np.zeros(len(y))
    square = np.array([float(v @ v) + 1 for v in values])
    order = np.random.default_rng(1)
    for _ in range(rounds):
        worst = 0.0
        for i in order.permutation(len(y)):
            row, v = rows[i], values[i]
            gradient = y[i] * (w[row] @ v + w[-1]) - 1
            held = min(gradient, 0) if alpha[i] <= 0 else max(gradient, 0) if alpha[i] >= penalty else gradient
            if held:
                worst = max(worst, abs(held))
                moved = min(max(alpha[i] - gradient / square[i], 0), penalty) - alpha[i]
                alpha[i] += moved
                w[row] += moved * y[i] * v
                w[-1] += moved * y[i]
        if worst < close:
            break
    return w, alpha


@dataclass
class Model:
    """Per cell the squared ratio and the weight times the ratio; bias, and slope and offset of the logistic curve."""

    cells: np.ndarray
    square: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    offset: float

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        square, weight = np.zeros(1 << BITS), np.zeros(1 << BITS)
        square[self.cells], weight[self.cells] = self.square, self.weight
        return square, weight

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500)))


def _scaled(rows: list[np.ndarray], ratio: np.ndarray) -> list[np.ndarray]:
    out = []
    for row in rows:
        v = ratio[row]
        size = np.sqrt(v @ v)
        out.append(v / size if size else v)
    return out


def _margins(rows: list[np.ndarray], ratio: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.array([w[row] @ v + w[-1] for row, v in zip(rows, _scaled(rows, ratio))])


def logistic(margin: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of the weighted logistic curve, by Newton steps with a small penalty on the slope."""
    theta, x = np.zeros(2), np.stack((margin, np.ones(len(margin))), 1)
    keep = np.diag([1e-3 * weight.sum() / max(len(weight), 1), 1e-9])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -500, 500)))
        pull = x.T @ (weight * (p - good)) + keep @ theta
        bend = x.T @ (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]) + keep
        step = np.linalg.solve(bend, pull)
        theta = theta - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(theta[0]), 0.0), float(theta[1])


def fit(rows: list[np.ndarray], good: np.ndarray, weight: np.ndarray, smooth: float = SMOOTH, penalty: float = PENALTY) -> Model:
    """Learns from the documents' cells and labels; ``weight`` makes up for unequal sampling of the labels.

    With one label only, or none, every document scores that label's share.
    """
    if not len(rows) or good.min() == good.max():
        share = 0.5 if not len(rows) else float(good[0])
        return Model(np.empty(0, np.int64), np.empty(0), np.empty(0), 0.0, 0.0, float(np.log((share + 0.01) / (1.01 - share))))
    y = np.where(good, 1.0, -1.0)
    pick = lambda items, mask: [items[i] for i in np.flatnonzero(mask)]
    margin, fold = np.zeros(len(rows)), np.arange(len(rows)) % FOLDS
    for k in range(FOLDS):
        seen = fold != k
        if not seen.any() or seen.all() or good[seen].min() == good[seen].max():
            continue
        ratio = ratios(pick(rows, seen), good[seen], smooth)
        w, _ = descend(pick(rows, seen), _scaled(pick(rows, seen), ratio), y[seen], 1 << BITS, penalty)
        margin[~seen] = _margins(pick(rows, ~seen), ratio, w)
    ratio = ratios(rows, good, smooth)
    w, _ = descend(rows, _scaled(rows, ratio), y, 1 << BITS, penalty)
    held = np.flatnonzero(ratio)
    return Model(held, ratio[held] ** 2, w[held] * ratio[held], float(w[-1]), *logistic(margin, good, weight))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, longest: int = LONGEST) -> Model:
    """Fits on at most ``sample`` labelled documents of either label, none held out.

    They are taken in the order of a hash of the key; documents of over
    ``longest`` words or 64 times as many characters take no part in the fit, so
    that the driver holds at most 2 * sample * 5 * longest cells of 4 bytes. Documents
    weigh as much as their label's share of all labelled rows. An id labelled
    twice is good only if none of its labels is bad; null labels do not count.
    """
    marks = labels.where(F.col(key).isNotNull() & F.col("quality").isin(0, 1) & ~held_out(key))
    marks = marks.groupBy(F.col(key).alias("__key")).agg(F.min("quality").cast("int").alias("good"))
    totals = {r["good"]: r["count"] for r in marks.groupBy("good").count().collect()}
    order = [F.xxhash64("__key"), "__key"]
    picked = [marks.where(F.col("good") == y).orderBy(*order).limit(sample) for y in (0, 1)]
    picked = written(picked[0].unionByName(picked[1]), "sample")
    known = docs.select(F.col(key), texts(docs, text)).join(picked, F.col(key) == F.col("__key"))

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        for lo, hi, data, offs in tv.slices(batch.column(1)):
            made, edge = cells(data, offs)
            _, _, first = tv.words(data, offs)
            column = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(made))
            keep = pa.array(np.diff(first) <= longest)
            yield {n: c.filter(keep) for n, c in (("key", batch.column(0)[lo:hi]), ("good", batch.column(2)[lo:hi]), ("cells", column))}

    short = known.where(F.length("text") <= 64 * longest).select(F.col("__key").cast("string").alias("key"), "text", "good")
    made = map_batches(short, ["key", "text", "good"], make, "key string, good int, cells array<int>").toArrow()
    made = made.sort_by("key")  # the fit does not hang on the order in which tasks end
    rows = [x.values.to_numpy() for x in made.column("cells")]
    good = np.array(made.column("good").to_pylist(), np.int64) == 1
    counts = np.maximum(np.array([(~good).sum(), good.sum()]), 1)
    weight = np.array([totals.get(0, 0), totals.get(1, 0)]) / counts
    return fit(rows, good, weight[good.astype(int)] if len(good) else np.empty(0))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``score``, the chance that a document is good, ``predicted`` and the ``margin``, per row.

    Null, empty and wordless texts have no n-gram: their margin is the bias
    alone. Rows repeated under one key get one result each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        own = shared.value
        square, weight = own.table()
        for lo, hi, data, offs in tv.slices(batch.column(1)):
            made, edge = cells(data, offs)
            total = lambda x: np.diff(np.concatenate(([0.0], np.cumsum(x[made])))[edge])
            size = np.sqrt(np.maximum(total(square), 0))
            margin = np.where(size > 1e-6, total(weight) / np.maximum(size, 1e-6), 0) + own.bias
            made = own.probability(margin)
            yield {key: batch.column(0)[lo:hi], "score": made, "predicted": (made >= THRESHOLD).astype(np.int32), "margin": margin}

    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, score double, predicted int, margin double"
    return map_batches(docs, [key, texts(docs, text)], make, schema).withColumn("held_out", held_out(key))


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, longest: int = LONGEST) -> DataFrame:
    """Learns from the labels and scores every document."""
    return score(docs, learn(docs, labels, key, text, sample, longest), key, text)
