"""Quality rules: an isolation forest on rule statistics of whole texts.

``statistics`` reads each text once. The forest is grown from random splits on
a bounded sample of rows labelled good; a document whose path to isolation is
short differs from them. The threshold comes from the scores of all labelled
rows, gathered as a fixed-size histogram.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelweave.llm import textvec as tv
from panelweave.llm.arrow import map_batches, texts, written

SYMBOLS = b"#*$%&|<>"
STATISTICS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
#: Repeated words stay with the base rule: their share, as a feature, hides the bad rows behind good rows of few repeats.
FEATURES = [
    "symbol_share",
    "stutter_share",
    "word_length",
    "upper_share",
    "shout_share",
    "bare_share",
    "dup_line_share",
]

IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(SYMBOLS)] = True


def _slice_statistics(data: np.ndarray, offs: np.ndarray, window: int) -> dict[str, np.ndarray]:
    n = len(offs) - 1
    starts, ends, first = tv.words(data, offs)
    n_words = np.diff(first)
    is_word = tv.IS_WORD[data]
    lead = (data & 0xC0) != 0x80
    chars = np.concatenate(([0], np.cumsum(is_word & lead)))[offs]
    line_from, line_to = tv.runs(data != 10, offs)
    worded = np.searchsorted(starts, line_to) > np.searchsorted(starts, line_from)
    line_from, line_to = line_from[worded], line_to[worded]
    line_first = np.searchsorted(line_from, offs)
    _, later = tv.repeated(tv.owners(line_first), tv.hashes(data, line_from, line_to))
    h = tv.hashes(data, starts, ends)
    at, made = tv.windows(h, first, window)
    owner = tv.owners(first)
    stutter = np.flatnonzero((h[1:] == h[:-1]) & (owner[1:] == owner[:-1]))
    letters = np.concatenate(([0], np.cumsum(tv.IS_ALNUM[data])))
    bare = letters[ends] == letters[starts]
    again, _ = tv.repeated(owner[at], made)
    in_repeat = tv.covered(at[again], window, len(starts))
    stats = {
        "n_words": n_words,
        "word_chars": np.diff(chars),
        "n_symbols": tv.count_in(IS_SYMBOL[data], offs),
        "n_dup_lines": np.bincount(tv.owners(line_first)[later], minlength=n),
        "n_repeat_words": np.bincount(owner[in_repeat], minlength=n),
    }
    upper = tv.count_in((data >= 65) & (data <= 90), offs)
    some = lambda part, whole: part / np.maximum(whole, 1)
    features = {
        "symbol_share": some(stats["n_symbols"], stats["word_chars"]),
        "stutter_share": some(np.bincount(owner[stutter], minlength=n), n_words),
        "word_length": some(stats["word_chars"], n_words),
        "upper_share": some(upper, stats["word_chars"]),
        "shout_share": some(tv.count_in(data == 33, offs), n_words),
        "bare_share": some(np.bincount(owner[bare], minlength=n), n_words),
        "dup_line_share": some(stats["n_dup_lines"], np.diff(line_first)),
    }
    return {k: v.astype(np.int64) for k, v in stats.items()} | features


def statistics(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 8, also: Sequence[str] = ()
) -> DataFrame:
    """Rule statistics and the forest's features, one row per document.

    Words are runs without ASCII white space, compared as they stand. Null and
    empty texts count 0 everywhere. The columns ``also`` are handed on.
    """

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        for lo, hi, data, offs in tv.slices(batch.column(1)):
            others = {c: batch.column(2 + i)[lo:hi] for i, c in enumerate(also)}
            yield {key: batch.column(0)[lo:hi]} | _slice_statistics(data, offs, window) | others

    kind = lambda c: f"{c} {docs.schema[c].dataType.simpleString()}"
    schema = f"{kind(key)}, {STATISTICS}, " + ", ".join([*[f"{f} double" for f in FEATURES], *map(kind, also)])
    return map_batches(docs, [key, texts(docs, text), *also], make, schema)


# --- the forest -------------------------------------------------------------


@dataclass
class Forest:
    """Trees as flat arrays: feature (-1 in a leaf), cut, left child, path length in a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    usual: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly of each row, 0 to 1: two to the minus mean path over the usual path."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            while (inner := self.feature[node] >= 0).any():
                f = np.maximum(self.feature[node], 0)
                step = self.left[node] + (x[rows, f] >= self.cut[node])
                node = np.where(inner, step, node)
            total += self.path[node]
        return 2.0 ** (-total / len(self.roots) / self.usual)


def usual_path(n) -> np.ndarray:
    """Mean path of an unsuccessful search among ``n`` values."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), n == 2)


def grow(x: np.ndarray, trees: int = 128, rows: int = 256, seed: int = 7) -> Forest:
    """Isolation forest: each tree splits ``rows`` sampled rows at random cuts.

    A cut is drawn uniformly over a range half as wide again as the rows'
    range, so that values beyond everything seen are cut off early.
    """
    rng = np.random.default_rng(seed)
    size = min(rows, len(x))
    deepest = int(np.ceil(np.log2(max(size, 2))))
    spread = x.max(0) - x.min(0) if len(x) else np.zeros(x.shape[1])
    spread = np.where(spread > 0, spread, 1.0)
    nodes, roots = [], []

    def split(part: np.ndarray, depth: int, at: int) -> None:
        if depth >= deepest or len(part) <= 1:
            nodes[at] = (-1, 0.0, 0, depth + float(usual_path(len(part))))
            return
        f = int(rng.integers(x.shape[1]))
        low, high = part[:, f].min(), part[:, f].max()
        margin = max((high - low) / 4, spread[f] / 64)
        cut = rng.uniform(low - margin, high + margin)
        left = len(nodes)
        nodes.extend([None, None])
        nodes[at] = (f, cut, left, 0.0)
        split(part[part[:, f] < cut], depth + 1, left)
        split(part[part[:, f] >= cut], depth + 1, left + 1)

    for _ in range(trees):
        roots.append(len(nodes))
        nodes.append(None)
        split(x[rng.choice(len(x), size, replace=False)] if len(x) else x, 0, roots[-1])
    feature, cut, left, path = (np.array(c) for c in zip(*nodes))
    return Forest(feature, cut, left, path, np.array(roots), max(float(usual_path(size)), 1.0))


def scored(stats: DataFrame, forest: Forest, key: str = "doc_id") -> DataFrame:
    """Adds ``anomaly`` to the statistics."""

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        x = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES])
        yield {n: batch.column(n) for n in batch.schema.names} | {"anomaly": forest.score(x)}

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema.fields)
    return map_batches(stats, stats.columns, make, f"{kinds}, anomaly double")


def threshold(scores: DataFrame, quality: str = "quality", bins: int = 2000, wrong: float = 0.001) -> float:
    """Lowest score that rejects at most ``wrong`` of the rows labelled good.

    All labelled rows count; they reach the driver as a histogram of at most
    ``bins`` rows. Without good rows nothing is rejected.
    """
    good = scores.where(F.col(quality) == 1).groupBy(F.ceil(F.col("anomaly") * bins).alias("bin")).count()
    counts = sorted((r["bin"], r["count"]) for r in good.collect())
    spare = wrong * sum(n for _, n in counts)
    for b, n in reversed(counts):
        spare -= n
        if spare < 0:
            return b / bins
    return 2.0


def judge(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sample: int = 4096,
    trees: int = 128,
    wrong: float = 0.001,
    also: Sequence[str] = (),
) -> DataFrame:
    """Statistics, ``base_failed``, ``anomaly`` and ``kept`` of every document.

    ``base_failed``: under 20 words, or over 30 percent of the words in
    repeated windows. Others are kept unless their anomaly passes the
    threshold. ``sample`` bounds the good labelled rows the forest grows from;
    they are taken in the order of a hash of the key. Rows with a null key
    have no label and are judged like others. Ids labelled twice count as good
    only if all their labels say so. Documents below 20 words take no part in
    the fit. The columns ``also`` are handed on.
    """
    stats = written(statistics(docs, key, text, also=also), "quality")
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    stats = stats.withColumn("base_failed", failed)
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.min("quality").alias("quality"))
    known = stats.where("not base_failed").join(marks, F.col(key) == F.col("__key"))
    good = known.where("quality = 1").orderBy(F.xxhash64(key), key).limit(sample)
    rows = good.select(*FEATURES).toArrow()
    forest = grow(np.column_stack([rows.column(f).to_numpy() for f in FEATURES]), trees)
    limit = threshold(scored(known.select(*FEATURES, "quality"), forest), wrong=wrong)
    out = scored(stats, forest, key)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= limit))
