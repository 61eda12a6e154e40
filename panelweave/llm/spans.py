"""Substring dedup by sliding spans of sentences.

Every short run of consecutive sentences is hashed. A run that also stands in
an earlier document, or earlier in its own, is a repeat, and the sentences it
covers go. Within a document repeats are found on the spot; across documents
one aggregate finds each run's first document and one join brings the hashes of
later documents back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelweave.llm import textvec as tv
from panelweave.llm.arrow import map_batches, texts, written
from panelweave.operators.groups import null_safe_join

#: Every run of ``SEVERAL`` sentences counts; shorter ones do from this many words on: two sentences, one sentence.
SEVERAL, WORDS, ALONE = 3, 16, 16
IS_STOP = np.zeros(256, bool)
IS_STOP[list(b".!?")] = True


def sentence_runs(data: np.ndarray, offs: np.ndarray, several: int = SEVERAL, words: int = WORDS, alone: int = ALONE) -> dict[str, np.ndarray]:
    """Sentences and runs of a slice.

    A sentence ends with a word that ends in a full stop, exclamation or
    question mark, or at a line end. The runs are, for every sentence, the
    shortest one beginning and the shortest one ending with it that has
    ``several`` sentences, however short, or two and more with ``words`` words
    in all, and sentences of ``alone`` words. Longer runs are covered by
    these, so that no repeated run of ``several`` sentences is missed. Gives each text's first sentence
    (``own``), sentences' first bytes (``begin``), runs' first and last
    sentence, and hashes, which ignore the case of A-Z and kinds of white space.
    """
    starts, ends, first = tv.words(data, offs)
    h = tv.hashes(tv.LOWER[data], starts, ends)
    line = np.searchsorted(np.flatnonzero(data == 10), starts)
    new = np.ones(len(starts), bool)
    if len(starts):
        new[1:] = IS_STOP[data[ends[:-1] - 1]] | (line[1:] != line[:-1])
        new[first[:-1][first[:-1] < len(starts)]] = True
    word = np.flatnonzero(new)  # first word of each sentence
    until = np.append(word[1:], len(starts))[: len(word)]
    own = np.searchsorted(word, first)
    each = np.arange(len(word))
    owner = tv.owners(own)
    ahead = np.minimum(each + several - 1, np.maximum(each + 1, np.searchsorted(until, word + words)))
    back = np.maximum(each - several + 1, np.minimum(each - 1, np.searchsorted(word, until - words, "right") - 1))
    fits = (ahead < own[1:][owner]) if len(word) else each > 0
    held = (back >= own[:-1][owner]) if len(word) else each > 0
    long = until - word >= alone
    low = np.concatenate((each[fits], back[held], each[long]))
    high = np.concatenate((ahead[fits], each[held], each[long]))
    pick = np.unique(low * (len(word) + 1) + high)
    low, high = pick // (len(word) + 1), pick % (len(word) + 1)
    up, down = tv.POWERS.to(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[: len(h)], out=total[1:])
    a, b = word[low], until[high]
    made = tv.mix((total[b] - total[a]) * down[a])
    return {"own": own, "begin": starts[word], "low": low, "high": high, "hash": made, "owner": owner[low] if len(low) else low}


def _hashes(docs: DataFrame, key: str, text: str, limits: tuple[int, int, int]) -> DataFrame:
    """Distinct run hashes of every document, as rows (hash, key)."""

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        for lo, hi, data, offs in tv.slices(batch.column(1)):
            found = sentence_runs(data, offs, *limits)
            _, later = tv.repeated(found["owner"], found["hash"])
            keep = ~later
            yield {
                "hash": found["hash"][keep].view(np.int64),
                "__key": batch.column(0)[lo:hi].take(pa.array(found["owner"][keep])),
            }

    return map_batches(docs, [_last(key), texts(docs, text)], make, "hash bigint, __key bigint")


def _last(key: str):
    """The key as a whole number; null comes after all others."""
    return F.coalesce(F.col(key).cast("bigint"), F.lit((1 << 63) - 1)).alias("__key")


def drop_repeated_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", several: int = SEVERAL, words: int = WORDS, alone: int = ALONE
) -> DataFrame:
    """Per row: key, ``text`` without repeated spans, ``n_sentences``, ``n_removed`` and ``removed``.

    The first occurrence stays: the one in the document of the smallest key,
    and there the one furthest to the front. A removed sentence takes the white
    space behind it along; ``removed`` lists the ranges as begin:end in UTF-8
    bytes. Every run of ``several`` sentences counts, one of
    two from ``words`` words on and a single one from ``alone``. ``key`` is a whole number; a null key counts as the last, and rows
    repeated under one key count as one document, each keeping its text. Null
    texts read as empty and have no sentence.
    """
    limits = (several, words, alone)
    seen = _hashes(docs, key, text, limits)
    shared = seen.groupBy(F.col("hash").alias("__hash")).agg(F.min("__key").alias("head"), F.max("__key").alias("tail"))
    shared = written(shared.where("head < tail").select("__hash", "head"), "shared")
    late = null_safe_join(seen, shared, {"hash": "__hash"}, "inner").where("__key > head")
    late = late.groupBy(F.col("__key").alias("__of")).agg(F.collect_set("hash").alias("late"))
    rows = docs.select(key, _last(key), texts(docs, text).alias("text"))
    both = null_safe_join(rows, late, {"__key": "__of"}, "left")

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        for lo, hi, data, offs in tv.slices(batch.column(1)):
            found = sentence_runs(data, offs, *limits)
            own, owner, made = found["own"], found["owner"], found["hash"]
            gone = _later(owner, made)
            edge = np.searchsorted(owner, np.arange(hi - lo + 1))
            for i in np.flatnonzero(batch.column(2)[lo:hi].is_valid().to_numpy(zero_copy_only=False)):
                late = batch.column(2)[lo + int(i)].values.to_numpy().view(np.uint64)
                part = slice(edge[i], edge[i + 1])
                gone[part] |= np.isin(made[part], late)
            cover = np.zeros(len(found["begin"]) + 1, np.int64)
            np.add.at(cover, found["low"][gone], 1)
            np.subtract.at(cover, found["high"][gone] + 1, 1)
            drop = np.cumsum(cover[:-1]) > 0
            kept, removed = [], []
            for i in range(hi - lo):
                begin = found["begin"][own[i] : own[i + 1]]
                body = data[offs[i] : offs[i + 1]]
                hit = drop[own[i] : own[i + 1]]
                if not hit.any():
                    kept.append(body.tobytes())
                    removed.append("")
                    continue
                stop = np.append(begin[1:], offs[i + 1])
                turn = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
                ranges = [(int(begin[a] - offs[i]), int(stop[b - 1] - offs[i])) for a, b in zip(turn[::2], turn[1::2])]
                keep = np.ones(len(body), bool)
                for a, b in ranges:
                    keep[a:b] = False
                kept.append(body[keep].tobytes())
                removed.append(",".join(f"{a}:{b}" for a, b in ranges))
            count = np.concatenate(([0], np.cumsum(drop)))
            yield {
                key: batch.column(0)[lo:hi],
                "text": pa.array(kept, pa.binary()).cast(pa.string()),
                "n_sentences": np.diff(own),
                "n_removed": count[own[1:]] - count[own[:-1]],
                "removed": pa.array(removed, pa.string()),
            }

    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, text string, n_sentences bigint, n_removed bigint, removed string"
    return map_batches(both, [F.col(key), "text", "late"], make, schema)


def _later(owner: np.ndarray, made: np.ndarray) -> np.ndarray:
    """Mask of the runs that repeat an earlier run of their text; runs are in text order."""
    key = made ^ tv.mix(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    out = np.zeros(len(made), bool)
    out[order[1:]] = key[order[1:]] == key[order[:-1]]
    return out
