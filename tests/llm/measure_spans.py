"""Share of repeated stretches of 50 words that the sentence spans remove: python tests/llm/measure_spans.py TABLE [SEVERAL WORDS ALONE]."""

import sys

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from panelweave.llm import spans, textvec as tv

WIDTH = 50


def measure(texts: list[str], **limits) -> dict[str, int]:
    """Stretches of words after their first occurrence, texts in order; and how much of them the runs cover."""
    blob = [(t or "").encode() for t in texts]
    data = np.frombuffer(b"".join(blob), np.uint8)
    offs = np.concatenate(([0], np.cumsum([len(b) for b in blob])))
    starts, ends, first = tv.words(data, offs)
    h = tv.hashes(tv.LOWER[data], starts, ends)
    owner = tv.owners(first)
    up, down = tv.POWERS.to(len(h) + 1)
    total = np.concatenate(([np.uint64(0)], np.cumsum(h * up[: len(h)], dtype=np.uint64)))
    at = np.arange(max(len(h) - WIDTH + 1, 0))
    at = at[owner[at] == owner[at + WIDTH - 1]]
    later = repeats((total[at + WIDTH] - total[at]) * down[at])
    covered = np.zeros(len(h) + 1, np.int64)
    np.add.at(covered, at[later], 1)
    np.subtract.at(covered, at[later] + WIDTH, 1)
    covered = np.cumsum(covered[:-1]) > 0

    found = spans.sentence_runs(data, offs, **limits)
    gone = repeats(found["hash"])
    drop = np.zeros(len(found["begin"]) + 1, np.int64)
    np.add.at(drop, found["low"][gone], 1)
    np.subtract.at(drop, found["high"][gone] + 1, 1)
    drop = np.cumsum(drop[:-1]) > 0
    cut = drop[np.searchsorted(found["begin"], starts, "right") - 1]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (covered * (owner + 1)))))) if len(h) else np.zeros(0, int)
    low = edge[covered[edge]]
    high = np.append(edge, len(h))[np.searchsorted(edge, low) + 1]
    share = np.array([cut[a:b].mean() for a, b in zip(low, high)])
    inside = np.bincount(owner, weights=covered, minlength=len(texts)) > 0
    touched = np.bincount(owner, weights=cut, minlength=len(texts)) > 0
    return {
        "stretches": len(low),
        "not covered": int((share == 0).sum()),
        "under 80 percent": int((share < 0.8).sum()),
        "words in stretches": int(covered.sum()),
        "of them removed": int((cut & covered).sum()),
        "other words removed": int((cut & ~covered).sum()),
        "texts without a stretch": int((~inside).sum()),
        "of them cut": int((touched & ~inside).sum()),
    }


def repeats(made: np.ndarray) -> np.ndarray:
    """Mask of the values that stand further to the front too."""
    order = np.argsort(made, kind="stable")
    out = np.zeros(len(made), bool)
    out[order[1:]] = made[order[1:]] == made[order[:-1]]
    return out


if __name__ == "__main__":
    rows = pq.read_table(sys.argv[1], columns=["doc_id", "text"]).sort_by("doc_id")
    limits = dict(zip(("several", "words", "alone"), map(int, sys.argv[2:5])))
    for name, value in measure(rows.column("text").to_pylist(), **limits).items():
        print(name, value)
