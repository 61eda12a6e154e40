"""Exact removal of long repeated byte strings by sorting suffixes.

Moving every suffix with its leading bytes would multiply the corpus. Instead
each string of ``SIZE`` bytes is filed under the least hash of its grams (its
lead): equal strings have equal leads, and neighbouring strings mostly share
one, so a text falls into runs of strings under one lead. Leads that stand only
once are dropped, runs of equal content are counted, and only one copy of each
distinct run goes on: the runs are range-partitioned by lead with sampled
splitters, and every bucket sorts the suffixes that begin in its runs by
multikey quicksort, a machine word at a time, until ``SIZE`` bytes agree.

A lead with very many distinct runs is not sorted in one task: its strings are
compared by 128-bit hashes that are counted across all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from panelweave.llm import textvec as tv
from panelweave.llm.arrow import map_batches, ship, texts, written
from panelweave.operators.groups import null_safe_join

SIZE, GRAM = 200, 64
#: Windows of a run are fewer than this, as all hold the lead's gram.
LONGEST = 256
#: Distinct runs of a lead that one task sorts, and bytes sorted at once.
CROWD, BLOCK = 2000, 2 << 20
#: Places of grams in a slice, and windows of one text cut at once.
PLACES, FAR = 1 << 24, 1 << 22


def _sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    out, done = h, 1
    while 2 * done <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    return np.minimum(out[: len(out) - (width - done)], out[width - done :]) if width > done else out


def cut_runs(data: np.ndarray, offs: np.ndarray, size: int = SIZE, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The runs of a slice: text number, first window (in its text), windows, lead, content hash; and text hashes."""
    up, down = tv.POWERS.to(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    span = lambda a, b: (total[b] - total[a]) * down[a]
    text = tv.mix(span(offs[:-1], offs[1:]) ^ tv.mix(np.diff(offs).astype(np.uint64)))
    n = len(data) - size + 1
    if n > FAR:  # one long text: its windows in parts, each with the bytes that its last window reaches
        parts = []
        for low in range(0, n, FAR):
            part = data[low : low + FAR + size - 1]
            parts.append(cut_runs(part, np.array([0, len(part)]), size, gram))
            parts[-1]["at"] += low
        return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]} | {"text": text}
    if n <= 0:
        none = np.empty(0, np.int64)
        return {"doc": none, "at": none, "n": none, "lead": none, "run": none, "text": text}
    grams = tv.mix((total[gram:] - total[:-gram]) * down[: len(data) - gram + 1])
    # 40 bits of hash, then the place: the least is the leftmost of the least hashes
    ranked = (grams & ~np.uint64(PLACES - 1)) | np.arange(len(grams), dtype=np.uint64)
    least = (_sliding_least(ranked, size - gram + 1) & np.uint64(PLACES - 1)).astype(np.int64)
    valid = np.zeros(n + 1, np.int8)
    room = np.flatnonzero(np.diff(offs) >= size)
    valid[offs[room]] = 1
    ends = offs[room + 1] - size + 1
    valid[ends[ends <= n]] -= 1
    valid = np.cumsum(valid[:n], dtype=np.int8) > 0
    new = valid.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
    new[offs[room]] = True
    first = np.flatnonzero(new)
    doc = np.searchsorted(offs, first, "right") - 1
    stop = np.minimum(np.append(first[1:], n), offs[doc + 1] - size + 1)
    run = tv.mix(span(first, stop + size - 1) ^ tv.mix((stop - first).astype(np.uint64)))
    lead = grams[least[first]].view(np.int64)
    return {"doc": doc, "at": first - offs[doc], "n": stop - first, "lead": lead, "run": run.view(np.int64), "text": text}


def _row_keys(text: np.ndarray, key: pa.Array) -> np.ndarray:
    """64 bits of each row: its text and its key."""
    return tv.mix(text ^ tv.mix(key.to_numpy().view(np.uint64))).view(np.int64)


def _runs(docs: DataFrame, key: str, text: str, size: int, gram: int) -> DataFrame:
    """One row per run: lead, run, the row's key and the packed place (first window and windows)."""

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        for lo, hi, data, offs in tv.slices(batch.column(1)):
            found = cut_runs(data, offs, size, gram)
            row = _row_keys(found["text"], batch.column(0)[lo:hi])
            yield {
                "lead": found["lead"],
                "run": found["run"],
                "row": row[found["doc"]],
                "place": found["at"] * LONGEST + found["n"] - 1,
            }

    return map_batches(docs, [_whole(key), texts(docs, text)], make, "lead bigint, run bigint, row bigint, place bigint")


def _whole(key: str):
    """The key as a number; null as the least."""
    return F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63))).alias("__key")


def _packed(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """The documents as key, row key and compressed text."""

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        press = zstandard.ZstdCompressor(level=1)
        for lo, hi, data, offs in tv.slices(batch.column(2)):
            up, down = tv.POWERS.to(len(data) + 1)
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
            span = (total[offs[1:]] - total[offs[:-1]]) * down[offs[:-1]]
            row = _row_keys(tv.mix(span ^ tv.mix(np.diff(offs).astype(np.uint64))), batch.column(1)[lo:hi])
            packed = [press.compress(data[a:b].tobytes()) for a, b in zip(offs[:-1], offs[1:])]
            yield {key: batch.column(0)[lo:hi], "row": row, "packed": pa.array(packed, pa.binary())}

    kind = docs.schema[key].dataType.simpleString()
    return map_batches(docs, [key, _whole(key), texts(docs, text)], make, f"{key} {kind}, row bigint, packed binary")


# --- comparing the distinct runs of a lead ----------------------------------


def equal_windows(data: np.ndarray, at: np.ndarray, group: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Mask of the suffixes at ``at`` whose first ``size`` bytes begin another suffix of their group.

    Multikey quicksort over all groups at once: suffixes that agree so far are
    sorted by their next machine word, and those left alone drop out. ``size``
    is a multiple of 8.
    """
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    word = np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))
    out = np.zeros(len(at), bool)
    order = np.argsort(group, kind="stable")
    tied = group[order]
    live = order
    for depth in range(-1, size // 8):
        if depth >= 0:
            key = word[at[live] + 8 * depth]
            head = np.flatnonzero(np.append(True, tied[1:] != tied[:-1]))
            count = np.diff(np.append(head, len(tied)))
            differs = key != np.repeat(key[head], count)
            if not differs.any():
                continue
            torn = np.repeat(np.logical_or.reduceat(differs, head), count)
            part = np.flatnonzero(torn)
            turn = part[np.lexsort((key[part], tied[part]))]
            live[part], key[part] = live[turn], key[turn]
            same = (tied[1:] == tied[:-1]) & (key[1:] == key[:-1])
        else:
            same = tied[1:] == tied[:-1]
        keep = np.append(same, False) | np.append(False, same)
        tied = np.cumsum(np.append(True, ~same))[keep]
        live = live[keep]
        if not len(live):
            break
    out[live] = True
    return out


def _windows_of(batch_texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Joined bytes, and start and text number of every window."""
    lengths = np.array([len(t) for t in batch_texts])
    base = np.concatenate(([0], np.cumsum(lengths)))
    count = lengths - size + 1
    owner = np.repeat(np.arange(len(lengths)), count)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + base[owner]
    return np.frombuffer(b"".join(batch_texts), np.uint8), at, owner


def _stretches(hit: np.ndarray, owner: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, first and last step of the maximal stretches of hits."""
    at = np.flatnonzero(hit)
    cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(owner[at]) > 0)) + 1
    low, high = np.concatenate(([0], cut)), np.concatenate((cut, [len(at)])) - 1
    if not len(at):
        return at, at, at
    return owner[at[low]], step[at[low]], step[at[high]]


def _sorted_marks(distinct: DataFrame, size: int) -> DataFrame:
    """Byte ranges (row, begin, end) of single runs whose strings stand in another run of the lead."""
    ship(distinct.sparkSession)

    def settle(held: list[tuple]) -> pa.RecordBatch:
        data, at, owner = _windows_of([h[4] for h in held], size)
        lead = np.array([h[0] for h in held], np.int64)
        hit = equal_windows(data, at, lead[owner], size)
        first = np.searchsorted(owner, np.arange(len(held)))
        of, low, high = _stretches(hit & np.array([h[3] for h in held])[owner], owner, np.arange(len(at)) - first[owner])
        begin = np.array([h[2] for h in held], np.int64)[of] + low
        row = np.array([h[1] for h in held], np.int64)[of]
        return pa.RecordBatch.from_arrays(
            [pa.array(row), pa.array(begin), pa.array(begin + (high - low) + size)], ["row", "begin", "end"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for item in zip(*columns):
                if total >= BLOCK and item[0] != held[-1][0]:
                    yield settle(held)
                    held, total = [], 0
                held.append(item)
                total += len(item[4])
        if held:
            yield settle(held)

    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = distinct.repartitionByRange(parts, "lead").sortWithinPartitions("lead")
    return ordered.select("lead", "row", "begin", "single", "bytes").mapInArrow(run, "row bigint, begin bigint, end bigint")


def _counted_marks(distinct: DataFrame, size: int) -> DataFrame:
    """The same for crowded leads: strings are hashed, and hashes counted across tasks."""

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        for i in range(0, batch.num_rows, 64):
            part = batch.slice(i, 64)
            data, at, owner = _windows_of(part.column(4).to_pylist(), size)
            up, down = tv.POWERS.to(len(data) + 1)
            sums = []
            for salt in (np.uint64(1), np.uint64(0xD6E8FEB86659FD93)):
                total = np.zeros(len(data) + 1, np.uint64)
                np.cumsum(tv.mix(data.astype(np.uint64) * salt + salt) * up[: len(data)], out=total[1:])
                sums.append(tv.mix((total[at + size] - total[at]) * down[at]).view(np.int64))
            own = pa.array(owner)
            first = np.searchsorted(owner, np.arange(part.num_rows))
            begin = part.column(2).to_numpy()[owner] + np.arange(len(at)) - first[owner]
            yield {
                "a": sums[0],
                "b": sums[1],
                "row": part.column(1).take(own),
                "begin": begin,
                "single": part.column(3).take(own),
            }

    schema = "a bigint, b bigint, row bigint, begin bigint, single boolean"
    rows = map_batches(distinct, ["lead", "row", "begin", "single", "bytes"], make, schema)
    weight = F.sum(F.when(F.col("single"), 1).otherwise(2))
    many = rows.groupBy(F.col("a").alias("__a"), F.col("b").alias("__b")).agg(weight.alias("n")).where("n > 1").drop("n")
    met = null_safe_join(rows.where("single"), many, {"a": "__a", "b": "__b"}, "left_semi")
    return met.select("row", "begin", (F.col("begin") + size).alias("end"))


# --- the operator -----------------------------------------------------------


def repeated_ranges(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, gram: int = GRAM, crowd: int = CROWD
) -> DataFrame:
    """Byte ranges (row, begin, end) covered by a string of ``size`` bytes that starts anywhere else too."""
    runs = _runs(docs, key, text, size, gram)
    leads = runs.groupBy("lead").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    leads = written(leads.select(F.col("lead").alias("__lead")), "leads")
    hits = written(null_safe_join(runs, leads, {"lead": "__lead"}, "inner"), "hits")
    kinds = hits.groupBy("lead", "run").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("row"))
    kinds = written(kinds, "runs")

    # a run that stands twice is settled; its bytes only serve to compare with others
    twice = kinds.where("n > 1").select(F.col("lead").alias("__lead"), F.col("run").alias("__run"))
    settled = null_safe_join(hits, twice, {"lead": "__lead", "run": "__run"}, "left_semi")
    begin = F.floor(F.col("place") / LONGEST).cast("bigint").alias("begin")
    until = (F.col("place") % LONGEST + size).alias("length")
    settled = settled.select("row", begin, until).select("row", "begin", (F.col("begin") + F.col("length")).alias("end"))

    sizes = kinds.groupBy("lead").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    sizes = sizes.select(F.col("lead").alias("__lead"), (F.col("kinds") > crowd).alias("crowded"))
    mixed = null_safe_join(kinds, sizes, {"lead": "__lead"}, "inner")
    mixed = mixed.select(F.col("lead").alias("__lead"), F.col("run").alias("__run"), F.col("row").alias("__row"), (F.col("n") == 1).alias("single"), "crowded")
    wanted = null_safe_join(hits, mixed, {"lead": "__lead", "run": "__run", "row": "__row"}, "inner")
    wanted = wanted.groupBy("lead", "run", "row", "single", "crowded").agg(F.min("place").alias("place"))
    by_row = wanted.groupBy(F.col("row").alias("__row")).agg(F.collect_list(F.struct("lead", "place", "single", "crowded")).alias("wanted"))
    packed = _packed(docs, key, text, size).select("row", "packed")
    held = packed.join(by_row, F.col("row") == F.col("__row"))

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        open_ = zstandard.ZstdDecompressor()
        out = {n: [] for n in ("lead", "row", "begin", "single", "crowded", "bytes")}
        for row, packed, items in zip(*(batch.column(i).to_pylist() for i in range(3))):
            data = open_.decompress(packed)
            for item in items:
                first, n = divmod(item["place"], LONGEST)
                for name, value in zip(out, (item["lead"], row, first, item["single"], item["crowded"], data[first : first + n + size])):
                    out[name].append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
        yield {n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds)}

    schema = "lead bigint, row bigint, begin bigint, single boolean, crowded boolean, bytes binary"
    distinct = written(map_batches(held, ["row", "packed", "wanted"], make, schema), "distinct")
    return settled.unionByName(_sorted_marks(distinct.where("not crowded"), size)).unionByName(
        _counted_marks(distinct.where("crowded"), size)
    )


def drop_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, gram: int = GRAM, crowd: int = CROWD
) -> DataFrame:
    """Per row: key, ``kept`` (the remaining bytes), ``n_bytes``, ``n_removed`` and ``n_spans``.

    Every byte goes that a string of ``size`` bytes covers which also starts
    anywhere else in the input, the same text included; strings never cross
    texts. All occurrences go, the first too. A null text reads as empty; texts
    shorter than ``size`` stay. Rows repeated under one key are copies of each
    other. ``key`` is a whole number; null counts as a value of its own.
    """
    ranges = repeated_ranges(docs, key, text, size, gram, crowd)
    marks = ranges.groupBy(F.col("row").alias("__row")).agg(F.collect_set(F.struct("begin", "end")).alias("marks"))
    packed = _packed(docs, key, text, size)
    both = null_safe_join(packed, marks, {"row": "__row"}, "left")

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        open_ = zstandard.ZstdDecompressor()
        out = {n: [] for n in ("kept", "n_bytes", "n_removed", "n_spans")}
        for packed, marks in zip(batch.column(1), batch.column(2)):
            data = np.frombuffer(open_.decompress(packed.as_py()), np.uint8)
            edge = np.zeros(len(data) + 1, np.int64)
            for mark in marks.as_py() or ():
                edge[mark["begin"]] += 1
                edge[mark["end"]] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            out["kept"].append(data[~gone].tobytes())
            out["n_bytes"].append(len(data))
            out["n_removed"].append(int(gone.sum()))
            out["n_spans"].append(int((gone & ~np.append(False, gone[:-1])).sum()) if len(data) else 0)
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
        yield {key: batch.column(0)} | {n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds)}

    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint"
    return map_batches(both, [key, "packed", "marks"], make, schema)


def brute_force(rows: list[str | None], size: int = SIZE) -> list[tuple[int, int, int, str]]:
    """The same by a table of all strings, for tests on a few texts."""
    data = [(t or "").encode() for t in rows]
    count: dict[bytes, int] = {}
    for d in data:
        for i in range(len(d) - size + 1):
            count[d[i : i + size]] = count.get(d[i : i + size], 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - size + 1):
            if count[d[i : i + size]] > 1:
                gone[i : i + size] = True
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(d) else 0
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out
