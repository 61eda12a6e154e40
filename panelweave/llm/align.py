"""Cross-tokenizer alignment with corpus-wide counts of linked id pairs.

Two tokenizers cut the same bytes, a blank and the text. Where tokens of both
end at one byte they are linked, and the bytes between such places are a
group. A first pass over the documents writes every task's distinct pairs. They
get a minimal perfect hash; counts are dense vectors indexed by it, summed in a
tree of tasks. A second pass aligns the documents again and looks the pairs'
counts up, each slot's key being compared with the pair asked for.

The two ids of a link end at one byte, so the bytes of one are a suffix of the
other's. The number of such pairs of the two vocabularies bounds the hash, the
vectors and what is broadcast, whatever the corpus (``pair_bound``).

Texts are cut at single blanks between other characters. Both tokenizers end a
token there whatever stands around, which their settings are checked for, so a
part seen before is taken from a bounded cache with its alignment.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelweave.llm import textvec as tv
from panelweave.llm.arrow import map_batches, ship, texts, written
from panelweave.llm.pieces import Model

#: Fixed value: how byte-level vocabularies of this family split text into words.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Parts kept per Python worker, and the longest part that is kept.
CACHED, LONG = 600_000, 64
#: Parts encoded together.
RUN = 4096
#: Characters of text worked through at once.
SLICE = 1 << 20
#: What makes it necessary to look at the characters around a blank: without it every blank is single.
CARE = ["  ", " \n", "\n ", *(c for c in map(chr, range(0x10000)) if c.isspace() and c not in " \n")]
#: Vectors that a task of the tree of sums adds.
FAN = 16


def byte_table() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Visible bytes stand for themselves, the others for the characters from 256 on.
    """
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabularies:
    """The files of a byte-level BPE tokenizer (JSON) and of a SentencePiece model."""

    byte_level: str
    pieces: bytes

    def name(self) -> str:
        return hashlib.sha256(self.byte_level.encode() + self.pieces).hexdigest()

    def surfaces(self) -> tuple[list[bytes], list[bytes]]:
        """The bytes of every id of either."""
        spec = json.loads(self.byte_level)
        table = byte_table()
        entries = {i: p for p, i in spec["model"]["vocab"].items()}
        entries |= {t["id"]: t["content"] for t in spec.get("added_tokens", [])}
        spelled = lambda p: bytes(table[c] for c in p) if all(c in table for c in p) else p.encode()
        first = [spelled(entries[i]) if i in entries else b"" for i in range(max(entries) + 1)]
        return first, Model(self.pieces).surface

    def cuttable(self) -> bool:
        """True if both end a token at every single blank between other characters."""
        spec, model = json.loads(self.byte_level), Model(self.pieces)
        before = spec.get("pre_tokenizer") or {}
        level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        plain = model.charsmap is None and not model.squeeze and model.prefix
        crossing = any("▁" in p.lstrip("▁") for p in model.pieces)
        return bool(level and not spec.get("normalizer") and plain and not crossing)


def pair_bound(first: list[bytes], second: list[bytes]) -> int:
    """How many pairs of ids can be linked at all: one's bytes end with the other's."""
    def longer(words: list[bytes], others: list[bytes], start: int) -> int:
        held: dict[bytes, int] = {}
        for w in others:
            held[w] = held.get(w, 0) + 1
        return sum(held.get(w[k:], 0) for w in words for k in range(start, len(w)))

    return longer(first, second, 0) + longer(second, first, 1)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys.

    Each level throws the keys left over on twice as many cells; keys alone in
    their cell stay there, the others go on. A key's slot is the number of
    occupied cells before its own, over all levels.
    """

    def __init__(self, keys: np.ndarray):
        keys = np.unique(np.asarray(keys, np.uint64))
        self.size, self.levels, rest = len(keys), [], keys
        while len(rest):
            cell = self._cells(rest, len(self.levels), max(64, 2 * len(rest)))
            alone = np.bincount(cell, minlength=max(64, 2 * len(rest))) == 1
            self.levels.append(alone)
            rest = rest[~alone[cell]]
        sizes = [int(x.sum()) for x in self.levels]
        before = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        self.rank = [np.cumsum(x, dtype=np.int32) - 1 + int(n) for x, n in zip(self.levels, before)]
        self.keys = np.zeros(self.size, np.uint64)
        self.keys[self.slots(keys, verified=False)] = keys

    @staticmethod
    def _cells(keys: np.ndarray, level: int, n: int) -> np.ndarray:
        salt = tv.mix(np.array([level + 1], np.uint64))
        return (tv.mix(keys ^ salt) % np.uint64(n)).astype(np.int64)

    def slots(self, keys: np.ndarray, verified: bool = True) -> np.ndarray:
        """Slot of each key; with ``verified`` -1 for a key that is none of the hashed ones."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (alone, rank) in enumerate(zip(self.levels, self.rank)):
            cell = self._cells(keys[left], level, len(alone))
            here = alone[cell]
            out[left[here]] = rank[cell[here]]
            left = left[~here]
        if verified and self.size:
            out[self.keys[np.maximum(out, 0)] != keys] = -1
        return out


def _byte_level(files: Vocabularies, surface: list[bytes]) -> Callable[[str], list[int]]:
    """Encoder of the byte-level tokenizer.

    Where ids follow the order of merges and words are split by the usual
    pattern, ids are ranks, and the faster of two libraries encodes by them.
    """
    spec = json.loads(files.byte_level)
    model, added = spec["model"], {t["id"] for t in spec.get("added_tokens", [])}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if files.cuttable() and all(model["vocab"].get(x + y) == 256 + i for i, (x, y) in enumerate(merges)):
        import tiktoken

        ranks = {surface[i]: i for i in model["vocab"].values() if i not in added}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    own = Tokenizer.from_str(files.byte_level)
    own.encode_special_tokens = True
    own.no_truncation()
    own.no_padding()
    return lambda text: own.encode(text, add_special_tokens=False).ids


class Parts:
    """Both tokenizers of a worker, and a bounded cache of aligned parts of texts."""

    def __init__(self, files: Vocabularies):
        import sentencepiece

        self.bytes = files.surfaces()
        self.first = _byte_level(files, self.bytes[0])
        self.second = sentencepiece.SentencePieceProcessor(model_proto=files.pieces)
        self.length = [np.array([len(x) for x in own]) for own in self.bytes]
        # every id as it is spelled before another of its group, and at the group's end
        self.words = [f"{i}{c}" for i in range(len(self.bytes[0])) for c in (",", "|")]
        self.words += [f"{i}{c}" for i in range(len(self.bytes[1])) for c in (",", ";", "")]
        self.cut = re.compile(r"(?<=\S) (?=\S)").split if files.cuttable() else None
        self.clear()

    def clear(self) -> None:
        """Forgets all parts; ``age`` tells those who hold numbers of parts."""
        self.age = getattr(self, "age", 0) + 1
        self.number: dict[str, int] = {}
        self.spelled: list[str] = []
        self.valid = np.empty(0, bool)
        self.sizes = np.empty((0, 2), np.int64)
        self.links, self.edge = np.empty(0, np.uint64), np.zeros(1, np.int64)

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        if self.cut is None:
            return [text]
        if text[0] == " " or text[-1] == " " or any(c in text for c in CARE):
            return self.cut(text)
        return text.split(" ")

    def encoded(self, parts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of a blank and each part by either tokenizer."""
        return list(zip(map(self.first, [" " + p for p in parts]), self.second.encode(parts, num_threads=1)))

    def aligned(self, part: str, a: list[int], b: list[int]) -> list[tuple[int, int, int]] | None:
        """Ends of the part's groups in bytes and in tokens of either; None if the bytes are not the part's."""
        source = b" " + part.encode()
        if b"".join(map(self.bytes[0].__getitem__, a)) != source or b"".join(map(self.bytes[1].__getitem__, b)) != source:
            return None
        ends = [np.cumsum(n[np.array(ids, np.int64)]) for n, ids in zip(self.length, (a, b))]
        at, i, j = np.intersect1d(*ends, return_indices=True)
        return list(zip(at.tolist(), (i + 1).tolist(), (j + 1).tolist()))

    def add(self, parts: list[str]) -> None:
        """Encodes and aligns parts that are not held yet, many at once.

        Parts joined by blanks are cut where they were joined. Where the bytes of a
        run of parts do not come back, it is halved until the guilty part is alone.
        """
        alone = lambda p: self.cut is None or p[0].isspace() or p[-1].isspace()
        plain = [p for p in parts if not alone(p)]
        runs = [plain[i : i + RUN] for i in range(0, len(plain), RUN)] + [[p] for p in parts if alone(p)]
        made = []
        while runs:
            run = runs.pop()
            done = self._together(run)
            if done is None and len(run) > 1:
                runs += [run[: len(run) // 2], run[len(run) // 2 :]]
                continue
            if done is None:
                done = [""], np.full((1, 2), -1), np.empty(0, np.uint64), np.zeros(1, np.int64)
            self.number.update(zip(run, range(len(self.spelled), len(self.spelled) + len(run))))
            self.spelled += done[0]
            made.append(done[1:])
        if not made:
            return
        sizes, links, counts = (np.concatenate(x) for x in zip(*made))
        self.valid = np.append(self.valid, sizes[:, 0] >= 0)
        self.sizes = np.vstack((self.sizes, np.maximum(sizes, 0)))
        self.links = np.append(self.links, links)
        self.edge = np.append(self.edge, self.edge[-1] + np.cumsum(counts))

    def _together(self, run: list[str]):
        """Spelled groups, token counts, links and link counts of a run of parts; None if bytes differ."""
        text = " ".join(run)
        source = b" " + text.encode()
        flat, ends = [], []
        for own, length, ids in zip(self.bytes, self.length, (self.first(" " + text), self.second.encode(text))):
            if b"".join(map(own.__getitem__, ids)) != source:
                return None
            flat.append(np.array(ids, np.int64))
            ends.append(np.cumsum(length[flat[-1]]))
        (a, b), (x, y) = flat, ends
        part = np.cumsum([1 + len(p.encode()) for p in run])
        at = np.searchsorted(y, x)
        i = np.flatnonzero(y[at] == x)  # last tokens of the groups by either
        j = at[i]
        if len(run) > 1 and (x[i][np.minimum(np.searchsorted(x[i], part), len(i) - 1)] != part).any():
            return None
        tokens = [np.diff(np.concatenate(([0], np.searchsorted(e, part, "right")))) for e in ends]
        counts = np.diff(np.concatenate(([0], np.searchsorted(x[i], part, "right"))))
        # both token lists in one, group by group, each with the sign that follows it
        left, right = np.arange(len(a)), np.arange(len(b))
        before = np.concatenate(([0], j + 1))
        place = np.empty(len(a) + len(b), np.int64)
        group = np.searchsorted(i, left), np.searchsorted(j, right)
        after = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        after[0][i] = after[1][j] = 1
        after[1][j[np.cumsum(counts) - 1]] = 2
        place[left + before[group[0]]] = 2 * a + after[0]
        place[right + i[group[1]] + 1] = 2 * len(self.bytes[0]) + 3 * b + after[1]
        words = list(map(self.words.__getitem__, place.tolist()))
        edge = np.concatenate(([0], np.cumsum(tokens[0] + tokens[1]))).tolist()
        spelled = ["".join(words[p:q]) for p, q in zip(edge, edge[1:])]
        return spelled, np.stack(tokens, 1), (a[i] << 32 | b[j]).astype(np.uint64), counts

    def numbers(self, held: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all parts of the texts in order, and where each text's begin."""
        if len(self.spelled) > CACHED:
            self.clear()
        rows = [self.split(t) for t in held]
        self.add(list(set().union(*rows).difference(self.number)))
        edge = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
        made = np.fromiter(map(self.number.__getitem__, chain.from_iterable(rows)), np.int64, edge[-1])
        for part in {p for r in rows if max(map(len, r), default=0) > LONG for p in r if len(p) > LONG}:
            del self.number[part]
        return made, edge

    def sound(self, parts: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """True for texts whose bytes both tokenizers give back; an empty text has none."""
        bad = np.concatenate(([0], np.cumsum(~self.valid[parts])))
        return (bad[edge[1:]] == bad[edge[:-1]]) & (edge[1:] > edge[:-1])


_WORKERS: dict[str, Parts] = {}


def worker(files: Vocabularies) -> Parts:
    """The Python worker's parts; kept between tasks."""
    name = files.name()
    if name not in _WORKERS:
        _WORKERS[name] = Parts(files)
    return _WORKERS[name]


def _held(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of slices of bounded size."""
    row, held, total = 0, [], 0
    for i, text in enumerate(column):
        held.append(text.as_py())
        total += len(held[-1])
        if total >= SLICE:
            yield row, held
            row, held, total = i + 1, [], 0
    if held:
        yield row, held


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(keys, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, at, counts)
    return keys, total


def task_pairs(docs: DataFrame, files: Vocabularies, text: str = "text") -> DataFrame:
    """First pass: one row per task with its distinct linked pairs and their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(files)
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker(shared.value)
        keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            for _, held in _held(batch.column(0)):
                parts, edge = own.numbers(held)
                parts = parts[np.repeat(own.sound(parts, edge), np.diff(edge))]
                seen, times = np.unique(parts, return_counts=True)
                size = own.edge[seen + 1] - own.edge[seen]
                total = np.cumsum(size)
                at = np.arange(total[-1] if len(total) else 0) + np.repeat(own.edge[seen] - (total - size), size)
                keys, counts = _summed(np.append(keys, own.links[at]), np.append(counts, np.repeat(times, size)))
        if len(keys):
            lists = [pa.array([x.view(np.int64)], pa.list_(pa.int64())) for x in (keys, counts)]
            yield pa.RecordBatch.from_arrays(lists, ["keys", "counts"])

    return docs.select(texts(docs, text)).mapInArrow(run, "keys array<bigint>, counts array<bigint>")


def tree_sum(vectors: DataFrame, n: int) -> np.ndarray | None:
    """Sum of the at most ``n`` arrays in column ``counts``, level by level over ever fewer tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.column(0):
                held = row.values.to_numpy()
                total = held.copy() if total is None else total + held
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], ["counts"])

    while n > 1:
        n = -(-n // FAN)
        vectors = vectors.repartition(n).mapInArrow(add, "counts array<bigint>")
    made = vectors.toArrow().column(0)
    return made.combine_chunks()[0].values.to_numpy() if len(made) else None


@dataclass
class Counts:
    """The corpus-wide counts of linked pairs, dense by the slot of their hash."""

    hash: PerfectHash
    n: np.ndarray
    best: np.ndarray

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each pair's count, 0 if the first pass did not see it, and whether it is the highest of its second id."""
        at = self.hash.slots(keys)
        made = np.where(at >= 0, self.n[at], 0) if len(self.n) else np.zeros(len(keys), np.int64)
        return made, (made > 0) & (made == self.best[(keys & np.uint64(0xFFFFFFFF)).astype(np.int64)])


def learn(docs: DataFrame, files: Vocabularies, text: str = "text") -> Counts:
    """Counts of all linked pairs: first pass, perfect hash, tree of dense sums."""
    spark = docs.sparkSession
    rows = written(task_pairs(docs, files, text), "pairs")
    first, second = files.surfaces()
    most = pair_bound(first, second)
    keys = rows.select(F.explode("keys").alias("key")).distinct().limit(most + 1).toArrow().column(0)
    if len(keys) > most:
        raise ValueError("more pairs of ids are linked than two vocabularies can link")
    made = PerfectHash(keys.to_numpy().astype(np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(made)

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for pairs, counts in zip(*(batch.column(i) for i in (0, 1))):
                at = shared.value.slots(pairs.values.to_numpy().view(np.uint64))
                if at.min() < 0:
                    raise ValueError("a pair of ids is missing from the hash")
                total = np.zeros(shared.value.size, np.int64) if total is None else total
                total[at] += counts.values.to_numpy()
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], ["counts"])

    total = tree_sum(rows.mapInArrow(dense, "counts array<bigint>"), rows.count())
    total = np.zeros(0, np.int64) if total is None else total
    best = np.zeros(len(second), np.int64)
    np.maximum.at(best, (made.keys & np.uint64(0xFFFFFFFF)).astype(np.int64), total)
    return Counts(made, total, best)


def pair_table(counts: Counts, spark) -> DataFrame:
    """The pairs with their counts: ``a``, ``b``, ``n`` and ``best``."""
    keys = counts.hash.keys
    n, best = counts.of(keys)
    columns = [(keys >> np.uint64(32)).astype(np.int32), (keys & np.uint64(0xFFFFFFFF)).astype(np.int32), n, best]
    return spark.createDataFrame(pa.table([pa.array(c) for c in columns], names=["a", "b", "n", "best"]))


def align(docs: DataFrame, files: Vocabularies, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids by both tokenizers and the ends of the groups, per row of ``docs``.

    ``a`` and ``b`` are the ids; ``ends_a`` and ``ends_b`` count the tokens up to
    the end of each group, ``ends`` the bytes of the text. Null and empty texts,
    and texts whose bytes a tokenizer does not give back, have empty lists.
    """
    shared = docs.sparkSession.sparkContext.broadcast(files)

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        own = worker(shared.value)
        for row, held in _held(batch.column(1)):
            lists = {n: [] for n in ("a", "b", "ends_a", "ends_b", "ends")}
            for text in held:
                done, n, at = {n: [] for n in lists}, [0, 0], -1
                parts = own.split(text)
                for part, (a, b) in zip(parts, own.encoded(parts) if parts else []):
                    made = own.aligned(part, a, b)
                    if made is None:
                        done = {n: [] for n in lists}
                        break
                    for end, i, j in made:
                        done["ends"].append(end + at)
                        done["ends_a"].append(i + n[0])
                        done["ends_b"].append(j + n[1])
                    done["a"].extend(a)
                    done["b"].extend(b)
                    n = [n[0] + len(a), n[1] + len(b)]
                    at += 1 + len(part.encode())
                for name in lists:
                    lists[name].append(done[name])
            yield {key: batch.column(0)[row : row + len(held)]} | {
                n: pa.array(v, pa.list_(pa.int64() if n == "ends" else pa.int32())) for n, v in lists.items()
            }

    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, a array<int>, b array<int>, ends_a array<int>, ends_b array<int>, ends array<bigint>"
    return map_batches(docs, [key, texts(docs, text)], make, schema)


def digests(docs: DataFrame, files: Vocabularies, counts: Counts, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Second pass: every row's alignment in figures, with the counts of its links.

    ``n_a``, ``n_b`` tokens, ``n_groups``, ``n_links``; ``n_best`` links whose
    pair is the commonest of its second id (ties count), ``count_sum`` over all
    links, and a digest of the groups. Null and empty texts, and texts whose
    bytes a tokenizer does not give back, have zeros and an empty digest. Rows
    repeated under one key get one result each, and count as often as they stand.
    """
    shared = docs.sparkSession.sparkContext.broadcast((files, counts))
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, counts = shared.value
        own = worker(files)
        age, table = -1, None
        for batch in batches:
            for row, held in _held(batch.column(1)):
                parts, edge = own.numbers(held)
                if own.age != age:
                    age, table = own.age, np.empty((0, 7), np.int64)
                if len(table) < len(own.spelled):  # figures of the parts added since
                    new = slice(len(table), len(own.spelled))
                    begin = own.edge[len(table) :]
                    n, best = counts.of(own.links[begin[0] :])
                    total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[begin - begin[0]])
                    links = np.diff(begin)
                    # parts of other texts may be held that this corpus lacks
                    added = [*own.sizes[new].T, links, links, total(best), total(n), total(n == 0)]
                    table = np.vstack((table, np.stack(added, 1)))
                sound = own.sound(parts, edge)
                total = np.zeros((len(parts) + 1, 7), np.int64)
                np.cumsum(table[parts], axis=0, out=total[1:])
                made = np.where(sound[:, None], total[edge[1:]] - total[edge[:-1]], 0)
                if made[:, 6].any():
                    raise ValueError("a pair of ids is linked that the first pass did not see")
                spelled = own.spelled.__getitem__
                digest = [
                    hashlib.sha256(";".join(map(spelled, parts[a:b].tolist())).encode()).hexdigest() if ok else ""
                    for ok, a, b in zip(sound.tolist(), edge[:-1].tolist(), edge[1:].tolist())
                ]
                columns = [batch.column(0)[row : row + len(held)], *map(pa.array, made[:, :6].T.copy()), pa.array(digest, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [key, *names, "groups_sha256"])

    schema = f"{key} {kind}, " + ", ".join(f"{n} bigint" for n in names) + ", groups_sha256 string"
    return docs.select(key, texts(docs, text)).mapInArrow(run, schema)
