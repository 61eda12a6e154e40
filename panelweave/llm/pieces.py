"""Offset-preserving SentencePiece encoding and decoding.

A text is normalised by the longest matching prefixes of the model's compiled
character map, keeping for every normalised byte the source byte it came from.
The normalised text is cut where no piece can reach across, the parts are
merged by the model's pieces, best score first, and every piece is projected
back to its span of source bytes. Merging works on arrays of parts at once;
parts seen before are taken from a bounded cache.

Models are BPE models with byte fallback; others are refused.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelweave.llm.arrow import map_batches, texts

SPACE = "▁"
NORMAL, CONTROL, USER, BYTE, UNUSED = 1, 3, 4, 6, 5
#: Parts kept per Python worker, and the longest part that is kept or merged in arrays.
#: A worker keeps them while it runs other stages, so they count against every step of a session.
CACHED, SHORT = 60_000, 64


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of one protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


class CharacterMap:
    """Longest-prefix replacement by a compiled map: a double-array trie and its strings."""

    def __init__(self, blob: bytes):
        (size,) = struct.unpack_from("<I", blob)
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.strings = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that begins at ``at``."""
        step = lambda unit: (unit >> 10) << ((unit & 512) >> 6)
        found, node = None, step(self.units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units) or (unit := self.units[node]) & 0x800000FF != data[i]:
                break
            node ^= step(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, self.units[node] & 0x7FFFFFFF
        if found:
            length, place = found
            return length, self.strings[place : self.strings.index(b"\0", place)]
        return None


class Model:
    """Pieces, normaliser and merges of a SentencePiece model file's bytes."""

    def __init__(self, blob: bytes):
        self.pieces, self.scores, self.kinds = [], [], []
        trainer, normaliser = {}, {}
        for field, value in _fields(blob):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normaliser = dict(_fields(value))
        if trainer.get(3, 1) != 2 or not trainer.get(35) or trainer.get(24) or USER in self.kinds:
            raise ValueError("only BPE models with byte fallback and without symbols of their own are read")
        self.charsmap = CharacterMap(normaliser[2]) if normaliser.get(2) else None
        self.prefix, self.squeeze = normaliser.get(3, 1), normaliser.get(4, 1)
        if not normaliser.get(5, 1):
            raise ValueError("models that keep plain spaces are not read")
        self.end = self.pieces.index("</s>")
        self._tables()

    def _tables(self) -> None:
        merge = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (NORMAL, UNUSED)}
        self.byte = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        # symbols: pieces by id, then characters that only occur inside pieces
        self.symbol = dict(merge)
        for c in sorted({c for p in merge for c in p} - merge.keys()):
            self.symbol[c] = len(self.pieces) + len(self.symbol) - len(merge)
        self.n = len(self.pieces) + len(self.symbol) - len(merge)
        rows = []
        for p, i in merge.items():
            for cut in range(1, len(p)):
                left, right = self.symbol.get(p[:cut]), self.symbol.get(p[cut:])
                if left is not None and right is not None:
                    rows.append((left * self.n + right, i))
        rows.sort()
        self.pair = np.array([r[0] for r in rows], np.int64)
        self.made = np.array([r[1] for r in rows], np.int64)
        # rank 0 merges first; equal scores share a rank, so the leftmost wins
        score = np.array(self.scores)[self.made]
        self.rank = np.unique(-score, return_inverse=True)[1].astype(np.int64)
        self.parts = self._cuts(merge)
        self.code = np.full(0x110000, -1, np.int32)
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.code[ord(c)] = i
        surface = [b"" if k == CONTROL else p.replace(SPACE, " ").encode() for p, k in zip(self.pieces, self.kinds)]
        length = [0 if k == CONTROL else len(p.encode()) for p, k in zip(self.pieces, self.kinds)]
        for value, i in self.byte.items():
            surface[i], length[i] = bytes([value]), 1
        self.surface, self.length = surface, np.array(length)
        self.text = [str(i) for i in range(len(self.pieces))]

    @staticmethod
    def _cuts(merge: Iterable[str]) -> re.Pattern:
        """Pattern of the parts that no piece reaches beyond, read off the characters that meet inside pieces."""
        meet = {pair for p in merge for pair in zip(p, p[1:])}
        if any(b == SPACE != a for a, b in meet):
            return re.compile("(?s).+")
        alone = "".join(re.escape(c) for c in "\n\t\r" if not any(c in pair for pair in meet))
        return re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|[{alone}]" if alone else ""))

    # --- normalising --------------------------------------------------------

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and the source byte of each of its bytes, with the source's end last."""
        source = text.encode()
        if not source:
            return "", np.zeros(1, np.int64)
        if self.charsmap is None and not self.squeeze:
            data = np.frombuffer(source, np.uint8)
            width = np.where(data == 32, 3, 1)
            align = np.repeat(np.arange(len(data)), width)
            lead = [0] * (3 * bool(self.prefix))
            made = SPACE * bool(self.prefix) + text.replace(" ", SPACE)
            return made, np.concatenate((np.array(lead, np.int64), align, [len(data)]))
        out, align, at = [], [], 0
        blank = bool(self.squeeze)  # blanks at the front go
        if self.prefix:
            out.append(SPACE.encode())
        first = len(out)
        while at < len(source):
            hit = self.charsmap.longest(source, at) if self.charsmap else None
            if hit is None:
                size = 1
                while at + size < len(source) and source[at + size] & 0xC0 == 0x80:
                    size += 1
                hit = size, source[at : at + size]
            size, made = hit
            if blank:
                made = made.lstrip(b" ")
            if made:
                made_spaces = made.replace(b" ", SPACE.encode())
                out.append(made_spaces)
                align.extend([at] * len(made_spaces))
                blank = bool(self.squeeze) and made.endswith(b" ")
            at += size
        if len(out) == first:
            return "", np.zeros(1, np.int64)
        if self.prefix:
            align = [align[0]] * 3 + align
        made, end = b"".join(out), len(source)
        while self.squeeze and made.endswith(SPACE.encode()) and len(made) > 3:
            made, end = made[:-3], align[-3]
            del align[-3:]
        return made.decode(), np.array([*align, end])

    # --- merging ------------------------------------------------------------

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging two symbols; a rank beyond all others where nothing fits."""
        key = left * self.n + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        fits = (self.pair[at] == key) & (left >= 0) & (right >= 0)
        return np.where(fits, self.rank[at], len(self.pair)), self.made[at]

    def _merge_rows(self, symbols: np.ndarray) -> np.ndarray:
        """Merges every row of a matrix of symbols; -1 is unknown, -2 is filling."""
        none = len(self.pair)
        rank, made = self._pairs(symbols[:, :-1], symbols[:, 1:])
        out = symbols.copy()
        rows = np.arange(len(symbols))
        while len(rows):
            best = rank.argmin(1)
            line = np.arange(len(rows))
            going = rank[line, best] < none
            if not going.all():
                out[rows[~going]] = symbols[~going]
                rows, symbols, rank, made, best = (x[going] for x in (rows, symbols, rank, made, best))
                line = line[: len(rows)]
                if not len(rows):
                    break
            symbols[line, best] = made[line, best]
            width = symbols.shape[1]
            after = np.arange(width) > best[:, None]
            pick = np.minimum(np.arange(width) + after, width - 1)
            last = after[:, -1:] & (np.arange(width) == width - 1)
            symbols = np.where(last, -2, np.take_along_axis(symbols, pick, 1))
            pick = np.minimum(np.arange(width - 1) + after[:, :-1], width - 2)
            rank = np.take_along_axis(rank, pick, 1)
            made = np.take_along_axis(made, pick, 1)
            rank[:, -1] = none
            for j, has in ((best, best < width - 1), (best - 1, best > 0)):
                w, j = line[has], j[has]
                rank[w, j], made[w, j] = self._pairs(symbols[w, j], symbols[w, j + 1])
        return out

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """Merges one long part with a heap of its neighbouring pairs."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, made = (x.tolist() for x in self._pairs(np.array(symbols[:-1]), np.array(symbols[1:])))
        none = len(self.pair)
        heap = [(r, i, symbols[i], symbols[i + 1], m) for i, (r, m) in enumerate(zip(rank, made)) if r < none]
        heapq.heapify(heap)
        known = {}

        def push(i: int) -> None:
            left, right = symbols[i], symbols[after[i]]
            if (left, right) not in known:
                r, m = self._pairs(np.array([left]), np.array([right]))
                known[left, right] = int(r[0]), int(m[0])
            r, m = known[left, right]
            if r < none:
                heapq.heappush(heap, (r, i, left, right, m))

        while heap:
            _, i, left, right, m = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = m, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                push(i)
            if before[i] >= 0:
                push(before[i])
        return [s for s in symbols if s is not None]

    def _ids(self, part: str, symbols: Iterable[int]) -> bytes:
        """Ids of a merged part as 32-bit integers; a symbol that is no piece becomes its bytes."""
        out, at = [], 0
        for s in symbols:
            if 0 <= s < len(self.pieces):
                out.append(s)
                at += len(self.pieces[s])
            else:
                out.extend(self.byte[b] for b in part[at].encode())
                at += 1
        return np.array(out, np.int32).tobytes()

    def merge(self, parts: Iterable[str]) -> dict[str, bytes]:
        """Ids of each distinct part."""
        out, by = {}, {}
        for part in parts:
            if len(part) > SHORT:
                out[part] = self._ids(part, self._merge_long([self.symbol.get(c, -1) for c in part]))
            else:
                by.setdefault(next(w for w in (8, 16, 32, SHORT) if len(part) <= w), []).append(part)
        for width, group in by.items():
            lengths = np.fromiter(map(len, group), np.int64, len(group))
            matrix = np.full((len(group), width), -2, np.int64)
            codes = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), "<u4")
            matrix[np.arange(width) < lengths[:, None]] = self.code[codes]
            merged = self._merge_rows(matrix)
            odd = ((merged == -1) | (merged >= len(self.pieces))).any(1)
            sizes = (merged != -2).sum(1)
            raw, step = merged.astype(np.int32).tobytes(), 4 * width
            ends = (np.arange(len(group)) * step + 4 * sizes).tolist()
            out.update(zip(group, [raw[i * step : end] for i, end in enumerate(ends)]))
            for i in np.flatnonzero(odd).tolist():
                out[group[i]] = self._ids(group[i], merged[i, : sizes[i]].tolist())
        return out


class Encoder:
    """Encodes and decodes with one model and a bounded cache of parts."""

    def __init__(self, blob: bytes):
        self.model = Model(blob)
        self.cache: dict[str, bytes] = {}

    def encode(self, batch: Iterable[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text: ids, the end id last, and the alignment of its normalised bytes."""
        model, cache = self.model, self.cache
        if len(cache) > CACHED:
            cache.clear()
        normal = [model.normalise(t) for t in batch]
        parts = [model.parts.findall(t) for t, _ in normal]
        cache.update(model.merge(set().union(*parts).difference(cache)))
        end = np.array([model.end], np.int32).tobytes()
        made = [np.frombuffer(b"".join([*map(cache.__getitem__, row), end]), np.int32) for row in parts]
        for part in {p for row in parts if max(map(len, row), default=0) > SHORT for p in row if len(p) > SHORT}:
            del cache[part]
        return [(ids, align) for ids, (_, align) in zip(made, normal)]

    def spans(self, ids: np.ndarray, align: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Source bytes from and to of every piece; an added or swallowed blank has an empty span."""
        edge = np.concatenate(([0], np.cumsum(self.model.length[ids])))
        place = align[np.minimum(edge, len(align) - 1)]
        return place[:-1], place[1:]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the pieces without the added blank; bytes that are no UTF-8 become U+FFFD."""
        made = b"".join(map(self.model.surface.__getitem__, ids.tolist()))
        if (self.model.prefix or self.model.squeeze) and made.startswith(b" "):
            made = made[1:]
        return made.decode("utf-8", "replace")


_ENCODERS: dict[bytes, Encoder] = {}


def encoder(blob: bytes) -> Encoder:
    """The worker's encoder of a model; kept between tasks."""
    name = hashlib.sha256(blob).digest()
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(blob)
    return _ENCODERS[name]


def _groups(column: pa.Array, size: int = 1 << 19) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of slices of bounded size."""
    row, held, total = 0, [], 0
    for i, text in enumerate(column):
        held.append(text.as_py())
        total += len(held[-1])
        if total >= size:
            yield row, held
            row, held, total = i + 1, [], 0
    if held:
        yield row, held


def encode(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``ids`` of every text, ``begins`` and ``ends`` of the pieces in its UTF-8 bytes.

    The end id is last, with an empty span; a null or empty text has only it.
    Rows repeated under one key get one result each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        own = encoder(shared.value)
        for row, held in _groups(batch.column(1)):
            made = own.encode(held)
            spans = [own.spans(*m) for m in made]
            edge = pa.array(np.concatenate(([0], np.cumsum([len(m[0]) for m in made]))), pa.int32())
            column = lambda parts, kind: pa.ListArray.from_arrays(edge, pa.array(np.concatenate(parts), kind))
            yield {
                key: batch.column(0)[row : row + len(held)],
                "ids": column([m[0] for m in made], pa.int32()),
                "begins": column([s[0] for s in spans], pa.int64()),
                "ends": column([s[1] for s in spans], pa.int64()),
            }

    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, ids array<int>, begins array<bigint>, ends array<bigint>"
    return map_batches(docs, [key, texts(docs, text)], make, schema)


def decode(encoded: DataFrame, model: bytes, key: str = "doc_id") -> DataFrame:
    """``text`` of every row of ``ids``; null ids read as none."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        own = encoder(shared.value)
        rows = [own.decode(np.array(ids.as_py() or [], np.int32)) for ids in batch.column(1)]
        yield {key: batch.column(0), "text": pa.array(rows, pa.string())}

    kind = encoded.schema[key].dataType.simpleString()
    return map_batches(encoded, [key, "ids"], make, f"{key} {kind}, text string")


def digests(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and digests of the encoding and of its decoding, made beside the encoding.

    ``source_bytes`` is the length of the pieces' spans, which is that of the
    text where the character map drops nothing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        own = encoder(shared.value)
        names = own.model.text.__getitem__
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for row, held in _groups(batch.column(1)):
            made = own.encode(held)
            spans = [own.spans(*m) for m in made]
            yield {
                key: batch.column(0)[row : row + len(held)],
                "n_tokens": pa.array([len(m[0]) for m in made], pa.int64()),
                "ids_sha256": [digest(" ".join(map(names, m[0].tolist()))) for m in made],
                "decoded_sha256": [digest(own.decode(m[0])) for m in made],
                "source_bytes": pa.array([int((b - a).sum()) for a, b in spans], pa.int64()),
            }

    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, source_bytes bigint"
    return map_batches(docs, [key, texts(docs, text)], make, schema)
