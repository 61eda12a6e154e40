"""Personal data by rules and a semi-Markov conditional random field.

The rules give the base spans. The random field scores whole candidate
segments (digit counts, grouping, check digits, neighbours) and a dynamic
program over segments of bounded length picks the boundaries and kinds that fit
best together; its spans are added where no base span stands. It learns from
the base spans of a bounded sample of texts, some of them rewritten into forms
that the rules do not know, and some into look-alikes that are no personal data.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelweave.llm import textvec as tv
from panelweave.llm.arrow import map_batches, texts, written

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGITS = re.compile(r"[0-9]+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+")
#: What a region with candidates is built around, and how many characters belong to it on either side.
TRIGGER = re.compile(r"[0-9]+|@|[(\[]at[)\]]")
AROUND = 24
#: Digit groups of a candidate at most, and characters of a number or of an address before its sign.
GROUPS, CHARS = 8, 64
NUMBER = re.compile(r"[+(]{0,2}[0-9]+")
NEXT = re.compile(r"[\x20().\-/]{1,3}[0-9]+")
SIGN = re.compile(r"@|[(\[]at[)\]]")
ADDRESS = re.compile(r"\x20?(?:@|[(\[]at[)\]])\x20?([A-Za-z0-9-]+(?:(?:\.|\x20dot\x20)[A-Za-z0-9-]+)+)")
#: Texts and regions that serve to learn at most, and characters of such a text.
SAMPLE, REGIONS, LONGEST = 1500, 1200, 20_000


def luhn(digits: str) -> bool:
    """Whether the last digit is the right check digit."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the rules by kind, then start; all in one pass per kind, whatever the text."""
    out = []
    last, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < at and (m := DOMAIN.match(text, at)):
            out.append(("email", begin, m.end()))
            last = m.end()
        else:
            last = at + 1
        at = text.find("@", max(last, at + 1))
    runs = [m.span() for m in DIGITS.finditer(text)]
    for chain in _chains(runs, text, "."):
        for i in range(0, len(chain) - 3, 4):
            four = chain[i : i + 4]
            if all(_byte(text[a:b]) for a, b in four):
                out.append(("ip", four[0][0], four[3][1]))
    for chain in _chains(runs, text, " -"):
        count = sum(b - a for a, b in chain)
        if 13 <= count <= 19 and luhn("".join(text[a:b] for a, b in chain)):
            out.append(("card", chain[0][0], chain[-1][1]))
    at = text.find("+")
    while at >= 0:
        if m := PHONE.match(text, at):
            end = m.end()
            while not text[end - 1].isdigit():
                end -= 1
            if end >= at + 4 and 9 <= sum(map(len, DIGITS.findall(text, at, end))) <= 15:
                out.append(("phone", at, end))
        at = text.find("+", at + 1)
    return out


def _chains(runs: list[tuple[int, int]], text: str, joints: str) -> Iterator[list[tuple[int, int]]]:
    """Digit runs that are joined by single characters."""
    chain: list[tuple[int, int]] = []
    for run in runs:
        if chain and not (run[0] == chain[-1][1] + 1 and text[chain[-1][1]] in joints):
            yield chain
            chain = []
        chain.append(run)
    if chain:
        yield chain


# --- candidates and their features ------------------------------------------


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around digits and at signs, with whole addresses; neighbours that meet are one."""
    found = []
    for m in TRIGGER.finditer(text):
        low, high = m.start() - AROUND, m.end() + AROUND
        if not m.group()[0].isdigit() and (address := _address(text, m.start())):
            low, high = min(low, address[0]), max(high, address[1].end())
        found.append((low, high))
    low = high = None
    for a, b in sorted(found):
        if low is not None and a > high:
            yield max(0, low), min(len(text), high)
            low = None
        low, high = (a, b) if low is None else (low, max(high, b))
    if low is not None:
        yield max(0, low), min(len(text), high)


def _address(text: str, at: int) -> tuple[int, re.Match] | None:
    """Where the address of the sign at a place begins, and its match from the sign to the end of the host."""
    m = ADDRESS.match(text, at - (text[at - 1 : at] == " "))
    if not m:
        return None
    begin = m.start()
    while begin > 0 and m.start() - begin < CHARS and text[begin - 1] in LOCAL:
        begin -= 1
    return (begin, m) if begin < m.start() else None


def _side(text: str, at: int) -> str:
    if not 0 <= at < len(text):
        return "edge"
    c = text[at]
    return "letter" if c.isalpha() else "digit" if c.isdigit() else "blank" if c.isspace() else c if c in "@.-_+/:=\"" else "mark"


def candidates(text: str, low: int, high: int) -> list[tuple[int, int, list[str]]]:
    """Segments of a region that may be an entity, with the features of the whole segment."""
    out = []
    for m in NUMBER.finditer(text, low, high):
        for begin in dict.fromkeys((m.start(), m.end() - len(m.group().lstrip("+(")))):
            at, groups, joints = m.end(), [m.group().lstrip("+(")], []
            while True:
                _number(out, text, begin, at, groups, joints)
                step = NEXT.match(text, at, high) if len(groups) < GROUPS else None
                if not step or step.end() - begin > CHARS or sum(map(len, groups)) > 19:
                    break
                gap = step.group().rstrip("0123456789")
                groups.append(step.group()[len(gap) :])
                joints.append(gap)
                at = step.end()
    for at in SIGN.finditer(text, low, high):
        if address := _address(text, at.start()):
            begin, m = address
            sign = m.group()[: m.start(1) - m.start()]
            name, site = text[begin : m.start()], m.group(1)
            out.append(
                (begin, m.end(), [
                    "mail", f"sign={sign.strip()}", f"blank={' ' in sign}", f"dots={min(site.count('.') + site.count(' dot '), 3)}",
                    f"tld={site.replace(' dot ', '.').rpartition('.')[2].isalpha()}", f"name={name[0].isalnum()}",
                    f"left={_side(text, begin - 1)}", f"right={_side(text, m.end())}",
                ])
            )
    return out


def _number(out: list, text: str, begin: int, end: int, groups: list[str], joints: list[str]) -> None:
    digits = "".join(groups)
    if not (7 <= len(digits) <= 19 or len(groups) == 4):
        return
    shape = "-".join(str(len(g)) for g in groups)
    marks = "".join(sorted(set("".join(joints))))
    lead = text[begin : begin + len(text[begin:end]) - len(text[begin:end].lstrip("+("))]
    check = len(digits) >= 13 and luhn(digits)
    dotted = len(groups) == 4 and all(j == "." for j in joints)
    out.append(
        (begin, end, [
            "number", f"n={len(digits)}", f"lead={lead}", f"shape={shape}", f"marks={marks}", f"check={check}",
            f"long={13 <= len(digits) <= 16}&{check}", f"ip={dotted and all(map(_byte, groups))}&{lead}", f"ten={len(digits) in (10, 11, 12)}&{len(groups)}&{lead}",
            f"left={_side(text, begin - 1)}", f"right={_side(text, end)}", f"paired={text[begin:end].count('(') == text[begin:end].count(')')}",
        ])
    )


# --- the random field -------------------------------------------------------


@dataclass
class Field:
    """Weights of (kind, feature)."""

    weights: dict[tuple[str, str], float] = field(default_factory=dict)

    def scores(self, features: Iterable[str]) -> list[float]:
        get = self.weights.get
        features = list(features)
        return [sum(get((kind, f), 0.0) for f in features) - 2.0 for kind in KINDS]

    def best(self, segments: list[tuple[int, int, list[str]]]) -> list[tuple[str, int, int]]:
        """The highest-scoring set of segments that do not overlap, with their kinds."""
        edges, ends = _grid(segments)
        value, back = [0.0] * len(edges), [None] * len(edges)
        for i in range(1, len(edges)):
            value[i] = value[i - 1]
            for start, number in ends[i]:
                scores = self.scores(segments[number][2])
                kind = max(range(len(KINDS)), key=scores.__getitem__)
                if value[start] + scores[kind] > value[i]:
                    value[i], back[i] = value[start] + scores[kind], (start, number, kind)
        out, i = [], len(edges) - 1
        while i > 0:
            if back[i] is None:
                i -= 1
            else:
                start, number, kind = back[i]
                out.append((KINDS[kind], segments[number][0], segments[number][1]))
                i = start
        return out[::-1]

    def chances(self, segments: list[tuple[int, int, list[str]]]) -> list[list[float]]:
        """Probability of every segment and kind under the field."""
        edges, ends = _grid(segments)
        scores = [self.scores(s[2]) for s in segments]
        ahead = [0.0] * len(edges)
        for i in range(1, len(edges)):
            ahead[i] = _sum([ahead[i - 1]] + [ahead[start] + s for start, number in ends[i] for s in scores[number]])
        behind = [0.0] * len(edges)
        starts: list[list[tuple[int, int]]] = [[] for _ in edges]
        for i, group in enumerate(ends):
            for start, number in group:
                starts[start].append((i, number))
        for i in range(len(edges) - 2, -1, -1):
            behind[i] = _sum([behind[i + 1]] + [behind[end] + s for end, number in starts[i] for s in scores[number]])
        out = [[0.0] * len(KINDS) for _ in segments]
        for i, group in enumerate(ends):
            for start, number in group:
                for k, s in enumerate(scores[number]):
                    out[number][k] = math.exp(ahead[start] + s + behind[i] - ahead[-1])
        return out


def _sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _grid(segments: list[tuple[int, int, list[str]]]) -> tuple[list[int], list[list[tuple[int, int]]]]:
    """Boundaries at which segments begin or end; for each the segments that end there."""
    edges = sorted({0} | {e for s in segments for e in s[:2]} | {max((s[1] for s in segments), default=0) + 1})
    place = {e: i for i, e in enumerate(edges)}
    ends: list[list[tuple[int, int]]] = [[] for _ in edges]
    for number, (begin, end, _) in enumerate(segments):
        ends[place[end]].append((place[begin], number))
    return edges, ends


def learn_field(windows: list[tuple[list[tuple[int, int, list[str]]], dict[tuple[int, int], str]]], rounds: int = 20) -> Field:
    """Weights that make the marked segments likely: gradient steps with their own rate per weight."""
    made = Field()
    weights, squares = made.weights, {}
    order = np.random.default_rng(5).permutation(len(windows))
    for _ in range(rounds):
        for w in order:
            segments, gold = windows[w]
            chances = made.chances(segments)
            step: dict[tuple[str, str], float] = {}
            for (begin, end, features), chance in zip(segments, chances):
                for kind, p in zip(KINDS, chance):
                    g = (gold.get((begin, end)) == kind) - p
                    if abs(g) > 1e-4:
                        for f in features:
                            step[kind, f] = step.get((kind, f), 0.0) + g
            for name, g in step.items():
                g -= 1e-3 * weights.get(name, 0.0)
                squares[name] = squares.get(name, 1e-6) + g * g
                weights[name] = weights.get(name, 0.0) + 0.7 * g / math.sqrt(squares[name])
    return made


def _rewritten(kind: str, value: str, rng: np.random.Generator) -> tuple[str, bool]:
    """The value in another form, and whether that still is personal data."""
    d = "".join(DIGITS.findall(value))
    pick = int(rng.integers(6))
    if kind == "phone" and len(d) >= 10:
        a, b, c = d[-10:-7], d[-7:-4], d[-4:]
        forms = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{d[:-10]} {a} {b} {c}", f"20{d[-2:]}-0{d[3]}-1{d[4]} {d[5:7]}", f"{d[:2]}.{d[2]}.{d[3:8]}"]
        return forms[pick], pick < 4
    if kind == "card":
        four = [d[i : i + 4] for i in range(0, len(d), 4)]
        wrong = d[:-1] + str((int(d[-1]) + 1 + pick) % 10)
        return [(".".join(four), True), ("  ".join(four), True), (wrong, False), (wrong, False), (wrong[:10], False), (f"978-{d[3]}-{d[4:6]}-{d[6:12]}-{d[12]}", False)][pick]
    if kind == "email":
        name, _, site = value.partition("@")
        forms = [f"{name} (at) {site}", f"{name}[at]{site}", f"{name} [at] {site.replace('.', ' dot ')}", f"{name} @ {site}", f"@{site}", f"{name}@"]
        return forms[pick], pick < 4
    parts = value.split(".")
    return [(value, True), (value, True), (".".join([parts[0], "999", *parts[2:]]), False), (".".join(parts[:3]), False), (value + ".7", False), ("-".join(parts), False)][pick]


def windows_of(text: str, rng: np.random.Generator | None = None) -> Iterator[tuple[list, dict]]:
    """Candidates and marked segments of each region; with ``rng`` half the base spans are rewritten first."""
    spans = sorted((a, b, kind) for kind, a, b in base_spans(text))
    made, gold, at, sure = [], {}, 0, []
    for a, b, kind in spans:
        if a < at:
            continue
        made.append(text[at:a])
        value, keep = text[a:b], True
        if rng is not None and rng.random() < 0.5:
            value, keep = _rewritten(kind, value, rng)
        begin = sum(map(len, made))
        if keep:
            gold[begin, begin + len(value)] = kind
        sure.append((begin, begin + len(value)))
        made.append(value)
        at = b
    text = "".join([*made, text[at:]])
    for low, high in regions(text):
        segments = candidates(text, low, high)
        if segments:
            yield segments, gold


def added_spans(text: str, base: list[tuple[str, int, int]], model: Field) -> list[tuple[str, int, int]]:
    """Spans of the random field that touch no base span."""
    out = []
    held = np.zeros(len(text) + 1, np.int32)
    for _, a, b in base:
        held[a:b] = 1
    before = np.concatenate(([0], np.cumsum(held))).tolist()
    for low, high in regions(text):
        for kind, a, b in model.best(candidates(text, low, high)):
            if before[a] == before[b]:
                out.append((kind, a, b))
    return out


# --- on tables --------------------------------------------------------------


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Field:
    """Learns from at most ``sample`` texts that have digits or an at sign, in the order of a hash of the key.

    Texts of over ``LONGEST`` characters take no part, and at most ``REGIONS``
    regions of either the plain or the rewritten texts.
    """
    known = docs.where(F.col(key).isNotNull() & F.col(text).rlike("[0-9@]") & (F.length(text) <= LONGEST))
    # ids first: the choice then moves no texts but those chosen
    ids = known.select(F.col(key).alias("__key")).orderBy(F.xxhash64("__key"), "__key").limit(sample)
    chosen = known.join(written(ids.distinct(), "sample"), F.col(key) == F.col("__key")).select(key, text)
    rows = chosen.orderBy(F.xxhash64(key), text).limit(sample).toArrow().column(1).to_pylist()
    rng = np.random.default_rng(11)
    plain = [w for t in rows for w in windows_of(t)][:REGIONS]
    other = [w for t in rows for w in windows_of(t, rng)][:REGIONS]
    return learn_field(plain + other)


def judge(docs: DataFrame, model: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Base counts, the base spans' digest, all spans and the number of added ones, per document.

    Spans are kind:start:end in code points, end exclusive, by kind, then
    start, joined by commas. Null and empty texts have none. Rows repeated
    under one key get one result each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    joined = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    empty = hashlib.sha256(b"").hexdigest()

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        for lo, hi, data, offs in tv.slices(batch.column(1)):
            n = hi - lo
            counts = np.zeros((len(KINDS), n), np.int64)
            prints, spans, more = [empty] * n, [""] * n, np.zeros(n, np.int64)
            marks = tv.count_in(((data >= 48) & (data <= 57)) | (data == 64) | (data == 40) | (data == 91), offs)
            for i in np.flatnonzero(marks).tolist():
                whole = data[offs[i] : offs[i + 1]].tobytes().decode("utf-8", "replace")
                base = base_spans(whole)
                for kind, _, _ in base:
                    counts[KINDS.index(kind), i] += 1
                prints[i] = hashlib.sha256(joined(base).encode()).hexdigest()
                added = added_spans(whole, base, shared.value)
                more[i] = len(added)
                spans[i] = joined(sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1])))
            yield {
                key: batch.column(0)[lo:hi],
                **{f"n_{k}": c for k, c in zip(KINDS, counts)},
                "base_sha256": prints,
                "spans": spans,
                "n_added": more,
            }

    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string, n_added bigint"
    return map_batches(docs, [key, texts(docs, text)], make, schema)
