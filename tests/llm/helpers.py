"""Small tables and plain versions of the operators for the tests."""

from __future__ import annotations

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int, pool: int = 400) -> str:
    """Prose of n words, in sentences and lines."""
    out = []
    for _ in range(n):
        w = "w" + "".join(chr(97 + int(c)) for c in str(rng.randrange(pool)))
        out.append(w + rng.choice(["", "", "", "", "", ".", ".", "!", "?", ".\n"]))
    return " ".join(out)


def documents(seed: int = 1, n: int = 60) -> list[tuple]:
    """Rows with copies, near copies, shared passages, nulls, empties, one long text and repeated rows."""
    rng = random.Random(seed)
    out = []
    shared = words(rng, 60)
    head = "site header line"
    for i in range(n):
        text = words(rng, rng.randint(1, 200))
        if i % 7 == 3:
            text = text + "\n" + shared + "\n" + words(rng, 20)
        if i % 11 == 5 and i > 10:
            text = out[i - 9][1]
        if i % 13 == 6 and i > 12:
            text = (out[i - 8][1] or "") + " tail"
        if i % 3 == 0:
            text = head + "\n" + (text or "")
        out.append((i, text, "en", f"src{i % 3}", len(text or "")))
    out[4] = (4, None, None, None, None)
    out[5] = (5, "", "en", "src1", 0)
    out[8] = (8, " \n\t ", "en", "src2", 4)
    out[9] = (9, words(rng, 20_000, 5000), "en", "src0", 0)
    out[10] = (10, "aaaa " * 300, "en", "src0", 0)
    out[11] = (11, "é" * 900, "fr", "src0", 0)
    out.append(out[20])
    out.append((None, out[21][1], "en", "src0", 0))
    return out


def split_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None, k: int) -> set[tuple]:
    w = split_words(lowered(text or ""))
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or {tuple(w)}


def near_duplicates(rows: list[tuple], k: int, percent: int) -> list[tuple]:
    """(id, size, component, kept) of every row by comparing all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if sets[i] and key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    out = []
    for i, (key, _) in enumerate(rows):
        component = least.get(find(i)) if sets[i] else key
        out.append((key, len(sets[i]), component, key == component))
    return out


def sentences(text: str) -> list[list[tuple[int, str]]]:
    out = []
    for line in re.finditer(r"[^\n]+", text):
        now = []
        for m in re.finditer(r"[^\x20\x09-\x0D]+", line.group()):
            now.append((line.start() + m.start(), m.group()))
            if m.group()[-1] in ".!?":
                out.append(now)
                now = []
        if now:
            out.append(now)
    return out


def sentence_runs(parts: list, several: int = 3, least: int = 16, alone: int = 16) -> list[tuple[int, int]]:
    """The shortest runs that count, from and up to every sentence."""
    n = [len(s) for s in parts]
    made = set()
    for i in range(len(parts)):
        j = i + 1
        while j < len(parts) and j - i + 1 < several and sum(n[i : j + 1]) < least:
            j += 1
        if j < len(parts):
            made.add((i, j))
        j = i - 1
        while j >= 0 and i - j + 1 < several and sum(n[j : i + 1]) < least:
            j -= 1
        if j >= 0:
            made.add((j, i))
        if n[i] >= alone:
            made.add((i, i))
    return sorted(made)


def all_runs(parts: list) -> list[tuple[int, int]]:
    """Every run that counts, of any length."""
    n = [len(s) for s in parts]
    pairs = [(i, j) for i in range(len(parts)) for j in range(i, len(parts))]
    return [(i, j) for i, j in pairs if j - i >= 2 or sum(n[i : j + 1]) >= 16]


def without_repeats(rows: list[tuple], runs=sentence_runs) -> dict:
    """{id: (text, sentences, removed)}; ids are unique."""
    first, out = set(), {}
    for key, text in sorted(rows):
        parts, dead = sentences(text or ""), set()
        for i, j in runs(parts):
            run = tuple(lowered(w) for s in parts[i : j + 1] for _, w in s)
            if run in first:
                dead.update(range(i, j + 1))
            first.add(run)
        edge = [s[0][0] for s in parts] + [len(text or "")]
        kept = (text or "")[: edge[0]] + "".join((text or "")[edge[i] : edge[i + 1]] for i in range(len(parts)) if i not in dead)
        out[key] = (kept, len(parts), len(dead))
    return out
