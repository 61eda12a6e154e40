"""Each operator against a plain version on small tables with odd rows."""

import hashlib
import math
import random
import re
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import DOCS, all_runs, documents, lowered, near_duplicates, shingles, split_words, without_repeats, words
from panelweave.llm import decontam, lines, minhash, pieces, pii, quality, spans, suffixes, textvec, toxicity, urls

KEY_LAST = lambda row: (row[0] is None, row[0] or 0, str(row[1:]))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 5 != 0), int(i % 4 == 0)) for i in range(50)] + [(None, 1, 1), (7, None, None), (7, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def got(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=KEY_LAST)


def clashing(docs):
    """Extra columns named like results and like things inside the operators."""
    names = ["kept", "n_words", "n_shingles", "component_id", "n_lines", "n_removed", "lines", "row", "lead", "score", "spans", "ids", "node", "bands", "marks"]
    return docs.withColumns({n: F.lit("x") for n in names})


# --- text vectors


def test_word_hashes_tell_words_apart_across_slices(monkeypatch):
    monkeypatch.setattr(textvec, "BLOCK", 64)
    texts = [words(random.Random(i), 50) for i in range(20)] + ["", None, "x" * 500]
    seen = {}
    for lo, hi, data, offs in textvec.slices(pa.array(texts)):
        starts, ends, first = textvec.words(data, offs)
        h = textvec.hashes(data, starts, ends)
        for i in range(lo, hi):
            part = h[first[i - lo] : first[i - lo + 1]]
            assert len(part) == len(split_words(texts[i]))
            for w, x in zip(split_words(texts[i]), part):
                assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("k", [1, 3, 5])
def test_shingle_sets(k):
    texts = ["a b c d a b c", "A B", None, "", " x ", "a b c", "z z z z z z"]
    sizes = [n for *_, begin in textvec.shingle_sets(pa.array(texts), k) for n in np.diff(begin)]
    assert sizes == [len(shingles(t, k)) for t in texts]


def test_temporaries_of_a_long_column_stay_small(monkeypatch):
    monkeypatch.setattr(textvec, "POWERS", textvec._Powers())
    column = pa.array([words(random.Random(i), 150) for i in range(4000)])
    tracemalloc.start()
    for _, _, data, offs in textvec.slices(column):
        quality._slice_statistics(data, offs, 8)
    for _, _, sets, begin in textvec.shingle_sets(column, 5):
        minhash.signatures(sets, begin)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 << 20


# --- 1: URL filters

URLS = [
    None, "", "no scheme", "http://", "http://COM/", "https://A.Example.COM/en/x?y=/en/", "http://www.example.com/en/",
    "http://x.www.example.com/en/../a", "http://example.com", "http://example.com?/en/", "ftp://a.net/es/", "http://net/fr",
    "http://net/fr/1", "http://.net/es/", "http://badexample.com/en/", "x://y://z.com/", "http://a.b.c.d.e.f.com/" + "a/" * 300,
    "http://example.com/en/", "http://example.com/en/", "http://EXAMPLE.com/EN/", "http://user@net:80/es/", "http://a.com\n/en/",
]


def plain_verdict(url, rules, default="allow"):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (lowered(m.group(1)), m.group(2)) if m else ("", "")
    fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, False, None, default))
    return host, path, best[3], best[4]


@pytest.mark.parametrize("rules", [urls.RULES, (("block", "com", "/en"), ("allow", "com", "/e"), ("block", "com", ""), ("allow", "com", "/en")), ()])
def test_url_filters(spark, rules):
    pages = spark.createDataFrame([(i, u, "extra") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    known = urls.rule_table(spark, rules) if rules else spark.createDataFrame([], "verdict string, host string, path string")
    rows = got(urls.judge(pages, known), "page_id", "host", "path", "rule", "verdict")
    assert rows == [(i, *plain_verdict(u, rules)) for i, u in enumerate(URLS)]
    assert urls.judge(pages.limit(0), known).count() == 0


def test_url_filters_stay_in_the_engine(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    plan = urls.judge(pages, urls.rule_table(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- 2: PII

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_base(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choices("01234567890123456789+++ -.-.()@@ab%_é", k=rng.randint(0, 60)))
        assert pii.base_spans(text) == plain_base(text), text


def test_long_odd_texts_take_no_square_time():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "+1 " * 60_000, "@" * 200_000, "1 2-" * 50_000):
        assert len(pii.base_spans(text)) < 60_000


def personal(rng):
    card = "".join(rng.choices("0123456789", k=15))
    card += next(str(d) for d in range(10) if pii.luhn(card + str(d)))
    return rng.choice([f"{rng.choice(['a.b', 'x7', '12'])}@{rng.choice(['', 'mail.'])}example.org", f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", card, ".".join(str(rng.randrange(256)) for _ in range(4))])


def test_random_field_adds_spans_and_leaves_clean_texts(spark):
    rng = random.Random(5)
    rows = [(i, " ".join([words(rng, 12), personal(rng), words(rng, 12), personal(rng), words(rng, 5)])) for i in range(150)]
    model = pii.learn(spark.createDataFrame(rows, "doc_id long, text string"))
    tests = [
        ("card 4111111111111111 4111111111111111 twice", 2), ("call (555) 123-4567 now", 1), ("mail a.b [at] site dot org", 1),
        ("no data here, only words", 0), ("number 4111111111111112 fails", 0), ("on 2024-01-15 at 10:30", 0), (None, 0), ("", 0),
    ]
    frame = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(tests)], "doc_id long, text string, spans string")
    for i, n_added, spans_ in got(pii.judge(frame, model), "doc_id", "n_added", "spans"):
        assert n_added == tests[i][1], tests[i]
        assert len([s for s in spans_.split(",") if s]) >= tests[i][1]
    out = got(pii.judge(spark.createDataFrame(rows, "doc_id long, text string"), model), "doc_id", "base_sha256", "spans")
    for (i, text), (_, digest, all_) in zip(rows, out):
        base = [f"{k}:{a}:{b}" for k, a, b in plain_base(text)]
        assert digest == hashlib.sha256(",".join(base).encode()).hexdigest() and set(base) <= set(all_.split(","))


def test_long_addresses_are_whole_candidates():
    hosts = ["mathematics.uni-hamburg.de", "research-institute dot org", "universityhospital dot org"]
    hosts += ["h" * (n - 4) + ".org" for n in (25, 40, 64, 300)] + ["sub.domain." * 5 + "example.net"]
    for local in ("anna.b", "maximilian.schwarzenberger-lindt", "l" * 25, "x." * 31 + "yz", "a1" * 32):
        for sign in ("@", " (at) ", "[at]", " [at] "):
            for host in hosts:
                text = f"please write to {local}{sign}{host}, with some words before and after it"
                spots = [(a, b) for a, b in pii.regions(text)]
                found = [text[s[0] : s[1]] for a, b in spots for s in pii.candidates(text, a, b) if s[2][0] == "mail"]
                assert found == [local + sign + host]
                assert all(x[1] < y[0] for x, y in zip(spots, spots[1:]))


def test_random_field_adds_long_addresses_whole(spark):
    rng = random.Random(5)
    rows = [(i, " ".join([words(rng, 12), personal(rng), words(rng, 12), personal(rng), words(rng, 5)])) for i in range(150)]
    model = pii.learn(spark.createDataFrame(rows, "doc_id long, text string"))
    mails = ["maximilian.schwarzenberger-lindt (at) example.org", "anna.b [at] mathematics.uni-hamburg.de", "anna.b [at] research-institute dot org", "anna.b [at] universityhospital dot org"]
    frame = spark.createDataFrame([(i, f"write to {m} today") for i, m in enumerate(mails)], "doc_id long, text string")
    out = got(pii.judge(frame, model), "doc_id", "n_added", "spans")
    assert out == [(i, 1, f"email:9:{9 + len(m)}") for i, m in enumerate(mails)]


@pytest.mark.parametrize("text", ["x +1 (555) 123-4567", "call 20 8123 4567 or", "id 10.20.30.40.7 y", "a.b (at) c.org, 555 123 4567"])
def test_field_is_a_distribution_over_segmentations(text):
    import itertools
    import math

    segments = [s for low, high in pii.regions(text) for s in pii.candidates(text, low, high)]
    assert 2 <= len(segments) <= 7
    kind = {s[2][0] for s in segments}
    model = pii.Field({(k, f): 1.1 * i + 0.9 for i, k in enumerate(pii.KINDS) for f in kind})
    model.weights |= {(k, f): 0.2 * ((7 * i + 3 * len(f)) % 11 - 5) for i, k in enumerate(pii.KINDS) for s in segments for f in s[2][1:]}
    total, marginal, best = 0.0, [[0.0] * len(pii.KINDS) for _ in segments], (-1.0, None)
    for chosen in itertools.product(range(-1, len(pii.KINDS)), repeat=len(segments)):
        picked = [(i, k) for i, k in enumerate(chosen) if k >= 0]
        ends = sorted(segments[i][:2] for i, _ in picked)
        if any(x[1] > y[0] for x, y in zip(ends, ends[1:])):
            continue
        weight = math.exp(sum(model.scores(segments[i][2])[k] for i, k in picked))
        total += weight
        best = max(best, (weight, sorted((pii.KINDS[k], *segments[i][:2]) for i, k in picked)))
        for i, k in picked:
            marginal[i][k] += weight
    for chances, row in zip(model.chances(segments), marginal):
        assert all(abs(c - m / total) < 1e-9 for c, m in zip(chances, row))
    found = model.best(segments)
    number = {s[:2]: i for i, s in enumerate(segments)}
    score = sum(model.scores(segments[number[a, b]][2])[pii.KINDS.index(k)] for k, a, b in found)
    assert found and abs(math.exp(score) - best[0]) < 1e-9 * best[0]


def test_added_spans_take_time_in_line_with_the_text():
    import time

    model = pii.Field({(k, "mail"): 9.0 if k == "email" else -9.0 for k in pii.KINDS})
    text = " ".join(f"a{i}@b.org c{i} (at) d.org" for i in range(50_000))
    began = time.time()
    base = pii.base_spans(text)
    added = pii.added_spans(text, base, model)
    assert len(base) == len(added) == 50_000 and time.time() - began < 30
    held = {(a, b) for _, a, b in base}
    assert not held & {(a, b) for _, a, b in added}


# --- 3: quality rules


def plain_statistics(text):
    w = split_words(text)
    lines_ = [x for x in (text or "").split("\n") if split_words(x)]
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    repeat = {i + j for at in seen.values() if len(at) > 1 for i in at for j in range(8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines_) - len(set(lines_)), len(repeat))


def test_statistics(docs):
    names = [c.split()[0] for c in quality.STATISTICS.split(", ")]
    rows = got(quality.statistics(clashing(docs)), "doc_id", *names)
    assert rows == sorted(((r[0], *plain_statistics(r[1])) for r in documents()), key=KEY_LAST)


def test_quality_judgement(spark, docs, labels):
    rng = random.Random(2)
    good = [(i, words(rng, 80), "en", "s", 0) for i in range(300)]
    bad = [(1000 + i, re.sub(r"(\w+)", r"\1%%%", words(rng, 80)), "en", "s", 0) for i in range(20)]
    frame = spark.createDataFrame(good + bad, DOCS)
    marks = spark.createDataFrame([(i, 1, 0) for i in range(200)] + [(1000, 0, 0)], "doc_id long, quality int, toxic int")
    kept = {r[0]: r[1] for r in got(quality.judge(frame, marks), "doc_id", "kept")}
    assert sum(kept[i] for i in range(200, 300)) >= 97 and not any(kept[1000 + i] for i in range(20))
    out = quality.judge(clashing(docs), labels)
    assert out.count() == docs.count() and out.where("base_failed and kept or kept is null").count() == 0
    assert quality.judge(docs.limit(0), labels).count() == 0
    assert quality.judge(docs, labels.limit(0)).where("kept = base_failed").count() == 0


def test_forest_scores_follow_path_lengths():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(40, 3)), [[9.0, 9.0, 9.0]]])
    forest = quality.grow(x, trees=5, rows=16, seed=1)

    def usual(n):
        return 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else float(n == 2)

    def path(row, node):
        f = forest.feature[node]
        return forest.path[node] if f < 0 else path(row, forest.left[node] + int(row[f] >= forest.cut[node]))

    want = [2 ** -(sum(path(row, r) for r in forest.roots) / 5 / usual(16)) for row in x]
    assert np.allclose(forest.score(x), want)
    assert np.argmax(quality.grow(x, trees=128, rows=41).score(x)) == 40

    def leaves(node, depth):
        if forest.feature[node] < 0:
            return [(depth, forest.path[node])]
        return leaves(forest.left[node], depth + 1) + leaves(forest.left[node] + 1, depth + 1)

    for root in forest.roots:
        ends, left = leaves(root, 0), []
        for depth, length in ends:
            # a leaf's path is its depth and the usual path among the rows left in it
            left.append(next(n for n in range(17) if abs(depth + usual(n) - length) < 1e-9))
            assert depth <= 4 and (left[-1] <= 1 or depth == 4)
    assert len(quality.grow(x[:1], trees=2).roots) == 2


def test_threshold_rejects_the_stated_share(spark):
    rng = random.Random(8)
    rows = [(rng.random(), 1) for _ in range(500)] + [(rng.random(), 0) for _ in range(50)]
    frame = spark.createDataFrame([*rows, (0.999, None)], "anomaly double, quality int")
    for wrong in (0.0, 0.01, 0.1):
        limit = quality.threshold(frame, wrong=wrong)
        rejected = lambda t: sum(a > t for a, q in rows if q == 1)
        assert rejected(limit) <= wrong * 500 < rejected(limit - 1 / 2000)
    assert quality.threshold(frame.where("quality = 0")) == 2.0


def test_repeated_lines_reach_the_forest(spark):
    text = "one two\nthree\none two\n\none two"
    frame = spark.createDataFrame([(1, text), (2, None), (3, "\n\n")], "doc_id long, text string")
    assert got(quality.statistics(frame), "doc_id", "dup_line_share") == [(1, 0.5), (2, 0.0), (3, 0.0)]


# --- 4: decontamination


def test_leaks(spark):
    rng = random.Random(4)
    items = [(i, " ".join(f"b{rng.randrange(5000)}" for _ in range(rng.randint(15, 60)))) for i in range(20)]
    items += [(90, None), (91, ""), (92, "too short item"), (None, " ".join(f"n{i}" for i in range(20))), (3, items[3][1])]
    docs, want = [], set()
    for i in range(200):
        text = " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(1, 300)))
        if i % 3 == 0:
            item, passage = items[rng.randrange(20)]
            part = passage.split()
            if i % 2:
                for j in range(2, len(part), 6):
                    part[j] = "swapped"
            text += " " + " ".join(part).upper() + ", " + text
            want.add((i, item))
        docs.append((i, text))
    docs += [(500, None), (501, ""), (None, items[2][1]), (502, " ".join(f"n{i}" for i in range(20))), (0, docs[0][1])]
    want |= {(None, 2), (502, None)}
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, seeds string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.leaks(frame, tests)
    assert {tuple(r) for r in found.select("doc_id", "item_id").collect()} == want
    assert found.count() == len(want)
    assert decontam.leaks(frame.limit(0), tests).count() == 0 == decontam.leaks(frame, tests.limit(0)).count()


def test_masks_hit_every_window_with_three_substitutions():
    import itertools

    for wrong in itertools.combinations(range(decontam.WINDOW), 3):
        assert any(not {o + s for o in mask} & set(wrong) for mask in decontam.MASKS for s in range(decontam.WINDOW - mask[-1]))


@pytest.mark.parametrize("n", range(1, 15))
def test_masks_hit_every_short_item_with_the_substitutions_allowed(n):
    import itertools

    allowed = n - -(-n * decontam.PERCENT // 100)
    masks = decontam.SHORT.get(n) or [(s, m) for m in decontam.MASKS for s in range(n - m[-1])]
    for wrong in itertools.combinations(range(n), allowed):
        assert any(not {o + s for o in mask} & set(wrong) for s, mask in masks)


def plain_pairs(docs, items):
    """(document, item) with a whole item or 15 of its tokens that agree to 80 percent, items of every length."""
    split = lambda t: re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", lowered(t))
    out = set()
    for key, text in docs:
        a = split(text)
        for item, other in items:
            b = split(other)
            w = min(decontam.WINDOW, len(b))
            places = [(i, j) for i in range(len(a) - w + 1) for j in range(len(b) - w + 1)]
            if b and any(100 * sum(a[i + k] == b[j + k] for k in range(w)) >= decontam.PERCENT * w for i, j in places):
                out.add((key, item))
    return out


def test_leaks_of_items_of_every_length(spark):
    import itertools

    rng = random.Random(14)
    items = [(10 * n + i, " ".join(f"i{n}x{i}x{k}" for k in range(n))) for n in range(1, 19) for i in range(2)]
    docs = []
    for item, text in items:
        part = text.split()
        allowed = min(len(part), 15) - -(-min(len(part), 15) * decontam.PERCENT // 100)
        wrongs = [w for r in range(allowed + 2) for w in itertools.combinations(range(len(part)), r)]
        for wrong in wrongs if len(wrongs) < 60 else rng.sample(wrongs, 60):
            changed = ["other" if k in wrong else p for k, p in enumerate(part)]
            docs.append((len(docs), " ".join([words(rng, rng.randint(0, 30)), *changed, words(rng, rng.randint(1, 30))])))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = decontam.leaks(frame, spark.createDataFrame(items, "item_id long, text string"))
    rows = [tuple(r) for r in found.select("doc_id", "item_id").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain_pairs(docs, items)


# --- 5: toxicity


def test_toxicity(spark):
    rng = random.Random(6)
    rows, marks = [], []
    for i in range(600):
        toxic = i % 6 == 0
        text = words(rng, 80)
        if toxic:
            w = text.split(" ")
            w[rng.randrange(len(w))] = rng.choice(["vile", "nasty", "foulmouthed"])
            text = " ".join(w)
        rows.append((i, text))
        marks.append((i, 1, int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    out = {r[0]: r for r in got(toxicity.judge(docs, labels), "doc_id", "held_out", "score", "predicted", "offending")}
    held = [i for i in out if out[i][1]]
    assert 80 <= len(held) <= 160 and all(0 <= r[2] <= 1 for r in out.values())
    assert np.mean([out[i][3] == (i % 6 == 0) for i in held]) > 0.97
    for i in held:
        for place in filter(None, out[i][4].split(",")):
            a, b = map(int, place.split(":"))
            assert re.search("vile|nasty|foulmouthed", rows[i][1].encode()[a:b].decode())


def test_toxicity_of_odd_rows(docs, labels):
    out = toxicity.judge(clashing(docs), labels)
    rows = got(out, "doc_id", "score", "predicted")
    assert len(rows) == len(documents()) and all(0 <= s <= 1 and p == int(s >= 0.5) for _, s, p in rows)
    assert {s for i, s, _ in rows if i in (4, 5, 8)} == {0.0}
    assert toxicity.judge(docs.limit(0), labels).count() == 0
    assert toxicity.judge(docs, labels.limit(0)).where("predicted = 1").count() == 0
    # nothing serves to learn, all is scored
    none = toxicity.judge(docs, labels, longest=0)
    assert none.count() == len(documents()) and none.where("predicted = 1").count() == 0


def plain_toxicity(text, weights, bias):
    """Noisy-or of the sentence scores, and the sentences of 0.5 or more, word by word."""
    raw = (text or "").encode()
    none, worst, places = 1.0, 0.0, []
    for part in re.finditer(rb"[^.!?\n]+", raw):
        found = list(re.finditer(rb"[A-Za-z0-9\x80-\xff]+", part[0]))
        if not found:
            continue
        total = bias
        for word in found:
            cells = toxicity.sentences(np.frombuffer(word[0], np.uint8), np.array([0, len(word[0])]))[0]
            total += sum(weights.get(int(c), 0.0) for c in cells[:, 0] if c)
        p = 1 / (1 + math.exp(-total))
        none, worst = none * (1 - p), max(worst, p)
        if p >= 0.5:
            places.append(f"{part.start() + found[0].start()}:{part.start() + found[-1].end()}")
    return 1 - none, worst, ",".join(places)


def test_toxicity_is_the_noisy_or_of_its_sentences(spark):
    cells = lambda w: toxicity.sentences(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[0][:, 0]
    weights = {int(cells(b"waa")[0]): 1.5, int(cells(b"vileness")[1]): 2.5, int(cells(b"vileness")[0]): 1.0, int(cells(b"wbb")[0]): -0.75}
    model = toxicity.Model(np.array(list(weights)), np.array(list(weights.values())), -3.0)
    texts = [words(random.Random(i), 30 + i, 40) for i in range(40)]
    texts += [None, "", "...", "Vileness", "waa waa. vileness waa\nVILEST vile? é vileness é!", "waa " * 5000, "wbb. " * 3000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for i, made, worst, predicted, places in got(toxicity.score(frame, model), "doc_id", "score", "worst", "predicted", "offending"):
        want = plain_toxicity(texts[i], weights, -3.0)
        assert made == pytest.approx(want[0], abs=1e-5) and worst == pytest.approx(want[1], abs=1e-5), texts[i]
        assert places == want[2] and predicted == int(made >= 0.5), texts[i]


def test_toxicity_fit_is_a_minimum_of_the_noisy_or_loss():
    rng = np.random.default_rng(5)
    bags, toxic = [], np.arange(300) % 3 == 0
    for y in toxic:
        cells = np.zeros((1 + len(toxicity.STEMS), 12), np.int64)
        cells[0] = rng.integers(1000, 1400, 12)
        if rng.random() < (0.8 if y else 0.1):
            cells[0, rng.integers(12)] = 77
        bags.append((cells, np.array([0, 4, 8])))
    weight = np.where(toxic, 2.0, 1.0)
    model = toxicity.fit(bags, toxic, weight)
    assert 77 in model.cells

    def loss(theta, bias):
        by_cell, total = dict(zip(model.cells.tolist(), theta)), 0.0
        for (cells, begin), y, w in zip(bags, toxic, weight):
            none = 1.0
            for part in np.split(cells, begin[1:], axis=1):
                s = bias + sum(by_cell.get(int(c), 0.0) for c in part.ravel())
                none *= 1 - 1 / (1 + math.exp(-s))
            total -= w * math.log(1 - none if y else none)
        return total / weight.sum() + 0.5e-4 * float(np.dot(theta, theta))

    best = loss(model.weights, model.bias)
    for step in (-0.2, 0.2):
        assert loss(model.weights, model.bias + step) > best
        for i in range(len(model.weights)):
            moved = model.weights.copy()
            moved[i] += step
            assert loss(moved, model.bias) > best


# --- 6: MinHash


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, docs, k, percent):
    rows = got(minhash.near_duplicates(clashing(docs), k, percent), "doc_id", "n_shingles", "component_id", "kept")
    assert rows == sorted(near_duplicates([r[:2] for r in documents()], k, percent), key=KEY_LAST)
    assert minhash.near_duplicates(docs.limit(0), k, percent).count() == 0


def test_chains_and_families_at_the_threshold(spark):
    rng = random.Random(8)
    rows = []
    for family in range(4):
        base = [f"f{family}_{i}" for i in range(120)]
        for i in range(40):  # every copy is near the original, copies often not near each other
            copy = list(base)
            for j in rng.sample(range(120), 2 if i else 0):
                copy[j] = f"x{rng.random()}"
            rows.append((family * 100 + 99 - i, " ".join(copy)))
        chain = list(base)
        for i in range(12):
            chain = [*chain[6:], *[f"c{family}_{i}_{j}" for j in range(6)]]
            rows.append((1000 + family * 100 + i, " ".join(chain)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = sorted(near_duplicates(rows, 3, 85))
    assert got(minhash.near_duplicates(frame, 3, 85), "doc_id", "n_shingles", "component_id", "kept") == want


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(textvec.mix(rng.integers(0, 1 << 62, 3000).astype(np.uint64)))
    b = np.concatenate((a[:2400], textvec.mix(rng.integers(0, 1 << 62, 600).astype(np.uint64))))
    sets = np.concatenate((a, np.unique(b)))
    made = minhash.signatures(sets, np.array([0, len(a), len(sets)]), 512)
    assert abs((made[0] == made[1]).mean() - 2400 / 3600) < 0.08


# --- 7: suffixes


@pytest.mark.parametrize("crowd", [2000, 1])
def test_suffix_dedup(docs, crowd):
    out = suffixes.drop_repeats(clashing(docs), crowd=crowd).withColumn("sha", F.sha2("kept", 256))
    rows = got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "sha")
    made = [(r[0], *b) for r, b in zip(documents(), suffixes.brute_force([r[1] for r in documents()]))]
    assert rows == sorted(made, key=KEY_LAST)


def test_suffix_dedup_of_overlaps_and_periods(spark):
    rng = random.Random(9)
    pool = ["".join(rng.choices("ab", k=rng.randint(50, 400))) for _ in range(6)]
    texts = ["".join(rng.choices(pool + ["x" * 150, "é" * 90, "xy" * 120], k=rng.randint(0, 6))) + str(i) for i in range(60)]
    texts += ["z" * 199, "z" * 200, "z" * 1000, "", None, "ab" * 3000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = suffixes.drop_repeats(frame).withColumn("sha", F.sha2("kept", 256))
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == [(i, *b) for i, b in enumerate(suffixes.brute_force(texts))]
    assert suffixes.drop_repeats(frame.limit(0)).count() == 0


def test_long_texts_are_cut_in_parts_alike(monkeypatch):
    data = np.frombuffer(("".join(random.Random(1).choices("abc ", k=5000)) + "q" * 700).encode(), np.uint8)
    whole = suffixes.cut_runs(data, np.array([0, len(data)]))
    monkeypatch.setattr(suffixes, "FAR", 1000)
    parts = suffixes.cut_runs(data, np.array([0, len(data)]))
    windows = lambda found: {(a + i, l) for a, n, l in zip(found["at"].tolist(), found["n"].tolist(), found["lead"].tolist()) for i in range(n)}
    assert windows(whole) == windows(parts) and len(windows(whole)) == len(data) - 199


def test_multikey_sort_finds_equal_suffixes():
    rng = random.Random(2)
    text = "".join(rng.choices("ab", k=300)) * 2 + "".join(rng.choices("ab", k=400))
    data = np.frombuffer(text.encode(), np.uint8)
    at = np.arange(len(text) - 16 + 1)
    group = at % 3
    seen = {}
    for i in at:
        seen.setdefault((i % 3, text[i : i + 16]), []).append(i)
    want = sorted(i for v in seen.values() if len(v) > 1 for i in v)
    assert np.flatnonzero(suffixes.equal_windows(data, at, group, 16)).tolist() == want


# --- 8: lines


def test_line_dedup(spark):
    rows = [(i, f"Header {i % 2}\nbody {i}\n\nbody {i} more text that is long", "en", f"s{i % 2}", 1) for i in range(40)]
    rows += [(100 + i, "copied page\nwith two lines", "en", "s1", 1) for i in range(12)]
    rows += [(200, None, "en", "s0", 1), (201, "", "en", "s0", 1), (202, "Header 0", None, None, None), (203, "Header 0\nown text of a page", "en", "s0", 1)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS + ", lines string, n_lines string")
    out = {r[0]: r[1:] for r in got(lines.drop_boilerplate(frame), "doc_id", "text", "n_lines", "n_removed")}
    assert out[0] == ("body 0\n\nbody 0 more text that is long", 4, 1) and out[203] == ("own text of a page", 2, 1)
    assert out[100] == ("copied page\nwith two lines", 2, 0)  # a copied page is not boilerplate
    assert out[200] == (None, 0, 0) and out[201] == ("", 1, 0) and out[202] == ("Header 0", 1, 0)
    assert lines.drop_boilerplate(frame.limit(0)).count() == 0


def test_near_copies_without_ids_meet_their_own_texts_only(spark, monkeypatch):
    """1,000 near copies under the null id, and 200 under one id: a class gathers one text per copy of it."""
    import random

    rng = random.Random(21)
    base = words(rng, 120, 4000).split()
    texts = []
    for i in range(1000):
        own = list(base)
        own[rng.randrange(len(own))] = f"w{i}"
        texts.append(" ".join(own))
    rows = [(None, t) for t in texts] + [(5, t + " tail") for t in texts[:200]] + [(None, texts[0])] * 3
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    gathered = []
    plain = minhash._class_texts
    monkeypatch.setattr(minhash, "map_batches", lambda df, *a: (gathered.append(df), map_batches(df, *a))[1])

    def counted(*args):
        gathered.clear()
        out = plain(*args)
        gathered.append(gathered[0].count())
        return out

    from panelweave.llm.arrow import map_batches

    monkeypatch.setattr(minhash, "_class_texts", counted)
    counts = []
    keep = minhash.written
    monkeypatch.setattr(minhash, "written", lambda df, name: (counts.append(gathered[-1]) if name == "texts" else None, keep(df, name))[1])
    out = minhash.near_duplicates(docs, 3, 85).collect()
    assert len(counts) == 1 and counts[0] <= len(rows)
    assert len(out) == len(rows) and {r.component_id for r in out} == {5}
    assert sum(r.kept for r in out) == 200


def test_sets_that_share_64_bits_stay_apart(spark, monkeypatch):
    """Every node key made equal: the other 64 bits tell the sets apart."""
    plain = minhash.signed
    monkeypatch.setattr(minhash, "signed", lambda *a, **k: plain(*a, **k).withColumn("node", F.lit(7).cast("bigint")))
    docs = spark.createDataFrame(documents(), DOCS)
    rows = got(minhash.near_duplicates(docs, 3, 85), "doc_id", "n_shingles", "component_id", "kept")
    assert rows == sorted(near_duplicates([r[:2] for r in documents()], 3, 85), key=KEY_LAST)


def plain_lines(rows, ratio, pages):
    """Line dedup in plain Python: (text, n_lines, n_removed) of every (id, text, site)."""
    from collections import Counter

    counts, totals = Counter(), Counter()
    for site, text in {(s, t or "") for _, t, s in rows}:
        totals[site] += 1
        counts.update((site, line) for line in set(text.split("\n")) if line.strip(" "))
    common = lambda s, line: counts[s, line] >= pages and counts[s, line] > totals[s] * ratio
    out = []
    for i, t, s in rows:
        every = (t or "").split("\n")
        few = [x for x in every if not common(s, x)]
        out.append((i, None if t is None else "\n".join(few), 0 if t is None else len(every), len(every) - len(few)))
    return out


def test_line_dedup_is_its_sql_and_its_plain_version(spark):
    """Copies, pages that are mostly boilerplate, null texts and sites; rows over and under either limit."""
    import random

    import duckdb

    rng = random.Random(8)
    shared = [f"site line {i}" for i in range(12)] + ["", "  "]
    rows = []
    for i in range(400):
        site = rng.choice(["a", "a", "a", "b", None])
        own = [rng.choice(shared[: 3 + i % 12]) for _ in range(rng.randrange(4))]
        own += [f"own {rng.randrange(3000)} {i}" for _ in range(rng.randrange(3))]
        rng.shuffle(own)
        rows.append((i if i % 50 else None, "\n".join(own), site))
    rows += [(1000 + i, "copied page\nwith a line of its own", "b") for i in range(60)]
    rows += [(2000, None, "a"), (2001, None, None), (2002, "", "b"), (2003, "site line 0\nsite line 0", "a")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)
    got_ = sorted(map(tuple, lines.drop_boilerplate(docs).select("doc_id", "text", "n_lines", "n_removed").collect()), key=str)
    assert got_ == sorted(plain_lines(rows, lines.RATIO, lines.PAGES), key=str)
    assert sum(r[3] for r in got_) > 100 and any(r[1] == "copied page\nwith a line of its own" for r in got_)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    sql = con.sql(lines.twin()).select("doc_id, text, n_lines, n_removed").fetchall()
    assert sorted(sql, key=str) == got_


def test_line_dedup_on_pages_that_are_mostly_boilerplate(spark):
    rows = [(i, f"The line of the site\nown text {i}", "s") for i in range(60)]
    rows += [(100, "The line of the site\nshort", "s"), (101, "The line of the site", "s")]
    rows += [(200 + i, "The line of the site\na page copied often\nwith a second line", "s") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = {r[0]: r[1:] for r in got(lines.drop_boilerplate(frame), "doc_id", "text", "n_lines", "n_removed")}
    assert out[0] == ("own text 0", 2, 1) and out[100] == ("short", 2, 1) and out[101] == ("", 1, 1)
    assert all(out[200 + i] == ("a page copied often\nwith a second line", 3, 1) for i in range(40))


# --- 9: sentence spans


def test_substring_dedup(spark, docs):
    rows = [r[:2] for r in documents() if r[0] is not None][:-1]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = {r[0]: r[1:] for r in got(spans.drop_repeated_spans(clashing(frame)), "doc_id", "text", "n_sentences", "n_removed")}
    assert out == without_repeats(rows) and sum(r[2] for r in out.values()) > 20
    assert spans.drop_repeated_spans(docs).count() == len(documents())
    assert spans.drop_repeated_spans(docs.limit(0)).count() == 0


def test_passages_of_fifty_words_go_whole(spark):
    rng = random.Random(12)
    for _ in range(20):
        shared = words(rng, 55).rstrip(".!?\n ") + "."
        rows = [(i, words(rng, 40).rstrip(".!?\n ") + f" end{i}.\n" + shared + "\n" + words(rng, 40)) for i in range(3)]
        assert all(shared.split()[-1] in r[1] for r in rows)
        out = without_repeats(rows)
        assert shared in out[0][0] and not any(set(shared.split()[20:30]) <= set(out[i][0].split()[40:60]) for i in (1, 2))


def test_every_run_of_several_sentences_counts(spark):
    rng = random.Random(21)
    few = [" ".join(rng.choices("a b c".split(), k=rng.randint(1, 3))) + rng.choice([". ", "! ", ".\n", "\n"]) for _ in range(8)]
    rows = [(i, "".join(rng.choices(few, k=rng.randint(0, 14))) + rng.choice(["", f"own{i} end."])) for i in range(300)]
    rows += [(300, "Yes it is. So be it. All right."), (301, "Yes it is. So be it. All right."), (302, "Yes it is. So be it. Or not.")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r[0]: r[1:] for r in got(spans.drop_repeated_spans(frame), "doc_id", "text", "n_sentences", "n_removed")}
    assert out == without_repeats(rows, all_runs)
    assert out[301] == ("", 3, 3) and out[302][2] == 0


def test_passages_within_lines_lose_their_whole_sentences(spark):
    rng = random.Random(22)
    own = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    inner = [own(9) + "." for _ in range(6)]
    shared = own(4) + ". " + " ".join(inner) + " " + own(5)
    rows = [(i, f"{own(12)} {shared} {own(7)}. {own(11)}.") for i in range(40)]
    out = dict(got(spans.drop_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "text"))
    assert out[0] == rows[0][1]
    for i in range(1, 40):
        assert not any(s in out[i] for s in inner)
        assert out[i].split()[:12] == rows[i][1].split()[:12] and out[i].split()[-11:] == rows[i][1].split()[-11:]


# --- 10: pieces


@pytest.fixture(scope="module")
def model():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def odd_texts():
    rng = random.Random(1)
    letters = list(" ▁\n\tabcdeinroths éñüß0123.,-=/日本😀́")
    fixed = ["", " ", "  ", "a  b", " x", "▁▁ a ▁b", "日本語テキスト", "a" * 500, " " * 100 + "x" + " " * 17, "<s> </s> <0x0A> <unk>", "in" * 200 + "erer", "=" * 300, "\0a"]
    return fixed + ["".join(rng.choices(letters, k=rng.randint(1, 200))) for _ in range(1500)] + [r[1] or "" for r in documents()]


def test_encoding_is_that_of_the_library(model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model)
    own = pieces.encoder(open(model, "rb").read())
    texts = odd_texts()
    for text, (ids, align) in zip(texts, own.encode(texts)):
        assert ids.tolist() == library.encode(text, add_eos=True), text
        assert own.decode(ids) == library.decode(ids.tolist())
        a, b = own.spans(ids, align)
        assert b"".join(text.encode()[i:j] for i, j in zip(a, b)) == text.encode()


def test_cache_of_pieces_stays_small(model):
    own = pieces.Encoder(open(model, "rb").read())
    for lo in range(0, 140_000, 20_000):
        own.encode([" ".join(f"w{i}" for i in range(lo, lo + 20_000))])
    held = sys.getsizeof(own.cache) + sum(sys.getsizeof(x) for entry in own.cache.items() for x in entry)
    assert 0 < held < 16 << 20


def test_pieces_of_tables(spark, docs, model):
    blob = open(model, "rb").read()
    made = pieces.encode(clashing(docs), blob)
    assert got(pieces.decode(made, blob), "doc_id", "text") == sorted(((r[0], r[1] or "") for r in documents()), key=KEY_LAST)
    rows = got(pieces.digests(docs, blob), "doc_id", "n_tokens", "source_bytes")
    assert rows == got(made.select("doc_id", F.size("ids").cast("long").alias("n"), F.element_at("ends", -1).alias("e")), "doc_id", "n", "e")
    assert pieces.encode(docs.limit(0), blob).count() == 0


def compiled_map(rules: dict[str, str]) -> bytes:
    """A double-array trie over few keys, each node in a block of 256 units of its own."""
    import struct

    strings, place = b"", {}
    for key, value in rules.items():
        place[key.encode()] = len(strings)
        strings += value.encode() + b"\0"
    nodes = {b""} | {k[:i] for k in place for i in range(1, len(k) + 1)}
    base = {n: 256 * (i + 1) for i, n in enumerate(sorted(nodes))}
    units = [0] * (256 * (len(nodes) + 1))
    where = lambda n: base[n[:-1]] ^ n[-1] if n else 0
    for n in nodes:
        here = where(n)
        offset = here ^ base[n]
        units[here] = (offset << 10 if offset < 1 << 21 else (offset >> 8) << 10 | 512) | (n[-1] if n else 0)
        if n in place:
            units[here] |= 256
            units[base[n]] = 0x80000000 | place[n]
    blob = struct.pack(f"<{len(units)}I", *units)
    return struct.pack("<I", len(blob)) + blob + strings


def test_character_map_and_alignment(model):
    rules = {"ﬁ": "fi", "é": "é", "ABC": "x", "AB": "yy", "\t": " ", "\u00ad": ""}
    own = pieces.Model(open(model, "rb").read())
    own.charsmap, own.squeeze = pieces.CharacterMap(compiled_map(rules)), 1
    text = "  ﬁn\tABCAB A é \u00ad "
    made, align = own.normalise(text)
    assert made == "▁fin▁xyy▁A▁é"
    source = text.encode()
    place = lambda part: source.index(part.encode())
    want = {"f": place("ﬁ"), "x": place("ABC"), "A": place("A é")}
    for c, at in want.items():
        assert align[made.encode().index(c.encode())] == at
    assert own.normalise("  \t ")[0] == "" and len(align) == len(made.encode()) + 1
