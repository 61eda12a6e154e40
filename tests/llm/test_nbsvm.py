"""The quality classifier: cells, ratios and descent against plain versions, and held-out accuracy."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import DOCS, documents, split_words, words
from panelweave.llm import nbsvm, queries, textvec as tv


def table(texts):
    out = []
    for lo, hi, data, offs in tv.slices(pa.array(texts, pa.string())):
        made, edge = nbsvm.cells(data, offs)
        out += [made[a:b] for a, b in zip(edge[:-1], edge[1:])]
    return out


def shape(data, before):
    kind = lambda i: int(nbsvm.KIND[data[min(max(i, 0), len(data) - 1)]])
    n = len(data)
    return tuple(map(kind, (0, 1, n - 3, n - 2, n - 1))), min(n, 12), data == before


def grams(text):
    """All n-grams of a text as plain tuples."""
    w = [x.encode() for x in split_words(text)]
    s = [shape(x, w[i - 1] if i else None) for i, x in enumerate(w)]
    runs = lambda name, items, k: {(name, k, *map(str, items[i : i + k])) for i in range(len(items) - k + 1)}
    return set().union(*(runs("word", w, k) for k in (1, 2)), *(runs("shape", s, k) for k in (1, 2, 3)))


def test_cells_are_the_distinct_ngrams(monkeypatch):
    monkeypatch.setattr(tv, "BLOCK", 200)
    texts = [r[1] for r in documents() if r[1] is None or len(r[1]) < 3000] + ["É è", "a", "a a a a", "x! x! x!", "　 　"]
    named = {}
    for text, row in zip(texts, table(texts)):
        expected = grams(text)
        assert len(row) == len(set(row.tolist())) and len(expected) - 3 <= len(row) <= len(expected)
    for text in ("one two. THREE!!", "same same same"):
        for g, c in zip(sorted(grams(text)), [None] * 99):
            named[g] = c
    a, b = table(["one two three four", "zzz one two"])
    shared = grams("one two three four") & grams("zzz one two")
    assert len(np.intersect1d(a, b)) == len(shared)


def test_ratios():
    rows = [np.array([1, 2]), np.array([2]), np.array([2, 3]), np.array([9])]
    got = nbsvm.ratios(rows, np.array([True, True, False, False]), smooth=1.0)
    size = 1 << nbsvm.BITS
    p, q = 3 + size, 3 + size
    assert got[1] == pytest.approx(math.log((2 / p) / (1 / q))) and got[2] == pytest.approx(math.log((3 / p) / (2 / q)))
    assert got[3] == got[9] == pytest.approx(math.log(0.5)) and got[7] == 0


def test_descent_closes_the_duality_gap():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(50, 8, replace=False)) for _ in range(120)]
    values = [rng.normal(size=8) for _ in rows]
    y = np.where(np.array([v.sum() + (r < 10).sum() for r, v in zip(rows, values)]) + rng.normal(size=120) > 1.5, 1.0, -1.0)
    w, alpha = nbsvm.descend(rows, values, y, 50, penalty=0.7, rounds=5000, close=1e-7)
    margin = np.array([w[r] @ v + w[-1] for r, v in zip(rows, values)])
    primal = w @ w / 2 + 0.7 * np.maximum(0, 1 - y * margin).sum()
    assert primal == pytest.approx(alpha.sum() - w @ w / 2, rel=1e-4)
    assert (alpha >= 0).all() and (alpha <= 0.7).all() and 0 < alpha.min() + 0.7


def test_logistic_meets_its_score_equations():
    rng = np.random.default_rng(1)
    x = rng.normal(size=4000)
    good = rng.random(4000) < 1 / (1 + np.exp(-(2 * x - 1)))
    weight = np.where(good, 2.0, 1.0)
    slope, offset = nbsvm.logistic(x, good, weight)
    left = weight * (1 / (1 + np.exp(-(slope * x + offset))) - good)
    assert abs(left.sum()) < 1e-3 and abs(left @ x) < 0.1 and 1.7 < slope < 2.3


def test_scores_follow_the_formula():
    rng = random.Random(1)
    texts = [words(rng, 40) for _ in range(40)] + [words(rng, 40).upper() + " JUNK!! JUNK!!" for _ in range(40)]
    good = np.arange(80) < 40
    rows = table(texts)
    own = nbsvm.fit(rows, good, np.ones(80))
    ratio = nbsvm.ratios(rows, good)
    w, _ = nbsvm.descend(rows, nbsvm._scaled(rows, ratio), np.where(good, 1.0, -1.0), 1 << nbsvm.BITS)
    square, weight = own.table()
    for row in table(texts[::7] + ["never seen words"]):
        v = ratio[row]
        plain = float(w[row] @ v) / (math.sqrt(v @ v) or 1) + w[-1]
        assert weight[row].sum() / max(math.sqrt(square[row].sum()), 1e-6) + own.bias == pytest.approx(plain)


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    judged = queries.op12_quality_classifier(spark, path)
    marks = spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "quality")
    rows = judged.where("held_out").join(marks, "doc_id").groupBy("quality", "predicted").count().collect()
    n = {(r["quality"], r["predicted"]): r["count"] for r in rows}
    assert n.get((1, 0), 0) <= 0.01 * n[1, 1] and n.get((0, 1), 0) <= 0.1 * n[0, 0]


def test_only_rows_not_held_out_teach(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, 20) if i % 2 else words(rng, 20).upper()) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    right = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    wrong = right.withColumn("quality", F.when(nbsvm.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    sums = [sorted(map(tuple, nbsvm.judge(docs, x).select("doc_id", "score").collect())) for x in (right, wrong)]
    assert sums[0] == sums[1]


def test_odd_rows(spark):
    docs = spark.createDataFrame(documents(), DOCS).withColumns({c: F.lit(1) for c in ("good", "cells", "score", "margin", "quality")}).repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(50)] + [(None, 1), (7, None), (7, 0), (999, 1)], "doc_id long, quality int")
    rows = nbsvm.judge(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    plain = [r["score"] for r in rows if r["doc_id"] in (4, 5, 8)]
    assert len(set(plain)) == 1
    for some in (labels.limit(0), labels.where("quality = 1"), labels.where("quality = 0")):
        assert nbsvm.judge(docs, some).where("score between 0 and 1").count() == docs.count()
    assert nbsvm.judge(docs.limit(0), labels).count() == 0
