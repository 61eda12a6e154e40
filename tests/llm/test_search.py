"""Ranked search against scores worked out term by term."""

import math
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import DOCS, documents, lowered, words
from panelweave.llm import queries, search

TERM = re.compile(search.TERM)


def terms(text):
    return TERM.findall(lowered(text or ""))


def plain(docs, items, top):
    """Sorted (item, rank, doc, score); docs and items are (id, text)."""
    rows = [(k, terms(t)) for k, t in docs if terms(t)]
    n_docs, n_terms = len(rows), sum(len(t) for _, t in rows)
    df = {}
    for _, t in rows:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    wanted = {}
    for k, t in items:
        wanted.setdefault(k, set()).update(terms(t))
    out = []
    for item, held in wanted.items():
        found = []
        for key, t in rows:
            m = 100 - 50 + 50 * len(t) * n_docs // n_terms
            score = 0
            for w in held & set(t):
                tf = t.count(w)
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                score += weight * (1000000000 * tf // (1000 * tf + 20 * m))
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        for rank, (score, _, _, key) in enumerate(sorted(found, key=lambda x: x[:3])[:top], 1):
            out.append((item, rank, key, -score))
    return sorted(out, key=str)


def items():
    rng = random.Random(5)
    out = [(i, words(rng, rng.randint(1, 40))) for i in range(30)]
    base = words(rng, 12)
    out += [(100 + i, base + " " + words(rng, 3)) for i in range(10)]
    out += [(200, None), (201, ""), (202, " .,;! "), (203, "nosuchterm"), (5, "wab waa"), (None, "wab wac"), (None, "wad"), (204, "WAB wab Wab é É")]
    return out


@pytest.mark.parametrize("block", [search.BLOCK, 400])
def test_equals_plain_scores(spark, block):
    rows = documents()
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("term", "terms", "score", "rank", "item", "n", "part")}).repartition(5)
    asked = spark.createDataFrame(items(), "item_id long, text string")
    got = search.ranked(docs, asked, top=7, block=block)
    assert sorted(map(tuple, got.collect()), key=str) == plain([(r[0], r[1]) for r in rows], items(), 7)
    if block < search.BLOCK:
        entries = search.item_terms(asked)
        n = search.blocks(entries, block)
        sizes = entries.groupBy(F.pmod(F.xxhash64("item"), F.lit(n)).alias("b")).agg(F.count("term").alias("n"), F.countDistinct("item").alias("i"))
        assert n > 1 and sizes.where(f"n > {block} and i > 1").count() == 0


def test_ties_and_copies(spark):
    rows = [(i, "one same text") for i in range(400)] + [(i, "another") for i in range(400, 420)] + [(7, "one same text"), (None, "one same text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    asked = [(1, "same"), (2, "another text")]
    got = search.ranked(docs, spark.createDataFrame(asked, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, asked, 50)


@pytest.mark.parametrize("docs,asked", [([], [(1, "a b")]), ([(1, "a b")], []), ([(1, None), (2, "")], [(1, "a")]), ([(1, "a")], [(1, "b")])])
def test_nothing_to_find(spark, docs, asked):
    got = search.ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(asked, "item_id long, text string"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


def test_text_keys(spark):
    docs = spark.createDataFrame([("b", "a term"), ("a", "a term"), (None, "a term"), ("c", "other words")], "doc_id string, text string")
    got = search.ranked(docs, spark.createDataFrame([("q", "term")], "item_id string, text string"))
    assert [(r["rank"], r["doc_id"]) for r in got.orderBy("rank").collect()] == [(1, "a"), (2, "b"), (3, None)]


def test_query_equals_its_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        path = f"/root/testdata/{sf}"
        got = sorted(map(tuple, queries.op11_ranked_search(spark, path).select("item_id", "rank", "doc_id", "score").collect()))
        con = duckdb.connect()
        for t in ("documents", "benchmark"):
            con.sql(f"create view {t} as select * from '{path}/{t}.parquet'")
        assert got == sorted(con.sql(search.twin()).fetchall())


def test_graph_gives_the_plain_sums_with_fewer_additions():
    rng = np.random.default_rng(2)
    base = [set(rng.integers(0, 60, 15).tolist()) for _ in range(6)]
    sets = [base[i % 6] | set(rng.integers(0, 90, 4).tolist()) for i in range(60)]
    pairs = [(i, t) for i, s in enumerate(sets) for t in sorted(s)]
    item, term = np.array(pairs).T
    own = search.mine(item, term, 90)
    doc, t = np.nonzero(rng.random((20, 90)) < 0.3)
    t_worth = rng.integers(1, 10**9, len(t))
    dense = np.zeros((90, 20), np.int64)
    dense[t, doc] = t_worth
    worth = {i for i in range(90)} - set(term.tolist())
    dense[sorted(worth)] = 0
    used = ~np.isin(t, sorted(worth))
    got = own.scores(t[used], doc[used], t_worth[used], 20)
    assert (got == np.stack([dense[sorted(s)].sum(0) for s in sets])).all()
    assert own.rounds and own.additions() < 0.6 * (len(pairs) - len(sets))


def test_terms_of_equal_hash_are_told_apart(monkeypatch):
    from panelweave.llm import textvec as tv

    monkeypatch.setattr(tv, "hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    own = search.Terms(["ab", "cd", "abc"])
    data = np.frombuffer(b"cd ab xy abc", np.uint8)
    starts, ends, _ = tv.words(data, np.array([0, len(data)]), tv.IS_ALNUM)
    word, term = own.find(data, starts, ends)
    assert sorted(zip(word.tolist(), term.tolist())) == [(0, 1), (1, 0), (3, 2)]


def test_best_keeps_ties_by_key():
    best = search.Best(1, 3)
    for keys in ([9, 8, 7, 6], [5, 4, None, 3]):
        best.add(np.full((1, 4), 10), pa.array(keys, pa.int64()))
    assert best.trim().column("key").to_pylist() == [3, 4, 5]
