"""The registered queries on the smallest tables and the pipeline stage by stage."""

import hashlib
import os
import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from helpers import DOCS, documents, lowered, near_duplicates, words
from panelweave.llm import decontam, lines
from panelweave.llm.queries import QUERIES, SQL
from tools.check import compare, connect

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_query(spark, name):
    status, message = compare(spark, connect(SF_DIR), name, entry.queries()[name], entry.oracle_sql().get(name), SF_DIR)
    assert status in ("ok", "rows") and not message.startswith("0 rows"), message


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(SQL) == {"op1_url_filters", "op8_line_dedup", "op11_ranked_search"} and "pipeline" in entry.queries()


@pytest.fixture(scope="module")
def stages(spark):
    return {name: lambda docs, f=f: f(spark, docs, SF_DIR) for name, f in corpus_pipeline.STAGES}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS)


def test_stages_take_odd_rows_and_empty_tables(docs, stages):
    for name, stage in stages.items():
        out = stage(docs)
        if name != "sentencepiece_encoding":
            assert out.columns == docs.columns
        assert 0 < out.count() <= docs.count()
        assert stage(docs.limit(0)).count() == 0


def test_near_duplicate_stage(docs, stages):
    rows = [r[:2] for r in documents()]
    want = {(k, rows[i][1]) for i, (k, _, _, kept) in enumerate(near_duplicates(rows, 5, 80)) if kept}
    out = [tuple(r) for r in stages["minhash_near_dedup"](docs).select("doc_id", "text").collect()]
    assert len(out) == len(set(out)) and set(out) == want


def test_clean_documents_pass_and_leaks_go(spark, stages):
    import random

    rng = random.Random(3)
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = [(i, words(rng, 60, 5000), "en", "s", 1) for i in range(50)]
    leaks = [(100 + i, words(rng, 30) + " " + items[i] + " " + words(rng, 30), "en", "s", 1) for i in range(20)]
    docs = spark.createDataFrame(clean + leaks, DOCS)
    kept = {r[0] for r in stages["benchmark_decontamination"](docs).select("doc_id").collect()}
    assert kept == set(range(50))
    cut = {r[0]: r[1] for r in stages["line_dedup"](docs).select("doc_id", "text").collect()}
    assert cut == {r[0]: r[1] for r in clean + leaks}


def test_rows_of_null_and_repeated_ids_are_judged_one_by_one(spark, stages):
    import random

    rng = random.Random(13)
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first()["text"]
    good, other, third = (words(rng, 80, 5000) for _ in range(3))
    near = good + " and a tail"
    rows = lambda *pairs: spark.createDataFrame([(i, t, "en", "s", 1) for i, t in pairs], DOCS)
    out = lambda name, df: sorted(map(tuple, stages[name](df).select("doc_id", "text").collect()), key=str)
    plain = lambda *pairs: sorted(pairs, key=str)
    odd = rows((None, good), (None, "too short"), (None, None), (None, ""), (7, other), (7, "junk"), (8, third), (8, third))
    assert out("quality_rules", odd) == plain((None, good), (7, other), (8, third), (8, third))
    odd = rows((None, good), (None, near), (None, other), (7, third), (7, third + " tail"), (9, other), (8, ""), (None, ""))
    found = out("minhash_near_dedup", odd)
    assert len(found) == 5 and {(9, other), (8, ""), (None, "")} <= set(found)
    assert len({(None, good), (None, near)} & set(found)) == 1 == len({(7, third), (7, third + " tail")} & set(found))
    leak = f"{other} {item} {third}"
    odd = rows((None, good), (None, leak), (None, None), (7, other), (7, leak))
    assert out("benchmark_decontamination", odd) == plain((None, good), (None, None), (7, other))


def plain_leak(text: str, items: list[list[str]]) -> bool:
    """Whether 12 of 15 tokens in a row agree with an item's."""
    import numpy as np

    tokens = re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", lowered(text))
    for item in items:
        n, m, w = len(tokens), len(item), min(decontam.WINDOW, len(item))
        if n < w or not m:
            continue
        equal = np.array(tokens, object)[:, None] == np.array(item, object)[None]
        agree = sum(equal[k : n - w + k + 1, k : m - w + k + 1].astype(int) for k in range(w))
        if (100 * agree >= decontam.PERCENT * w).any():
            return True
    return False


def test_run_is_the_plain_stages_in_a_row(spark):
    """The forest's choice is taken as it is; every later stage is done again by plain code."""
    import duckdb
    import pandas as pd
    import public_tokenizers
    import sentencepiece

    kept = corpus_pipeline.quality_rules(spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"), SF_DIR)
    kept = pd.DataFrame([r.asDict() for r in kept.collect()])
    assert (kept.text.str.split().str.len() >= 20).all()
    con = duckdb.connect()
    con.register("kept", kept)
    rows = con.sql(lines.twin("kept")).select("doc_id, text").fetchall()
    rows = [(i, t) for (i, _, _, chosen), (_, t) in zip(near_duplicates(rows, 5, 80), rows) if chosen]
    texts = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    items = [re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", lowered(t)) for t in texts]
    rows = [(i, t) for i, t in rows if not plain_leak(t, items)]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for i, t in rows:
        ids = library.encode(t, add_eos=True)
        want[i] = (len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids)))
    out = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert {r[0]: tuple(r[1:]) for r in out} == want and len(out) == len(want)
