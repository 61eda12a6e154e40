"""Cross-tokenizer alignment against whole-text encodings, link by link."""

import hashlib
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import DOCS, documents
from panelweave.llm import align, queries

ODD = [
    "plain words here",
    "a",
    " leading blank",
    "trailing blank ",
    "two  blanks and   three",
    "line\nbreaks \n and\n\nmore \t tabs",
    "no break 　 wide",
    "don't we'll I'm '' 's",
    "emoji 🎉🎉 and 漢字 mixed漢字text",
    "<|endoftext|> and <s> </s> <0x41> <unk>",
    "under▁score of the other kind",
    "x" * 700 + " " + "é" * 300,
    "\x00nul and \x1f control \x7f",
    "123456 78,901.5 -- === ***!!!",
    "",
    None,
    "same text",
    "same text",
]


@pytest.fixture(scope="module")
def files():
    return queries.vocabularies()


def plain(texts, files):
    """(n_a, n_b, links, groups) of every text, encoded whole; None if its bytes do not come back."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_str(files.byte_level)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_proto=files.pieces)
    table = align.byte_table()
    vocab = {i: p for p, i in a.get_vocab().items()}
    out = []
    for text in texts:
        source = b" " + (text or "").encode()
        x = a.encode(" " + (text or ""), add_special_tokens=False).ids
        y = b.encode(text or "")
        own = [bytes(table[c] for c in vocab[i]) for i in x]
        other = []
        for i in y:
            piece = b.id_to_piece(i)
            other.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
        if not text or b"".join(own) != source or b"".join(other) != source:
            out.append(None)
            continue
        where = lambda parts: {at: i for i, at in enumerate(accumulate(map(len, parts)))}
        left, right = where(own), where(other)
        links, groups, p, q = [], [], 0, 0
        for at in sorted(left.keys() & right.keys()):
            i, j = left[at] + 1, right[at] + 1
            links.append((x[i - 1], y[j - 1]))
            groups.append((x[p:i], y[q:j]))
            p, q = i, j
        out.append((len(x), len(y), links, groups))
    return out


def figures(made):
    counts = Counter(link for m in made if m for link in m[2])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for m in made:
        if m is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in m[3])
        held = sum(counts[link] == best[link[1]] for link in m[2])
        total = sum(counts[link] for link in m[2])
        out.append((m[0], m[1], len(m[3]), len(m[2]), held, total, hashlib.sha256(spelled.encode()).hexdigest()))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_equals_whole_text_encoding(spark, files):
    texts = ODD + [r[1] for r in documents()]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, n_a string, parts int").repartition(4)
    counts = align.learn(docs, files)
    got = sorted(map(tuple, align.digests(docs, files, counts).select("doc_id", *COLUMNS).collect()))
    assert [g[1:] for g in got] == figures(plain(texts, files))
    pairs = {(r["a"], r["b"]): r["n"] for r in align.pair_table(counts, spark).collect()}
    assert pairs == dict(Counter(link for m in plain(texts, files) if m for link in m[2]))


def test_groups_and_ends(spark, files):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    for row, made in zip(align.align(docs, files).orderBy("doc_id").collect(), plain(ODD, files)):
        if made is None:
            assert row["a"] == row["b"] == row["ends"] == []
            continue
        cut = lambda ids, ends: [ids[a:b] for a, b in zip([0, *ends], ends)]
        assert list(zip(cut(row["a"], row["ends_a"]), cut(row["b"], row["ends_b"]))) == made[3]
        assert row["ends"][-1] == len(ODD[row["doc_id"]].encode())


def test_registered_query(spark, files):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    got = queries.op13_token_alignment(spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == figures(plain([d["text"] for d in docs], files))


def test_cutting_at_blanks_changes_nothing(files):
    parts = align.Parts(files)
    assert files.cuttable() and parts.cut
    for text in filter(None, ODD):
        a, b = zip(*parts.encoded(parts.split(text)))
        whole = parts.encoded([text])[0]
        assert [i for x in a for i in x] == whole[0] and [i for x in b for i in x] == whole[1]


def test_ranks_give_the_ids_of_the_file(files):
    from tokenizers import Tokenizer

    own = Tokenizer.from_str(files.byte_level)
    own.encode_special_tokens = True
    parts = align.Parts(files)
    for text in filter(None, ODD + [r[1] for r in documents()]):
        assert parts.first(text) == own.encode(text, add_special_tokens=False).ids


def test_full_cache_and_long_parts(spark, files, monkeypatch):
    parts = align.Parts(files)
    monkeypatch.setattr(align, "CACHED", 20)
    texts = [f"word{i} again word{i} {'y' * 100}" for i in range(60)]
    for lo in range(0, 60, 5):
        made, edge = parts.numbers(texts[lo : lo + 5])
        assert parts.sound(made, edge).all() and len(parts.number) <= 20 + 20
        assert not any(len(p) > align.LONG for p in parts.number)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 62, n).astype(np.uint64))
    made = align.PerfectHash(keys)
    assert sorted(made.slots(keys).tolist()) == list(range(len(keys)))
    assert (made.keys[made.slots(keys)] == keys).all() if n else True
    other = np.arange(500, dtype=np.uint64) | np.uint64(1 << 63)
    assert (made.slots(other) == -1).all()


def test_tree_of_sums(spark):
    rows = spark.createDataFrame([([i, 1, -i],) for i in range(70)], "counts array<bigint>").repartition(40)
    assert align.tree_sum(rows, 70).tolist() == [2415, 70, -2415]
    assert align.tree_sum(rows.limit(0), 0) is None


def test_bound_holds_all_pairs():
    first, second = [b" ab", b"b", b"cab", b""], [b"b", b"ab", b"xcab", b"b"]
    linked = sum(bool(x and y) and (x.endswith(y) or y.endswith(x)) for x in first for y in second)
    assert align.pair_bound(first, second) >= linked


def test_empty_table_and_text_keys(spark, files):
    none = spark.createDataFrame([], DOCS)
    assert align.digests(none, files, align.learn(none, files)).count() == 0
    named = spark.createDataFrame([("k", "some text"), (None, "some text"), ("k", "some text")], "doc_id string, text string")
    rows = align.digests(named, files, align.learn(named, files)).collect()
    assert len(rows) == 3 and len({tuple(r[c] for c in COLUMNS) for r in rows}) == 1
    assert rows[0]["count_sum"] == 3 * rows[0]["n_links"]


def test_a_pair_unknown_to_the_first_pass_fails(spark, files):
    counts = align.learn(spark.createDataFrame([(1, "one")], "doc_id long, text string"), files)
    n, best = counts.of(np.array([1 << 40], np.uint64))
    assert n.tolist() == [0] and not best.any()
    with pytest.raises(Exception, match="first pass did not see"):
        align.digests(spark.createDataFrame([(1, "quite other words")], "doc_id long, text string"), files, counts).collect()
