import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from panelweave.operators import quality as Q, regions as R, reshape as H
from panelweave.session import cut_lineage


def test_spread_rejects_values_that_are_not_listed(frame, rows):
    df = frame([(1, "a", 5), (1, "z", 6)], "k int, n string, v int")
    with pytest.raises(PySparkException, match="not listed"):
        H.spread(df, ["k"], "n", "v", ["a"]).collect()
    assert rows(H.spread(df, ["k"], "n", "v", ["a"], others="drop")) == [(1, 5)]


def test_tag_lists_of_any_length(frame):
    df = frame([("g", f"t{i:02}") for i in range(26)] * 2, "g string, t string")
    assert H.equivalence_rows(df, "g", "t").first()["tags"] == [f"t{i:02}" for i in range(26)]


def test_spread_rejects_crowded_cells(frame):
    df = frame([("a", "x", 1), ("a", "x", 2)], "k string, n string, v int")
    with pytest.raises(PySparkException, match="several rows"):
        H.spread(df, ["k"], "n", "v", ["x"]).collect()


def test_gather_and_protect_years(frame, rows):
    wide = frame([("a", 1.0, None)], "k string, `1990` double, `2000` double")
    assert H.protect_years(wide).columns == ["k", "X1990", "X2000"]
    assert H.unprotect_years(H.protect_years(wide)).columns == wide.columns
    assert rows(H.gather_years(wide)) == [("a", 1990, 1.0), ("a", 2000, None)]
    assert rows(H.gather_years(wide, drop_null=True)) == [("a", 1990, 1.0)]
    assert H.columns_without_null(wide) == ["k", "1990"]


def test_write_to_regions_with_trade(frame, rows):
    df = frame([("s1", True, "end-year"), ("s2", None, "2020")], "subsector string, traded boolean, until string")
    regions = frame([(1, "USA"), (2, "EU")], "id int, region string")
    out = R.write_to_regions(
        df, regions, ["region", "market", "subsector", "until"], ["until"], "market", F.col("traded"), "USA", ["subsector"]
    )
    assert rows(out) == [("EU", "EU", "s2", 2020), ("USA", "EU", "EU s1", 2100), ("USA", "USA", "USA s1", 2100), ("USA", "USA", "s2", 2020)]


def test_overlay_adds_and_replaces(frame, rows):
    base = frame([(1, 10, "x"), (2, 20, "y")], "k int, v int, note string")
    assert rows(R.overlay(base, frame([(2, 21), (3, 30)], "k int, v int"), ["k"])) == [(1, 10, "x"), (2, 21, "y"), (3, 30, None)]


def test_lineage_with_a_cycle(frame, rows):
    edges = frame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "s string, t string")
    out = R.lineage_closure(edges, "s", "t")
    assert [r for r in rows(out) if r[0] == "a"] == [("a", "a", 3), ("a", "b", 1), ("a", "c", 2), ("a", "d", 3)]


def test_lineage_of_any_depth(frame, monkeypatch):
    rounds = []
    monkeypatch.setattr(R, "cut_lineage", lambda df: rounds.append(1) or cut_lineage(df))
    out = R.lineage_closure(frame([(i, i + 1) for i in range(300)], "s int, t int"), "s", "t")
    wrong = out.where("depth != target - source").count()
    assert (out.count(), wrong) == (300 * 301 // 2, 0) and len(rounds) <= 10


def test_lineage_takes_the_fewest_steps(frame, rows):
    rng = random.Random(4)
    edges = {(rng.randrange(25), rng.randrange(25)) for _ in range(40)} | {(i, i + 1) for i in range(30, 41)} | {(41, 30), (33, 38)}
    best = {e: 1 for e in edges}
    for n in range(2, 60):
        for (a, b), d in list(best.items()):
            if d == n - 1:
                for x, y in edges:
                    if x == b:
                        best.setdefault((a, y), n)
    out = R.lineage_closure(frame([*edges, *list(edges)[:5]], "s int, t int"), "s", "t")
    assert rows(out) == sorted((a, b, d) for (a, b), d in best.items())


def test_cancelling_leaves_make_an_empty_branch(frame, rows):
    df = frame([("a", "x", 5), ("a", "y", -5), ("b", "x", 1), ("b", "y", 0), ("c", None, 2)], "l1 string, l2 string, v int")
    kept = R.prune_empty(df, ["l1", "l2"], "v")
    assert rows(kept) == [("b", "x", 1), ("c", None, 2)]
    trade = frame([("a", 1), ("b", 2), ("z", 3), (None, 4)], "l1 string, n int")
    assert rows(R.prune_references(trade, df, kept, ["l1"])) == [("b", 2), ("z", 3), (None, 4)]


def test_empty_branches_and_pruning(frame, rows):
    df = frame([("a", "x", 0), ("a", "y", 2), ("b", "x", 0), ("b", "y", 0)], "l1 string, l2 string, v int")
    assert rows(R.empty_branches(df, ["l1", "l2"], "v")) == [("a", "x", 2), ("b", "x", 2), ("b", "y", 2), ("b", None, 1)]
    assert rows(R.prune_empty(df, ["l1"], "v")) == [("a", "x", 0), ("a", "y", 2)]


def test_pass_through_accumulates_listed_inputs(frame):
    chain = frame([("s1", "s2", 1), ("s2", "s3", 2)], "sector string, fuel string, position int")
    out = R.pass_through(frame([("r", "s2", 2.0), ("r", "s3", 3.0)], "k string, sector string, v double"), chain, ["k"], "sector", "fuel", "v")
    assert {r.sector: r.calibrated for r in out.collect()} == {"s1": 5.0, "s2": 3.0}


def test_income_groups_exclude_thresholds(frame):
    df = frame([(1.0,), (2.0,), (3.0,), (4.0,), (5.0,)], "v double")
    assert [r.g for r in df.select(R.income_group(F.col("v"), 2.0, 4.0).alias("g")).collect()] == ["low", None, "medium", None, "high"]


def test_table_diff(frame):
    left = frame([("a", 1.0), ("b", 2.5), ("c", 2.5), ("d", 1.0), (None, 3.0)], "k string, v double")
    right = frame([("a", 2.0), ("b", 2.501), ("c", 2.6), ("e", 1.0), (None, 3.0)], "k string, v double")
    assert {r.k: r.status for r in Q.table_diff(left, right, ["k"], "v").collect()} == {
        "a": "differs", "c": "differs", "d": "only left", "e": "only right",
    }


def test_contracts(frame):
    df = frame([(1, "2000", 1.0)], "id int, year string, logit_exp double")
    found = Q.contract_report(df, {"id": T.IntegerType(), "year": T.StringType(), "gone": T.StringType()})
    assert ("year", "not numeric") in found and ("gone", "missing") in found and ("logit_exp", "unexpected") in found
    assert ("logit_type", "missing beside logit columns") in found
    assert Q.contract_select(df, ["year", "id"]).columns == ["year", "id"]
    with pytest.raises(ValueError):
        Q.contract_select(df, ["nope"])


def test_expectations_count_null_as_broken(frame):
    df = frame([(1,), (-1,), (None,)], "v int")
    assert Q.expect(df, {"positive": F.col("v") > 0}).first().violations == 2


def test_cube_gap(frame):
    df = frame([("a", 1), ("a", 2), ("b", 1)], "k string, y int")
    assert Q.cube_gaps(df, ["k", "y"]).first().gap == 1
