import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelweave.operators import joins as J
from panelweave.operators.groups import first_rows, share, with_group, with_panel, with_total


@pytest.fixture
def left(frame):
    return frame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")


def test_checked_join_matches(frame, left, rows):
    right = frame([(1, 10.0), (2, 20.0), (3, 30.0), (3, 31.0)], "id int, w double")
    assert rows(J.checked_join(left, right, {"k": "id"})) == [(1, "a", 10.0), (2, "b", 20.0), (2, "c", 20.0)]


@pytest.mark.parametrize(
    "lookup", [[(1, 10.0)], [(1, 10.0), (2, 20.0), (2, 20.0)], [(1, 10.0), (2, None)]], ids=["miss", "ambiguous", "null"]
)
def test_checked_join_fails(frame, left, lookup):
    with pytest.raises(PySparkException, match="missed or is ambiguous"):
        J.checked_join(left, frame(lookup, "k int, w double"), ["k"]).collect()


def test_checked_join_fails_though_columns_are_pruned(frame, left):
    with pytest.raises(PySparkException):
        J.checked_join(left, frame([(1, 10.0)], "k int, w double"), ["k"]).select("v").collect()


@pytest.mark.parametrize("later", ["v = 'a'", "w > 5", "k = 1", "w = 10 and v = 'a'"])
def test_checked_join_fails_though_a_later_filter_drops_the_row(frame, left, later):
    with pytest.raises(PySparkException, match="missed or is ambiguous"):
        J.checked_join(left, frame([(1, 10.0)], "k int, w double"), ["k"]).where(later).collect()


def test_checked_join_sorts_nothing_to_count_keys(spark, frame, left):
    plan = J.checked_join(left, frame([(1, "p"), (2, "q")], "k int, w string"), ["k"])
    assert "SortAggregate" not in plan._jdf.queryExecution().executedPlan().toString()


def test_complete_panel_fails_on_two_rows_of_one_key_and_year(frame):
    df = frame([("a", 1, 5), ("a", 1, 6)], "k string, year int, v int")
    with pytest.raises(PySparkException, match="several rows"):
        J.complete_panel(df, ["k"], "year", [1, 2]).collect()


def test_checked_join_ignored_column_and_null_key(frame, rows):
    left = frame([(1, "a"), (None, "b")], "k int, v string")
    right = frame([(1, None), (None, 5.0)], "k int, w double")
    assert rows(J.checked_join(left, right, ["k"], ignore=["w"], null_keys=True), "v", "w") == [("a", None), ("b", 5.0)]
    with pytest.raises(PySparkException):
        J.checked_join(left, right, ["k"], ignore=["w"]).collect()


def test_first_rows_ties_and_nulls(frame, rows):
    df = frame([("x", None, 1), ("x", 2, 9), ("x", 2, 3), ("y", None, 5)], "k string, o int, v int")
    assert rows(first_rows(df, ["k"], ["o"])) == [("x", 2, 3), ("y", None, 5)]
    assert rows(first_rows(df, ["k"], ["o", "v"], last=True)) == [("x", None, 1), ("y", None, 5)]


def test_replicate_is_a_full_product_under_copies(spark):
    df = spark.range(50).select(F.when(F.col("id") < 40, 0).otherwise(F.col("id")).alias("a"))
    other = spark.range(7).select(F.col("id").alias("b"))
    out = J.replicate(df, other)
    assert out.count() == 350
    assert out.where("a = 0").groupBy("b").count().where("count <> 40").count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert J.replicate(df, other).count() == 350
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("complete", [J.complete, J.complete_panel])
def test_complete_keeps_rows_outside_the_values(frame, rows, complete):
    df = frame([("a", 1, 5.0), ("a", 9, 6.0), (None, 2, 7.0)], "k string, year int, v double")
    out = complete(df, ["k"], "year", [1, 2], fill={"v": 0.0})
    assert rows(out) == sorted(
        [("a", 1, 5.0), ("a", 2, 0.0), ("a", 9, 6.0), (None, 1, 0.0), (None, 2, 7.0)], key=lambda r: (r[0] is None, r[1])
    )


def test_swap_codes_both_ways_and_duplicates(frame, rows):
    codes = frame([("Z1", "north"), ("Z2", "south")], "code string, name string")
    df = frame([("Z2", 1), ("Z1", 2)], "zone string, v int")
    named = J.swap_codes(df, "zone", codes, "code", "name", "^Z[0-9]$")
    assert rows(named) == [("north", 2), ("south", 1)]
    assert rows(J.swap_codes(named, "zone", codes, "code", "name", "^Z[0-9]$")) == rows(df)
    twice = codes.unionByName(frame([("Z3", "south")], "code string, name string"))
    with pytest.raises(PySparkException, match="duplicates"):
        J.swap_codes(named, "zone", twice, "code", "name", "^Z[0-9]$").collect()


def test_fallback_levels(frame, rows):
    rules = frame([("s", "u", "t", 1.0), ("s", "w", "t", 2.0), ("s", "u", "z", 3.0)], "a string, b string, c string, rate double")
    df = frame([("s", "u", "t"), ("s", "q", "t"), ("s", "u", "q"), ("n", "n", "n")], "a string, b string, c string")
    out = J.fallback_join(df, rules, [["a", "b", "c"], ["a", "c"], ["a", "b"]], "rate", ["rate"])
    assert rows(out) == [("n", "n", "n", None), ("s", "q", "t", 1.0), ("s", "u", "q", 1.0), ("s", "u", "t", 1.0)]


def test_group_values_agree(frame, rows):
    df = frame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 5.0)], "k string, v double")
    aggs = {"t": F.sum("v")}
    assert rows(with_group(df, ["k"], aggs)) == rows(with_panel(df, ["k"], aggs))
    assert {r.t for r in with_total(df, aggs).collect()} == {14.0}


def test_share_with_zero_total(frame, rows):
    df = frame([("a", 1, 0.0), ("a", 2, 0.0), ("b", 1, 1.0), ("b", 2, 3.0)], "k string, i int, v double")
    assert rows(share(df, "v", ["k"]), "k", "i", "share") == [("a", 1, None), ("a", 2, None), ("b", 1, 0.25), ("b", 2, 0.75)]
    assert rows(share(df, "v", ["k"], equal_split=True), "k", "i", "share")[:2] == [("a", 1, 0.5), ("a", 2, 0.5)]


def test_first_year_reaching(frame, rows):
    rules = frame([("a", None, 5.0), ("b", 2003, 5.0), ("c", None, 99.0)], "k string, start int, least double")
    series = frame([("a", 2000, 1.0), ("a", 2001, 5.0), ("a", 2002, 9.0), ("b", 2000, 9.0), ("c", 2000, 1.0)], "k string, year int, value double")
    out = J.first_year_reaching(rules, series, ["k"], F.col("least"), "start")
    assert rows(out, "k", "start") == [("a", 2001), ("b", 2003)]


def test_derived_rows_fall_back_or_stay_null(frame, rows):
    df = frame([("s", "t", "PM", 10.0), ("s", "u", "PM", 10.0), ("q", "t", "PM", 10.0), ("s", "t", "CO", 1.0)], "a string, b string, gas string, v double")
    rules = frame([("s", "t", 0.5), ("s", "z", 0.2)], "a string, b string, f double")
    out = J.derived_rows(df, F.col("gas") == "PM", rules, [["a", "b"], ["a"]], {"BC": "f"}, "gas", "v")
    assert rows(out.where("gas = 'BC'"), "a", "b", "v") == [("q", "t", None), ("s", "t", 5.0), ("s", "u", 2.0)]
    assert out.count() == 7


def test_fallback_reports_rules_that_differ(frame, rows):
    df = frame([(1, "a", "x"), (2, "a", "y"), (3, "b", "z"), (4, "c", "x"), (5, None, "x"), (6, "d", "x")], "id int, a string, b string")
    rules = frame(
        [("a", "x", 3.0, 1), ("a", "x", 3.0, 2), ("a", "q", 2.0, 3), ("b", "z", None, 1), ("b", "w", 5.0, 9), ("b", "v", 4.0, 10), ("c", "x", 7.0, 2), ("c", "x", 6.0, 3), (None, "x", 8.0, 1)],
        "a string, b string, rate double, rank int",
    )
    out = J.fallback_join(df, rules, [["a", "b"], ["a"]], "rate", ["rank"], "differ").select("id", "rate", "differ")
    assert rows(out) == [(1, 3.0, False), (2, 3.0, True), (3, None, None), (4, 7.0, True), (5, 8.0, False), (6, None, None)]


def test_fallback_joins_the_rows_once(frame):
    df = frame([(1, "a", "x")], "id int, a string, b string")
    out = J.fallback_join(df, df.withColumnRenamed("id", "rate"), [["a", "b"], ["a"], ["b"]], "rate", ["rate"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2
