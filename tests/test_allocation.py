import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelweave.operators import allocation as A, balances as B


def test_downscale_keeps_totals_with_a_zero_proxy(frame):
    coarse = frame([("r", 2000, 90.0), ("s", 2000, 10.0)], "g string, year int, value double")
    members = frame([("r", "a", 1.0), ("r", "b", 2.0), ("s", "c", 0.0), ("s", "d", 0.0)], "g string, m string, p double")
    out = {r.m: r.value for r in A.downscale(coarse, members, ["g"], "p").collect()}
    assert out == {"a": 30.0, "b": 60.0, "c": 5.0, "d": 5.0}


def test_scale_to_control_and_strict(frame, rows):
    detail = frame([("a", 1.0), ("a", 3.0), ("b", 2.0), ("z", 0.0)], "k string, v double")
    control = frame([("a", 8.0), ("z", 5.0)], "k string, t double")
    assert rows(A.scale_to_control(detail, control, ["k"], "v", "t"), "k", "v") == [("a", 2.0), ("a", 6.0), ("b", 2.0), ("z", 0.0)]
    assert rows(A.scale_to_control(detail, control, ["k"], "v", "t", default=0.0), "k", "v")[2] == ("b", 0.0)
    with pytest.raises(PySparkException):
        A.scale_strict(detail, control, ["k"], "v", "t", "x").collect()


def test_deduction_order_and_guard(frame, rows):
    df = frame([(10.0, 5.0, 3.0), (10.0, 5.0, 7.0)], "a double, b double, d double")
    assert rows(A.deduct_in_order(df, "a", "b", "d", 0.5, "x", "y"), "x", "y") == [(5.0, 3.0), (7.0, 5.0)]
    with pytest.raises(PySparkException, match="exceeds"):
        A.deduct_in_order(frame([(10.0, 1.0, 9.0)], "a double, b double, d double"), "a", "b", "d", 0.5, "x", "y").collect()


def test_absorb_negatives(frame):
    df = frame([("a", -2.0), ("a", 4.0), ("a", 6.0), ("b", 1.0)], "k string, v double")
    out = A.absorb_negatives(df, ["k"], "v", "x").collect()
    assert sorted((r.k, round(r.x, 9)) for r in out) == [("a", 0.0), ("a", 3.2), ("a", 4.8), ("b", 1.0)]
    with pytest.raises(PySparkException, match="negative"):
        A.absorb_negatives(frame([("a", -2.0), ("a", 1.0)], "k string, v double"), ["k"], "v", "x").collect()


def test_emission_factor_rules(frame):
    activity = frame([("s", "a", 2.0), ("s", "b", 0.0), ("t", "a", 5.0)], "s string, f string, amount double")
    emissions = frame([("s", "a", 4.0), ("s", "b", 1.0)], "s string, f string, e double")
    out = {(r.s, r.f): r.factor for r in A.emission_factors(activity, emissions, ["s", "f"], ["s"], "amount", "e").collect()}
    assert out == {("s", "a"): 2.0, ("s", "b"): 0.0, ("t", "a"): 1.0}


def test_mix_share_bounds(frame):
    df = frame([(0.4, 0.3, 0.5), (0.2, 0.3, 0.5), (0.6, 0.3, 0.5)], "m double, lo double, hi double")
    out = sorted((r.m, round(r.share_low, 9)) for r in A.mix_share(df, "m", "lo", "hi", 0.1).collect())
    assert out == [(0.2, 1.0), (0.4, 0.5), (0.6, 0.25)]


def test_scale_with_alternate_and_zero_base(frame):
    detail = frame([("n", "x", 2.0), ("n", "alt", 4.0), ("m", "x", 0.0), ("m", "x", 0.0)], "k string, c string, v double")
    control = frame([("n", "alt", 8.0), ("m", "x", 6.0)], "k string, c string, t double")
    out = sorted((r.k, r.c, r.o) for r in A.scale_with_alternate(detail, control, ["k"], "c", "alt", "v", "t", "o").collect())
    assert out == [("m", "x", 3.0), ("m", "x", 3.0), ("n", "alt", 8.0), ("n", "x", 4.0)]


def test_impute_by_second_reference(frame):
    prices = frame([("usa", "corn", 2.0), ("idn", "palm", 3.0), ("x", "corn", 9.0)], "area string, item string, p double")
    index = frame([("usa", 1.0, 2.0), ("idn", 0.5, 1.0), ("x", 0.25, 0.5)], "area string, i0 double, i1 double")
    out = {(r.area, r.item): r.p for r in A.impute_by_index(prices, index, "area", "item", "p", ["usa", "idn"], ["i0", "i1"]).collect()}
    assert out == {
        ("usa", "corn"): 2.0, ("usa", "palm"): 6.0, ("idn", "corn"): 1.0, ("idn", "palm"): 3.0, ("x", "corn"): 9.0, ("x", "palm"): 1.5,
    }


def test_reconcile_takes_the_lower_and_fills(frame, rows):
    exports = frame([("a", "b", 1, 5.0), ("a", "c", 1, 2.0)], "r string, p string, year int, value double")
    imports = frame([("b", "a", 1, 4.0), ("c", "b", 1, 7.0)], "r string, p string, year int, value double")
    out = B.reconcile_bilateral(exports, imports, "r", "p", ["year"])
    assert rows(out, "r", "p", "value") == [("a", "b", 4.0), ("a", "c", 2.0), ("b", "c", 7.0)]


def elements(frame, cells):
    rows = [("A", "i", 1, e, float(v)) for e, v in cells.items()]
    return frame(rows, "area string, item string, year int, element string, value double")


def test_split_balances_close(frame):
    cell = ["area", "item", "year"]
    df = elements(frame, {"Production": 50, "Import": 30, "Opening stocks": 8, "Export": 10, "Food": 40, "Feed": 20, "Closing stocks": 12})
    out = B.stock_balance(B.import_balance(df, cell), cell)
    values = {(r.bal_source, r.element): r.value for r in out.collect()}
    for e in ("Production", "Import", "Opening stocks", "Export", "Food", "Feed", "Closing stocks"):
        assert sum(v for (s, name), v in values.items() if name == e) == pytest.approx(
            df.where(F.col("element") == e).first().value
        )
    assert values["bal_import", "Food"] == 20.0
    for source in ("bal_import", "bal_domestic_lag", "bal_domestic_current"):
        assert values[source, "Residuals"] == pytest.approx(values[source, "Regional supply"] - values[source, "Regional demand"])


def test_import_share_is_capped(frame):
    df = elements(frame, {"Import": 30, "Food": 10, "Production": 1})
    values = {(r.bal_source, r.element): r.value for r in B.import_balance(df, ["area", "item", "year"]).collect()}
    assert values["bal_import", "Food"] == 10.0 and values["bal_import", "Residuals"] == 20.0


def test_trim_excess_exports(frame):
    df = elements(frame, {"Production": 5, "Export": 9, "Import": 3})
    out = {r.element: r.value for r in B.trim_excess_exports(df, ["area", "item", "year"]).collect()}
    assert out == {"Production": 5.0, "Export": 6.0, "Import": 0.0}


def test_gross_trade_is_balanced_or_dropped(frame):
    rows = [(a, "i", 1, e, v) for a, e, v in [("x", "Export", 6.0), ("y", "Import", 10.0), ("x", "Production", 20.0)]]
    rows += [(a, "j", 1, e, v) for a, e, v in [("x", "Export", 1.0), ("y", "Import", 1.0), ("x", "Production", 1000.0)]]
    df = frame(rows, "area string, item string, year int, element string, value double")
    out = {(r.item, r.element): r.value for r in B.balance_gross_trade(df, "area", ["item", "year"]).collect()}
    assert out["i", "Export"] == pytest.approx(8.0) and out["i", "Import"] == pytest.approx(8.0)
    assert out["j", "Export"] == 0.0 and out["j", "Production"] == 1000.0


def test_primary_equivalent_by_hand(frame):
    # 20 of seed are crushed to 10 of oil: all of the oil's food use is worth 20 of seed.
    rows = [("c", "seed", 0, "A", 1, e, v) for e, v in [("Production", 30.0), ("Processed", 20.0), ("Food", 10.0)]]
    rows += [("c", "oil", 1, "A", 1, e, v) for e, v in [("Production", 10.0), ("Food", 10.0)]]
    df = frame(rows, "comm string, item string, tier int, area string, year int, element string, value double")
    sinks = frame([("c", "oil", 1, "seed", 0.0)], "comm string, sink_item string, sink_tier int, source_item string, min_rate double")
    out = B.final_balance(B.primary_equivalent(df, sinks, "area", [1]), ["comm", "area", "year"])
    got = {r.element: round(r.value, 9) for r in out.collect()}
    assert {e: got[e] for e in ("Production", "Processed", "Food", "Residuals")} == {"Production": 30.0, "Processed": 0.0, "Food": 30.0, "Residuals": 0.0}


def test_yield_index_weighs_items_by_area(frame):
    df = frame([(1, "x", 30.0, 10.0), (2, "x", 10.0, 10.0), (1, "y", 8.0, 30.0), (3, "y", 2.0, 10.0)], "who int, item string, made double, area double")
    zones = frame([(1, "n"), (2, "s"), (3, "s")], "who int, zone string")
    got = {r.zone: r.idx for r in A.yield_index(df, zones, "who", "item", "made", "area", "zone", "idx").collect()}
    # x yields 2 everywhere, y a quarter
    assert got["n"] == pytest.approx((1.5 * 10 + (8 / 30 / 0.25) * 30) / 40)
    assert got["s"] == pytest.approx((0.5 * 10 + 0.8 * 10) / 20)
    with pytest.raises(Exception, match="missed"):
        A.yield_index(df, zones.where("who < 3"), "who", "item", "made", "area", "zone", "idx").collect()


def test_survey_conversion_looks_to_the_turn(frame):
    df = frame([("a", 1, 2.0), ("a", 2, 4.0), ("a", 3, 8.0), ("a", 4, None), ("b", 1, 5.0), ("c", 1, 1.0), ("c", 2, 0.0)], "k string, year int, value double")
    got = {(r.k, r.year): r.conv for r in A.survey_conversion(df, ["k"], "value", 3, "conv").collect()}
    assert [got["a", y] for y in (1, 2, 3, 4)] == [0.5, 0.5, 2.0, 1.0]
    assert got["b", 1] == 1.0 and got["c", 1] == 1.0 and got["c", 2] == 1.0
