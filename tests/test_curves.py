import math

import pytest
from pyspark.sql import functions as F

from panelweave.operators import curves as C


def test_exponent_is_recovered(spark):
    true = 3.37
    points = spark.range(1, 60).select(
        F.lit("a").alias("k"), F.col("id").cast("double").alias("x"), F.lit(20.0).alias("mid")
    ).withColumn("y", F.pow("x", F.lit(true)) / (F.pow("mid", F.lit(true)) + F.pow("x", F.lit(true))))
    fitted = F.pow("x", "b") / (F.pow("mid", "b") + F.pow("x", "b"))
    out = C.fit_by_grid(points, ["k"], {"b": (1.0, 15.0)}, fitted - F.col("y"), [28, 20, 20]).first()
    assert out.b == pytest.approx(true, abs=0.006) and out.sse < 1e-4


def test_two_parameters_are_recovered(spark):
    points = spark.range(0, 30).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("t"))
    points = points.withColumn("y", C.s_curve(F.lit(0.4), F.lit(12.0), F.col("t")))
    error = C.s_curve(F.col("s"), F.col("h"), F.col("t")) - F.col("y")
    out = C.fit_by_grid(points, ["k"], {"s": (0.0, 2.0), "h": (0.0, 30.0)}, error, [20, 10, 10]).first()
    assert out.s == pytest.approx(0.4, abs=0.02) and out.h == pytest.approx(12.0, abs=0.2)


def test_supply_below_base_price_is_zero(frame):
    df = frame([(5.0,), (10.0,), (30.0,)], "p double")
    supply = C.smooth_supply(F.lit(2.0), F.lit(20.0), F.lit(10.0), F.lit(100.0), F.col("p"))
    assert [r.s for r in df.select(supply.alias("s")).collect()] == [0.0, 0.0, 50.0]
    price = C.price_at_share(F.lit(2.0), F.lit(20.0), F.lit(10.0))
    check = C.smooth_supply(F.lit(2.0), F.lit(20.0), F.lit(10.0), F.lit(100.0), price)
    assert df.select(check.alias("s")).first().s == pytest.approx(95.0)


def test_improvement_rate_reaches_target_or_null(spark):
    rate = lambda target: spark.range(1).select(C.improvement_rate(F.lit(target), F.lit(100.0), F.lit(0.4), F.lit(10)).alias("r")).first().r
    r = rate(60.0)
    assert 100 * 0.4 + (100 - 40) * (1 - r) ** 10 == pytest.approx(60.0)
    assert rate(30.0) is None and rate(120.0) is None


def test_mid_price_between_brackets(frame):
    df = frame([("a", 1.0, 2.0), ("a", 2.0, 2.0), ("a", 4.0, 2.0), ("a", 5.0, 4.0)], "k string, p double, q double")
    curve = C.supply_curve(df, ["k"], "p", "q")
    # Half of 10 lies between (price 2, supply 4) and (price 4, supply 6); prices count from 1.
    assert C.bracketed_mid_price(curve, ["k"], "p", "supply").first().mid_price == pytest.approx(2.0)
    half = C.half_supply_price(curve, ["k"], "p", "supply").first()
    assert (half.base_price, half.max_supply, half.mid_price) == (1.0, 10.0, 4.0)


def test_abatement_cap_and_missing_baseline(frame, rows):
    cuts = frame([("a", 0.0, 6.0), ("a", 10.0, 5.0), ("b", 0.0, 1.0)], "k string, cost double, cut double")
    base = frame([("a", 10.0)], "k string, base double")
    out = C.abatement_shares(cuts, base, ["k"], "cost", "cut", "base")
    assert rows(out) == [("a", 0.0, 0.6), ("a", 10.0, 0.95), ("b", 0.0, 0.0)]


def test_outlier_replacement(frame):
    rows = [("k", i, float(100 - i), 10.0 + i) for i in range(9)] + [("k", 9, 0.5, 500.0), ("k", 10, 0.25, None)]
    df = frame(rows, "k string, id int, w double, v double")
    out = {r.id: r.x for r in C.cap_outliers(df, ["k"], "v", "w", "id", 0.95, 0.99, "x").collect()}
    assert out[8] == out[9] == out[10] == 13.5
    assert out[3] == 13.0


def test_outlier_replacement_under_either_rule(frame):
    """Rows outside the group rule are held against the limit and take the whole group's median, null counted as 0."""
    values = [4.0, 6.0, 8.0, 10.0, 500.0, None, 2000.0, 30.0]
    rows = [("k", i, 100.0 if i < 4 else 4.0, v, i % 2 == 0 if i < 7 else None) for i, v in enumerate(values)]
    df = frame(rows + [("one", 8, 0.0, None, True), ("none", 9, 1.0, 2000.0, False)], "k string, id int, w double, v double, own boolean")
    made = C.cap_outliers(df, ["k"], "v", "w", "id", 0.95, 0.965, "x", by_group=F.col("own"), limit=1000.0)
    out = {r.id: r.x for r in made.collect()}
    assert made.columns == [*df.columns, "x"]
    # the top members are the first four: their median is 7, their largest 10; the median of all eight is 9
    assert [out[i] for i in range(8)] == [4.0, 6.0, 8.0, 10.0, 7.0, 9.0, 7.0, 30.0]
    assert out[8] == 0.0 and out[9] == 2000.0
    with pytest.raises(ValueError):
        C.cap_outliers(df, ["k"], "v", "w", "id", 0.95, 0.9, "x", by_group=F.col("own"))


def test_stacked_segments_cover_each_period(frame):
    df = frame([("n", 0.4, 0.3, 0.2, 0.1, 4.0, 2.0, 1.0, 0.4)], "k string, d0 double, d1 double, d2 double, d3 double, t0 double, t1 double, t2 double, t3 double")
    names = ["base", "middle", "high", "peak"]
    out = C.stacked_segments(df, [f"d{i}" for i in range(4)], [f"t{i}" for i in range(4)], names).collect()
    for name in names:
        assert sum(r[name] for r in out) == pytest.approx(1.0)
    base = next(r for r in out if r.segment == "base")
    assert base.base == 1.0 and base.middle == pytest.approx((0.4 * 2 / 4) / 0.3)


def test_log_elasticity_limits(spark):
    value = lambda q, y: spark.range(1).select(C.log_elasticity(F.lit(q), F.lit(1.0), F.lit(y), F.lit(1.0)).alias("e")).first().e
    assert value(4.0, 2.0) == pytest.approx(2.0)
    assert value(1000.0, 1.01) == 10.0 and value(0.5, 1.0) == -10.0 and value(1.0, 1.0) is None


def test_lookup_interpolation(spark):
    knots = [(0.0, 1.0), (10.0, 3.0), (20.0, 2.0)]
    value = lambda x, rule: spark.range(1).select(C.lookup_interpolated(F.lit(x), knots, rule).alias("y")).first().y
    assert [value(x, 1) for x in (-1.0, 0.0, 5.0, 15.0, 21.0)] == [None, 1.0, 2.0, 2.5, None]
    assert [value(x, 2) for x in (-1.0, 21.0)] == [1.0, 2.0]


def test_log_grades(frame):
    df = frame([("a", 2.0, 100.0, 5.0)], "k string, base double, rsc double, used double")
    out = C.log_price_grades(df, ["k"], "base", "rsc", "used", F.lit(0.5), 16.0, 3).orderBy("price").collect()
    assert [r.price for r in out] == pytest.approx([2.0, 8.0, 32.0])
    assert [r.available for r in out] == pytest.approx([100 * math.sqrt(4) - 5, 100 * math.sqrt(16) - 5, 0.0])
