import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelweave.functions import semantics as S
from panelweave.functions.units import ModelTime, deflator, deflator_from


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_ratio_of_zero_is_null_or_default(spark):
    assert one(spark, S.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, S.ratio(F.lit(1.0), F.lit(0.0), 0)) == 0.0
    assert one(spark, S.ratio(F.lit(3), F.lit(2))) == 1.5


def test_aggregates_with_nulls(frame):
    df = frame([(1, 1.0), (1, None), (2, 2.0), (2, 3.0)], "k int, v double")
    out = {
        r.k: (r.strict, r.lenient, r.mean)
        for r in df.groupBy("k")
        .agg(S.strict_sum("v").alias("strict"), S.lenient_sum("v").alias("lenient"), S.strict_mean("v").alias("mean"))
        .collect()
    }
    assert out == {1: (None, 1.0, None), 2: (5.0, 5.0, 2.5)}


def test_weighted_mean_zero_weight(frame):
    df = frame([(1, 1.0, 0.0), (2, 4.0, 1.0), (2, 1.0, 2.0)], "k int, x double, w double")
    out = {r.k: r.m for r in df.groupBy("k").agg(S.weighted_mean("x", "w").alias("m")).collect()}
    assert out == {1: None, 2: 2.0}


def test_row_extremes_keep_null(frame):
    df = frame([(1.0, None), (1.0, 2.0)], "a double, b double")
    assert [tuple(r) for r in df.select(S.row_max("a", "b"), S.row_min("a", "b")).collect()] == [(None, None), (2.0, 1.0)]


def test_null_safe_predicates(frame):
    df = frame([("a",), ("b",), (None,)], "x string")
    assert df.where(~S.is_in("x", ["a"])).count() == 2
    picked = [r.y for r in df.select(S.if_else(F.col("x") == "a", 1, 0).alias("y")).collect()]
    assert picked == [1, 0, None]


@pytest.mark.parametrize("x,digits,want", [(123456.0, 3, 123000.0), (-0.0012345, 2, -0.0012), (0.0, 3, 0.0), (99950.0, 3, 100000.0)])
def test_signif(spark, x, digits, want):
    assert one(spark, S.signif(F.lit(x), digits)) == pytest.approx(want)


def test_text_rules(spark):
    assert one(spark, S.paste(F.lit("a"), F.lit(None).cast("string"), sep="-")) == "a-NA"
    assert one(spark, S.replace_first(F.lit("banana"), "an", "x")) == "bxana"
    assert one(spark, S.extract(F.lit("coal traded"), "^.*(?= traded)")) == "coal"
    assert one(spark, S.extract(F.lit("coal"), "^.*(?= traded)")) is None


def test_bins_and_alignment(spark):
    label = lambda v: one(spark, S.bin_label(F.lit(v), [0, 10, 20], ["low", "high"]))
    assert [label(v) for v in (0, 1, 10, 11, 20, 21)] == [None, "low", "low", "high", "high", None]
    assert one(spark, S.align_up(F.lit(2006), 5)) == 2010
    assert one(spark, S.align_up(F.lit(2010), 5)) == 2010


def test_clamp_keeps_null(spark):
    assert one(spark, S.clamp(F.lit(None).cast("double"), 0.0, 1.0)) is None
    assert one(spark, S.clamp(F.lit(7.0), 0.0, 1.0)) == 1.0


def test_deflator(spark):
    assert deflator(2009, 2009) == 1.0
    assert deflator(1975, 1990) == pytest.approx(31.361 / 66.773)
    with pytest.raises(ValueError):
        deflator(1928, 2000)
    assert one(spark, deflator_from(F.lit(1990), 1975)) == pytest.approx(deflator(1975, 1990))
    with pytest.raises(PySparkException):
        one(spark, deflator_from(F.lit(1900), 1975))


def test_model_clock(spark):
    clock = ModelTime()
    assert one(spark, clock.next_year(F.lit(2015))) == 2020
    assert one(spark, clock.next_year(F.lit(2100))) == 2100
    with pytest.raises(PySparkException):
        one(spark, clock.next_year(F.lit(2016)))
    words = {w: one(spark, clock.year_number(F.lit(w))) for w in ["start-year", "initial-nonhistorical-year", "2031", "never"]}
    assert words == {"start-year": 1975, "initial-nonhistorical-year": 2020, "2031": 2031, "never": None}
