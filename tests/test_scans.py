import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from panelweave.operators.curves import quartile_grades
from panelweave.operators.scans import quantiles, running_total


def test_running_total_with_a_hot_value(spark):
    # One value holds most rows; ids break the tie and cut it into buckets.
    rng = np.random.default_rng(0)
    n = 3000
    pdf = pd.DataFrame(
        {
            "k": rng.choice(["a", "b"], n, p=[0.9, 0.1]),
            "id": np.arange(n),
            "w": np.where(rng.random(n) < 0.7, 50.0, rng.integers(0, 1000, n)).astype(float),
        }
    )
    df = spark.createDataFrame(pdf)
    out = running_total(
        df, {"cum": "w"}, ["k"], [F.col("w").desc(), F.col("id").asc()], totals={"all": "cum"}, rows=400
    ).toPandas()
    want = pdf.sort_values(["k", "w", "id"], ascending=[True, False, True])
    want["cum"] = want.groupby("k")["w"].cumsum()
    want["all"] = want.groupby("k")["w"].transform("sum")
    got = out.sort_values(["k", "w", "id"], ascending=[True, False, True])
    assert np.allclose(got["cum"], want["cum"]) and np.allclose(got["all"], want["all"])


def test_running_total_without_keys(spark):
    df = spark.range(100).withColumn("v", F.lit(1))
    out = running_total(df, {"n": "v"}, [], [F.col("id")], totals={"all": "n"}, rows=7)
    assert out.where(F.col("n") != F.col("id") + 1).count() == 0
    assert out.where("all <> 100").count() == 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=30))
def test_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("a", None)], "k string, v double")
    probs = {"q0": 0.0, "q1": 0.1, "q5": 0.5, "q9": 0.95, "qm": 1.0}
    got = quantiles(df, ["k"], "v", probs).first()
    for name, p in probs.items():
        assert got[name] == pytest.approx(np.quantile(values, p))
    steps = quantiles(df, ["k"], "v", {}, steps=probs).first()
    for name, p in probs.items():
        assert steps[name] == np.quantile(values, p, method="inverted_cdf")


def test_quantiles_without_keys(frame):
    df = frame([(1.0,), (2.0,), (4.0,)], "v double")
    assert quantiles(df, [], "v", {"m": 0.5}).first().m == 2.0


def test_quartile_grades_small_groups(frame, rows):
    df = frame([("a", 1.0, 5), ("a", 2.0, 7), ("a", 3.0, 1), ("a", 4.0, 2), ("a", 5.0, 4), ("b", 1.0, 3)], "k string, p double, q int")
    assert rows(quartile_grades(df, ["k"], "p", "q")) == [
        ("a", 2.0, "grade 1", 12), ("a", 3.0, "grade 2", 1), ("a", 4.0, "grade 3", 2), ("a", 5.0, "grade 4", 4),
        ("b", 1.0, "grade 1", 3),
    ]
