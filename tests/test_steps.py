import pyarrow as pa
import pytest

from panelweave.operators.steps import Step, rows_per_group, run_step, run_steps


@pytest.fixture
def tables(frame):
    return {"a": frame([(1, 2)], "k int, v int")}


def double(inputs):
    return {"b": inputs["a"].selectExpr("k", "2 * v AS w")}


def test_steps_run_when_their_inputs_are_there(tables, rows):
    last = Step("last", {"b": ["w"]}, {"c": ["w"]}, lambda t: {"c": t["b"].select("w")})
    first = Step("first", {"a": ["k", "v"]}, {"b": ["k", "w"]}, double)
    assert rows(run_steps([last, first], tables)["c"]) == [(4,)]
    with pytest.raises(KeyError, match="last"):
        run_steps([last], tables)


@pytest.mark.parametrize(
    "inputs, outputs",
    [({"z": []}, {"b": []}), ({"a": ["missing"]}, {"b": []}), ({"a": []}, {"b": ["missing"]}), ({"a": []}, {"c": []}), ({"a": []}, {})],
)
def test_broken_contracts_fail(tables, inputs, outputs):
    with pytest.raises((KeyError, ValueError), match="step"):
        run_step(Step("step", inputs, outputs, double), tables)


def test_a_step_sees_its_declared_inputs_only(tables):
    step = Step("step", {}, {}, lambda t: {} if not t else {"leak": t})
    assert set(run_step(step, tables)) == {"a"}


def test_a_group_function_returns_any_number_of_rows(frame, rows):
    # defined here, so that workers get it by value
    def run(group):
        few = group.slice(0, 0 if group.column("v")[0].as_py() == -1 else 2)
        return few.append_column("place", pa.array(range(len(few)), pa.int64())).append_column("unused", few.column("v"))

    df = frame([(1, 5), (1, 3), (1, 4), (2, -1), (2, 9), (None, 7), (None, 6), (3, None)], "k int, v int")
    out = rows_per_group(df, ["k"], run, "place int, k int, v long", ["v"])
    assert out.columns == ["place", "k", "v"]
    want = {(0, 1, 3), (1, 1, 4), (0, None, 6), (1, None, 7), (0, 3, None)}
    assert set(map(tuple, out.collect())) == want and out.count() == 5
    assert rows_per_group(df.limit(0), ["k"], run, "place int, k int", ["v"]).count() == 0


def test_a_group_beyond_its_bound_fails_before_it_is_gathered(spark, frame):
    def count(group):
        return pa.table({"n": [len(group)]})

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = spark.range(0, 5000, 1, 4).selectExpr("if(id < 1000, 0, id % 9 + 1) AS k", "id")
        assert sorted(r[0] for r in rows_per_group(df, ["k"], count, "n long", bound=1000).collect())[-1] == 1000
        plan = rows_per_group(df, ["k"], count, "n long")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        with pytest.raises(Exception, match="over 999 rows"):
            rows_per_group(df, ["k"], count, "n long", bound=999).collect()
        with pytest.raises(Exception, match="m"):
            rows_per_group(df, ["k"], count, "m long").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
