"""Hot keys and sizes: results stay whole and the work is split."""

import pytest
from pyspark.sql import functions as F

from panelweave.operators.groups import first_rows, share, with_group
from panelweave.operators.joins import checked_join, full_join
from panelweave.operators.scans import quantiles
from panelweave.session import checkpoint_root, cut_lineage, drop_scratch, run_dir, scratch_dir, use_settings

SMALL = {
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
}


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key."""
    use_settings(spark)
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    # The pad keeps the shuffled rows from compressing to almost nothing.
    yield spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") < 100_000, 0).otherwise(F.col("id") % 5000 + 1).alias("k"),
        (F.col("id") % 97).cast("double").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.count()
    return df._jdf.queryExecution().executedPlan().toString()


def test_group_totals_split_the_hot_key(skewed):
    out = with_group(skewed, ["k"], {"t": F.sum("v")})
    rows = out.collect()
    assert len(rows) == 300_000
    hot = sum(i % 97 for i in range(100_000))
    assert {r.t for r in rows if r.k == 0} == {float(hot)}
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_lookup_splits_the_hot_key(skewed):
    lookup = skewed.groupBy("k").agg(F.max("v").alias("m"))
    out = checked_join(skewed, lookup, ["k"])
    assert len(out.collect()) == 300_000
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_full_join_splits_hot_keys_of_either_side(skewed):
    """Keys 0 (hot on the left, 20 partners), -1 (hot on the right, one partner), -2 (hot on the right only), null (hot)."""
    left = skewed.select(F.when(F.col("k") % 50 != 49, F.col("k")).alias("k"), F.col("pad").alias("a"))
    left = left.unionByName(left.limit(1).select(F.lit(-1).cast("bigint").alias("k"), "a"))
    right = skewed.select(F.when(F.col("k") == 0, -1).when(F.col("k") < 1500, -2).otherwise(F.col("k") + 2000).alias("k"), F.col("pad").alias("b"))
    right = right.unionByName(skewed.where("k = 1").limit(20).select(F.lit(0).cast("bigint").alias("k"), F.col("pad").alias("b")))
    out = full_join(left, right, ["k"], share=0.01, least=1000)
    plain = left.join(right, "k", "full")
    assert out.columns == ["k", "a", "b"]
    print_of = lambda df: df.select(F.count("*"), F.count("k"), F.count("a"), F.count("b"), F.sum(F.xxhash64("k", "a", "b").cast("decimal(38,0)"))).first()
    assert print_of(out) == print_of(plain)
    out.write.format("noop").mode("overwrite").save()
    out.collect()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_full_join_of_null_keys_and_empty_sides(frame):
    a = frame([(1, None, 1.0), (None, "x", 2.0), (2, "y", None)], "i int, s string, a double")
    b = frame([(1, None, 5.0), (None, "x", 6.0), (3, "z", 7.0)], "i int, s string, b double")
    same = [(1, None, 1.0, 5.0), (2, "y", None, None), (3, "z", None, 7.0), (None, "x", 2.0, 6.0)]
    apart = [(1, None, 1.0, None), (1, None, None, 5.0), (2, "y", None, None), (3, "z", None, 7.0), (None, "x", 2.0, None), (None, "x", None, 6.0)]
    for least in (0, 100):  # every key hot, or none
        got = {tuple(r) for r in full_join(a, b, ["i", "s"], null_keys=True, share=0.0, least=least).collect()}
        assert got == set(same)
        got = {tuple(r) for r in full_join(a, b, ["i", "s"], share=0.0, least=least).collect()}
        assert got == set(apart)
    assert full_join(a, b.limit(0), ["i", "s"], share=0.0, least=0).count() == 3 == full_join(a.limit(0), b, ["i", "s"]).count()
    with pytest.raises(ValueError):
        full_join(a, a, ["i", "s"])


def test_shares_and_first_rows_of_a_hot_key(skewed):
    parts = share(skewed, "v", ["k"]).groupBy("k").agg(F.sum("share").alias("s"))
    assert parts.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0
    top = first_rows(skewed, ["k"], ["v", "pad"])
    assert top.count() == 5001
    assert top.where("k = 0").first().v == 0.0


def test_quantile_of_a_hot_key(skewed):
    got = quantiles(skewed, ["k"], "v", {"m": 0.5}, few=1000).where("k = 0").first().m
    values = sorted(i % 97 for i in range(100_000))
    assert got == (values[49_999] + values[50_000]) / 2


def test_scratch_follows_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == root and scratch_dir(spark, "x").startswith(root)
    assert cut_lineage(spark.range(3)).inputFiles()[0].removeprefix("file://").startswith(root)


def test_scratch_without_the_setting_lies_beside_the_tables(spark, monkeypatch):
    setting = spark.conf.get("spark.checkpoint.dir")
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: {"spark.sql.warehouse.dir": "/shared/tables"}.get(key, default))
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    monkeypatch.setattr(type(spark.sparkContext), "setCheckpointDir", lambda self, path: None)
    assert checkpoint_root(spark) == "/shared/tables/_scratch" and setting


def test_scratch_on_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    tables = {"spark.sql.warehouse.dir": "file:/home/me/spark-warehouse"}
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: tables.get(key, default))
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    monkeypatch.setattr(type(spark.sparkContext), "setCheckpointDir", lambda self, path: None)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    for path in ("file:/home/me/spark-warehouse", "/home/me/spark-warehouse", "file:///x"):
        tables["spark.sql.warehouse.dir"] = path
        with pytest.raises(RuntimeError):
            checkpoint_root(spark)
    tables["spark.sql.warehouse.dir"] = "hdfs://name/tables"
    assert checkpoint_root(spark) == "hdfs://name/tables/_scratch"


def test_scratch_is_removed_as_a_whole(spark):
    cut_lineage(spark.range(3))
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert system.exists(folder)
    drop_scratch(spark)
    assert not system.exists(folder)


def test_year_bounds_reach_the_scan(spark):
    import __spark_entry__ as entry

    for name in ("j12_anti_join", "u3_value_set_operations"):
        plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan, name


def test_no_collecting_or_pairing_nodes_in_core_plans(spark):
    import __spark_entry__ as entry

    for name in ("w8_cumulative_share_by_rank", "j8_repeat_for_each_row", "n1_write_to_all_regions", "d14_stock_balance"):
        plan = executed(entry.queries()[name](spark, "/root/testdata/sf0.001"))
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert node not in plan, (name, node)


def test_a_key_with_very_many_values_is_shared_by_tasks(spark):
    """A million distinct prices under one key: no task scans more than twice the mean."""
    from panelweave.operators.curves import supply_curve
    from panelweave.operators.scans import ROWS, running_total

    rows = spark.range(0, 1_000_000, 1, 8).select(F.lit(1).alias("k"), (F.col("id") / 1e7).alias("v"), "id", F.lit(1).alias("one"))
    n = -(-1_000_000 // ROWS) * 4
    run = running_total(rows, {"n": "id"}, ["k"], [F.col("v"), F.col("id")], rows=-(-1_000_000 // n))
    assert run.where(F.col("n") != F.col("id") * (F.col("id") + 1) / 2).count() == 0
    sizes = [r["count"] for r in rows.repartitionByRange(n, "k", "v", "id").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == n and max(sizes) <= 2 * sum(sizes) / n
    curve = supply_curve(rows, ["k"], "v", "one")
    assert curve.where(F.col("supply") != F.round(F.col("v") * 1e7) + 1).count() == 0 and curve.where("supply_total <> 1000000").count() == 0


def test_bands_narrow_to_exact_quantiles(spark):
    """300,000 distinct values of one key, and another whose one value is held by a third of all rows."""
    rows = spark.range(0, 600_000, 1, 8).select(
        (F.col("id") % 2).alias("k"),
        F.when((F.col("id") % 2 == 1) & (F.col("id") < 400_000), 7.0).otherwise(((F.col("id") * 7919) % 600_011).cast("double")).alias("v"),
    )
    probs = {"q1": 0.1, "q5": 0.5, "q9": 0.951}
    got = {r.k: r for r in quantiles(rows, ["k"], "v", probs, steps={"s3": 0.3}, few=500).collect()}
    want = {r.k: r for r in quantiles(rows, ["k"], "v", probs, steps={"s3": 0.3}, few=10**9).collect()}
    plain = {r.k: r for r in rows.groupBy("k").agg(*[F.percentile("v", p).alias(n) for n, p in probs.items()]).collect()}
    for k in (0, 1):
        assert got[k] == want[k]
        assert all(abs(got[k][n] - plain[k][n]) < 1e-6 for n in probs)
