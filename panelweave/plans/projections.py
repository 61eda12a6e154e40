"""Queries for projections and computed columns."""

import re

from pyspark.sql import functions as F

from panelweave.operators.groups import with_total
from panelweave.operators.joins import keep_matching
from panelweave.operators.reshape import (
    columns_without_null,
    numeric_columns,
    protect_years,
    unprotect_years,
)
from panelweave.plans.registry import query
from panelweave.plans.views import GAPS, TS, WIDE, YEARS


@query("p1_project_and_drop", "SELECT o_orderkey, o_totalprice FROM orders")
def _p1(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").drop("o_custkey")


@query("p2_project_by_pattern", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def _p2(t):
    return t.orders.select(*[c for c in t.orders.columns if not re.search("price|date", c)])


@query("p3_rename_in_projection", f"WITH {TS} SELECT n_nationkey AS area, year, value AS amount FROM ts")
def _p3(t):
    return t.ts.select(F.col("n_nationkey").alias("area"), "year", F.col("value").alias("amount"))


@query("p4_rename", "SELECT s_suppkey AS id, s_name AS name, s_nationkey, s_acctbal AS balance FROM supplier")
def _p4(t):
    return t.supplier.withColumnsRenamed({"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance"})


@query(
    "p5_rename_by_pattern",
    "SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS mktsegment FROM customer",
)
def _p5(t):
    return t.customer.toDF(*[re.sub("^c_", "", c) for c in t.customer.columns])


@query(
    "p6_protect_year_names",
    f"WITH {WIDE} SELECT n_nationkey, {', '.join(f'\"{y}\" AS \"X{y}\"' for y in YEARS)} FROM wide",
)
def _p6(t):
    return protect_years(unprotect_years(protect_years(t.wide)))


@query(
    "p7_chained_columns",
    """SELECT o_orderkey, round(o_totalprice * 0.9, 3) AS net, round(o_totalprice * 0.9 * 0.2, 4) AS tax,
       o_totalprice * 0.9 * 0.2 > 50000 AS high FROM orders""",
)
def _p7(t):
    out = t.orders.withColumn("a", F.col("o_totalprice") * 0.9).withColumn("b", F.col("a") * 0.2)
    return out.withColumn("high", F.col("b") > 50000).select(
        "o_orderkey", F.round("a", 3).alias("net"), F.round("b", 4).alias("tax"), "high"
    )


@query("p8_compute_and_keep", f"WITH {TS} SELECT n_nationkey, year - 1995 AS step, round(value / 1000000, 8) AS millions FROM ts")
def _p8(t):
    return t.ts.select(
        "n_nationkey", (F.col("year") - 1995).alias("step"), F.round(F.col("value") / 1000000, 8).alias("millions")
    )


@query(
    "p9_all_numeric_columns",
    f"WITH {GAPS} SELECT o_custkey, year, coalesce(value, 0) AS value, coalesce(n_orders, 0) AS n_orders FROM gaps",
)
def _p9(t):
    numbers = numeric_columns(t.gaps)
    return t.gaps.select(*[F.coalesce(c, F.lit(0)).alias(c) if c in numbers else F.col(c) for c in t.gaps.columns])


@query("p10_drop_columns_with_nulls", f"WITH {WIDE} SELECT * FROM wide")
def _p10(t):
    late = F.max(F.when(F.col("year") > 2001, F.col("value")))
    extra = t.ts.groupBy("n_nationkey").agg(late.alias("2002"))
    both = t.wide.join(extra, "n_nationkey")
    return both.select(*[F.col(f"`{c}`") for c in columns_without_null(both)])


@query(
    "p11_pull_values_as_filter",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def _p11(t):
    wanted = t.customer.where("c_mktsegment = 'BUILDING'")
    return keep_matching(t.orders, wanted, {"o_custkey": "c_custkey"}).select("o_orderkey", "o_totalprice")


@query(
    "p12_literal_table",
    """SELECT rank, count(*) AS n FROM orders JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3),
       ('4-NOT SPECIFIED', 4), ('5-LOW', 5)) p(o_orderpriority, rank) USING (o_orderpriority) GROUP BY 1""",
)
def _p12(t):
    literal = t.spark.createDataFrame(
        [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)],
        "o_orderpriority string, rank int",
    )
    return t.orders.groupBy("o_orderpriority").count().join(literal, "o_orderpriority").select(
        "rank", F.col("count").alias("n")
    )


@query(
    "p13_append_literal_rows",
    """SELECT n_name, count(c_custkey) AS n FROM (SELECT n_nationkey, n_name FROM nation
       UNION ALL VALUES (98, 'ATLANTIS'), (99, 'UNKNOWN')) LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1""",
)
def _p13(t):
    extra = t.spark.createDataFrame([(98, "ATLANTIS"), (99, "UNKNOWN")], "n_nationkey int, n_name string")
    nations = t.nation.select("n_nationkey", "n_name").unionByName(extra)
    counts = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).count()
    return nations.join(counts, "n_nationkey", "left").select(
        "n_name", F.coalesce("count", F.lit(0)).alias("n")
    )


@query(
    "p14_bind_single_row",
    """SELECT s_suppkey, s_acctbal, lo, hi FROM supplier CROSS JOIN
       (SELECT min(s_acctbal) AS lo, max(s_acctbal) AS hi FROM supplier)""",
)
def _p14(t):
    return with_total(
        t.supplier.select("s_suppkey", "s_acctbal"), {"lo": F.min("s_acctbal"), "hi": F.max("s_acctbal")}
    )


@query("p15_compose_key", "SELECT p_partkey, p_brand || ':' || p_type || ':' || p_size AS id FROM part")
def _p15(t):
    return t.part.select("p_partkey", F.concat_ws(":", "p_brand", "p_type", "p_size").alias("id"))


@query(
    "p16_split_key",
    "SELECT p_partkey, split_part(p_name, ' ', 1) AS adjective, split_part(p_name, ' ', 2) AS noun FROM part",
)
def _p16(t):
    parts = F.split("p_name", " ")
    return t.part.select("p_partkey", F.get(parts, 0).alias("adjective"), F.get(parts, 1).alias("noun"))


@query(
    "p17_overwrite_where",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer",
)
def _p17(t):
    return t.customer.select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, 0.0).otherwise(F.col("c_acctbal")).alias("c_acctbal")
    )


@query(
    "p18_replace_nulls_per_column",
    f"WITH {GAPS} SELECT o_custkey, year, coalesce(value, -1) AS value, coalesce(n_orders, 0) AS n_orders FROM gaps",
)
def _p18(t):
    return t.gaps.fillna({"value": -1.0, "n_orders": 0})


@query("p19_select_by_name_list", f"WITH {TS} SELECT year, n_nationkey, value FROM ts")
def _p19(t):
    names = ["year", "n_nationkey", "value"]
    return t.ts.select(*names)


@query("p20_constant_columns", f"WITH {TS} SELECT n_nationkey, year, value, 'currency' AS unit, 1 AS weight FROM ts")
def _p20(t):
    return t.ts.select("n_nationkey", "year", "value", F.lit("currency").alias("unit"), F.lit(1).alias("weight"))
