"""Queries for grouped aggregates."""

from pyspark.sql import functions as F

from panelweave.functions.semantics import (
    lenient_sum,
    ratio,
    strict_sum,
    sum_where,
    weighted_mean,
)
from panelweave.operators.curves import regression
from panelweave.operators.groups import first_rows, with_panel
from panelweave.operators.reshape import numeric_columns
from panelweave.operators.scans import quantiles
from panelweave.plans.registry import query
from panelweave.plans.views import BILAT, CY, GAPS, TS, WIDE, YEARS


def gaps_by_segment(t):
    who = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    return t.gaps.join(who, "o_custkey")


SEGMENTS = f"""{GAPS}, seg AS (SELECT gaps.*, c_nationkey, c_mktsegment FROM gaps JOIN customer ON o_custkey = c_custkey)"""


@query(
    "ag1_grouped_sum_strict_and_lenient",
    f"""WITH {SEGMENTS} SELECT c_nationkey, c_mktsegment, year,
        CASE WHEN count(value) = count(*) THEN round(sum(value), 2) END AS strict,
        round(coalesce(sum(value), 0), 2) AS lenient FROM seg GROUP BY 1, 2, 3""",
)
def _ag1(t):
    return gaps_by_segment(t).groupBy("c_nationkey", "c_mktsegment", "year").agg(
        F.round(strict_sum("value"), 2).alias("strict"), F.round(lenient_sum("value"), 2).alias("lenient")
    )


@query(
    "ag2_several_aggregates",
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS qty, max(l_extendedprice) AS top,
       min(l_shipdate)::DATE AS first_ship, count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def _ag2(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("qty"),
        F.max("l_extendedprice").alias("top"),
        F.to_date(F.min("l_shipdate")).alias("first_ship"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "ag3_group_by_all_except",
    f"WITH {BILAT} SELECT c_nation, year, round(sum(value), 4) AS value FROM bilat GROUP BY 1, 2",
)
def _ag3(t):
    keys = [c for c in t.bilat.columns if c not in ("value", "s_nation")]
    return t.bilat.groupBy(*keys).agg(F.round(F.sum("value"), 4).alias("value"))


@query(
    "ag4_aggregate_every_numeric",
    f"""WITH {WIDE} SELECT n_regionkey, {', '.join(f'round(sum("{y}"), 2) AS "{y}"' for y in YEARS)}
        FROM wide JOIN nation USING (n_nationkey) GROUP BY 1""",
)
def _ag4(t):
    rows = t.wide.join(t.nation.select("n_nationkey", "n_regionkey"), "n_nationkey")
    numbers = numeric_columns(rows, except_for=["n_nationkey", "n_regionkey"])
    return rows.groupBy("n_regionkey").agg(*[F.round(F.sum(F.col(f"`{c}`")), 2).alias(c) for c in numbers])


@query(
    "ag5_mean",
    f"""WITH {SEGMENTS} SELECT c_nationkey, c_mktsegment, year,
        CASE WHEN count(value) = count(*) THEN round(sum(value), 2) / count(*) END AS strict,
        round(sum(value), 2) / count(value) AS known FROM seg GROUP BY 1, 2, 3""",
)
def _ag5(t):
    return gaps_by_segment(t).groupBy("c_nationkey", "c_mktsegment", "year").agg(
        ratio(F.round(strict_sum("value"), 2), F.count(F.lit(1))).alias("strict"),
        ratio(F.round(F.sum("value"), 2), F.count("value")).alias("known"),
    )


@query(
    "ag6_weighted_mean",
    """SELECT l_returnflag, l_suppkey, round(sum(l_discount * l_extendedprice) / sum(l_extendedprice), 9) AS discount
       FROM lineitem GROUP BY 1, 2""",
)
def _ag6(t):
    return t.lineitem.groupBy("l_returnflag", "l_suppkey").agg(
        F.round(weighted_mean("l_discount", "l_extendedprice"), 9).alias("discount")
    )


@query(
    "ag7_median",
    "SELECT p_brand, round(median(p_retailprice), 6) AS median FROM part GROUP BY 1",
)
def _ag7(t):
    out = quantiles(t.part, ["p_brand"], "p_retailprice", {"median": 0.5})
    return out.withColumn("median", F.round("median", 6))


@query(
    "ag8_quantiles_two_kinds",
    """WITH r AS (SELECT l_returnflag, l_extendedprice AS x,
         row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS rn,
         count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
       SELECT l_returnflag, round(quantile_cont(x, 0.1), 6) AS p10, round(quantile_cont(x, 0.95), 6) AS p95,
         min(CASE WHEN rn >= n * 0.25 THEN x END) AS d25, min(CASE WHEN rn >= n * 0.75 THEN x END) AS d75
       FROM r GROUP BY 1""",
)
def _ag8(t):
    out = quantiles(
        t.lineitem, ["l_returnflag"], "l_extendedprice", {"p10": 0.1, "p95": 0.95}, steps={"d25": 0.25, "d75": 0.75}
    )
    return out.select(
        "l_returnflag", F.round("p10", 6).alias("p10"), F.round("p95", 6).alias("p95"), "d25", "d75"
    )


@query(
    "ag9_min_max_count_first_last",
    f"""WITH {CY} SELECT o_custkey, min(value) AS least, max(value) AS most, count(*) AS n,
        arg_min(value, year) AS first, arg_max(value, year) AS last FROM cy GROUP BY 1""",
)
def _ag9(t):
    return t.cy.groupBy("o_custkey").agg(
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        F.count(F.lit(1)).alias("n"),
        F.min_by("value", "year").alias("first"),
        F.max_by("value", "year").alias("last"),
    )


@query(
    "ag10_conditional_aggregate",
    """SELECT l_suppkey, coalesce(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 0) AS returned,
       greatest(max(CASE WHEN l_linestatus = 'O' THEN l_extendedprice END), 0) AS open_top FROM lineitem GROUP BY 1""",
)
def _ag10(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        sum_where(F.col("l_returnflag") == "R", "l_quantity").alias("returned"),
        F.greatest(F.max(F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice"))), F.lit(0.0)).alias("open_top"),
    )


@query(
    "ag11_level_by_level_rollup",
    """SELECT p_brand, p_type, CAST(sum(p_size) AS BIGINT) AS size, CAST(grouping(p_brand) + grouping(p_type) AS INTEGER) AS level
       FROM part GROUP BY ROLLUP (p_brand, p_type)""",
)
def _ag11(t):
    return t.part.rollup("p_brand", "p_type").agg(
        F.sum("p_size").alias("size"),
        (F.grouping("p_brand") + F.grouping("p_type")).cast("int").alias("level"),
    )


@query("ag12_distinct_rows", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def _ag12(t):
    return t.customer.select("c_nationkey", "c_mktsegment").distinct()


@query(
    "ag13_distinct_keeping_first",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
)
def _ag13(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return first_rows(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "ag14_last_wins",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def _ag14(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return first_rows(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], last=True).drop("o_orderdate")


@query(
    "ag15_count_distinct",
    "SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1",
)
def _ag15(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_orderkey").alias("orders")
    )


@query(
    "ag16_whole_table_scalar",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""",
)
def _ag16(t):
    begin = t.orders.agg(F.trunc(F.max("o_orderdate"), "year")).scalar()
    return t.orders.where(F.col("o_orderdate") >= begin).select("o_orderkey", "o_totalprice")


@query(
    "ag17_sum_of_squared_errors",
    f"""WITH {TS}, m AS (SELECT n_nationkey, avg(value) AS mean FROM ts GROUP BY 1)
        SELECT n_nationkey, round(sum((value / 1e6 - mean / 1e6) ** 2), 6) AS sse FROM ts JOIN m USING (n_nationkey) GROUP BY 1""",
)
def _ag17(t):
    rows = with_panel(t.ts, ["n_nationkey"], {"mean": F.avg("value")})
    error = F.col("value") / 1e6 - F.col("mean") / 1e6
    return rows.groupBy("n_nationkey").agg(F.round(F.sum(error * error), 6).alias("sse"))


@query(
    "ag18_linear_regression",
    f"""WITH {TS} SELECT n_nationkey, count(*) AS n, round(regr_slope(value / 1e6, year - 1995), 10) AS slope,
        round(regr_intercept(value / 1e6, year - 1995), 10) AS intercept FROM ts GROUP BY 1""",
)
def _ag18(t):
    rows = t.ts.select("n_nationkey", (F.col("value") / 1e6).alias("y"), (F.col("year") - 1995).alias("x"))
    return regression(rows, ["n_nationkey"], "y", "x").select(
        "n_nationkey", "n", F.round("slope", 10).alias("slope"), F.round("intercept", 10).alias("intercept")
    )


@query(
    "ag19_two_step_mean",
    f"""WITH {CY} SELECT c_nationkey, round(sum(value), 2) / count(*) AS mean FROM
        (SELECT DISTINCT o_custkey, year, value FROM cy) JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def _ag19(t):
    who = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return t.cy.select("o_custkey", "year", "value").join(who, "o_custkey").groupBy("c_nationkey").agg(
        ratio(F.round(F.sum("value"), 2), F.count(F.lit(1))).alias("mean")
    )


@query(
    "ag20_ratio_of_sums",
    """SELECT p_brand, round(sum(l_extendedprice) / sum(l_quantity), 6) AS unit_value
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def _ag20(t):
    per_part = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.sum("l_extendedprice").alias("amount"), F.sum("l_quantity").alias("qty")
    )
    return per_part.join(t.part.select("p_partkey", "p_brand"), "p_partkey").groupBy("p_brand").agg(
        F.round(ratio(F.sum("amount"), F.sum("qty")), 6).alias("unit_value")
    )
