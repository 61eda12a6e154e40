"""Queries for sorts, extremes and top rows."""

from pyspark.sql import Window, functions as F

from panelweave.operators.groups import first_rows
from panelweave.operators.joins import checked_join
from panelweave.plans.registry import query
from panelweave.plans.views import CURVE, CY, GAPS, TS


@query("o1_sort_nulls_last", f"WITH {GAPS} SELECT o_custkey, year, value FROM gaps ORDER BY value ASC NULLS LAST, o_custkey, year")
def _o1(t):
    return t.gaps.select("o_custkey", "year", "value").orderBy(F.col("value").asc_nulls_last(), "o_custkey", "year")


@query("o2_sort_descending", f"WITH {CURVE} SELECT * FROM curve ORDER BY price DESC, p_brand")
def _o2(t):
    return t.curve.orderBy(F.col("price").desc_nulls_last(), "p_brand")


@query("o3_sort_within_groups", f"WITH {TS} SELECT n_regionkey, n_nationkey, year, value FROM ts ORDER BY 1, 2, 3")
def _o3(t):
    return t.ts.orderBy("n_regionkey", "n_nationkey", "year")


@query(
    "o4_first_and_last_element",
    f"WITH {CY} SELECT year, count(*) AS n, round(sum(value), 2) AS value FROM cy WHERE year IN ((SELECT min(year) FROM cy), (SELECT max(year) FROM cy)) GROUP BY 1",
)
def _o4(t):
    ends = t.cy.agg(F.min("year").alias("a"), F.max("year").alias("b")).select(
        F.array("a", "b").alias("ends")
    )
    yearly = t.cy.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("value"))
    return yearly.where(F.array_contains(ends.scalar(), F.col("year")))


@query(
    "o5_top_one_per_group",
    f"""WITH {CY}, s AS (SELECT c_nationkey, o_custkey, round(sum(value), 2) AS total FROM cy JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
        SELECT c_nationkey, o_custkey, total FROM s
        QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY total DESC, o_custkey DESC) = 1""",
)
def _o5(t):
    who = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    sums = t.cy.groupBy("o_custkey").agg(F.round(F.sum("value"), 2).alias("total")).join(who, "o_custkey")
    return first_rows(sums, ["c_nationkey"], ["total", "o_custkey"], last=True).select("c_nationkey", "o_custkey", "total")


@query(
    "o6_next_in_ordered_domain",
    f"""WITH {CY}, d AS (SELECT year, coalesce(lead(year) OVER (ORDER BY year), year) AS next_year FROM (SELECT DISTINCT year FROM cy))
        SELECT o_custkey, year, next_year, value FROM cy JOIN d USING (year)""",
)
def _o6(t):
    # One row per year, so the window without a partition key stays tiny.
    years = t.cy.select("year").distinct()
    domain = years.withColumn("next_year", F.coalesce(F.lead("year").over(Window.orderBy("year")), "year"))
    return checked_join(t.cy.select("o_custkey", "year", "value"), domain, ["year"])
