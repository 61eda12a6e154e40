"""Queries for wide and long forms."""

from pyspark.sql import functions as F

from panelweave.functions.semantics import sum_where
from panelweave.operators.reshape import equivalence_rows, gather_years, spread
from panelweave.plans.registry import query
from panelweave.plans.views import CY, YEARS
from panelweave.sources.sinks import nest


@query("r1_year_columns_to_rows", f"WITH {CY} SELECT o_custkey, year, value AS amount FROM cy")
def _r1(t):
    wide = spread(t.cy, ["o_custkey"], "year", "value", YEARS)
    return gather_years(wide, "amount", drop_null=True)


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "r2_measures_to_rows",
    " UNION ALL ".join(
        f"SELECT l_returnflag, '{m}' AS measure, count(*) AS n, round(sum({m}), 2) AS total FROM lineitem GROUP BY 1"
        for m in MEASURES
    ),
)
def _r2(t):
    sums = t.lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), *[F.round(F.sum(m), 2).alias(m) for m in MEASURES]
    )
    return sums.unpivot(["l_returnflag", "n"], MEASURES, "measure", "total")


@query(
    "r3_rows_to_columns",
    """SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
       count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
       FROM orders GROUP BY 1""",
)
def _r3(t):
    counts = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return spread(counts, ["o_custkey"], "o_orderstatus", "n", ["F", "O", "P"], fill=0)


@query(
    "r4_nest_and_unnest",
    f"WITH {CY} SELECT o_custkey, count(*) OVER (PARTITION BY o_custkey) AS years, year, value FROM cy",
)
def _r4(t):
    nested = nest(t.cy.select("o_custkey", "year", "value"), ["o_custkey"], "series", ["year"])
    return nested.select("o_custkey", F.size("series").cast("long").alias("years"), F.inline("series"))


@query(
    "r5_logical_pivot",
    """SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS is_return,
       sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0 END) AS is_kept FROM lineitem GROUP BY 1""",
)
def _r5(t):
    back = F.col("l_returnflag") == "R"
    return t.lineitem.groupBy("l_suppkey").agg(
        sum_where(back, "l_quantity").alias("is_return"), sum_where(~back, "l_quantity").alias("is_kept")
    )


@query(
    "r6_equivalence_row",
    """SELECT p_type, count(DISTINCT p_brand) AS n_tags, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS tags
       FROM part GROUP BY 1""",
)
def _r6(t):
    rows = equivalence_rows(t.part, "p_type", "p_brand")
    return rows.select("p_type", F.size("tags").cast("long").alias("n_tags"), F.array_join("tags", ",").alias("tags"))
