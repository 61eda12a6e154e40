"""Queries for window functions on series, and group values attached to rows."""

from pyspark.sql import Window, functions as F

from panelweave.functions.semantics import ratio, row_max, row_min, sum_where, year_between
from panelweave.operators.allocation import index_to_member
from panelweave.operators.curves import supply_curve
from panelweave.operators.groups import share, with_panel
from panelweave.operators.scans import running_total, with_quantiles
from panelweave.operators.timeseries import anchor_value, cumulative_product, moving_average, over
from panelweave.plans.registry import query
from panelweave.plans.views import CURVE, CY, GAPS, LINES, SUA, TS

CUST = "PARTITION BY o_custkey ORDER BY year"


@query(
    "w1_share_of_group_total",
    f"WITH {TS} SELECT n_nationkey, year, round(value / sum(value) OVER (PARTITION BY n_regionkey, year), 9) AS share FROM ts",
)
def _w1(t):
    return share(t.ts, "value", ["n_regionkey", "year"]).select("n_nationkey", "year", F.round("share", 9).alias("share"))


URGENT = """urgent AS (SELECT c_custkey, c_nationkey, c_mktsegment, round(coalesce(sum(o_totalprice), 0), 2) AS value
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
    AND year(o_orderdate) = 1998 GROUP BY 1, 2, 3)"""


def urgent(t):
    # all orders are read; only the few that count have a value, so that some totals are zero
    chosen = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT") & year_between("o_orderdate", 1998)
    sums = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.round(sum_where(chosen, "o_totalprice"), 2).alias("value")
    )
    return (
        t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
        .join(sums, "c_custkey", "left")
        .fillna(0.0, ["value"])
    )


@query(
    "w2_share_with_equal_split",
    f"""WITH {URGENT} SELECT c_custkey, round(coalesce(value / nullif(sum(value) OVER w, 0), 1.0 / count(*) OVER w), 9) AS share
        FROM urgent WINDOW w AS (PARTITION BY c_nationkey, c_mktsegment)""",
)
def _w2(t):
    out = share(urgent(t), "value", ["c_nationkey", "c_mktsegment"], equal_split=True)
    return out.select("c_custkey", F.round("share", 9).alias("share"))


@query(
    "w3_lag_with_default",
    f"WITH {GAPS} SELECT o_custkey, year, value, lag(value, 1, -1.0) OVER ({CUST}) AS before FROM gaps",
)
def _w3(t):
    return t.gaps.select("o_custkey", "year", "value", F.lag("value", 1, -1.0).over(over(["o_custkey"])).alias("before"))


@query(
    "w4_lead_with_default",
    f"WITH {GAPS} SELECT o_custkey, year, lead(value, 1, 0.0) OVER ({CUST}) AS after FROM gaps",
)
def _w4(t):
    return t.gaps.select("o_custkey", "year", F.lead("value", 1, 0.0).over(over(["o_custkey"])).alias("after"))


@query(
    "w5_change_and_growth",
    f"""WITH {GAPS} SELECT o_custkey, year, round(value - lag(value) OVER w, 2) AS change,
        round(value / lag(value) OVER w, 9) AS growth FROM gaps WINDOW w AS ({CUST})""",
)
def _w5(t):
    before = F.lag("value").over(over(["o_custkey"]))
    return t.gaps.select(
        "o_custkey",
        "year",
        F.round(F.col("value") - before, 2).alias("change"),
        F.round(ratio("value", before), 9).alias("growth"),
    )


@query(
    "w6_cumulative_sum",
    f"WITH {CURVE} SELECT p_brand, price, CAST(sum(quantity) OVER (PARTITION BY p_brand ORDER BY price) AS BIGINT) AS supply FROM curve",
)
def _w6(t):
    curve = supply_curve(t.part, ["p_brand"], "p_retailprice", "p_size")
    return curve.select("p_brand", F.col("p_retailprice").alias("price"), "supply")


@query(
    "w7_cumulative_product",
    f"""WITH {TS}, g AS (SELECT n_nationkey, year, coalesce(value / lag(value) OVER w, 1.0) AS factor FROM ts
          WINDOW w AS (PARTITION BY n_nationkey ORDER BY year))
        SELECT n_nationkey, year, round(product(factor) OVER (PARTITION BY n_nationkey ORDER BY year), 9) AS level FROM g""",
)
def _w7(t):
    factor = F.coalesce(ratio("value", F.lag("value").over(over(["n_nationkey"]))), F.lit(1.0))
    out = cumulative_product(t.ts.withColumn("factor", factor), ["n_nationkey"], "factor", "level")
    return out.select("n_nationkey", "year", F.round("level", 9).alias("level"))


@query(
    "w8_cumulative_share_by_rank",
    f"""WITH {CY}, s AS (SELECT c_nationkey, o_custkey, round(sum(value), 2) AS total FROM cy
          JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
        SELECT c_nationkey, o_custkey, round(sum(total) OVER (PARTITION BY c_nationkey ORDER BY total DESC, o_custkey
          ROWS UNBOUNDED PRECEDING) / sum(total) OVER (PARTITION BY c_nationkey), 9) AS cum_share FROM s""",
)
def _w8(t):
    who = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    sums = t.cy.groupBy("o_custkey").agg(F.round(F.sum("value"), 2).alias("total")).join(who, "o_custkey")
    run = running_total(
        sums,
        {"cum": "total"},
        ["c_nationkey"],
        [F.col("total").desc(), F.col("o_custkey").asc()],
        totals={"all": "cum"},
    )
    return run.select("c_nationkey", "o_custkey", F.round(ratio("cum", "all"), 9).alias("cum_share"))


@query(
    "w9_row_number_label",
    f"WITH {CURVE} SELECT p_brand, price, 'grade' || row_number() OVER (PARTITION BY p_brand ORDER BY price) AS grade FROM curve",
)
def _w9(t):
    points = t.curve.withColumn("one", F.lit(1))
    run = running_total(points, {"n": "one"}, ["p_brand"], [F.col("price")])
    return run.select("p_brand", "price", F.concat(F.lit("grade"), F.col("n").cast("string")).alias("grade"))


@query(
    "w10_centred_moving_average",
    f"""WITH {GAPS} SELECT o_custkey, year, round(coalesce(CASE WHEN count(value) OVER w = 3 THEN avg(value) OVER w END, value), 4) AS smooth
        FROM gaps WINDOW w AS ({CUST} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)""",
)
def _w10(t):
    out = moving_average(t.gaps, ["o_custkey"], "value", "mean", periods=3)
    return out.select("o_custkey", "year", F.round(F.coalesce("mean", "value"), 4).alias("smooth"))


@query(
    "w11_anchor_value_in_group",
    f"""WITH {GAPS} SELECT o_custkey, year, round(value / max(CASE WHEN year = 1997 THEN value END) OVER (PARTITION BY o_custkey), 9) AS idx
        FROM gaps""",
)
def _w11(t):
    out = anchor_value(t.gaps, ["o_custkey"], F.col("year") == 1997, "value", "base")
    return out.select("o_custkey", "year", F.round(ratio("value", "base"), 9).alias("idx"))


@query(
    "w12_index_to_first_row",
    f"WITH {CY} SELECT o_custkey, year, round(value / first_value(value) OVER ({CUST}), 9) AS idx FROM cy",
)
def _w12(t):
    first = F.first("value").over(over(["o_custkey"]).rowsBetween(Window.unboundedPreceding, 0))
    return t.cy.select("o_custkey", "year", F.round(ratio("value", first), 9).alias("idx"))


@query(
    "w13_fill_down_and_up",
    f"""WITH {GAPS} SELECT o_custkey, year,
        last_value(value IGNORE NULLS) OVER ({CUST} ROWS UNBOUNDED PRECEDING) AS down,
        first_value(value IGNORE NULLS) OVER ({CUST} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS up FROM gaps""",
)
def _w13(t):
    so_far = (Window.unboundedPreceding, 0)
    back = over(["o_custkey"], F.col("year").desc())
    return t.gaps.select(
        "o_custkey",
        "year",
        F.last("value", ignorenulls=True).over(over(["o_custkey"]).rowsBetween(*so_far)).alias("down"),
        F.last("value", ignorenulls=True).over(back.rowsBetween(*so_far)).alias("up"),
    )


@query(
    "w14_first_zero_after_activity",
    f"""WITH {GAPS}, z AS (SELECT o_custkey, year, coalesce(value, 0) AS v,
          lag(coalesce(value, 0)) OVER ({CUST}) AS p FROM gaps)
        SELECT o_custkey, year, coalesce(v = 0 AND p <> 0, false) AS is_first_zero FROM z""",
)
def _w14(t):
    zeroed = t.gaps.fillna(0.0, ["value"])
    before = F.lag("value").over(over(["o_custkey"]))
    return zeroed.select(
        "o_custkey",
        "year",
        F.coalesce((F.col("value") == 0) & (before != 0), F.lit(False)).alias("is_first_zero"),
    )


@query(
    "w15_group_quantile_on_rows",
    """WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.95) AS upper FROM lineitem GROUP BY 1)
       SELECT l_orderkey, l_linenumber, round(upper, 6) AS upper, l_extendedprice FROM lineitem JOIN q USING (l_returnflag)
       WHERE l_extendedprice > upper""",
)
def _w15(t):
    rows = with_quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", {"upper": 0.95})
    return rows.where(F.col("l_extendedprice") > F.col("upper")).select(
        "l_orderkey", "l_linenumber", F.round("upper", 6).alias("upper"), "l_extendedprice"
    )


@query(
    "w16_row_wise_extremes",
    f"""WITH {GAPS}, p AS (SELECT o_custkey, year, value AS a, lag(value) OVER ({CUST}) AS b FROM gaps)
        SELECT o_custkey, year, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN greatest(a, b) END AS hi,
        CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN least(a, b) END AS lo FROM p""",
)
def _w16(t):
    pairs = t.gaps.withColumn("before", F.lag("value").over(over(["o_custkey"])))
    return pairs.select("o_custkey", "year", row_max("value", "before").alias("hi"), row_min("value", "before").alias("lo"))


@query(
    "w17_algebra_between_elements",
    f"""WITH {SUA} SELECT area, item, year, element, round(value - max(CASE WHEN element = 'Production' THEN value END)
        OVER (PARTITION BY area, item, year), 2) AS over_production FROM sua""",
)
def _w17(t):
    rows = anchor_value(t.sua, ["area", "item", "year"], F.col("element") == "Production", "value", "made")
    return rows.select("area", "item", "year", "element", F.round(F.col("value") - F.col("made"), 2).alias("over_production"))


@query(
    "w18_group_size_on_rows",
    f"WITH {LINES} SELECT n_lines, count(*) AS rows, sum(l_quantity) AS qty FROM lineitem JOIN lines USING (l_orderkey) GROUP BY 1",
)
def _w18(t):
    rows = with_panel(t.lineitem.select("l_orderkey", "l_quantity"), ["l_orderkey"], {"n_lines": F.count(F.lit(1))})
    return rows.groupBy("n_lines").agg(F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("qty"))


@query(
    "w19_index_to_reference_member",
    f"""WITH {TS} SELECT n_nationkey, year, round(coalesce(value / max(CASE WHEN n_nationkey = 7 THEN value END)
        OVER (PARTITION BY year), 0.001), 9) AS idx FROM ts""",
)
def _w19(t):
    out = index_to_member(t.ts, ["year"], F.col("n_nationkey") == 7, "value", "idx")
    return out.select("n_nationkey", "year", F.round(F.coalesce("idx", F.lit(0.001)), 9).alias("idx"))
