"""Queries for filters and predicates."""

from pyspark.sql import functions as F

from panelweave.functions.semantics import is_in
from panelweave.operators.curves import half_supply_price, supply_curve
from panelweave.operators.groups import attach, with_panel
from panelweave.operators.joins import drop_matching
from panelweave.operators.reshape import spread
from panelweave.plans.registry import query
from panelweave.plans.views import CURVE, CY, GAPS, YEARS


@query("f1_row_filter", f"WITH {GAPS} SELECT o_custkey, year, value FROM gaps WHERE value > 200000")
def _f1(t):
    return t.gaps.where(F.col("value") > 200000).select("o_custkey", "year", "value")


@query(
    "f2_membership_null_safe",
    f"""WITH {GAPS} SELECT o_custkey, year, n_orders, coalesce(n_orders IN (2, 3), false) AS is_member
        FROM gaps WHERE n_orders IS NULL OR n_orders NOT IN (1, 4)""",
)
def _f2(t):
    kept = t.gaps.where(~is_in("n_orders", [1, 4]))
    return kept.select("o_custkey", "year", "n_orders", is_in("n_orders", [2, 3]).alias("is_member"))


@query(
    "f3_regex_match",
    """SELECT p_partkey, p_name, p_type FROM part
       WHERE regexp_matches(p_type, '^(S|P)') AND contains(p_name, 'bolt')""",
)
def _f3(t):
    return t.part.where(F.col("p_type").rlike("^(S|P)") & F.col("p_name").contains("bolt")).select(
        "p_partkey", "p_name", "p_type"
    )


@query(
    "f4_filter_on_group_total",
    f"""WITH {CY} SELECT o_custkey, year, value FROM cy
        QUALIFY sum(value) OVER (PARTITION BY o_custkey) > 2500000""",
)
def _f4(t):
    rows = with_panel(t.cy, ["o_custkey"], {"total": F.sum("value")})
    return rows.where(F.col("total") > 2500000).select("o_custkey", "year", "value")


@query(
    "f5_first_row_over_threshold",
    f"""WITH {CURVE}, run AS (SELECT p_brand, price,
          CAST(sum(quantity) OVER (PARTITION BY p_brand ORDER BY price) AS BIGINT) AS supply FROM curve),
        top AS (SELECT *, max(supply) OVER (PARTITION BY p_brand) AS m FROM run)
        SELECT p_brand, min(price) AS price FROM top WHERE supply >= 0.5 * m GROUP BY 1""",
)
def _f5(t):
    curve = supply_curve(t.part, ["p_brand"], "p_retailprice", "p_size")
    return half_supply_price(curve, ["p_brand"], "p_retailprice", "supply", out="price").select("p_brand", "price")


@query("f6_drop_missing", f"WITH {GAPS} SELECT o_custkey, year, value, n_orders FROM gaps WHERE value IS NOT NULL")
def _f6(t):
    return t.gaps.dropna(subset=["value"])


@query(
    "f7_drop_all_zero_years",
    f"""WITH u AS (SELECT c_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice FROM customer
          LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
        SELECT c_custkey, {', '.join(f'round(coalesce(sum(CASE WHEN year = {y} THEN o_totalprice END), 0), 2) AS y{y}' for y in YEARS)}
        FROM u GROUP BY 1 HAVING coalesce(sum(o_totalprice), 0) <> 0""",
)
def _f7(t):
    urgent = t.orders.where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    sums = urgent.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("value")
    )
    wide = spread(sums, ["o_custkey"], "year", "value", YEARS)
    rows = attach(t.customer.select(F.col("c_custkey")), wide.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])
    filled = rows.fillna(0.0)
    return filled.where(sum([F.col(f"`{y}`") for y in YEARS], F.lit(0.0)) != 0).toDF(
        "c_custkey", *[f"y{y}" for y in YEARS]
    )


@query(
    "f8_exclude_composite_keys",
    """SELECT o_orderkey, o_custkey, o_orderpriority FROM orders o WHERE o_orderstatus = 'O' AND NOT EXISTS
       (SELECT 1 FROM orders f WHERE f.o_orderstatus = 'F' AND f.o_custkey = o.o_custkey
        AND f.o_orderpriority = o.o_orderpriority)""",
)
def _f8(t):
    status = lambda s: t.orders.where(F.col("o_orderstatus") == s)
    kept = drop_matching(status("O"), status("F"), ["o_custkey", "o_orderpriority"])
    return kept.select("o_orderkey", "o_custkey", "o_orderpriority")


@query(
    "f9_years_window",
    f"WITH {CY} SELECT o_custkey, CAST(year AS DOUBLE) AS year, value FROM cy WHERE year BETWEEN 1996 AND 1999",
)
def _f9(t):
    cast = t.cy.select("o_custkey", F.col("year").cast("double"), F.col("value").cast("double"))
    return cast.where(F.col("year").between(1996, 1999))


@query(
    "f10_rule_or_no_rule",
    """WITH rules AS (SELECT c_nationkey, avg(c_acctbal) AS least FROM customer GROUP BY 1 HAVING count(*) >= 60)
       SELECT c_custkey, c_nationkey FROM customer LEFT JOIN rules USING (c_nationkey)
       WHERE least IS NULL OR c_acctbal >= least""",
)
def _f10(t):
    rules = (
        t.customer.groupBy("c_nationkey")
        .agg(F.avg("c_acctbal").alias("least"), F.count(F.lit(1)).alias("n"))
        .where("n >= 60")
        .drop("n")
    )
    rows = attach(t.customer, rules, ["c_nationkey"])
    kept = rows.where(F.col("least").isNull() | (F.col("c_acctbal") >= F.col("least")))
    return kept.select("c_custkey", "c_nationkey")


@query(
    "f11_compare_anchor_rows",
    f"""WITH {CY}, a AS (SELECT o_custkey, max(CASE WHEN year = 1996 THEN value END) AS v0,
          max(CASE WHEN year = 2000 THEN value END) AS v1 FROM cy GROUP BY 1)
        SELECT cy.o_custkey, year, value FROM cy JOIN a ON a.o_custkey = cy.o_custkey AND v0 < v1""",
)
def _f11(t):
    at = lambda y: F.max(F.when(F.col("year") == y, F.col("value")))
    rows = with_panel(t.cy, ["o_custkey"], {"v0": at(1996), "v1": at(2000)})
    return rows.where(F.col("v0") < F.col("v1")).select("o_custkey", "year", "value")
