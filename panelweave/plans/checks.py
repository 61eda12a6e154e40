"""Queries for data-quality operators and user functions."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from panelweave.functions.units import ModelTime
from panelweave.operators import quality as Q
from panelweave.operators.groups import share
from panelweave.operators.balances import final_balance
from panelweave.operators.steps import Step, rows_per_group, run_steps
from panelweave.plans.registry import query
from panelweave.plans.views import BILAT, CY, LINES, SUA, TS, YEARS
from panelweave.session import cut_lineage


@query(
    "q1_rule_report",
    """SELECT 'price positive' AS rule, count(*) FILTER (WHERE NOT l_extendedprice > 0) AS violations FROM lineitem
       UNION ALL SELECT 'discount at most 9 percent', count(*) FILTER (WHERE NOT l_discount <= 0.09) FROM lineitem
       UNION ALL SELECT 'known flag', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem""",
)
def _q1(t):
    return Q.expect(
        t.lineitem,
        {
            "price positive": F.col("l_extendedprice") > 0,
            "discount at most 9 percent": F.col("l_discount") <= 0.09,
            "known flag": F.col("l_returnflag").isin("A", "N"),
        },
    )


@query(
    "q2_table_contract",
    f"""WITH {CY} SELECT f.name, f.finding, n.rows FROM (VALUES ('value', 'is double, not bigint'), ('unit', 'missing'), ('n_orders', 'unexpected')) f(name, finding)
        CROSS JOIN (SELECT count(*) AS rows FROM cy) n""",
)
def _q2(t):
    required = {"o_custkey": T.LongType(), "year": T.IntegerType(), "value": T.LongType(), "unit": T.StringType()}
    findings = Q.contract_report(t.cy, required)
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(f).alias("finding")) for n, f in findings])
    return t.cy.agg(F.count(F.lit(1)).alias("rows")).select(F.inline(pairs), "rows")


@query(
    "q3_balance_and_cube_completeness",
    f"""WITH {SUA}, b AS (SELECT area, item, year, sum(CASE WHEN element IN ('Production', 'Import', 'Opening stocks') THEN value ELSE 0 END)
          - sum(CASE WHEN element IN ('Export', 'Feed', 'Food', 'Processed', 'Closing stocks') THEN value ELSE 0 END) AS d FROM sua GROUP BY 1, 2, 3)
        SELECT (SELECT count(*) FROM sua) AS rows, (SELECT count(DISTINCT area) * count(DISTINCT item) * count(DISTINCT year) * count(DISTINCT element) FROM sua) AS cells,
          (SELECT count(DISTINCT area) * count(DISTINCT item) * count(DISTINCT year) * count(DISTINCT element) - count(*) FROM sua) AS gap,
          (SELECT count(*) FROM b WHERE abs(d) > 0.0001) AS unbalanced""",
)
def _q3(t):
    sua = cut_lineage(t.sua)
    gaps = Q.cube_gaps(sua, ["area", "item", "year", "element"])
    residual = final_balance(sua, ["area", "item", "year"]).where("element = 'Residuals'")
    broken = residual.where(F.abs("value") > 0.0001).agg(F.count(F.lit(1)).alias("unbalanced"))
    return gaps.withColumn("unbalanced", broken.scalar())


@query(
    "q3_supply_use_report",
    f"""WITH {SUA}, c AS (SELECT area, item, year, coalesce(sum(CASE WHEN element IN ('Production', 'Import') THEN value END), 0)
          - coalesce(sum(CASE WHEN element IN ('Export', 'Feed', 'Food', 'Processed') THEN value END), 0) AS d FROM sua GROUP BY 1, 2, 3),
        w AS (SELECT item, year, coalesce(sum(CASE WHEN element = 'Import' THEN value END), 0)
          - coalesce(sum(CASE WHEN element = 'Export' THEN value END), 0) AS d FROM sua GROUP BY 1, 2)
        SELECT 'null value' AS rule, count(*) FILTER (WHERE value IS NULL) AS violations FROM sua
        UNION ALL SELECT 'negative value', count(*) FILTER (WHERE value < -0.001) FROM sua
        UNION ALL SELECT 'trade imbalance', count(*) FILTER (WHERE abs(d) > 0.0001) FROM w
        UNION ALL SELECT 'supply differs from demand', count(*) FILTER (WHERE abs(d) > 0.0001) FROM c
        UNION ALL SELECT 'missing cell', count(DISTINCT area) * count(DISTINCT item) * count(DISTINCT year) * count(DISTINCT element) - count(*) FROM sua""",
)
def _q3_report(t):
    supply, demand = ["Production", "Import"], ["Export", "Feed", "Food", "Processed"]
    return Q.supply_use_report(cut_lineage(t.sua), "area", "item", ["Stock Variation", "Other uses"], supply, demand)


@query(
    "q4_two_table_consistency",
    f"""WITH {LINES} SELECT coalesce(l_orderkey, o_orderkey) AS orderkey, o_totalprice, amount FROM orders FULL JOIN lines ON l_orderkey = o_orderkey
        WHERE (coalesce(o_totalprice, 0) <= 0 AND coalesce(amount, 0) > 0) OR (coalesce(amount, 0) <= 0 AND coalesce(o_totalprice, 0) > 0)""",
)
def _q4(t):
    zero = F.lit(0.0)
    price, amount = F.coalesce("o_totalprice", zero), F.coalesce("amount", zero)
    bad = ((price <= 0) & (amount > 0)) | ((amount <= 0) & (price > 0))
    left = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_totalprice")
    right = t.lines.select(F.col("l_orderkey").alias("orderkey"), "amount")
    return Q.mismatches(left, right, ["orderkey"], bad).select("orderkey", "o_totalprice", "amount")


@query(
    "q5_negative_value_guard",
    "SELECT c_nationkey, count(*) AS rows, min(c_acctbal) AS lowest FROM customer WHERE c_acctbal < 0 GROUP BY 1",
)
def _q5(t):
    return Q.negative_rows(t.customer, ["c_nationkey"], "c_acctbal")


@query(
    "q6_table_diff_with_tolerance",
    """WITH r AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_totalprice * 1.01 WHEN 'O' THEN o_totalprice * 1.001 ELSE o_totalprice END AS v
         FROM orders WHERE o_orderpriority <> '5-LOW'),
       j AS (SELECT o.o_orderkey, o_totalprice AS l, v AS r FROM orders o LEFT JOIN r USING (o_orderkey) WHERE o_orderpriority <> '4-NOT SPECIFIED'
         UNION ALL SELECT r.o_orderkey, NULL, v FROM r JOIN orders o USING (o_orderkey) WHERE o_orderpriority = '4-NOT SPECIFIED')
       SELECT status, count(*) AS n FROM (SELECT CASE WHEN l IS NULL THEN 'only right' WHEN r IS NULL THEN 'only left'
         WHEN abs(l - r) <= CASE WHEN l = floor(l) AND r = floor(r) THEN 0 ELSE 3e-3 * (1e-4 + abs(l)) END THEN 'same' ELSE 'differs' END AS status FROM j)
       WHERE status <> 'same' GROUP BY 1""",
)
def _q6(t):
    drift = (
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") * 1.01)
        .when(F.col("o_orderstatus") == "O", F.col("o_totalprice") * 1.001)
        .otherwise(F.col("o_totalprice"))
    )
    left = t.orders.where("o_orderpriority <> '4-NOT SPECIFIED'").select("o_orderkey", "o_totalprice")
    right = t.orders.where("o_orderpriority <> '5-LOW'").select("o_orderkey", drift.alias("o_totalprice"))
    diff = Q.table_diff(left, right, ["o_orderkey"], "o_totalprice")
    return diff.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q7_orphans_and_duplicates",
    """SELECT 'orphan' AS kind, l_orderkey AS key, count(*) AS rows FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') GROUP BY 2
       UNION ALL SELECT 'duplicate', l_orderkey, count(*) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def _q7(t):
    lost = Q.orphans(t.lineitem, t.orders.where("o_orderstatus <> 'F'"), "l_orderkey", "o_orderkey")
    twice = Q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])
    tag = lambda df, kind: df.select(F.lit(kind).alias("kind"), F.col("l_orderkey").alias("key"), "rows")
    return tag(lost, "orphan").unionByName(tag(twice, "duplicate"))


def yearly_change(inputs):
    """A user's step: named tables in, named tables out."""
    wide = inputs["yearly"].groupBy("o_custkey").agg(
        *[F.max(F.when(F.col("year") == y, F.col("value"))).alias(f"v{y}") for y in (1995, 2001)]
    )
    return {"change": wide.select("o_custkey", F.round(F.col("v2001") - F.col("v1995"), 2).alias("change"))}


@query(
    "ud1_user_step_over_named_tables",
    f"""WITH {CY} SELECT o_custkey, round(max(CASE WHEN year = 2001 THEN value END) - max(CASE WHEN year = 1995 THEN value END), 2) AS change FROM cy GROUP BY 1""",
)
def _ud1(t):
    step = Step("yearly_change", {"yearly": ["o_custkey", "year", "value"]}, {"change": ["o_custkey", "change"]}, yearly_change)
    return run_steps([step], {"yearly": t.cy, "unused": t.nation})["change"]


@query(
    "ud2_group_function_returning_rows",
    """WITH b AS (SELECT p_brand, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part GROUP BY 1),
       g AS (SELECT p_brand, lo, unnest(range(0, CAST(floor((hi - lo) / 10 + 1e-9) AS INTEGER) + 1)) AS i FROM b)
       SELECT p_brand, CAST(i AS INTEGER) AS step, round(lo + i * 10, 6) AS price FROM g""",
)
def _ud2(t):
    ends = t.part.groupBy("p_brand").agg(F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi"))
    steps = F.sequence(F.lit(0), F.floor((F.col("hi") - F.col("lo")) / 10 + F.lit(1e-9)).cast("int"))
    return ends.withColumn("step", F.explode(steps)).select(
        "p_brand", "step", F.round(F.col("lo") + F.col("step") * 10, 6).alias("price")
    )


# Orders of a customer at least 90 days after the last one taken, from the first on.
@query(
    "ud2_caller_function_per_group",
    """WITH RECURSIVE o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS day FROM orders WHERE o_orderdate IS NOT NULL),
       k AS (SELECT o_custkey, min(day) AS day, 1 AS place FROM o GROUP BY 1
         UNION ALL SELECT k.o_custkey, min(o.day), k.place + 1 FROM k JOIN o ON o.o_custkey = k.o_custkey
         AND o.day >= k.day + 90 GROUP BY k.o_custkey, k.place)
       SELECT o_custkey, place, day FROM k""",
)
def _ud2_caller(t):
    def spaced(group: pa.Table) -> pa.Table:
        days, taken = group.column("day").to_numpy(), [0]
        while (at := int(np.searchsorted(days, days[taken[-1]] + 90))) < len(days):
            taken.append(at)
        out = group.take(taken)
        return out.append_column("place", pa.array(np.arange(1, len(taken) + 1)))

    day = F.unix_date(F.to_date("o_orderdate")).alias("day")
    dated = t.orders.where("o_orderdate is not null").select("o_custkey", day)
    return rows_per_group(dated, ["o_custkey"], spaced, "o_custkey long, place int, day long", ["day"])


@query(
    "ud3_vectorised_scalar",
    f"WITH {CY} SELECT o_custkey, year, least(year + 1, 2001) AS next_year FROM cy",
)
def _ud3(t):
    clock = ModelTime(base_years=tuple(YEARS[:4]), future_years=tuple(YEARS[4:]))
    return t.cy.select("o_custkey", "year", clock.next_year(F.col("year")).alias("next_year"))


@query(
    "ud4_parameterised_columns",
    f"""WITH {TS}, {BILAT} SELECT 'ts' AS source, CAST(n_regionkey AS INTEGER) AS grp, year, round(value / sum(value) OVER (PARTITION BY n_regionkey, year), 9) AS share FROM ts
        UNION ALL SELECT 'bilat', s_nation, year, round(value / sum(value) OVER (PARTITION BY s_nation, year), 9) FROM bilat""",
)
def _ud4(t):
    def shares(df, source, group, value):
        out = share(df, value, [group, "year"])
        return out.select(F.lit(source).alias("source"), F.col(group).alias("grp"), "year", F.round("share", 9).alias("share"))

    return shares(t.ts, "ts", "n_regionkey", "value").unionByName(shares(t.bilat, "bilat", "s_nation", "value"))
