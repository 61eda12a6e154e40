"""Queries for joins."""

from pyspark.sql import functions as F

from panelweave.functions.semantics import year_between
from panelweave.operators import joins as J
from panelweave.operators.balances import reconcile_bilateral
from panelweave.operators.groups import attach, first_rows
from panelweave.plans.registry import query
from panelweave.plans.views import BILAT, CY, GAPS, TS
from panelweave.session import cut_lineage


@query(
    "j1_left_join",
    f"""WITH {CY} SELECT c_custkey, c_mktsegment, year, value FROM customer
        LEFT JOIN cy ON o_custkey + 7 = c_custkey""",
)
def _j1(t):
    right = t.cy.select((F.col("o_custkey") + 7).alias("c_custkey"), "year", "value")
    return t.customer.select("c_custkey", "c_mktsegment").join(right, "c_custkey", "left")


@query(
    "j2_inner_join",
    "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey",
)
def _j2(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "c_mktsegment"
    )


@query(
    "j3_full_join",
    """WITH a AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS spent, count(*) AS orders FROM orders GROUP BY 1),
        b AS (SELECT c_custkey + 7 AS o_custkey, c_acctbal FROM customer)
        SELECT o_custkey, spent, orders, c_acctbal FROM a FULL JOIN b USING (o_custkey)""",
)
def _j3(t):
    orders = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spent"), F.count(F.lit(1)).alias("orders"))
    customers = t.customer.select((F.col("c_custkey") + 7).alias("o_custkey"), "c_acctbal")
    return J.full_join(orders, customers, ["o_custkey"])


@query(
    "j4_right_join",
    f"""WITH {CY} SELECT c_custkey, year, value FROM cy RIGHT JOIN customer ON o_custkey + 7 = c_custkey""",
)
def _j4(t):
    left = t.cy.select((F.col("o_custkey") + 7).alias("c_custkey"), "year", "value")
    return left.join(t.customer.select("c_custkey"), "c_custkey", "right")


@query(
    "j5_checked_left_join",
    f"""WITH {CY} SELECT c_mktsegment, year, round(sum(value), 2) AS value
        FROM cy JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def _j5(t):
    rows = J.checked_join(t.cy, t.customer.select("c_custkey", "c_mktsegment"), {"o_custkey": "c_custkey"})
    return rows.groupBy("c_mktsegment", "year").agg(F.round(F.sum("value"), 2).alias("value"))


@query(
    "j6_keep_first_join",
    """WITH f AS (SELECT p_brand, p_partkey, p_retailprice FROM part
         QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) = 1)
       SELECT part.p_partkey, part.p_brand, f.p_partkey AS cheapest, f.p_retailprice AS least
       FROM part JOIN f USING (p_brand)""",
)
def _j6(t):
    right = t.part.select("p_brand", F.col("p_retailprice").alias("least"), F.col("p_partkey").alias("cheapest"))
    return J.keep_first_join(t.part.select("p_partkey", "p_brand"), right, ["p_brand"], ["least", "cheapest"])


@query(
    "j7_large_left_join",
    """SELECT o_orderstatus, l_returnflag, count(*) AS n, sum(l_quantity) AS qty
       FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
)
def _j7(t):
    per_order = t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty")
    )
    status = t.orders.select("o_orderkey", "o_orderstatus")
    return (
        per_order.join(status, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .groupBy("o_orderstatus", "l_returnflag")
        .agg(F.sum("n").alias("n"), F.sum("qty").alias("qty"))
    )


@query("j8_repeat_for_each_row", "SELECT c_custkey, r_name FROM customer CROSS JOIN region")
def _j8(t):
    return J.replicate(t.customer.select("c_custkey"), t.region.select("r_name"))


@query(
    "j9_all_combinations",
    """SELECT c_mktsegment, o_orderpriority, o_orderstatus FROM (SELECT DISTINCT c_mktsegment FROM customer)
       CROSS JOIN (SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders)""",
)
def _j9(t):
    return J.replicate(
        t.customer.select("c_mktsegment").distinct(), t.orders.select("o_orderpriority", "o_orderstatus").distinct()
    )


@query(
    "j10_complete",
    f"""WITH {CY}, grid AS (SELECT o_custkey, y AS year FROM (SELECT DISTINCT o_custkey FROM cy)
          CROSS JOIN (SELECT CAST(unnest(range(1996, 2006)) AS INTEGER) AS y))
        SELECT o_custkey, year, coalesce(value, 0) AS value FROM grid FULL JOIN cy USING (o_custkey, year)""",
)
def _j10(t):
    series = t.cy.select("o_custkey", "year", "value")
    return J.complete(series, ["o_custkey"], "year", range(1996, 2006), fill={"value": 0.0})


@query(
    "j11_semi_join",
    """SELECT o_orderkey, o_orderstatus FROM orders
       WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def _j11(t):
    lines = t.lineitem.where("l_returnflag = 'R'")
    return J.keep_matching(t.orders.select("o_orderkey", "o_orderstatus"), lines, {"o_orderkey": "l_orderkey"})


@query(
    "j12_anti_join",
    """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS
       (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = 2000)""",
)
def _j12(t):
    active = t.orders.where(year_between("o_orderdate", 2000))
    return J.drop_matching(t.customer.select("c_custkey", "c_name"), active, {"c_custkey": "o_custkey"})


@query(
    "j13_named_keys_and_suffixes",
    f"""WITH {BILAT} SELECT a.n_name AS name_1, b.n_name AS name_2, year, value FROM bilat
        JOIN nation a ON s_nation = a.n_nationkey JOIN nation b ON c_nation = b.n_nationkey""",
)
def _j13(t):
    names = t.nation.select("n_nationkey", "n_name")
    one = J.checked_join(t.bilat, names.withColumnRenamed("n_name", "name_1"), {"s_nation": "n_nationkey"})
    two = J.checked_join(one, names.withColumnRenamed("n_name", "name_2"), {"c_nation": "n_nationkey"})
    return two.select("name_1", "name_2", "year", "value")


@query(
    "j14_vector_lookup",
    """WITH m AS (SELECT p_brand, p_type FROM part
         QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) = 1)
       SELECT l_returnflag, m.p_type AS looked_up, count(*) AS n FROM lineitem
       JOIN part ON l_partkey = p_partkey JOIN m USING (p_brand) GROUP BY 1, 2""",
)
def _j14(t):
    first = first_rows(t.part.select("p_brand", "p_partkey", F.col("p_type").alias("looked_up")), ["p_brand"], ["p_partkey"])
    counts = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_returnflag", "p_brand")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return attach(counts, first.drop("p_partkey"), ["p_brand"]).groupBy("l_returnflag", "looked_up").agg(
        F.sum("n").alias("n")
    )


@query(
    "j15_bidirectional_code_swap",
    """SELECT c_custkey, n_name AS zone, 'ZN' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS back
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def _j15(t):
    zone = lambda c: F.concat(F.lit("ZN"), F.lpad(F.col(c).cast("string"), 3, "0"))
    codes = t.nation.select(zone("n_nationkey").alias("code"), "n_name")
    coded = t.customer.select("c_custkey", zone("c_nationkey").alias("zone"))
    named = J.swap_codes(coded, "zone", codes, "code", "n_name", "^ZN[0-9]{3}$")
    again = J.swap_codes(named, "zone", codes, "code", "n_name", "^ZN[0-9]{3}$")
    return named.join(again.withColumnRenamed("zone", "back"), "c_custkey")


@query(
    "j16_hierarchical_fallback_join",
    """WITH rules AS (SELECT CASE WHEN p_size > 30 THEN p_brand || '*' ELSE p_brand END AS p_brand, p_type,
           CASE WHEN p_size > 10 THEN p_size + 100 ELSE p_size END AS p_size, p_retailprice AS rate FROM part),
       l0 AS (SELECT p_brand, p_type, p_size, min(rate) AS rate, min(rate) <> max(rate) AS several FROM rules GROUP BY 1, 2, 3),
       l1 AS (SELECT p_brand, p_type, min(rate) AS rate, min(rate) <> max(rate) AS several FROM rules GROUP BY 1, 2),
       l2 AS (SELECT p_type, min(rate) AS rate, min(rate) <> max(rate) AS several FROM rules GROUP BY 1)
       SELECT p.p_partkey, coalesce(l0.rate, l1.rate, l2.rate) AS rate, coalesce(l0.several, l1.several, l2.several) AS several FROM part p
       LEFT JOIN l0 USING (p_brand, p_type, p_size) LEFT JOIN l1 USING (p_brand, p_type) LEFT JOIN l2 USING (p_type)""",
)
def _j16(t):
    # other brands and sizes in some of the rules leave parts to the wider levels
    brand = F.when(F.col("p_size") > 30, F.concat("p_brand", F.lit("*"))).otherwise(F.col("p_brand"))
    size = F.when(F.col("p_size") > 10, F.col("p_size") + 100).otherwise(F.col("p_size"))
    rules = t.part.select(brand.alias("p_brand"), "p_type", size.alias("p_size"), F.col("p_retailprice").alias("rate"))
    parts = t.part.select("p_partkey", "p_brand", "p_type", "p_size")
    levels = [["p_brand", "p_type", "p_size"], ["p_brand", "p_type"], ["p_type"]]
    return J.fallback_join(parts, rules, levels, "rate", ["rate"], "several").select("p_partkey", "rate", "several")


@query(
    "j16_derived_rows_by_fallback",
    """WITH rules AS (SELECT CASE p_type WHEN 'ECONOMY' THEN p_brand || '*' ELSE p_brand END AS p_brand, p_type, min(p_retailprice) / 1000 AS f FROM part GROUP BY 1, 2),
       byt AS (SELECT p_type, min(f) AS f FROM rules GROUP BY 1),
       d AS (SELECT p_brand, p_type, CASE WHEN p_size > 25 THEN 'coarse' ELSE 'fine' END AS gas, CAST(sum(p_size) AS DOUBLE) AS v FROM part GROUP BY 1, 2, 3)
       SELECT p_brand, p_type, gas, v FROM d
       UNION ALL SELECT p_brand, p_type, 'soot', round(v * coalesce(rules.f, byt.f), 6) FROM d LEFT JOIN rules USING (p_brand, p_type) LEFT JOIN byt USING (p_type) WHERE gas = 'fine'""",
)
def _j16_derived(t):
    gas = F.when(F.col("p_size") > 25, "coarse").otherwise("fine")
    rows = t.part.groupBy("p_brand", "p_type", gas.alias("gas")).agg(F.sum("p_size").cast("double").alias("v"))
    # other brands in the rules of one type leave its rows to the wider level
    brand = F.when(F.col("p_type") == "ECONOMY", F.concat("p_brand", F.lit("*"))).otherwise(F.col("p_brand"))
    rules = t.part.select(brand.alias("p_brand"), "p_type", (F.col("p_retailprice") / 1000).alias("soot"))
    levels = [["p_brand", "p_type"], ["p_type"]]
    out = J.derived_rows(rows, F.col("gas") == "fine", rules, levels, {"soot": "soot"}, "gas", "v")
    return out.withColumn("v", F.round("v", 6))


@query(
    "j17_self_join_shifted_year",
    f"""WITH {GAPS} SELECT a.o_custkey, a.year, a.value, b.value AS earlier FROM gaps a
        LEFT JOIN gaps b ON a.o_custkey = b.o_custkey AND a.year = b.year + 2""",
)
def _j17(t):
    return J.shifted(t.gaps.select("o_custkey", "year", "value"), ["o_custkey"], "year", "value", 2, "earlier")


@query(
    "j18_self_join_swapped_partners",
    f"""WITH {BILAT}, e AS (SELECT s_nation AS reporter, CASE WHEN year = 1997 THEN c_nation + 100 ELSE c_nation END AS partner, year, value FROM bilat),
        i AS (SELECT c_nation AS partner, s_nation AS reporter, year, round(value * 0.98, 6) AS value FROM bilat)
        SELECT reporter, partner, year, least(e.value, i.value) AS value FROM e FULL JOIN i USING (reporter, partner, year)""",
)
def _j18(t):
    # the exports of one year name partners that report no imports, and the other way round
    partner = F.when(F.col("year") == 1997, F.col("c_nation") + 100).otherwise(F.col("c_nation"))
    bilat = cut_lineage(t.bilat)
    exports = bilat.select(F.col("s_nation").alias("reporter"), partner.alias("partner"), "year", "value")
    imports = bilat.select(
        F.col("c_nation").alias("reporter"),
        F.col("s_nation").alias("partner"),
        "year",
        F.round(F.col("value") * 0.98, 6).alias("value"),
    )
    return reconcile_bilateral(exports, imports, "reporter", "partner", ["year"])


@query(
    "j19_threshold_entry_year",
    f"""WITH {TS}, rules AS (SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN 1999 END AS start_year,
          (SELECT avg(value) FROM ts) * (1 + n_nationkey / 100.0) AS least FROM nation)
        SELECT r.n_nationkey, CAST(coalesce(start_year, min(CASE WHEN value >= least THEN year END)) AS INTEGER) AS start_year
        FROM rules r LEFT JOIN ts USING (n_nationkey) GROUP BY r.n_nationkey, start_year, least
        HAVING coalesce(start_year, min(CASE WHEN value >= least THEN year END)) IS NOT NULL""",
)
def _j19(t):
    mean = t.ts.agg(F.avg("value")).scalar()
    rules = t.nation.select(
        "n_nationkey",
        F.when(F.col("n_regionkey") == 0, F.lit(1999)).alias("start_year"),
        (mean * (1 + F.col("n_nationkey") / 100.0)).alias("least"),
    )
    out = J.first_year_reaching(rules, t.ts, ["n_nationkey"], F.col("least"), "start_year")
    return out.select("n_nationkey", "start_year")


@query(
    "j20_override_rows",
    """WITH g AS (SELECT p_brand, p_type, round(avg(p_retailprice), 6) AS rate, count(*) AS n FROM part GROUP BY 1, 2),
       s AS (SELECT p_brand, p_type, max(p_retailprice) AS rate FROM part GROUP BY 1, 2 HAVING count(*) > 15)
       SELECT p_brand, p_type, coalesce(s.rate, g.rate) AS rate FROM g LEFT JOIN s USING (p_brand, p_type)""",
)
def _j20(t):
    by = t.part.groupBy("p_brand", "p_type")
    generic = by.agg(F.round(F.avg("p_retailprice"), 6).alias("rate"))
    specific = by.agg(F.max("p_retailprice").alias("rate"), F.count(F.lit(1)).alias("n")).where("n > 15").drop("n")
    return J.override_rows(generic, specific, ["p_brand", "p_type"])


@query(
    "j21_revised_values",
    f"""WITH {CY}, r AS (SELECT o_custkey + 7 AS c_custkey, max(value) AS value FROM cy GROUP BY 1)
        SELECT c_custkey, coalesce(value, c_acctbal) AS c_acctbal FROM customer LEFT JOIN r USING (c_custkey)""",
)
def _j21(t):
    revised = t.cy.groupBy((F.col("o_custkey") + 7).alias("c_custkey")).agg(F.max("value").alias("c_acctbal"))
    return J.revise(t.customer.select("c_custkey", "c_acctbal"), revised, ["c_custkey"], "c_acctbal")
