"""Queries for region and scenario write-out, naming, overrides, hierarchies and lineage."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from panelweave.functions.semantics import paste
from panelweave.operators import regions as R
from panelweave.operators.groups import attach
from panelweave.operators.joins import checked_join, drop_matching, keep_matching
from panelweave.operators.reshape import stack_tables
from panelweave.plans.registry import query
from panelweave.plans.views import CY, TS
from panelweave.plans.windows import urgent
from panelweave.sources.tables import Annotations


def regions(t):
    return t.region.select(F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region"))


SECTORS = """sec AS (SELECT c_mktsegment AS subsector, o_orderpriority AS technology, count(*) AS n,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'start-year' WHEN 'MACHINERY' THEN 'end-year' ELSE '2020' END AS from_year
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def sectors(t):
    start = F.when(F.col("c_mktsegment") == "BUILDING", "start-year").when(F.col("c_mktsegment") == "MACHINERY", "end-year")
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_customer.join(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey")
        .groupBy("c_mktsegment", "o_orderpriority")
        .agg(F.sum("n").alias("n"))
        .select(
            F.col("c_mktsegment").alias("subsector"),
            F.col("o_orderpriority").alias("technology"),
            "n",
            start.otherwise("2020").alias("from_year"),
        )
    )


@query(
    "n1_write_to_all_regions",
    f"""WITH {SECTORS} SELECT CASE WHEN subsector = 'BUILDING' THEN 'EUROPE' ELSE r_name END AS region, r_name AS market,
        CASE WHEN subsector = 'BUILDING' THEN r_name || ' ' || subsector ELSE subsector END AS subsector,
        CASE WHEN subsector = 'BUILDING' THEN r_name || ' ' || technology ELSE technology END AS technology,
        CASE from_year WHEN 'start-year' THEN 1975 WHEN 'end-year' THEN 2100 ELSE CAST(from_year AS INTEGER) END AS from_year, n
        FROM sec CROSS JOIN region""",
)
def _n1(t):
    return R.write_to_regions(
        sectors(t).withColumn("traded", F.col("subsector") == "BUILDING"),
        regions(t),
        ["region", "market", "subsector", "technology", "from_year", "n"],
        year_columns=["from_year"],
        market="market",
        traded=F.col("traded"),
        home="EUROPE",
        traded_columns=["subsector", "technology"],
    )


@query(
    "n2_write_to_sub_regions",
    f"""WITH {SECTORS}, gone AS (SELECT DISTINCT n_name, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey
          GROUP BY 1, 2 HAVING count(*) < 10)
        SELECT n_name AS region, subsector, technology, CASE WHEN technology = '2-HIGH' THEN r_name ELSE 'national' END AS market, n
        FROM sec CROSS JOIN nation JOIN region ON n_regionkey = r_regionkey
        WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.n_name = nation.n_name AND gone.c_mktsegment = subsector)""",
)
def _n2(t):
    members = t.nation.select(F.col("n_name").alias("region"))
    national = sectors(t).withColumn("region", F.lit("national"))
    rows = R.write_to_members(national, members, ["region", "subsector", "technology", "n"])
    counts = t.customer.groupBy("c_nationkey", F.col("c_mktsegment").alias("subsector")).agg(F.count(F.lit(1)).alias("k"))
    lacking = checked_join(counts.where("k < 10"), t.nation.select("n_nationkey", "n_name"), {"c_nationkey": "n_nationkey"})
    kept = drop_matching(rows, lacking, {"region": "n_name", "subsector": "subsector"})
    grid = checked_join(t.nation.select("n_name", "n_regionkey"), t.region, {"n_regionkey": "r_regionkey"})
    placed = checked_join(kept, grid.select("n_name", F.col("r_name").alias("grid")), {"region": "n_name"})
    market = F.when(F.col("technology") == "2-HIGH", F.col("grid")).otherwise("national")
    return placed.select("region", "subsector", "technology", market.alias("market"), "n")


@query(
    "n3_traded_names",
    """SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'HOME' ELSE n_name END AS region, c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN n_name || ' ' || c_mktsegment ELSE c_mktsegment END AS subsector
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def _n3(t):
    rows = checked_join(
        t.customer.select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("subsector")),
        t.nation.select("n_nationkey", F.col("n_name").alias("region")),
        {"c_nationkey": "n_nationkey"},
    ).withColumn("traded", F.when(F.col("subsector") == "BUILDING", True))
    return R.set_traded_names(rows, F.col("traded"), "HOME", ["subsector"]).select("region", "c_custkey", "subsector")


@query(
    "n4_share_weight_flag",
    """WITH u AS (SELECT c_custkey, c_nationkey, c_mktsegment, coalesce(sum(o_totalprice), 0) AS v FROM customer
         LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1998 GROUP BY 1, 2, 3)
       SELECT c_custkey, CAST(sum(v) OVER (PARTITION BY c_nationkey, c_mktsegment) > 0 AS INTEGER) AS share_weight FROM u""",
)
def _n4(t):
    return R.share_weight(urgent(t), ["c_nationkey", "c_mktsegment"], "value").select("c_custkey", "share_weight")


@query(
    "n5_node_and_leaf_names",
    """SELECT p_partkey, 'root' AS root, substr(p_type, 1, 1) || '_' || p_brand AS node1, p_type || '_' || p_brand AS node2,
       lower(p_type) || '_' || p_brand || '_' || CASE WHEN p_size > 25 THEN 'hi' ELSE 'lo' END AS leaf FROM part""",
)
def _n5(t):
    nesting = t.part.select(
        F.lower("p_type").alias("leaf"), F.substring("p_type", 1, 1).alias("node1"), F.col("p_type").alias("node2")
    ).distinct()
    rows = t.part.select(
        "p_partkey", F.lower("p_type").alias("kind"), "p_brand", F.when(F.col("p_size") > 25, "hi").otherwise("lo").alias("level")
    )
    out = R.node_names(rows, nesting, "leaf", ["node1", "node2"], "kind", zone="p_brand", suffix="level")
    return out.select("p_partkey", "root", "node1", "node2", "leaf")


@query(
    "n6_attach_and_scale_densities",
    """WITH d AS (SELECT p_brand, CASE p_type WHEN 'ECONOMY' THEN 'OTHER' ELSE p_type END AS p_type, avg(p_size) AS density FROM part GROUP BY 1, 2)
       SELECT p_partkey, round(round_even(density, 1) * CASE p_type WHEN 'PROMO' THEN 0.8 WHEN 'SMALL' THEN 0.5 ELSE 1 END, 4) AS density, 1975 AS fillout
       FROM part LEFT JOIN d USING (p_brand, p_type)""",
)
def _n6(t):
    # one type is renamed in the rules, so that its parts have no density
    kind = F.when(F.col("p_type") == "ECONOMY", "OTHER").otherwise(F.col("p_type")).alias("p_type")
    densities = t.part.groupBy("p_brand", kind).agg(F.avg("p_size").alias("density"))
    rows = attach(t.part.select("p_partkey", "p_brand", "p_type"), densities, ["p_brand", "p_type"])
    factor = F.when(F.col("p_type") == "PROMO", 0.8).when(F.col("p_type") == "SMALL", 0.5).otherwise(1.0)
    return rows.select(
        "p_partkey", F.round(F.bround("density", 1) * factor, 4).alias("density"), F.lit(1975).alias("fillout")
    )


@query(
    "n7_income_group_membership",
    f"""WITH {TS}, g AS (SELECT n_nationkey, CASE WHEN value < 23e6 THEN 'low' WHEN value > 23e6 AND value < 25e6 THEN 'medium' WHEN value > 25e6 THEN 'high' END AS grp
          FROM ts WHERE year = 2000)
        SELECT c_custkey, grp FROM customer JOIN g ON c_nationkey = n_nationkey WHERE grp IN ('low', 'high')""",
)
def _n7(t):
    groups = t.ts.where("year = 2000").select("n_nationkey", R.income_group(F.col("value"), 23e6, 25e6).alias("grp"))
    chosen = groups.where(F.col("grp").isin("low", "high"))
    return t.customer.join(chosen, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "grp")


@query(
    "n8_scenario_variants",
    f"""WITH {TS} SELECT scenario, n_nationkey, year, round(value * CASE WHEN scenario = 'mixed' THEN CASE n_regionkey WHEN 0 THEN 0.5 WHEN 1 THEN 2.0 ELSE 1.0 END ELSE m END, 4) AS value
        FROM ts CROSS JOIN (VALUES ('low', 0.5), ('ref', 1.0), ('high', 2.0), ('mixed', 1.0)) s(scenario, m)""",
)
def _n8(t):
    variants = R.scenario_variants(t.ts, {"low": 0.5, "ref": 1.0, "high": 2.0, "mixed": 1.0}, "value")
    tier = F.when(F.col("n_regionkey") == 0, 0.5).when(F.col("n_regionkey") == 1, 2.0).otherwise(1.0)
    value = F.when(F.col("scenario") == "mixed", F.col("value") * tier).otherwise(F.col("value"))
    return variants.select("scenario", "n_nationkey", "year", F.round(value, 4).alias("value"))


@query(
    "n9_user_override",
    f"""WITH {CY}, o AS (SELECT o_custkey, year, round(value * 2, 2) AS value FROM cy WHERE n_orders >= 4 UNION ALL SELECT -1, 2001, 5.0)
        SELECT o_custkey, year, coalesce(o.value, cy.value) AS value, n_orders FROM cy FULL JOIN o USING (o_custkey, year)""",
)
def _n9(t):
    revised = t.cy.where("n_orders >= 4").select("o_custkey", "year", F.round(F.col("value") * 2, 2).alias("value"))
    extra = t.spark.createDataFrame([(-1, 2001, 5.0)], "o_custkey long, year int, value double")
    return R.overlay(t.cy, revised.unionByName(extra), ["o_custkey", "year"])


@query(
    "n10_lineage_closure",
    """WITH RECURSIVE e AS (SELECT 'C' || c_custkey AS a, 'N' || c_nationkey AS b FROM customer UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation
         UNION ALL SELECT 'R' || r_regionkey, 'WORLD' FROM region),
       c AS (SELECT a AS source, b AS target, 1 AS depth FROM e UNION ALL SELECT c.source, e.b, c.depth + 1 FROM c JOIN e ON c.target = e.a)
       SELECT source, target, CAST(min(depth) AS INTEGER) AS depth FROM c GROUP BY 1, 2""",
)
def _n10(t):
    node = lambda prefix, key: F.concat(F.lit(prefix), F.col(key).cast("string"))
    edges = (
        t.customer.select(node("C", "c_custkey").alias("a"), node("N", "c_nationkey").alias("b"))
        .unionByName(t.nation.select(node("N", "n_nationkey").alias("a"), node("R", "n_regionkey").alias("b")))
        .unionByName(t.region.select(node("R", "r_regionkey").alias("a"), F.lit("WORLD").alias("b")))
    )
    return R.lineage_closure(edges, "a", "b")


MADE = {"yearly": ("Orders by customer and year", ["orders"]), "series": ("Order value by nation", ["orders", "customer", "nation"])}


@query(
    "n11_data_map",
    f"""WITH {CY}, ts AS (SELECT DISTINCT c_nationkey, year FROM cy JOIN customer ON o_custkey = c_custkey)
        SELECT 'yearly' AS name, 'Orders by customer and year' AS title, 'currency' AS units, 'orders' AS precursors, count(*) AS rows FROM cy
        UNION ALL SELECT 'series', 'Order value by nation', 'currency', 'orders; customer; nation', count(*) FROM ts""",
)
def _n11(t):
    notes = Annotations()
    for name, (title, inputs) in MADE.items():
        notes.add(name, "title", title).add(name, "units", "currency").add(name, "precursors", *inputs)
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows")
        for n, df in (("yearly", t.cy), ("series", t.ts))
    ]
    table = notes.data_map(t.spark).select(F.col("table").alias("name"), "title", "units", "precursors")
    return table.join(reduce(DataFrame.unionByName, parts), "name")


@query(
    "n12_prune_empty_branches",
    """WITH v AS (SELECT p_partkey, p_brand, p_type, p_name, CASE WHEN p_retailprice > 975 AND p_size > 25 THEN p_size ELSE 0 END AS v FROM part),
       s AS (SELECT *, sum(v) OVER (PARTITION BY p_brand) AS a, sum(v) OVER (PARTITION BY p_brand, p_type) AS b,
               sum(v) OVER (PARTITION BY p_brand, p_type, p_name) AS c FROM v),
       kept AS (SELECT * FROM s WHERE a <> 0 AND b <> 0 AND c <> 0),
       market AS (SELECT DISTINCT p_brand, p_type FROM part),
       gone AS (SELECT p_brand, p_type FROM market EXCEPT SELECT p_brand, p_type FROM kept)
       SELECT 'branch' AS kind, p_partkey, p_brand, p_type, p_name FROM kept UNION ALL
       SELECT 'market', NULL, p_brand, p_type, NULL FROM market m
       WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.p_brand = m.p_brand AND g.p_type = m.p_type)""",
)
def _n12(t):
    amount = F.when((F.col("p_retailprice") > 975) & (F.col("p_size") > 25), F.col("p_size")).otherwise(0)
    tree = t.part.select("p_partkey", "p_brand", "p_type", "p_name", amount.alias("v"))
    kept = R.prune_empty(tree, ["p_brand", "p_type", "p_name"], "v")
    markets = R.prune_references(t.part.select("p_brand", "p_type").distinct(), tree, kept, ["p_brand", "p_type"])
    kept = kept.drop("v").withColumn("kind", F.lit("branch"))
    return kept.unionByName(markets.withColumn("kind", F.lit("market")), allowMissingColumns=True)


@query(
    "n13_expand_technologies",
    """WITH d AS (SELECT s_nationkey, l_returnflag AS tech, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
       m AS (SELECT DISTINCT l_returnflag AS tech, l_linestatus AS cooling FROM lineitem)
       SELECT s_nationkey, tech AS subsector, cooling AS technology, n FROM d JOIN m USING (tech) JOIN nation ON s_nationkey = n_nationkey
       WHERE cooling <> 'F' OR n_regionkey IN (0, 1)""",
)
def _n13(t):
    nations = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    data = (
        t.lineitem.groupBy("l_suppkey", F.col("l_returnflag").alias("tech"))
        .agg(F.count(F.lit(1)).alias("n"))
        .join(nations, "l_suppkey")
        .groupBy("s_nationkey", "tech")
        .agg(F.sum("n").alias("n"))
    )
    mapping = t.lineitem.select(F.col("l_returnflag").alias("tech"), F.col("l_linestatus").alias("technology")).distinct()
    coast = t.nation.where("n_regionkey IN (0, 1)").select(F.col("n_nationkey").alias("s_nationkey"), F.lit(True).alias("coastal"))
    rows = attach(data, coast, ["s_nationkey"])
    allowed = (F.col("technology") != "F") | F.coalesce("coastal", F.lit(False))
    out = R.expand_technologies(rows, mapping, ["tech"], {"tech": "subsector"}, allowed)
    return out.select("s_nationkey", "subsector", "technology", "n")


@query(
    "n14_sector_relabelling",
    f"""WITH {SECTORS} SELECT n_name AS region, CASE subsector WHEN 'BUILDING' THEN 'national construction' ELSE 'national ' || lower(subsector) END AS sector, technology, n
        FROM sec CROSS JOIN nation WHERE subsector IN ('BUILDING', 'MACHINERY') AND n_regionkey = 2""",
)
def _n14(t):
    chosen = sectors(t).where(F.col("subsector").isin("BUILDING", "MACHINERY"))
    label = F.when(F.col("subsector") == "BUILDING", "national construction").otherwise(
        F.concat(F.lit("national "), F.lower("subsector"))
    )
    members = t.nation.where("n_regionkey = 2").select(F.col("n_name").alias("region"))
    return R.write_to_members(chosen.withColumn("sector", label), members, ["region", "sector", "technology", "n"])


@query(
    "n15_market_token",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN n_name ELSE 'global' END AS market FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def _n15(t):
    rows = checked_join(
        t.customer.select("c_custkey", "c_nationkey", F.when(F.col("c_mktsegment") == "HOUSEHOLD", "regional").otherwise("global").alias("market")),
        t.nation.select("n_nationkey", "n_name"),
        {"c_nationkey": "n_nationkey"},
    )
    return rows.select("c_custkey", F.when(F.col("market") == "regional", F.col("n_name")).otherwise(F.col("market")).alias("market"))


CHAIN = [("1-URGENT", "2-HIGH", 1), ("2-HIGH", "3-MEDIUM", 2), ("3-MEDIUM", "5-LOW", 3)]


@query(
    "n16_pass_through_outputs",
    f"""WITH c AS (SELECT * FROM (VALUES {', '.join(map(str, CHAIN))}) v(sector, fuel, position)),
        s AS (SELECT c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS fuel, sum(o_totalprice) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
        r AS (SELECT c_nationkey, year, sector, fuel, v, sum(v) OVER (PARTITION BY c_nationkey, year ORDER BY position DESC) AS cum FROM s JOIN c USING (fuel))
        SELECT c_nationkey, year, sector, fuel, round(CASE WHEN fuel IN (SELECT sector FROM c) THEN cum ELSE v END, 2) AS calibrated FROM r""",
)
def _n16(t):
    yearly = t.orders.groupBy(
        F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("sector")
    ).agg(F.sum("o_totalprice").alias("v"))
    rows = yearly.join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")
    chain = t.spark.createDataFrame(CHAIN, "sector string, fuel string, position int")
    out = R.pass_through(rows, chain, ["c_nationkey", "year"], "sector", "fuel", "v")
    return out.withColumn("calibrated", F.round("calibrated", 2))


@query(
    "n17_drop_leaves_without_production",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) > 0)""",
)
def _n17(t):
    active = t.lineitem.where("l_returnflag = 'R' AND l_quantity > 0")
    return keep_matching(t.orders.select("o_orderkey", "o_custkey"), active, {"o_orderkey": "l_orderkey"})


@query(
    "n18_split_leaf_into_levels",
    "SELECT p_partkey, p_type || '_' || p_brand AS node5, p_type || '_' || p_brand || '_' || lvl AS leaf FROM part CROSS JOIN (VALUES ('lo'), ('hi')) v(lvl)",
)
def _n18(t):
    rows = t.part.select("p_partkey", paste("p_type", "p_brand", sep="_").alias("leaf"))
    return R.split_levels(rows, "leaf", "node5", ["lo", "hi"]).select("p_partkey", "node5", "leaf")


@query(
    "n19_harmonise_sibling_tables",
    """SELECT DISTINCT 'customer' AS origin, c_nationkey AS nation, c_mktsegment AS sector, NULL AS technology FROM customer
       UNION ALL SELECT DISTINCT 'supplier', s_nationkey, NULL, NULL FROM supplier UNION ALL SELECT DISTINCT 'part', NULL, p_brand, p_type FROM part""",
)
def _n19(t):
    tables = [
        t.customer.select(F.lit("customer").alias("origin"), "c_nationkey", "c_mktsegment").distinct(),
        t.supplier.select(F.lit("supplier").alias("origin"), "s_nationkey").distinct(),
        t.part.select(F.lit("part").alias("origin"), "p_brand", "p_type").distinct(),
    ]
    renames = [
        {"c_nationkey": "nation", "c_mktsegment": "sector"},
        {"s_nationkey": "nation"},
        {"p_brand": "sector", "p_type": "technology"},
    ]
    return stack_tables(tables, renames).select("origin", "nation", "sector", "technology")


@query(
    "n20_rekey_table_family",
    """WITH f AS (SELECT p_brand, p_type, p_retailprice AS cost FROM part QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_retailprice, p_partkey) = 1),
       k AS (SELECT DISTINCT p_brand, p_type, upper(p_type) || '/' || substr(p_brand, 7) AS sector, 'dry ' || lower(p_type) AS tech FROM part)
       SELECT DISTINCT sector, tech, CASE WHEN tech LIKE '%promo%' THEN round(cost * 0.95, 4) ELSE cost END AS cost FROM k JOIN f USING (p_brand, p_type)""",
)
def _n20(t):
    table = t.part.select("p_brand", "p_type", F.col("p_retailprice").alias("cost"), "p_partkey")
    key_map = t.part.select(
        F.col("p_brand").alias("from_brand"),
        F.col("p_type").alias("from_type"),
        F.concat(F.upper("p_type"), F.lit("/"), F.substring("p_brand", 7, 10)).alias("to_sector"),
        F.concat(F.lit("dry "), F.lower("p_type")).alias("to_tech"),
    ).distinct()
    out = R.rekey(
        table,
        key_map,
        {"from_brand": "p_brand", "from_type": "p_type"},
        {"to_sector": "sector", "to_tech": "tech"},
        ["sector", "tech", "cost"],
        ["cost", "p_partkey"],
    )
    cost = F.when(F.col("tech").contains("promo"), F.round(F.col("cost") * 0.95, 4)).otherwise(F.col("cost"))
    return out.withColumn("cost", cost)
