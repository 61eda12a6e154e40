"""Stand-in tables derived from the driver tables, each with its SQL text.

Sums are rounded to the exact decimals of their inputs, so that both engines
give the same number whatever order they add in.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelweave.operators.joins import complete_panel
from panelweave.operators.reshape import spread
from panelweave.session import cut_lineage, use_settings

YEARS = list(range(1995, 2002))

YEAR_LIST = ", ".join(str(y) for y in YEARS)

# Orders per customer and year.
CY = """cy AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
         round(sum(o_totalprice), 2) AS value, count(*) AS n_orders
  FROM orders GROUP BY 1, 2)"""

# The same, completed over the years, with gaps.
GAPS = f"""{CY},
gaps AS (
  SELECT k.o_custkey, y.year, cy.value, cy.n_orders
  FROM (SELECT DISTINCT o_custkey FROM cy) k
  CROSS JOIN (SELECT CAST(unnest(range(1995, 2002)) AS INTEGER) AS year) y
  LEFT JOIN cy ON cy.o_custkey = k.o_custkey AND cy.year = y.year)"""

# Order value per nation and year.
TS = """ts AS (
  SELECT n_regionkey, n_nationkey, CAST(year(o_orderdate) AS INTEGER) AS year,
         round(sum(o_totalprice), 2) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3)"""

WIDE = f"""{TS},
wide AS (
  SELECT n_nationkey, {', '.join(f'max(CASE WHEN year = {y} THEN value END) AS "{y}"' for y in YEARS)}
  FROM ts GROUP BY 1)"""

# Revenue per supplier nation, customer nation and year.
BILAT = """bilat AS (
  SELECT s_nationkey AS s_nation, c_nationkey AS c_nation,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         round(sum(l_extendedprice * (1 - l_discount)), 4) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY 1, 2, 3)"""

# Supply points: quantity per brand and price.
CURVE = """curve AS (
  SELECT p_brand, p_retailprice AS price, CAST(sum(p_size) AS BIGINT) AS quantity
  FROM part GROUP BY 1, 2)"""

# Quantities by both nations, part type, year and return flag.
FLOWS = """flows AS MATERIALIZED (
  SELECT s_nationkey AS s_nation, c_nationkey AS c_nation, p_type AS item,
         CAST(year(o_orderdate) AS INTEGER) AS year, l_returnflag AS flag,
         sum(l_quantity) AS qty, round(sum(l_quantity * l_discount), 2) AS opened,
         round(sum(l_quantity * l_tax), 2) AS closed
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3, 4, 5)"""

# A long element table built from the flows.
SUA = f"""{FLOWS},
sua AS MATERIALIZED (
  SELECT area, item, year, element, round(sum(value), 2) AS value FROM (
    SELECT s_nation AS area, item, year, 'Production' AS element, qty AS value FROM flows
    UNION ALL SELECT s_nation, item, year, 'Export', qty FROM flows WHERE s_nation <> c_nation
    UNION ALL SELECT c_nation, item, year, 'Import', qty FROM flows WHERE s_nation <> c_nation
    UNION ALL SELECT c_nation, item, year,
      CASE flag WHEN 'A' THEN 'Food' WHEN 'N' THEN 'Feed' ELSE 'Processed' END, qty FROM flows
    UNION ALL SELECT s_nation, item, year, 'Opening stocks', opened FROM flows
    UNION ALL SELECT s_nation, item, year, 'Closing stocks', closed FROM flows)
  GROUP BY 1, 2, 3, 4)"""

# Order totals and the sum of their lines.
LINES = """lines AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty,
         round(sum(l_extendedprice), 2) AS amount
  FROM lineitem GROUP BY 1)"""


class Tables:
    """Driver tables as lazy readers, and the views above as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = use_settings(spark)
        self._dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self._dir}/{name}.parquet")
        self.__dict__[name] = df
        return df

    @cached_property
    def cy(self) -> DataFrame:
        return self.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
            F.round(F.sum("o_totalprice"), 2).alias("value"), F.count(F.lit(1)).alias("n_orders")
        )

    @cached_property
    def gaps(self) -> DataFrame:
        return complete_panel(self.cy, ["o_custkey"], "year", YEARS)

    @cached_property
    def ts(self) -> DataFrame:
        # Orders shrink to one row per customer and year before the join, so a
        # customer with a large part of all orders does not skew it.
        yearly = self.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
            F.sum("o_totalprice").alias("value")
        )
        return (
            yearly.join(self.customer, yearly.o_custkey == self.customer.c_custkey)
            .join(self.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("n_regionkey", "n_nationkey", "year")
            .agg(F.round(F.sum("value"), 2).alias("value"))
        )

    @cached_property
    def wide(self) -> DataFrame:
        return spread(self.ts, ["n_nationkey"], "year", "value", YEARS)

    @cached_property
    def buyers(self) -> DataFrame:
        """Orders with the customer's nation."""
        o, c = self.orders, self.customer
        return o.join(c, o.o_custkey == c.c_custkey).select(
            "o_orderkey", F.col("c_nationkey").alias("c_nation"), F.year("o_orderdate").alias("year")
        )

    @cached_property
    def bilat(self) -> DataFrame:
        li, s = self.lineitem, self.supplier
        sold = li.join(s, li.l_suppkey == s.s_suppkey).select(
            "l_orderkey",
            F.col("s_nationkey").alias("s_nation"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("value"),
        )
        return (
            sold.join(self.buyers, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("s_nation", "c_nation", "year")
            .agg(F.round(F.sum("value"), 4).alias("value"))
        )

    @cached_property
    def curve(self) -> DataFrame:
        return self.part.groupBy("p_brand", F.col("p_retailprice").alias("price")).agg(
            F.sum("p_size").alias("quantity")
        )

    @cached_property
    def flows(self) -> DataFrame:
        li, s, p = self.lineitem, self.supplier, self.part
        sold = (
            li.join(s, li.l_suppkey == s.s_suppkey)
            .join(p, li.l_partkey == p.p_partkey)
            .select(
                "l_orderkey",
                F.col("s_nationkey").alias("s_nation"),
                F.col("p_type").alias("item"),
                F.col("l_returnflag").alias("flag"),
                F.col("l_quantity").alias("qty"),
                (F.col("l_quantity") * F.col("l_discount")).alias("opened"),
                (F.col("l_quantity") * F.col("l_tax")).alias("closed"),
            )
        )
        return (
            sold.join(self.buyers, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("s_nation", "c_nation", "item", "year", "flag")
            .agg(
                F.sum("qty").alias("qty"),
                F.round(F.sum("opened"), 2).alias("opened"),
                F.round(F.sum("closed"), 2).alias("closed"),
            )
        )

    def keep_flows(self) -> Tables:
        """Write the flows once, for queries that read them several times."""
        self.__dict__["flows"] = cut_lineage(self.flows)
        return self

    @cached_property
    def sua(self) -> DataFrame:
        f = self.flows
        seller, buyer, abroad = F.col("s_nation"), F.col("c_nation"), F.col("s_nation") != F.col("c_nation")
        use = F.when(f.flag == "A", "Food").when(f.flag == "N", "Feed").otherwise("Processed")
        cell = lambda area, element, value: F.struct(
            area.alias("area"), element.alias("element"), value.alias("value")
        )
        cells = F.array(
            cell(seller, F.lit("Production"), f.qty),
            cell(F.when(abroad, seller), F.lit("Export"), f.qty),
            cell(F.when(abroad, buyer), F.lit("Import"), f.qty),
            cell(buyer, use, f.qty),
            cell(seller, F.lit("Opening stocks"), f.opened),
            cell(seller, F.lit("Closing stocks"), f.closed),
        )
        return (
            f.select("item", "year", F.inline(cells))
            .where(F.col("area").isNotNull())
            .groupBy("area", "item", "year", "element")
            .agg(F.round(F.sum("value"), 2).alias("value"))
        )

    @cached_property
    def lines(self) -> DataFrame:
        return self.lineitem.groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum("l_quantity").alias("qty"),
            F.round(F.sum("l_extendedprice"), 2).alias("amount"),
        )
