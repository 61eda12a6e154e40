"""Queries for table sources and sinks, written to the shared folder and read back."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from panelweave.functions.semantics import strict_sum
from panelweave.operators.groups import share
from panelweave.operators.joins import checked_join, complete_panel
from panelweave.operators.quality import contract_select
from panelweave.operators.regions import scenario_variants
from panelweave.operators.reshape import gather_years, spread
from panelweave.operators.timeseries import interpolate
from panelweave.plans.registry import query
from panelweave.plans.views import CY, TS, YEARS
from panelweave.session import scratch_dir
from panelweave.sources import annotated_csv, sinks, tables


def row_counts(spark, named: dict[str, DataFrame], label: str) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias(label), "rows") for n, df in named.items()]
    return reduce(DataFrame.unionByName, parts)


@query(
    "entry_regional_panel",
    f"""WITH {TS},
    sums AS (SELECT r_name, year, round(sum(value), 2) AS value
             FROM ts JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2),
    grid AS (SELECT k.r_name, y.year, s.value
             FROM (SELECT DISTINCT r_name FROM sums) k
             CROSS JOIN (SELECT CAST(unnest(range(1994, 2003)) AS INTEGER) AS year) y
             LEFT JOIN sums s ON s.r_name = k.r_name AND s.year = y.year),
    filled AS (SELECT r_name, year,
        coalesce(value, CASE WHEN year < 1995 THEN first_value(value IGNORE NULLS) OVER w
                             ELSE last_value(value IGNORE NULLS) OVER w END) AS value
        FROM grid WINDOW w AS (PARTITION BY r_name ORDER BY year
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
    SELECT r_name, year, value, round(value / sum(value) OVER (PARTITION BY year), 9) AS share
    FROM filled""",
)
def _entry(t):
    yearly = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.sum("o_totalprice").alias("value")
    )
    mapped = checked_join(
        yearly, t.customer.select("c_custkey", "c_nationkey"), {"o_custkey": "c_custkey"}
    )
    nations = mapped.groupBy("c_nationkey", "year").agg(strict_sum("value").alias("value"))
    regions = checked_join(
        checked_join(nations, t.nation.select("n_nationkey", "n_regionkey"), {"c_nationkey": "n_nationkey"}),
        t.region,
        {"n_regionkey": "r_regionkey"},
    )
    sums = regions.groupBy("r_name", "year").agg(F.round(strict_sum("value"), 2).alias("value"))
    filled = interpolate(complete_panel(sums, ["r_name"], "year", range(1994, 2003)), ["r_name"], rule=2)
    return share(filled, "value", ["year"]).withColumn("share", F.round("share", 9))


@query("s1_annotated_csv_scan", "SELECT * FROM customer")
def _s1(t):
    path = annotated_csv.write_annotated(
        t.customer, scratch_dir(t.spark, "customer"), "Customers", "currency", ["One row per customer"]
    )
    df = annotated_csv.read_annotated(t.spark, path).df
    return df.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query(
    "s2_type_code_schema",
    """SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total,
       'string,string,string,double,string' AS types FROM orders GROUP BY 1""",
)
def _s2(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    path = annotated_csv.write_annotated(orders, scratch_dir(t.spark, "orders"), "Orders", "currency")
    df = annotated_csv.read_annotated(t.spark, path).df
    types = ",".join(f.dataType.simpleString() for f in df.schema.fields)
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.lit(types).alias("types")
    )


@query(
    "s3_header_metadata",
    """SELECT k.key, k.value, n.rows FROM (VALUES ('title', 'Suppliers'), ('units', 'currency'),
       ('comments', 'One row per supplier' || chr(10) || 'Balance may be negative')) k(key, value)
       CROSS JOIN (SELECT count(*) AS rows FROM supplier) n""",
)
def _s3(t):
    path = annotated_csv.write_annotated(
        t.supplier, scratch_dir(t.spark, "supplier"), "Suppliers", "currency",
        ["One row per supplier", "Balance may be negative"],
    )
    table = annotated_csv.read_annotated(t.spark, path)
    pairs = [F.struct(F.lit(k).alias("key"), F.lit(table.metadata[k]).alias("value")) for k in ("title", "units", "comments")]
    return table.df.agg(F.count(F.lit(1)).alias("rows")).select(F.inline(F.array(*pairs)), "rows")


@query(
    "s4_extension_probe_gzip",
    "SELECT p_type, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS size FROM part GROUP BY 1",
)
def _s4(t):
    base = scratch_dir(t.spark, "part")
    annotated_csv.write_annotated(t.part, base + ".csv.gz", "Parts", "mixed", compression="gzip")
    df = annotated_csv.read_annotated(t.spark, annotated_csv.find_table(t.spark, base)).df
    return df.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size"))


@query("s5_optional_source", "SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1")
def _s5(t):
    schema = t.supplier.schema
    here = tables.optional_table(t.spark, f"{t._dir}/supplier.parquet", schema)
    absent = tables.optional_table(t.spark, f"{t._dir}/absent.parquet", schema)
    return here.unionByName(absent).groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s6_fallback_table",
    """SELECT 'withheld' AS kind, o_orderstatus, count(*) AS n FROM orders GROUP BY 2
       UNION ALL SELECT 'present', o_orderstatus, count(*) FROM orders WHERE o_orderstatus = 'F' GROUP BY 2""",
)
def _s6(t):
    withheld = tables.with_fallback(t.orders.where("o_orderstatus = 'X'"), t.orders)
    present = tables.with_fallback(t.orders.where("o_orderstatus = 'F'"), t.orders)
    count = lambda df, kind: df.groupBy(F.lit(kind).alias("kind"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return count(withheld, "withheld").unionByName(count(present, "present"))


@query("s7_quirky_csv", f"WITH {CY} SELECT CAST(o_custkey AS INTEGER) AS o_custkey, year, value FROM cy")
def _s7(t):
    wide = spread(t.cy, ["o_custkey"], "year", "value", YEARS)
    years = [F.coalesce(F.col(f"`{y}`").cast("string"), F.lit("")) for y in YEARS]
    body = wide.select(F.concat_ws(",", F.col("o_custkey").cast("string"), F.lit(""), *years).alias("value"))
    total = wide.agg(*[F.round(F.sum(F.col(f"`{y}`")), 2).alias(str(y)) for y in YEARS])
    total = total.select(F.concat_ws(",", F.lit("Total"), F.lit(""), *[F.col(f"`{y}`").cast("string") for y in YEARS]).alias("value"))
    titles = total.select(F.explode(F.array(F.lit("Order value by customer"), F.lit("currency,,"))).alias("value"))
    path = scratch_dir(t.spark, "quirky")
    body.unionByName(total).unionByName(titles).write.text(path)
    schema = T.StructType(
        [T.StructField("o_custkey", T.IntegerType()), T.StructField("blank", T.StringType())]
        + [T.StructField(f"y{y}", T.DoubleType()) for y in YEARS]
    )
    df = annotated_csv.read_quirky(t.spark, path, schema, skip=r"^(Total|Order value|currency)").drop("blank")
    long = gather_years(df.toDF("o_custkey", *[str(y) for y in YEARS]), drop_null=True)
    return long


@query(
    "s8_table_sink",
    f"""WITH {TS} SELECT 'series' AS name, count(*) AS rows FROM ts
        UNION ALL SELECT 'orders_by_priority', count(DISTINCT o_orderpriority) FROM orders""",
)
def _s8(t):
    made = {
        "series": t.ts,
        "orders_by_priority": t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")),
        "nation": t.nation,
    }
    paths = sinks.write_tables(made, {"nation": ["input"]}, scratch_dir(t.spark, "tables"))
    return row_counts(t.spark, {n: t.spark.read.parquet(p) for n, p in paths.items()}, "name")


@query(
    "s9_document_sink",
    f"""WITH {TS} SELECT 'series' AS tag, count(*) AS rows, round(sum(n), 0) AS items FROM
          (SELECT n_nationkey, count(*) AS n FROM ts GROUP BY 1)
        UNION ALL SELECT 'customer', count(*), CAST(count(*) AS DOUBLE) FROM customer""",
)
def _s9(t):
    series = sinks.nest(t.ts, ["n_regionkey", "n_nationkey"], "point", ["year"])
    path = sinks.write_one_document(
        {"series": series, "customer": t.customer.select("c_custkey", "c_name", "c_mktsegment")},
        scratch_dir(t.spark, "document"),
        {"customer": ["c_name", "c_custkey", "c_mktsegment"]},
    )
    read = lambda tag, schema: sinks.read_from_document(t.spark, path, tag, schema)
    back = read("series", "n_nationkey int, point array<struct<year: int, value: double>>")
    flat = read("customer", "c_name string, c_custkey long, c_mktsegment string")
    count = lambda df, tag, items: df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(items).cast("double").alias("items")
    ).select(F.lit(tag).alias("tag"), "rows", "items")
    return count(back, "series", F.size("point")).unionByName(count(flat, "customer", F.lit(1)))


@query(
    "s10_contract_column_order",
    f"WITH {TS} SELECT n_regionkey, n_nationkey, year, value FROM ts",
)
def _s10(t):
    shuffled = t.ts.select("value", "year", "n_nationkey", "n_regionkey")
    return contract_select(shuffled, ["n_regionkey", "n_nationkey", "year", "value"])


@query(
    "s11_type_split_tables",
    """WITH typed AS (SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN 'absolute-cost-logit'
                                WHEN 'MACHINERY' THEN 'relative-cost-logit' END AS logit_type FROM customer)
       SELECT coalesce(logit_type, 'relative-cost-logit') AS logit_table, count(*) AS rows FROM typed GROUP BY 1
       UNION ALL SELECT 'all', count(*) FROM typed""",
)
def _s11(t):
    typed = t.customer.withColumn(
        "logit_type",
        F.when(F.col("c_mktsegment") == "BUILDING", "absolute-cost-logit").when(
            F.col("c_mktsegment") == "MACHINERY", "relative-cost-logit"
        ),
    )
    return row_counts(t.spark, sinks.split_by_type(typed), "logit_table")


@query(
    "s12_generated_nesting_levels",
    f"""WITH {TS} SELECT n_regionkey, count(DISTINCT n_nationkey) AS nations, count(*) AS points,
        round(sum(value), 2) AS value FROM ts GROUP BY 1""",
)
def _s12(t):
    nested = sinks.nest_levels(t.ts, [["n_regionkey"], ["n_nationkey"], ["year"]], ["subsector0", "subsector1"])
    inner = F.flatten(F.transform("subsector0", lambda s: s["subsector1"]))
    return nested.select(
        "n_regionkey",
        F.size("subsector0").cast("long").alias("nations"),
        F.size(inner).cast("long").alias("points"),
        F.round(F.aggregate(inner, F.lit(0.0), lambda acc, p: acc + p["value"]), 2).alias("value"),
    )


@query(
    "s12_nested_document",
    """WITH located AS (SELECT n_regionkey, c_nationkey, c_custkey, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey),
         marks AS (SELECT DISTINCT 'region' AS tag, n_regionkey AS name FROM located UNION ALL SELECT DISTINCT 'nation', c_nationkey FROM located),
         lines AS (SELECT '<' || tag || ' name="' || name || '">' AS line FROM marks UNION ALL SELECT '</' || tag || '>' FROM marks
           UNION ALL SELECT '<customer><c_custkey>' || c_custkey || '</c_custkey><c_name>' || c_name || '</c_name></customer>' FROM located
           UNION ALL VALUES ('<scenario>'), ('</scenario>'))
       SELECT line, count(*) AS copies FROM lines GROUP BY 1""",
)
def _s12_document(t):
    located = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    path = sinks.write_nested_document(
        located.select("n_regionkey", "c_nationkey", "c_custkey", "c_name"),
        {"region": "n_regionkey", "nation": "c_nationkey"},
        "customer",
        scratch_dir(t.spark, "nested"),
    )
    return t.spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("copies"))


@query(
    "s13_write_by_scenario",
    f"""WITH {TS} SELECT scenario, count(*) AS rows, round(sum(round(value * factor, 4)), 2) AS total
        FROM ts CROSS JOIN (VALUES ('low', 0.5), ('ref', 1.0), ('high', 2.0)) s(scenario, factor) GROUP BY 1""",
)
def _s13(t):
    variants = scenario_variants(t.ts, {"low": 0.5, "ref": 1.0, "high": 2.0}, "value")
    path = sinks.write_by_scenario(
        variants.withColumn("value", F.round("value", 4)), scratch_dir(t.spark, "scenarios")
    )
    return t.spark.read.parquet(path).groupBy("scenario").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("value"), 2).alias("total")
    )


@query("s14_output_suffix", "SELECT '_high' AS suffix, count(*) AS rows FROM supplier")
def _s14(t):
    paths = sinks.write_document({"supplier": t.supplier}, scratch_dir(t.spark, "suffix"), suffix="_high")
    back = t.spark.read.format("xml").option("rowTag", "supplier").schema("s_suppkey long").load(paths["supplier"])
    suffix = paths["supplier"][len(paths["supplier"].removesuffix("_high")):]
    return back.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(suffix).alias("suffix"), "rows")


NOTED = {"orders": ("Orders", "currency"), "lineitem": ("Order lines", "pieces"), "part": ("Parts", "currency")}


@query(
    "s15_table_annotations",
    """SELECT 'orders' AS "table", 'Orders' AS title, 'currency' AS units, 'whole table; one row per order' AS comments,
              count(*) AS rows FROM orders
       UNION ALL SELECT 'lineitem', 'Order lines', 'pieces', 'whole table', count(*) FROM lineitem
       UNION ALL SELECT 'part', 'Parts', 'currency', 'whole table', count(*) FROM part""",
)
def _s15(t):
    notes = tables.Annotations()
    for name, (title, units) in NOTED.items():
        notes.add(name, "title", title).add(name, "units", units).add(name, "comments", "whole table")
    notes.add("orders", "comments", "one row per order")
    counts = row_counts(t.spark, {n: getattr(t, n) for n in NOTED}, "table")
    return notes.data_map(t.spark).select("table", "title", "units", "comments").join(counts, "table")
