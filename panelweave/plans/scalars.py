"""Queries for scalar expressions."""

from pyspark.sql import functions as F

from panelweave.functions.semantics import (
    align_up,
    bin_label,
    clamp,
    extract,
    if_else,
    is_finite,
    paste,
    ratio,
    recode,
    replace_first,
    signif,
)
from panelweave.functions.units import UNIT_FACTORS, deflator, deflator_from
from panelweave.operators.joins import checked_join
from panelweave.plans.registry import query
from panelweave.plans.views import CY, GAPS, YEARS

TO_2020 = " ".join(f"WHEN {y} THEN {deflator(2020, y)!r}" for y in YEARS)


@query(
    "x1_concatenate_with_missing",
    f"WITH {GAPS} SELECT o_custkey, year, o_custkey || '/' || coalesce(CAST(n_orders AS VARCHAR), 'NA') AS label FROM gaps",
)
def _x1(t):
    return t.gaps.select("o_custkey", "year", paste("o_custkey", "n_orders", sep="/").alias("label"))


@query(
    "x2_regex_replace_first_and_all",
    """SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '_') AS first_only, regexp_replace(p_name, '[aeiou]', '_', 'g') AS every
       FROM part""",
)
def _x2(t):
    return t.part.select(
        "p_partkey",
        replace_first("p_name", "[aeiou]", "_").alias("first_only"),
        F.regexp_replace("p_name", "[aeiou]", "_").alias("every"),
    )


@query(
    "x3_regex_extract_look_ahead",
    """SELECT p_partkey, regexp_extract(p_name, '^(.*) ', 1) AS head,
       CASE WHEN regexp_matches(p_name, 'b[a-z]+$') THEN regexp_extract(p_name, 'b[a-z]+$') END AS b_noun FROM part""",
)
def _x3(t):
    return t.part.select(
        "p_partkey", extract("p_name", "^.*(?= )").alias("head"), extract("p_name", "b[a-z]+$").alias("b_noun")
    )


@query("x4_case_change", "SELECT c_custkey, lower(c_mktsegment) AS low, upper(c_name) AS high FROM customer")
def _x4(t):
    return t.customer.select("c_custkey", F.lower("c_mktsegment").alias("low"), F.upper("c_name").alias("high"))


@query(
    "x5_substring_and_length",
    "SELECT c_custkey, substr(c_name, 1, 4) AS head, CAST(length(c_name) AS INTEGER) AS len FROM customer",
)
def _x5(t):
    return t.customer.select("c_custkey", F.substring("c_name", 1, 4).alias("head"), F.length("c_name").alias("len"))


@query("x6_split_last_token", "SELECT p_partkey, split_part(p_name, ' ', -1) AS noun FROM part")
def _x6(t):
    return t.part.select("p_partkey", F.element_at(F.split("p_name", " "), -1).alias("noun"))


@query(
    "x7_trim_and_pad",
    "SELECT s_suppkey, trim('  ' || s_name || ' ') AS name, lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS padded FROM supplier",
)
def _x7(t):
    return t.supplier.select(
        "s_suppkey",
        F.trim(F.concat(F.lit("  "), "s_name", F.lit(" "))).alias("name"),
        F.format_string("%03d", "s_nationkey").alias("padded"),
    )


@query(
    "x8_casts_bad_text_to_null",
    """SELECT c_custkey, try_cast(substr(c_name, 10) AS INTEGER) AS good, try_cast(c_name AS INTEGER) AS bad,
       CAST(c_custkey AS VARCHAR) AS text, CAST(c_nationkey AS DOUBLE) AS number FROM customer""",
)
def _x8(t):
    return t.customer.select(
        "c_custkey",
        F.substring("c_name", 10, 20).try_cast("int").alias("good"),
        F.col("c_name").try_cast("int").alias("bad"),
        F.col("c_custkey").cast("string").alias("text"),
        F.col("c_nationkey").cast("double").alias("number"),
    )


@query(
    "x9_conditional_null_rule",
    f"""WITH {GAPS} SELECT o_custkey, year, CASE WHEN value > 300000 THEN 'big' WHEN value <= 300000 THEN 'small' END AS size,
        CASE WHEN n_orders >= 3 THEN 3 WHEN n_orders = 2 THEN 2 ELSE 0 END AS bucket FROM gaps""",
)
def _x9(t):
    return t.gaps.select(
        "o_custkey",
        "year",
        if_else(F.col("value") > 300000, "big", "small").alias("size"),
        F.when(F.col("n_orders") >= 3, 3).when(F.col("n_orders") == 2, 2).otherwise(0).alias("bucket"),
    )


@query(
    "x10_recode_by_map",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status FROM orders""",
)
def _x10(t):
    return t.orders.select("o_orderkey", recode("o_orderstatus", {"F": "final", "O": "open"}).alias("status"))


@query(
    "x11_null_and_finite_tests",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_tax = 0 AS no_tax, l_tax <> 0 AS has_ratio,
       coalesce(round(l_discount / nullif(l_tax, 0), 9), 1) AS cleaned FROM lineitem""",
)
def _x11(t):
    raw = F.when(F.col("l_tax") == 0, F.lit(float("inf"))).otherwise(ratio("l_discount", "l_tax"))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        ratio("l_discount", "l_tax").isNull().alias("no_tax"),
        is_finite(raw).alias("has_ratio"),
        F.when(is_finite(raw), F.round(raw, 9) + 0.0).otherwise(1.0).alias("cleaned"),
    )


@query(
    "x12_rounding",
    """SELECT o_orderkey, round_even(o_totalprice, 0) AS whole, ceil(o_totalprice)::BIGINT AS up, floor(o_totalprice)::BIGINT AS down,
       round(round_even(o_totalprice * pow(10.0, 2 - floor(log10(o_totalprice))), 0) / pow(10.0, 2 - floor(log10(o_totalprice))), 6) AS three
       FROM orders""",
)
def _x12(t):
    return t.orders.select(
        "o_orderkey",
        F.bround("o_totalprice", 0).alias("whole"),
        F.ceil("o_totalprice").alias("up"),
        F.floor("o_totalprice").alias("down"),
        F.round(signif("o_totalprice", 3), 6).alias("three"),
    )


@query(
    "x13_power_exp_log_abs",
    """SELECT c_custkey, round(pow(abs(c_acctbal), 0.5), 8) AS root, round(exp(c_acctbal / 10000), 9) AS e,
       round(ln(abs(c_acctbal) + 1), 9) AS l FROM customer""",
)
def _x13(t):
    size = F.abs("c_acctbal")
    return t.customer.select(
        "c_custkey",
        F.round(F.pow(size, 0.5), 8).alias("root"),
        F.round(F.exp(F.col("c_acctbal") / 10000), 9).alias("e"),
        F.round(F.log(size + 1), 9).alias("l"),
    )


@query(
    "x14_bins_and_alignment",
    """SELECT p_partkey, CASE WHEN p_size > 0 AND p_size <= 10 THEN 'small' WHEN p_size > 10 AND p_size <= 30 THEN 'middle'
       WHEN p_size > 30 AND p_size <= 50 THEN 'large' END AS bin, CAST(ceil(p_size / 5.0) * 5 AS INTEGER) AS aligned FROM part""",
)
def _x14(t):
    return t.part.select(
        "p_partkey",
        bin_label("p_size", [0, 10, 30, 50], ["small", "middle", "large"]).alias("bin"),
        align_up("p_size", 5).alias("aligned"),
    )


@query(
    "x15_sequences_and_log_grid",
    """WITH b AS (SELECT p_brand, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part GROUP BY 1),
       i AS (SELECT unnest(range(0, 11)) AS i)
       SELECT p_brand, CAST(i AS INTEGER) AS step, round(lo + i * (hi - lo) / 10, 6) AS even,
         round(exp(ln(lo) + i * (ln(hi) - ln(lo)) / 10), 6) AS logged FROM b CROSS JOIN i""",
)
def _x15(t):
    ends = t.part.groupBy("p_brand").agg(F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi"))
    i = F.col("step")
    return ends.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(10)))).select(
        "p_brand",
        "step",
        F.round(F.col("lo") + i * (F.col("hi") - F.col("lo")) / 10, 6).alias("even"),
        F.round(F.exp(F.log("lo") + i * (F.log("hi") - F.log("lo")) / 10), 6).alias("logged"),
    )


@query(
    "x16_price_deflator",
    f"WITH {CY} SELECT o_custkey, year, round(value * CASE year {TO_2020} END, 6) AS value FROM cy",
)
def _x16(t):
    value = F.col("value") * deflator_from(F.col("year"), 2020)
    return t.cy.select("o_custkey", "year", F.round(value, 6).alias("value"))


@query(
    "x17_unit_conversion",
    "SELECT l_suppkey, round(sum(l_quantity) * 3.6e-3, 6) AS energy, round(sum(l_quantity) * (1000.0 / 908), 6) AS short FROM lineitem GROUP BY 1",
)
def _x17(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("qty")).select(
        "l_suppkey",
        F.round(F.col("qty") * UNIT_FACTORS["KWH_GJ"], 6).alias("energy"),
        F.round(F.col("qty") * UNIT_FACTORS["T_METRIC_SHORT"], 6).alias("short"),
    )


LEVELS = ["2-HIGH", "5-LOW", "1-URGENT", "3-MEDIUM", "4-NOT SPECIFIED"]


@query(
    "x18_ordered_categories",
    f"""SELECT o_custkey, arg_min(o_orderpriority, list_position({LEVELS!r}, o_orderpriority)) AS foremost,
        CAST(min(list_position({LEVELS!r}, o_orderpriority)) AS INTEGER) AS rank FROM orders GROUP BY 1""",
)
def _x18(t):
    rank = F.array_position(F.array(*[F.lit(v) for v in LEVELS]), F.col("o_orderpriority")).cast("int")
    return t.orders.groupBy("o_custkey").agg(
        F.min_by("o_orderpriority", rank).alias("foremost"), F.min(rank).alias("rank")
    )


@query(
    "x19_safe_ratio",
    "SELECT l_orderkey, l_linenumber, l_partkey, round(coalesce(l_discount / nullif(l_tax, 0), 0), 9) + 0 AS part FROM lineitem",
)
def _x19(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.round(ratio("l_discount", "l_tax", 0), 9) + 0).alias("part")
    )


@query(
    "x20_clamp_to_range",
    f"WITH {GAPS} SELECT o_custkey, year, CASE WHEN value IS NOT NULL THEN greatest(100000, least(400000, value)) END AS value FROM gaps",
)
def _x20(t):
    return t.gaps.select("o_custkey", "year", clamp("value", 100000.0, 400000.0).alias("value"))


@query(
    "x21_code_standard_and_merge",
    f"""WITH {CY} SELECT CASE lower(n_name) WHEN 'nation_24' THEN 'nation_4' ELSE lower(n_name) END AS code, year,
        round(sum(value), 2) AS value FROM cy JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY 1, 2""",
)
def _x21(t):
    who = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    code = recode(F.lower("n_name"), {"nation_24": "nation_4"})
    return (
        t.cy.join(who, "o_custkey")
        .groupBy("c_nationkey", "year")
        .agg(F.sum("value").alias("value"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(code.alias("code"), "year")
        .agg(F.round(F.sum("value"), 2).alias("value"))
    )


@query(
    "x22_suffix_by_lookup",
    """SELECT l_returnflag || CASE WHEN l_returnflag = 'R' THEN '_' || CAST(s_nationkey AS VARCHAR) ELSE '' END AS gas,
       count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""",
)
def _x22(t):
    counts = t.lineitem.groupBy("l_returnflag", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    named = checked_join(counts, t.supplier.select("s_suppkey", "s_nationkey"), {"l_suppkey": "s_suppkey"})
    gas = F.when(F.col("l_returnflag") == "R", F.concat_ws("_", "l_returnflag", "s_nationkey")).otherwise(
        F.col("l_returnflag")
    )
    return named.groupBy(gas.alias("gas")).agg(F.sum("n").alias("n"))


@query(
    "x23_composite_input_name",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name WHEN p_type = 'PROMO'
         THEN lower(p_type) || '_' || p_brand || '_' || substr(p_name, 1, 1)
         ELSE lower(p_type) || '_' || substr(p_name, 1, 1) END AS input_name FROM part""",
)
def _x23(t):
    sectors = t.part.select("p_type").distinct().withColumn("sector", F.lower("p_type"))
    rows = checked_join(t.part, sectors, ["p_type"])
    short = F.substring("p_name", 1, 1)
    name = (
        F.when(F.col("p_size") > 25, F.col("p_name"))
        .when(F.col("p_type") == "PROMO", paste("sector", "p_brand", short, sep="_"))
        .otherwise(paste("sector", short, sep="_"))
    )
    return rows.select("p_partkey", name.alias("input_name"))


@query(
    "x24_unit_driven_conversion",
    """SELECT l_suppkey, l_returnflag, CASE l_returnflag WHEN 'A' THEN sum(l_quantity) * 2.5 WHEN 'N' THEN sum(l_quantity) / 4 END AS amount,
       CASE WHEN l_returnflag IN ('A', 'N') THEN 'GJ' END AS unit FROM lineitem GROUP BY 1, 2""",
)
def _x24(t):
    sums = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    unit = F.col("l_returnflag")
    return sums.select(
        "l_suppkey",
        "l_returnflag",
        F.when(unit == "A", F.col("q") * 2.5).when(unit == "N", F.col("q") / 4).alias("amount"),
        F.when(unit.isin("A", "N"), "GJ").alias("unit"),
    )


FACTORS = " ".join(f"WHEN {y} THEN {deflator(1975, y)!r}" for y in YEARS)


@query(
    "x25_row_year_deflation",
    f"""WITH {CY} SELECT o_custkey, round(sum(value * CASE year {FACTORS} END) / sum(n_orders), 6) AS real_mean FROM cy GROUP BY 1""",
)
def _x25(t):
    real = t.cy.withColumn("real", F.col("value") * deflator_from(F.col("year"), 1975))
    return real.groupBy("o_custkey").agg(F.round(ratio(F.sum("real"), F.sum("n_orders")), 6).alias("real_mean"))
