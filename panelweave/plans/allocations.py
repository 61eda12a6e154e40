"""Queries for downscaling, control totals, splits and imputation."""

from pyspark.sql import functions as F

from panelweave.functions.semantics import clamp, ratio, sum_where, weighted_mean
from panelweave.operators import allocation as A
from panelweave.operators.groups import attach, share, with_panel, with_total
from panelweave.operators.joins import checked_join, replicate_values
from panelweave.operators.timeseries import extend, interpolate
from panelweave.plans.registry import query
from panelweave.plans.series import BETWEEN, interpolation
from panelweave.plans.views import CY, GAPS, TS, YEARS
from panelweave.session import cut_lineage


def by_status(t):
    """Order value per customer and status."""
    at = lambda s: F.round(sum_where(F.col("o_orderstatus") == s, "o_totalprice"), 2).alias(s.lower())
    return t.orders.groupBy("o_custkey").agg(*[at(s) for s in "FOP"])


STATUS = """st AS (SELECT o_custkey, round(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 0), 2) AS f,
  round(coalesce(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 0), 2) AS o,
  round(coalesce(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 0), 2) AS p FROM orders GROUP BY 1)"""


def customer_nations(t):
    return t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")


@query(
    "d1_proxy_downscaling",
    f"""WITH {TS}, r AS (SELECT n_regionkey, year, round(sum(value), 2) AS value FROM ts GROUP BY 1, 2),
        m AS (SELECT n_regionkey, n_nationkey, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
        SELECT n_regionkey, n_nationkey, year, value * (n / sum(n) OVER (PARTITION BY n_regionkey, year)) AS value FROM m JOIN r USING (n_regionkey)""",
)
def _d1(t):
    coarse = t.ts.groupBy("n_regionkey", "year").agg(F.round(F.sum("value"), 2).alias("value"))
    counts = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    members = counts.join(t.nation.select("n_nationkey", "n_regionkey"), "n_nationkey")
    out = A.downscale(coarse, members, ["n_regionkey"], "n")
    return out.select("n_regionkey", "n_nationkey", "year", "value")


@query(
    "d2_chained_shares",
    f"""WITH {TS} SELECT n_nationkey, year, round(value / sum(value) OVER (PARTITION BY n_regionkey, year)
          * (sum(value) OVER (PARTITION BY n_regionkey, year) / sum(value) OVER (PARTITION BY year)), 9) AS share FROM ts""",
)
def _d2(t):
    out = A.chained_share(t.ts, "value", ["n_regionkey", "year"], ["year"], "share")
    return out.select("n_nationkey", "year", F.round("share", 9).alias("share"))


@query(
    "d3_same_value_to_members",
    f"""WITH {TS}, r AS (SELECT n_regionkey, round(avg(value), 4) AS rate FROM ts GROUP BY 1)
        SELECT c_custkey, rate FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN r USING (n_regionkey)""",
)
def _d3(t):
    rates = t.ts.groupBy("n_regionkey").agg(F.round(F.avg("value"), 4).alias("rate"))
    nations = checked_join(t.nation.select("n_nationkey", "n_regionkey"), rates, ["n_regionkey"])
    members = checked_join(
        t.customer.select("c_custkey", "c_nationkey"), nations.select("n_nationkey", "rate"), {"c_nationkey": "n_nationkey"}
    )
    return members.select("c_custkey", "rate")


@query(
    "d4_aggregate_through_mapping",
    """SELECT r_name, round(sum(c_acctbal), 2) AS balance, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
def _d4(t):
    nations = t.customer.groupBy("c_nationkey").agg(F.sum("c_acctbal").alias("b"), F.count(F.lit(1)).alias("n"))
    mapped = checked_join(nations, t.nation.select("n_nationkey", "n_regionkey"), {"c_nationkey": "n_nationkey"})
    named = checked_join(mapped, t.region, {"n_regionkey": "r_regionkey"})
    return named.groupBy("r_name").agg(F.round(F.sum("b"), 2).alias("balance"), F.sum("n").alias("n"))


@query(
    "d5_scale_to_control_totals",
    """WITH s AS (SELECT l_orderkey, sum(l_extendedprice) AS v FROM lineitem GROUP BY 1)
       SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * coalesce(o_totalprice / nullif(v, 0), 1), 4) AS scaled
       FROM lineitem JOIN s USING (l_orderkey) LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus = 'F'""",
)
def _d5(t):
    control = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    detail = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    out = A.scale_to_control(detail, control, ["l_orderkey"], "l_extendedprice", "o_totalprice", out="scaled", short=True)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("scaled", 4).alias("scaled"))


@query(
    "d6_scale_to_delivered_supply",
    """WITH s AS (SELECT l_orderkey, sum(l_quantity) AS v FROM lineitem GROUP BY 1)
       SELECT l_suppkey, l_returnflag, round(sum(l_quantity * (o_totalprice / v)), 4) AS scaled
       FROM lineitem JOIN s USING (l_orderkey) JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
)
def _d6(t):
    control = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    detail = t.lineitem.select("l_orderkey", "l_suppkey", "l_returnflag", "l_quantity")
    out = A.scale_strict(detail, control, ["l_orderkey"], "l_quantity", "o_totalprice", "scaled", short=True)
    return out.groupBy("l_suppkey", "l_returnflag").agg(F.round(F.sum("scaled"), 4).alias("scaled"))


@query(
    "d7_time_limited_control_scaling",
    f"""WITH {TS} SELECT n_nationkey, year, round(value * CASE WHEN year >= 1998 THEN 1 + n_nationkey / 100.0
          ELSE 1 + n_nationkey / 100.0 * (year - 1995) / 3.0 END, 4) AS value FROM ts""",
)
def _d7(t):
    ts = cut_lineage(t.ts)
    control = ts.where("year >= 1998").select(
        "n_nationkey", "year", (F.col("value") * (1 + F.col("n_nationkey") / 100.0)).alias("control")
    )
    known = attach(control, ts.select("n_nationkey", "year", "value"), ["n_nationkey", "year"]).select(
        "n_nationkey", "year", ratio("control", "value").alias("scaler")
    )
    anchor = t.nation.select("n_nationkey", F.lit(1995).alias("year"), F.lit(1.0).alias("scaler"))
    scalers = A.extend_scalers(known.unionByName(anchor), ["n_nationkey"], YEARS)
    rows = checked_join(ts, scalers, ["n_nationkey", "year"])
    return rows.select("n_nationkey", "year", F.round(F.col("value") * F.col("scaler"), 4).alias("value"))


@query(
    "d17_capped_two_stage_deduction",
    f"""WITH {STATUS}, x AS (SELECT *, least(0.3 * p, 0.5 * f + o) AS d FROM st)
        SELECT o_custkey, round(CASE WHEN f * 0.5 >= d THEN f - d ELSE f * 0.5 END, 4) AS first_left,
          round(CASE WHEN f * 0.5 >= d THEN o ELSE o + f * 0.5 - d END, 4) + 0 AS second_left FROM x""",
)
def _d17(t):
    rows = by_status(t).withColumn("d", F.least(F.col("p") * 0.3, F.col("f") * 0.5 + F.col("o")))
    out = A.deduct_in_order(rows, "f", "o", "d", 0.5, "first_left", "second_left")
    return out.select(
        "o_custkey",
        F.round("first_left", 4).alias("first_left"),
        (F.round("second_left", 4) + 0).alias("second_left"),
    )


@query(
    "d18_input_output_coefficient",
    """SELECT l_partkey, round(sum(l_extendedprice), 2) / sum(l_quantity) AS io,
       sum(l_quantity) - sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS net FROM lineitem GROUP BY 1""",
)
def _d18(t):
    sums = t.lineitem.groupBy("l_partkey").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("input"),
        F.sum("l_quantity").alias("output"),
        sum_where(F.col("l_returnflag") == "R", "l_quantity").alias("own"),
    )
    return sums.select("l_partkey", ratio("input", "output").alias("io"), (F.col("output") - F.col("own")).alias("net"))


@query(
    "d19_redistribute_negatives",
    """WITH s AS (SELECT c_custkey, c_acctbal, sum(least(c_acctbal, 0)) OVER w AS neg, sum(greatest(c_acctbal, 0)) OVER w AS pos
         FROM customer WINDOW w AS (PARTITION BY c_nationkey))
       SELECT c_custkey, round(CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal * (1 + neg / pos) END, 6) AS balance FROM s""",
)
def _d19(t):
    out = A.absorb_negatives(t.customer, ["c_nationkey"], "c_acctbal", "balance")
    return out.select("c_custkey", F.round("balance", 6).alias("balance"))


@query(
    "d20_residual_as_plug",
    """WITH s AS (SELECT l_orderkey, sum(l_extendedprice) AS v FROM lineitem GROUP BY 1)
       SELECT o_custkey, round(sum(o_totalprice - coalesce(v, 0)), 2) AS residual FROM orders LEFT JOIN s ON l_orderkey = o_orderkey GROUP BY 1""",
)
def _d20(t):
    sums = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("v"))
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice").join(sums, "o_orderkey", "left")
    return rows.groupBy("o_custkey").agg(
        F.round(F.sum(F.col("o_totalprice") - F.coalesce("v", F.lit(0.0))), 2).alias("residual")
    )


@query(
    "d21_capped_fraction",
    f"""WITH {STATUS}, x AS (SELECT *, f + o + p AS total, least(0.4, coalesce(f / nullif(f + o + p, 0), 0)) AS frac FROM st)
        SELECT o_custkey, round(frac, 9) AS frac, round(total * frac, 4) AS used, round(o / nullif(total * frac, 0), 6) AS yield FROM x""",
)
def _d21(t):
    rows = by_status(t).withColumn("total", F.col("f") + F.col("o") + F.col("p"))
    out = A.cap_fraction(rows, "f", "total", 0.4, "frac", "used")
    return out.select(
        "o_custkey",
        F.round("frac", 9).alias("frac"),
        F.round("used", 4).alias("used"),
        F.round(ratio("o", "used"), 6).alias("yield"),
    )


@query(
    "d22_proportional_shrink",
    """WITH s AS (SELECT *, sum(l_extendedprice) OVER (PARTITION BY l_suppkey) AS tot FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * ((tot - greatest(0, s_acctbal)) / tot), 4) AS kept
       FROM s JOIN supplier ON l_suppkey = s_suppkey""",
)
def _d22(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    extra = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.greatest("s_acctbal", F.lit(0.0)).alias("extra"))
    out = A.shrink_group(rows, ["l_suppkey"], "l_extendedprice", extra, "extra", "kept")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("kept", 4).alias("kept"))


@query(
    "d23_protected_split",
    f"""WITH {CY}, b AS (SELECT o_custkey, max(CASE WHEN year = 2001 THEN value END) AS base, min(value) AS least FROM cy GROUP BY 1)
        SELECT o_custkey, year, round(CASE WHEN least < 0.3 * base THEN 0.3 * value WHEN base IS NOT NULL THEN 0.3 * base END, 6) AS protected,
          round(CASE WHEN least < 0.3 * base THEN 0.7 * value WHEN base IS NOT NULL THEN value - 0.3 * base END, 6) AS open
        FROM cy JOIN b USING (o_custkey)""",
)
def _d23(t):
    rows = with_panel(
        t.cy,
        ["o_custkey"],
        {"base": F.max(F.when(F.col("year") == 2001, F.col("value"))), "least": F.min("value")},
    ).withColumn("fraction", F.lit(0.3))
    out = A.protected_split(rows, "value", "base", "least", "fraction")
    return out.select("o_custkey", "year", F.round("protected", 6).alias("protected"), F.round("open", 6).alias("open"))


@query(
    "d24_mix_by_extended_shares",
    f"""WITH {TS}, s AS (SELECT c_nationkey AS n_nationkey, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year, sum(o_totalprice) AS v
          FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) <= 1998 GROUP BY 1, 2, 3),
        sh AS (SELECT *, v / sum(v) OVER (PARTITION BY n_nationkey, year) AS share FROM s),
        grid AS (SELECT n_nationkey, o_orderpriority, y.year, share FROM (SELECT DISTINCT n_nationkey, o_orderpriority FROM sh)
          CROSS JOIN (SELECT CAST(unnest(range(1995, 2002)) AS INTEGER) AS year) y LEFT JOIN sh USING (n_nationkey, o_orderpriority, year)),
        {interpolation('grid', 'n_nationkey, o_orderpriority', y='share')}
        SELECT n_nationkey, o_orderpriority, year, round(value * CASE WHEN known >= 2 THEN coalesce({BETWEEN}, y0, y1) END, 2) AS value
        FROM interp JOIN ts USING (n_nationkey, year)""",
)
def _d24(t):
    early = t.orders.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("date"))
    sums = (
        early.groupBy("o_custkey", "o_orderpriority", F.year("o_orderdate").alias("year"))
        .agg(F.sum("o_totalprice").alias("v"))
        .join(customer_nations(t).withColumnRenamed("c_nationkey", "n_nationkey"), "o_custkey")
        .groupBy("n_nationkey", "o_orderpriority", "year")
        .agg(F.sum("v").alias("v"))
    )
    keys = ["n_nationkey", "o_orderpriority"]
    shares = extend(
        share(sums, "v", ["n_nationkey", "year"], out="value").select(*keys, "year", "value"), keys, YEARS, rule=2
    ).withColumnRenamed("value", "share")
    rows = shares.join(t.ts.select("n_nationkey", "year", "value"), ["n_nationkey", "year"])
    return rows.select(*keys, "year", F.round(F.col("value") * F.col("share"), 2).alias("value"))


@query(
    "d25_emission_factors",
    """WITH a AS (SELECT l_suppkey, l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS amount FROM lineitem GROUP BY 1, 2, 3),
       e AS (SELECT l_suppkey, l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS emitted FROM lineitem
         WHERE l_discount >= 0.1 AND l_tax >= 0.08 GROUP BY 1, 2, 3),
       j AS (SELECT a.*, coalesce(emitted, 0) AS emitted FROM a LEFT JOIN e USING (l_suppkey, l_returnflag, year))
       SELECT l_suppkey, l_returnflag, year, CASE WHEN sum(emitted) OVER (PARTITION BY l_suppkey, year) = 0 THEN 1
         ELSE round(coalesce(emitted / nullif(amount, 0), 0), 9) END AS factor FROM j""",
)
def _d25(t):
    keys = ["l_suppkey", "l_returnflag", "year"]
    lines = t.lineitem.withColumn("year", F.year("l_shipdate"))
    activity = lines.groupBy(*keys).agg(F.sum("l_quantity").alias("amount"))
    dirty = lines.where((F.col("l_discount") >= 0.1) & (F.col("l_tax") >= 0.08))
    emissions = dirty.groupBy(*keys).agg(F.sum("l_quantity").alias("emitted"))
    out = A.emission_factors(activity, emissions, keys, ["l_suppkey", "year"], "amount", "emitted")
    return out.select(*keys, F.round("factor", 9).alias("factor"))


@query(
    "d26_weighted_mean_with_filled_weights",
    f"""WITH {GAPS}, {interpolation('gaps', 'o_custkey')},
        w AS (SELECT o_custkey, year, coalesce({BETWEEN}, y0, y1) AS w FROM interp WHERE known >= 2)
        SELECT c_nationkey, year, round(sum(c_acctbal * w) / sum(w), 6) AS balance FROM w JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def _d26(t):
    weights = interpolate(t.gaps, ["o_custkey"], rule=2, out="w").where(F.col("w").isNotNull())
    who = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal")
    return weights.join(who, "o_custkey").groupBy("c_nationkey", "year").agg(
        F.round(weighted_mean("c_acctbal", "w"), 6).alias("balance")
    )


@query(
    "d27_yield_index",
    """WITH y AS (SELECT l_suppkey, p_type, sum(l_extendedprice) AS made, sum(l_quantity) AS area FROM lineitem
         JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
       g AS (SELECT p_type, sum(made) / sum(area) AS world FROM y GROUP BY 1)
       SELECT s_nationkey, round(sum(made / area / world * area) / sum(area), 9) AS idx FROM y JOIN g USING (p_type)
       JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""",
)
def _d27(t):
    sums = (
        t.lineitem.groupBy("l_suppkey", F.col("l_partkey").alias("p_partkey"))
        .agg(F.sum("l_extendedprice").alias("made"), F.sum("l_quantity").alias("area"))
        .join(t.part.select("p_partkey", "p_type"), "p_partkey")
        .groupBy("l_suppkey", "p_type")
        .agg(F.sum("made").alias("made"), F.sum("area").alias("area"))
    )
    members = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    out = A.yield_index(sums, members, "l_suppkey", "p_type", "made", "area", "s_nationkey", "idx")
    return out.withColumn("idx", F.round("idx", 9))


@query(
    "d28_survey_scaling",
    f"""WITH {CY} SELECT o_custkey, year, round(coalesce(CASE WHEN year < 1998 THEN value / lead(value) OVER w
          ELSE value / lag(value) OVER w END, 1), 9) AS conv FROM cy WINDOW w AS (PARTITION BY o_custkey ORDER BY year)""",
)
def _d28(t):
    rows = A.survey_conversion(t.cy, ["o_custkey"], "value", 1998, "conv")
    return rows.select("o_custkey", "year", F.round("conv", 9).alias("conv"))


@query(
    "d29_two_component_mix",
    """WITH m AS (SELECT p_brand, round(avg(p_size), 8) AS mean, round(avg(CASE WHEN p_type = 'ECONOMY' THEN p_size END), 8) AS low,
         round(avg(CASE WHEN p_type = 'PROMO' THEN p_size END), 8) AS high FROM part GROUP BY 1),
       a AS (SELECT *, CASE WHEN mean < low THEN mean WHEN mean >= low THEN low END AS la,
         CASE WHEN mean > high THEN mean + 0.03 WHEN mean <= high THEN high END AS ha FROM m)
       SELECT p_brand, round(la, 8) AS low_adj, round(ha, 8) AS high_adj, round((mean - ha) / nullif(la - ha, 0), 6) AS share_low FROM a""",
)
def _d29(t):
    at = lambda kind: F.round(F.avg(F.when(F.col("p_type") == kind, F.col("p_size"))), 8)
    means = t.part.groupBy("p_brand").agg(
        F.round(F.avg("p_size"), 8).alias("mean"), at("ECONOMY").alias("low"), at("PROMO").alias("high")
    )
    out = A.mix_share(means, "mean", "low", "high", 0.03)
    return out.select(
        "p_brand",
        F.round("low_adj", 8).alias("low_adj"),
        F.round("high_adj", 8).alias("high_adj"),
        F.round("share_low", 6).alias("share_low"),
    )


@query(
    "d30_observed_else_class_share",
    """WITH o AS (SELECT o_custkey, c_mktsegment, o_orderpriority, round(sum(o_totalprice), 2) AS v FROM orders
         JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
       s AS (SELECT *, v / sum(v) OVER (PARTITION BY o_custkey) AS share FROM o),
       c AS (SELECT c_mktsegment, o_orderpriority, sum(v) / sum(sum(v)) OVER (PARTITION BY c_mktsegment) AS mean FROM o GROUP BY 1, 2)
       SELECT m.o_custkey, m.c_mktsegment, c.o_orderpriority, round(coalesce(share, mean), 9) AS share
       FROM (SELECT DISTINCT o_custkey, c_mktsegment FROM s) m JOIN c USING (c_mktsegment)
       LEFT JOIN s ON s.o_custkey = m.o_custkey AND s.o_orderpriority = c.o_orderpriority""",
)
def _d30(t):
    who = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    sums = (
        t.orders.groupBy("o_custkey", "o_orderpriority")
        .agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
        .join(who, "o_custkey")
    )
    observed = share(sums, "v", ["o_custkey"])
    per_class = sums.groupBy("c_mktsegment", "o_orderpriority").agg(F.sum("v").alias("v"))
    average = share(per_class, "v", ["c_mktsegment"])
    out = A.fill_from_class(observed, average, ["o_custkey"], ["c_mktsegment"], "o_orderpriority", "share")
    return out.withColumn("share", F.round("share", 9))


FCR = A.fixed_charge_rate(0.1, 10)


@query(
    "d31_levelised_cost",
    """SELECT p_brand, p_type, round(sum(CASE WHEN p_type = 'LARGE' THEN p_retailprice
         ELSE p_retailprice * (0.1 + 0.1 / (pow(1.1, 10) - 1)) / p_size END), 6) AS cost FROM part GROUP BY 1, 2""",
)
def _d31(t):
    yearly = ratio(F.col("p_retailprice") * FCR, "p_size")
    cost = F.when(F.col("p_type") == "LARGE", F.col("p_retailprice")).otherwise(yearly)
    return t.part.groupBy("p_brand", "p_type").agg(F.round(F.sum(cost), 6).alias("cost"))


@query(
    "d32_chained_fractions",
    f"""WITH {TS}, seg AS (SELECT c_nationkey AS n_nationkey, c_mktsegment, count(*) / sum(count(*)) OVER (PARTITION BY c_nationkey) AS part
          FROM customer GROUP BY 1, 2),
        v AS (SELECT c_mktsegment, year, sum(value * part) AS v FROM ts JOIN seg USING (n_nationkey) GROUP BY 1, 2),
        n AS (SELECT c_mktsegment, year, v / sum(v) OVER (PARTITION BY c_mktsegment) AS f FROM v)
        SELECT c_mktsegment, year, round(f, 9) AS fraction, round(f / max(CASE WHEN year = 1995 THEN f END) OVER (PARTITION BY c_mktsegment), 9) AS weight FROM n""",
)
def _d32(t):
    counts = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    parts = share(counts, "n", ["n_nationkey"], out="part")
    amounts = (
        t.ts.select("n_nationkey", "year", "value")
        .join(parts, "n_nationkey")
        .groupBy("c_mktsegment", "year")
        .agg(F.sum(F.col("value") * F.col("part")).alias("v"))
    )
    fractions = share(amounts, "v", ["c_mktsegment"], out="fraction")
    out = A.index_to_member(fractions, ["c_mktsegment"], F.col("year") == 1995, "fraction", "weight")
    return out.select("c_mktsegment", "year", F.round("fraction", 9).alias("fraction"), F.round("weight", 9).alias("weight"))


@query(
    "d33_priority_split_of_supplies",
    f"""WITH {STATUS}, u AS (SELECT o_custkey, f AS a, o AS b, p * 0.5 + 1 AS n1, c_acctbal + 1000 AS n2 FROM st JOIN customer ON o_custkey = c_custkey),
        x AS (SELECT *, (a + b) / (n1 + n2) AS per FROM u), y AS (SELECT *, least(per, a / n1) AS a1 FROM x),
        z AS (SELECT *, per - a1 AS b1, greatest(b - (per - a1) * n1, 0) AS left_b FROM y)
        SELECT o_custkey, round(a1, 8) AS a_one, round(b1, 8) AS b_one, round(coalesce(left_b / nullif(n2, 0), 0), 8) AS b_two FROM z""",
)
def _d33(t):
    who = t.customer.select(F.col("c_custkey").alias("o_custkey"), (F.col("c_acctbal") + 1000).alias("n2"))
    rows = by_status(t).join(who, "o_custkey").withColumn("n1", F.col("p") * 0.5 + 1)
    out = A.priority_split(rows, "f", "o", "n1", "n2")
    return out.select("o_custkey", *[F.round(c, 8).alias(c) for c in ("a_one", "b_one", "b_two")])


@query(
    "d34_retained_and_retired_split",
    f"""WITH {GAPS}, {interpolation('gaps', 'o_custkey')},
        f AS (SELECT o_custkey, year, CASE WHEN known >= 2 THEN coalesce({BETWEEN}, y0, y1) END AS v FROM interp),
        r AS (SELECT o_custkey, max(CASE WHEN year = 1998 THEN v END) AS base,
          coalesce(greatest(0, 1 - max(CASE WHEN year = 2001 THEN v END) / max(CASE WHEN year = 1998 THEN v END)), 0) AS frac FROM f GROUP BY 1)
        SELECT o_custkey, 'retained' AS tech, round(base * (1 - frac), 4) AS value FROM r
        UNION ALL SELECT o_custkey, 'retired', round(base * frac, 4) FROM r""",
)
def _d34(t):
    filled = interpolate(t.gaps, ["o_custkey"], rule=2)
    at = lambda y: F.max(F.when(F.col("year") == y, F.col("value")))
    rows = filled.groupBy("o_custkey").agg(at(1998).alias("base"), at(2001).alias("late"))
    frac = F.coalesce(clamp(1 - ratio("late", "base"), low=F.lit(0.0)), F.lit(0.0))
    split = rows.withColumn("frac", frac)
    both = replicate_values(split, "tech", ["retained", "retired"])
    part = F.when(F.col("tech") == "retained", 1 - F.col("frac")).otherwise(F.col("frac"))
    return both.select("o_custkey", "tech", F.round(F.col("base") * part, 4).alias("value"))


@query(
    "d35_impute_by_ratio_of_totals",
    f"""WITH {GAPS}, p AS (SELECT o_custkey, max(CASE WHEN year = 2000 THEN value END) AS x, max(CASE WHEN year = 1999 THEN value END) AS y FROM gaps GROUP BY 1)
        SELECT o_custkey, round(coalesce(x, y * (SELECT sum(x) / sum(y) FROM p WHERE x IS NOT NULL AND y IS NOT NULL)), 4) AS value FROM p""",
)
def _d35(t):
    at = lambda y: F.max(F.when(F.col("year") == y, F.col("value")))
    pairs = t.gaps.groupBy("o_custkey").agg(at(2000).alias("x"), at(1999).alias("y"))
    return A.impute_by_ratio(pairs, "x", "y", "value").select("o_custkey", F.round("value", 4).alias("value"))


@query(
    "d36_scale_with_unmatched_zero",
    """WITH s AS (SELECT l_orderkey, sum(l_quantity) AS v FROM lineitem GROUP BY 1)
       SELECT l_suppkey, round(sum(l_quantity * coalesce(o_totalprice / nullif(v, 0), 0)), 4) AS scaled
       FROM lineitem JOIN s USING (l_orderkey) LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus = 'F' GROUP BY 1""",
)
def _d36(t):
    control = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    detail = t.lineitem.select("l_orderkey", "l_suppkey", "l_quantity")
    out = A.scale_to_control(detail, control, ["l_orderkey"], "l_quantity", "o_totalprice", default=0.0, out="scaled", short=True)
    return out.groupBy("l_suppkey").agg(F.round(F.sum("scaled"), 4).alias("scaled"))


@query(
    "d37_fill_through_intensity",
    f"""WITH {GAPS}, pc AS (SELECT o_custkey, year, value / (c_acctbal + 2000) AS value, c_acctbal + 2000 AS driver FROM gaps JOIN customer ON o_custkey = c_custkey),
        {interpolation('pc', 'o_custkey')},
        m AS (SELECT o_custkey, median(value) AS m FROM pc GROUP BY 1)
        SELECT o_custkey, year, round(driver * coalesce(CASE WHEN known >= 2 THEN coalesce({BETWEEN}, y0, y1) END, m), 4) AS value
        FROM interp JOIN m USING (o_custkey)""",
)
def _d37(t):
    who = t.customer.select(F.col("c_custkey").alias("o_custkey"), (F.col("c_acctbal") + 2000).alias("driver"))
    rows = t.gaps.join(who, "o_custkey").withColumn("pc", ratio("value", "driver"))
    filled = interpolate(rows, ["o_custkey"], y="pc", rule=2, out="filled")
    # At most one value per year and customer goes into each median.
    medians = rows.groupBy("o_custkey").agg(F.median("pc").alias("m"))
    out = attach(filled, medians, ["o_custkey"])
    return out.select("o_custkey", "year", F.round(F.col("driver") * F.coalesce("filled", "m"), 4).alias("value"))


@query(
    "d38_complete_with_global_median",
    """WITH s AS (SELECT s_nationkey AS n_nationkey, CASE WHEN avg(s_acctbal) > 4500 THEN round(avg(s_acctbal), 8) END AS price FROM supplier GROUP BY 1)
       SELECT n_nationkey, round(coalesce(price, (SELECT median(price) FROM s)), 6) AS price, price IS NULL AS filled FROM nation LEFT JOIN s USING (n_nationkey)""",
)
def _d38(t):
    average = F.avg("s_acctbal")
    known = t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(
        F.when(average > 4500, F.round(average, 8)).alias("price")
    )
    out = A.complete_with_median(t.nation.select("n_nationkey"), known, ["n_nationkey"], "price")
    return out.withColumn("price", F.round("price", 6))


@query(
    "d39_impute_by_reference_index",
    """WITH p AS (SELECT s_nationkey, p_brand || ' ' || p_name AS item, round(sum(l_extendedprice), 2) / sum(l_quantity) AS price FROM lineitem
         JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
       w AS (SELECT s_nationkey, round(sum(l_extendedprice), 2) / sum(l_quantity) AS price FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
       i AS (SELECT s_nationkey, price / (SELECT price FROM w WHERE s_nationkey = 0) AS i0, price / (SELECT price FROM w WHERE s_nationkey = 1) AS i1 FROM w),
       b AS (SELECT item, max(CASE WHEN s_nationkey = 0 THEN price END) AS r0, max(CASE WHEN s_nationkey = 1 THEN price END) AS r1 FROM p GROUP BY 1)
       SELECT i.s_nationkey, b.item, coalesce(p.price, r0 * i0, r1 * i1) AS price FROM i CROSS JOIN b
       LEFT JOIN p ON p.s_nationkey = i.s_nationkey AND p.item = b.item""",
)
def _d39(t):
    sums = [F.sum("l_extendedprice").alias("v"), F.sum("l_quantity").alias("q")]
    nation = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    item = F.concat_ws(" ", "p_brand", "p_name").alias("item")
    price = ratio(F.round(F.sum("v"), 2), F.sum("q")).alias("price")
    sold = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(*sums).join(nation, "l_suppkey")
    prices = (
        sold.join(t.part.select(F.col("p_partkey").alias("l_partkey"), item), "l_partkey")
        .groupBy("s_nationkey", "item")
        .agg(price)
    )
    level = sold.groupBy("s_nationkey").agg(price)
    ref = lambda k: F.max(F.when(F.col("s_nationkey") == k, F.col("price")))
    index = with_total(level, {"p0": ref(0), "p1": ref(1)}).select(
        "s_nationkey", ratio("price", "p0").alias("i0"), ratio("price", "p1").alias("i1")
    )
    return A.impute_by_index(prices, index, "s_nationkey", "item", "price", [0, 1], ["i0", "i1"])


@query(
    "d40_scaler_with_alternate_category",
    """WITH d AS (SELECT c_nationkey, o_orderpriority, c_custkey, round(coalesce(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 0), 2) AS v
         FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
       c AS (SELECT c_nationkey, o_orderpriority, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey
         WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '3-MEDIUM') GROUP BY 1, 2),
       s AS (SELECT c_nationkey, o_orderpriority, sum(v) AS v, count(*) AS n FROM d GROUP BY 1, 2),
       m AS (SELECT c.c_nationkey, c.o_orderpriority, total, total / nullif(v, 0) AS k, n FROM c LEFT JOIN s USING (c_nationkey, o_orderpriority))
       SELECT d.c_nationkey, d.o_orderpriority, c_custkey, round(CASE WHEN m.total IS NOT NULL AND m.k IS NULL THEN m.total / m.n
         ELSE d.v * coalesce(m.k, a.k) END, 4) AS scaled
       FROM d LEFT JOIN m ON m.c_nationkey = d.c_nationkey AND m.o_orderpriority = d.o_orderpriority
       LEFT JOIN m a ON a.c_nationkey = d.c_nationkey AND a.o_orderpriority = '3-MEDIUM'""",
)
def _d40(t):
    who = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    sums = t.orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.round(sum_where(F.col("o_orderstatus") == "O", "o_totalprice"), 2).alias("v"),
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("f"),
    )
    rows = sums.join(who, "o_custkey")
    control = (
        rows.where(F.col("o_orderpriority").isin("1-URGENT", "3-MEDIUM") & F.col("f").isNotNull())
        .groupBy("c_nationkey", "o_orderpriority")
        .agg(F.round(F.sum("f"), 2).alias("total"))
    )
    out = A.scale_with_alternate(
        rows.select("c_nationkey", "o_orderpriority", F.col("o_custkey").alias("c_custkey"), "v"),
        control, ["c_nationkey"], "o_orderpriority", "3-MEDIUM", "v", "total", "scaled",
    )
    return out.select("c_nationkey", "o_orderpriority", "c_custkey", F.round("scaled", 4).alias("scaled"))
