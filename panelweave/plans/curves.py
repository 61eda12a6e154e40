"""Queries for supply and abatement curves, fits and clipping."""

from pyspark.sql import functions as F

from panelweave.functions.semantics import clamp, ratio, row_min
from panelweave.functions.units import UNIT_FACTORS
from panelweave.operators import curves as C
from panelweave.operators.allocation import fixed_charge_rate
from panelweave.operators.groups import attach, with_group, with_panel
from panelweave.operators.timeseries import over, resample
from panelweave.plans.registry import query
from panelweave.plans.views import CURVE, CY, TS
from panelweave.session import cut_lineage

RUN = f"""{CURVE}, run AS (SELECT *, CAST(sum(quantity) OVER (PARTITION BY p_brand ORDER BY price) AS DOUBLE) AS supply,
  CAST(sum(quantity) OVER (PARTITION BY p_brand) AS DOUBLE) AS total FROM curve)"""


def brand_curve(t):
    return C.supply_curve(t.part, ["p_brand"], "p_retailprice", "p_size")


@query(
    "c1_evaluate_smooth_supply",
    """SELECT p_partkey, round(CASE WHEN p_retailprice < 920 THEN 0 ELSE pow(p_retailprice - 920, 1 + p_size / 10.0)
       / (pow(50, 1 + p_size / 10.0) + pow(p_retailprice - 920, 1 + p_size / 10.0)) * p_size END, 8) AS supply FROM part""",
)
def _c1(t):
    supply = C.smooth_supply(
        1 + F.col("p_size") / 10.0, F.lit(50.0), F.lit(920.0), F.col("p_size").cast("double"), F.col("p_retailprice")
    )
    return t.part.select("p_partkey", F.round(supply, 8).alias("supply"))


@query(
    "c2_price_at_95_percent",
    "SELECT p_partkey, round(pow(0.95::DOUBLE / (1 - 0.95::DOUBLE), 1.0 / (1 + p_size / 10.0)) * 50 + p_retailprice, 6) AS price FROM part",
)
def _c2(t):
    price = C.price_at_share(1 + F.col("p_size") / 10.0, F.lit(50.0), F.col("p_retailprice"))
    return t.part.select("p_partkey", F.round(price, 6).alias("price"))


@query(
    "c3_aggregate_member_curves",
    """WITH m AS (SELECT p_type, p_brand, min(p_retailprice) AS base, round(avg(p_retailprice) - min(p_retailprice), 8) + 1 AS mid,
         CAST(sum(p_size) AS DOUBLE) AS maximum FROM part GROUP BY 1, 2),
       e AS (SELECT p_type, min(base) AS low, max(pow(0.95::DOUBLE / (1 - 0.95::DOUBLE), 1.0 / 2) * mid + base) AS high FROM m GROUP BY 1),
       g AS (SELECT p_type, low, unnest(range(0, CAST(floor((high - low) / 25 + 1e-9) AS INTEGER) + 1)) AS step FROM e),
       p AS (SELECT *, low + step * 25.0::DOUBLE AS price FROM g)
       SELECT p_type, CAST(step AS INTEGER) AS step, round(min(price), 6) AS price, round(sum(CASE WHEN price < base THEN 0
         ELSE pow(price - base, 2) / (pow(mid, 2) + pow(price - base, 2)) * maximum END), 6) AS supply
       FROM p JOIN m USING (p_type) GROUP BY 1, 2""",
)
def _c3(t):
    members = t.part.groupBy("p_type", "p_brand").agg(
        F.min("p_retailprice").alias("base"),
        (F.round(F.avg("p_retailprice") - F.min("p_retailprice"), 8) + 1).alias("mid"),
        F.sum("p_size").cast("double").alias("maximum"),
    ).withColumn("exponent", F.lit(2.0))
    out = C.aggregate_curves(members, ["p_type"], "exponent", "mid", "base", "maximum", step=25.0)
    return out.select("p_type", "step", F.round("price", 6).alias("price"), F.round("supply", 6).alias("supply"))


@query(
    "c4_cumulative_supply_by_cost",
    """WITH p AS (SELECT p_type, round(p_retailprice / p_size, 4) AS cost, CAST(sum(p_size) AS BIGINT) AS p_size FROM part GROUP BY 1, 2)
       SELECT p_type, cost, CAST(sum(p_size) OVER (PARTITION BY p_type ORDER BY cost) AS BIGINT) AS supply FROM p""",
)
def _c4(t):
    points = t.part.withColumn("cost", F.round(ratio("p_retailprice", "p_size"), 4))
    return C.supply_curve(points, ["p_type"], "cost", "p_size").select("p_type", "cost", "supply")


@query(
    "c5_half_maximum_price",
    f"""WITH {RUN} SELECT p_brand, min(price) AS base_price, CAST(max(total) AS BIGINT) AS max_supply,
        min(CASE WHEN supply >= 0.5 * total THEN price END) AS mid_price FROM run GROUP BY 1""",
)
def _c5(t):
    return C.half_supply_price(brand_curve(t), ["p_brand"], "p_retailprice", "supply")


def grid_fit_sql(points: str, keys: str, params: dict, error: str, rounds: list) -> str:
    """SQL for successively finer grids, one round after another."""
    ctes, prev = [], None
    width = {n: hi - lo for n, (lo, hi) in params.items()}
    for r, parts in enumerate(rounds):
        grids, cols = [], []
        for n, (lo, hi) in params.items():
            low = f"{lo!r}::DOUBLE" if prev is None else f"({n}_best - {width[n] / 2!r}::DOUBLE)"
            cols.append(f"greatest({lo!r}::DOUBLE, least({hi!r}::DOUBLE, {low} + {n}_i * {width[n] / parts!r}::DOUBLE)) AS {n}")
            grids.append(f"CROSS JOIN (SELECT unnest(range(0, {parts + 1})) AS {n}_i) {n}_g")
            width[n] = 2 * width[n] / parts
        source = points if prev is None else f"{points} JOIN {prev} USING ({keys})"
        names = ", ".join(params)
        best = ", ".join(f"arg_min({n}, (sse, {names})) AS {n}_best" for n in params)
        ctes.append(f"e{r} AS (SELECT *, {', '.join(cols)} FROM {source} {' '.join(grids)})")
        ctes.append(f"s{r} AS (SELECT {keys}, {names}, sum(({error}) * ({error})) AS sse FROM e{r} GROUP BY ALL)")
        ctes.append(f"b{r} AS (SELECT {keys}, {best}, min(sse) AS sse FROM s{r} GROUP BY {keys})")
        prev = f"b{r}"
        ctes[-1] = ctes[-1] if r == len(rounds) - 1 else ctes[-1].replace(", min(sse) AS sse", "")
    return ", ".join(ctes)


@query(
    "c6_fit_curve_exponent",
    f"""WITH {RUN}, h AS (SELECT p_brand, min(price) AS base, min(CASE WHEN supply >= 0.5 * total THEN price END) - min(price) AS mid FROM run GROUP BY 1),
        pts AS (SELECT p_brand, price - base AS x, mid, supply / total AS y FROM run JOIN h USING (p_brand)),
        {grid_fit_sql('pts', 'p_brand', {'b': (1.0, 15.0)}, 'pow(x, b) / nullif(pow(mid, b) + pow(x, b), 0) - y', [28, 20, 20])}
        SELECT p_brand, round(b_best, 6) AS exponent, round(sse, 6) AS sse FROM b2""",
)
def _c6(t):
    curve = brand_curve(t)
    half = C.half_supply_price(curve, ["p_brand"], "p_retailprice", "supply")
    points = attach(curve, half, ["p_brand"]).select(
        "p_brand",
        (F.col("p_retailprice") - F.col("base_price")).alias("x"),
        (F.col("mid_price") - F.col("base_price")).alias("mid"),
        (F.col("supply") / F.col("supply_total")).alias("y"),
    )
    error = lambda b: ratio(F.pow("x", b), F.pow("mid", b) + F.pow("x", b)) - F.col("y")
    out = C.fit_by_grid(cut_lineage(points), ["p_brand"], {"b": (1.0, 15.0)}, error, [28, 20, 20])
    return out.select("p_brand", F.round("b", 6).alias("exponent"), F.round("sse", 6).alias("sse"))


@query(
    "c7_fit_retirement_s_curve",
    f"""WITH {TS}, pts AS (SELECT n_nationkey, year - 1995 AS x, 1 - sum(value) OVER (PARTITION BY n_nationkey ORDER BY year)
          / sum(value) OVER (PARTITION BY n_nationkey) AS y FROM ts),
        {grid_fit_sql('pts', 'n_nationkey', {'k': (0.0, 4.0), 'h': (0.0, 10.0)}, '1 / (1 + exp(k * (x - h))) - y', [20, 10])}
        SELECT n_nationkey, round(k_best, 6) AS steepness, round(h_best, 6) AS half_life, round(sse, 8) AS sse FROM b1""",
)
def _c7(t):
    # One row per year and nation.
    left = with_panel(t.ts, ["n_nationkey"], {"total": F.sum("value")}).withColumn(
        "run", F.sum("value").over(over(["n_nationkey"]))
    )
    points = left.select(
        "n_nationkey", (F.col("year") - 1995).alias("x"), (1 - F.col("run") / F.col("total")).alias("y")
    )
    error = lambda k, h: C.s_curve(k, h, F.col("x")) - F.col("y")
    out = C.fit_by_grid(cut_lineage(points), ["n_nationkey"], {"k": (0.0, 4.0), "h": (0.0, 10.0)}, error, [20, 10])
    return out.select(
        "n_nationkey",
        F.round("k", 6).alias("steepness"),
        F.round("h", 6).alias("half_life"),
        F.round("sse", 8).alias("sse"),
    )


COSTS = [895.0, 910.0, 930.0, 950.05, 970.0, 990.0]


@query(
    "c8_marginal_abatement_curve",
    f"""WITH r AS (SELECT p_type, p_retailprice AS x, sum(sum(p_size)) OVER (PARTITION BY p_type ORDER BY p_retailprice) AS cum FROM part GROUP BY 1, 2),
        b AS (SELECT p_type, sum(p_size) * 0.9 AS base FROM part GROUP BY 1),
        s AS (SELECT p_type, x, CASE WHEN cum / base >= 1 THEN 0.95 ELSE (cum / base)::DOUBLE END AS y FROM r JOIN b USING (p_type)),
        n AS (SELECT p_type, g.q, max(x) FILTER (WHERE x <= q) AS x0, arg_max(y, x) FILTER (WHERE x <= q) AS y0,
          min(x) FILTER (WHERE x >= q) AS x1, arg_min(y, x) FILTER (WHERE x >= q) AS y1
          FROM s CROSS JOIN (SELECT unnest({COSTS!r}::DOUBLE[]) AS q) g GROUP BY 1, 2)
        SELECT p_type, q AS tax, round(y0 + (y1 - y0) * coalesce((q - x0) / nullif(x1 - x0, 0), 0), 8) AS reduction FROM n""",
)
def _c8(t):
    reductions = t.part.select("p_type", F.col("p_retailprice").alias("tax"), F.col("p_size").alias("amount"))
    baseline = t.part.groupBy("p_type").agg((F.sum("p_size") * 0.9).alias("base"))
    shares = C.abatement_shares(reductions, baseline, ["p_type"], "tax", "amount", "base")
    out = resample(shares, ["p_type"], "tax", "share", COSTS)
    return out.select("p_type", "tax", F.round("share", 8).alias("reduction"))


@query(
    "c9_improvement_rate_closed_form",
    f"""WITH {TS}, a AS (SELECT n_nationkey, max(CASE WHEN year = 1995 THEN value END) AS v0, max(CASE WHEN year = 2001 THEN value END) AS v1 FROM ts GROUP BY 1),
        b AS (SELECT n_nationkey, (v1 - v0 * 0.1) / nullif(v0 - v0 * 0.1, 0) AS base FROM a)
        SELECT n_nationkey, CASE WHEN base >= 0 AND base <= 1 THEN round(1 - pow(base, 1.0 / 6), 9) END AS rate FROM b""",
)
def _c9(t):
    at = lambda y: F.max(F.when(F.col("year") == y, F.col("value")))
    ends = t.ts.groupBy("n_nationkey").agg(at(1995).alias("v0"), at(2001).alias("v1"))
    rate = C.improvement_rate(F.col("v1"), F.col("v0"), F.lit(0.1), F.lit(6))
    return ends.select("n_nationkey", F.round(rate, 9).alias("rate"))


@query(
    "c10_quartile_grades",
    """WITH p AS (SELECT p_brand, p_retailprice AS price, sum(p_size) AS q FROM part GROUP BY 1, 2),
       r AS (SELECT *, sum(q) OVER w AS cum, row_number() OVER w AS rn, count(*) OVER (PARTITION BY p_brand) AS n FROM p
         WINDOW w AS (PARTITION BY p_brand ORDER BY price)),
       k AS (SELECT * FROM r WHERE rn IN (ceil(n * 0.25), ceil(n * 0.5), ceil(n * 0.75), n))
       SELECT p_brand, price, 'grade ' || row_number() OVER w AS grade, CAST(cum - coalesce(lag(cum) OVER w, 0) AS BIGINT) AS marginal FROM k
       WINDOW w AS (PARTITION BY p_brand ORDER BY price)""",
)
def _c10(t):
    out = C.quartile_grades(t.part, ["p_brand"], "p_retailprice", "p_size")
    return out.withColumnRenamed("p_retailprice", "price")


@query(
    "c11_gompertz_demand",
    """WITH d AS (SELECT c_nationkey, count(*) AS density FROM customer GROUP BY 1),
       i AS (SELECT o_custkey, sum(o_totalprice) AS income FROM orders GROUP BY 1)
       SELECT c_custkey, round((60 - 3 * ln(density)) * exp(-4 * exp(-0.1 * ln(income))) + c_acctbal / 10000, 8) AS demand
       FROM customer JOIN i ON o_custkey = c_custkey JOIN d USING (c_nationkey)""",
)
def _c11(t):
    income = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("income"))
    rows = with_group(t.customer, ["c_nationkey"], {"density": F.count(F.lit(1))}).join(income, "c_custkey")
    demand = C.gompertz(
        F.lit(60.0), F.lit(3.0), F.col("density"), F.lit(4.0), F.lit(0.1), F.col("income"), F.col("c_acctbal") / 10000
    )
    return rows.select("c_custkey", F.round(demand, 8).alias("demand"))


@query(
    "c12_regression_prediction",
    f"""WITH {CY} SELECT o_custkey, count(*) AS n, round(CASE WHEN count(*) = 1 THEN max(value)
          ELSE regr_intercept(value, year - 1995) + regr_slope(value, year - 1995) * 7 END, 7) AS predicted FROM cy GROUP BY 1""",
)
def _c12(t):
    rows = t.cy.select("o_custkey", "value", (F.col("year") - 1995).alias("x"))
    lines = C.regression(rows, ["o_custkey"], "value", "x")
    line = F.col("intercept") + F.col("slope") * 7
    return lines.select("o_custkey", "n", F.round(F.when(F.col("n") == 1, F.col("mean")).otherwise(line), 7).alias("predicted"))


@query(
    "c13_outlier_replacement",
    f"""WITH {CY}, w AS (SELECT c_nationkey, o_custkey, c_mktsegment AS seg, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS raw,
          CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE 0 END AS v, round(sum(value), 2) AS wt
          FROM cy JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4, 5),
        c AS (SELECT *, sum(wt) OVER (PARTITION BY c_nationkey ORDER BY wt DESC, o_custkey ROWS UNBOUNDED PRECEDING) / sum(wt) OVER (PARTITION BY c_nationkey) AS part FROM w),
        l AS (SELECT *, min(part) OVER (PARTITION BY c_nationkey) AS least FROM c),
        t AS (SELECT c_nationkey, median(v) AS med, max(v) AS largest FROM l WHERE part <= greatest(least, 0.6) AND NOT (wt = 0 AND part > 0) GROUP BY 1),
        q AS (SELECT c_nationkey, quantile_cont(v, 0.95) AS upper, median(v) AS middle FROM w GROUP BY 1)
        SELECT o_custkey, round(CASE WHEN seg IN ('BUILDING', 'MACHINERY') THEN CASE WHEN raw IS NULL OR raw > least(upper, largest) THEN med ELSE raw END
            WHEN raw IS NULL OR raw > 9000 THEN middle ELSE raw END, 6) AS value FROM w JOIN t USING (c_nationkey) JOIN q USING (c_nationkey)""",
)
def _c13(t):
    known = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    who = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", F.col("c_mktsegment").alias("seg"), known.alias("v"))
    rows = t.cy.groupBy("o_custkey").agg(F.round(F.sum("value"), 2).alias("wt")).join(who, "o_custkey")
    grouped = F.col("seg").isin("BUILDING", "MACHINERY")
    out = C.cap_outliers(rows, ["c_nationkey"], "v", "wt", "o_custkey", 0.95, 0.6, "value", by_group=grouped, limit=9000.0)
    return out.select("o_custkey", F.round("value", 6).alias("value"))


@query(
    "c14_interquartile_cap",
    """WITH q AS (SELECT l_suppkey, median(l_extendedprice) + 0.9 * (quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25)) AS upper
         FROM lineitem GROUP BY 1)
       SELECT l_orderkey, l_linenumber, l_partkey, round(least(l_extendedprice, upper), 6) AS capped FROM lineitem JOIN q USING (l_suppkey)""",
)
def _c14(t):
    out = C.cap_by_spread(t.lineitem, ["l_suppkey"], "l_extendedprice", out="capped", times=0.9)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("capped", 6).alias("capped"))


@query(
    "c15_percentile_band",
    """WITH q AS (SELECT p_brand, quantile_cont(p_retailprice, 0.1) AS lo, quantile_cont(p_retailprice, 0.8) AS hi FROM part GROUP BY 1)
       SELECT p_partkey, round(least(greatest(p_retailprice, lo), hi), 6) AS price FROM part JOIN q USING (p_brand)""",
)
def _c15(t):
    out = C.narrow_band(t.part, ["p_brand"], "p_retailprice", 0.1, 0.8, out="price")
    return out.select("p_partkey", F.round("price", 6).alias("price"))


@query(
    "c16_log_price_resource_grades",
    """WITH b AS (SELECT p_brand, min(p_retailprice) AS base, sum(p_size) AS rsc, sum(CASE WHEN p_type = 'PROMO' THEN p_size ELSE 0 END) AS used FROM part GROUP BY 1),
       g AS (SELECT *, i, exp(i * (ln(100) / 4) + ln(base)) AS price FROM b CROSS JOIN (SELECT unnest(range(0, 5)) AS i)),
       a AS (SELECT *, rsc * pow(price / base, 0.3) - used AS avail FROM g)
       SELECT p_brand, round(price, 6) AS price, round(lead(avail, 1, 0.0) OVER (PARTITION BY p_brand ORDER BY i), 6) AS available, 'grade' || (i + 1) AS grade FROM a
       UNION ALL SELECT p_brand, round(base * 0.5, 6), CAST(used AS DOUBLE), 'grade hist' FROM b WHERE used > 0""",
)
def _c16(t):
    base = t.part.groupBy("p_brand").agg(
        F.min("p_retailprice").alias("base"),
        F.sum("p_size").alias("rsc"),
        F.coalesce(F.sum(F.when(F.col("p_type") == "PROMO", F.col("p_size"))), F.lit(0)).alias("used"),
    )
    graded = C.log_price_grades(base, ["p_brand"], "base", "rsc", "used", F.lit(0.3), 100.0, 5)
    history = base.where("used > 0").select(
        "p_brand",
        (F.col("base") * 0.5).alias("price"),
        F.col("used").cast("double").alias("available"),
        F.lit("grade hist").alias("grade"),
    )
    return graded.unionByName(history).select(
        "p_brand", F.round("price", 6).alias("price"), F.round("available", 6).alias("available"), "grade"
    )


@query(
    "c17_income_elasticity",
    f"""WITH {CY}, p AS (SELECT o_custkey, year, ln(value / lag(value) OVER w) AS u, ln(n_orders / lag(n_orders) OVER w) AS v FROM cy
          WINDOW w AS (PARTITION BY o_custkey ORDER BY year))
        SELECT o_custkey, year, round(CASE WHEN v = 0 THEN CASE WHEN u > 0 THEN 10 WHEN u < 0 THEN -10 END
          WHEN u / v > 10 THEN 10 WHEN u / v < -10 THEN -10 ELSE u / v END, 8) AS elasticity FROM p""",
)
def _c17(t):
    w = over(["o_custkey"])
    elasticity = C.log_elasticity(
        F.col("value"), F.lag("value").over(w), F.col("n_orders"), F.lag("n_orders").over(w)
    )
    return t.cy.select("o_custkey", "year", F.round(elasticity, 8).alias("elasticity"))


KNOTS = [(0.0, 0.9), (500000.0, 0.6), (1500000.0, 0.25), (4000000.0, 0.1)]


@query(
    "c18_parameter_by_income",
    """WITH i AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS y FROM orders GROUP BY 1)
       SELECT o_custkey, round(CASE WHEN y <= 500000 THEN 0.9 + (0.6 - 0.9) * y / 500000 WHEN y <= 1500000 THEN 0.6 + (0.25 - 0.6) * (y - 500000) / 1000000
         WHEN y <= 4000000 THEN 0.25 + (0.1 - 0.25) * (y - 1500000) / 2500000 END, 11) AS elasticity FROM i""",
)
def _c18(t):
    income = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("y"))
    return income.select("o_custkey", F.round(C.lookup_interpolated(F.col("y"), KNOTS), 11).alias("elasticity"))


@query(
    "c19_maximum_reduction",
    """WITH u AS (SELECT l_suppkey, p_brand, sum(l_extendedprice) / sum(l_quantity) AS cur FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
       b AS (SELECT p_brand, min(cur) AS best FROM u GROUP BY 1)
       SELECT l_suppkey, p_brand, round(least(100, greatest(0, 100 * (cur - best) / cur)), 6) AS reduction FROM u JOIN b USING (p_brand)""",
)
def _c19(t):
    units = (
        t.lineitem.groupBy("l_suppkey", F.col("l_partkey").alias("p_partkey"))
        .agg(F.sum("l_extendedprice").alias("v"), F.sum("l_quantity").alias("q"))
        .join(t.part.select("p_partkey", "p_brand"), "p_partkey")
        .groupBy("l_suppkey", "p_brand")
        .agg(ratio(F.sum("v"), F.sum("q")).alias("cur"))
    )
    rows = with_group(units, ["p_brand"], {"best": F.min("cur")})
    reduction = clamp(ratio(100 * (F.col("cur") - F.col("best")), "cur"), 0.0, 100.0)
    return rows.select("l_suppkey", "p_brand", F.round(reduction, 6).alias("reduction"))


@query(
    "c20_weighted_lifetime_by_bin",
    """WITH b AS (SELECT p_brand, CASE WHEN p_size <= 15 THEN 'young' WHEN p_size <= 35 THEN 'middle' ELSE 'old' END AS bin,
         sum(p_retailprice * (p_size - 5)) / sum(p_retailprice) AS life, sum(p_size) AS generation FROM part GROUP BY 1, 2)
       SELECT p_brand, bin, CASE WHEN round_even(life, 0) < 0 THEN 1 ELSE round_even(life, 0) + 0 END AS lifetime,
         round(generation / sum(generation) OVER (PARTITION BY p_brand), 9) AS share FROM b""",
)
def _c20(t):
    out = C.lifetimes_by_bin(t.part, ["p_brand"], "p_size", "p_retailprice", [0, 15, 35, 50], ["young", "middle", "old"], 5)
    return out.withColumn("share", F.round("share", 9))


@query(
    "c21_load_segment_coefficients",
    """WITH d AS (SELECT c_nationkey, sum(CASE o_orderpriority WHEN '1-URGENT' THEN o_totalprice END) / sum(o_totalprice) AS d1,
         sum(CASE o_orderpriority WHEN '2-HIGH' THEN o_totalprice END) / sum(o_totalprice) AS d2,
         sum(CASE o_orderpriority WHEN '3-MEDIUM' THEN o_totalprice END) / sum(o_totalprice) AS d3,
         sum(CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN o_totalprice END) / sum(o_totalprice) AS d4,
         count(CASE o_orderpriority WHEN '1-URGENT' THEN 1 END)::DOUBLE AS t1, count(CASE o_orderpriority WHEN '2-HIGH' THEN 1 END)::DOUBLE AS t2,
         count(CASE o_orderpriority WHEN '3-MEDIUM' THEN 1 END)::DOUBLE AS t3, count(CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 1 END)::DOUBLE AS t4
         FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
       b AS (SELECT *, d1 * t2 / t1 AS b2, d1 * t3 / t1 AS b3, d1 * t4 / t1 AS b4 FROM d),
       i AS (SELECT *, d2 - b2 AS i2, (d2 - b2) * t3 / t2 AS i3, (d2 - b2) * t4 / t2 AS i4 FROM b),
       s AS (SELECT *, d3 - b3 - i3 AS s3, (d3 - b3 - i3) * t4 / t3 AS s4 FROM i)
       SELECT c_nationkey, 'base' AS segment, 1.0::DOUBLE AS base, round(b2 / d2, 6) AS intermediate, round(b3 / d3, 6) AS subpeak, round(b4 / d4, 6) AS peak FROM s
       UNION ALL SELECT c_nationkey, 'intermediate', 0, round(i2 / d2, 6), round(i3 / d3, 6), round(i4 / d4, 6) FROM s
       UNION ALL SELECT c_nationkey, 'subpeak', 0, 0, round(s3 / d3, 6), round(s4 / d4, 6) FROM s
       UNION ALL SELECT c_nationkey, 'peak', 0, 0, 0, round((d4 - b4 - i4 - s4) / d4, 6) FROM s""",
)
def _c21(t):
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
    hit = lambda p: F.col("o_orderpriority") == p
    by_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum("o_totalprice").alias("all"),
        *[F.sum(F.when(hit(p), F.col("o_totalprice"))).alias(f"v{i}") for i, p in enumerate(names)],
        *[F.count(F.when(hit(p), 1)).alias(f"n{i}") for i, p in enumerate(names)],
    )
    nations = by_customer.join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey").groupBy("c_nationkey").agg(
        *[ratio(F.sum(f"v{i}"), F.sum("all")).alias(f"d{i}") for i in range(4)],
        *[F.sum(f"n{i}").cast("double").alias(f"t{i}") for i in range(4)],
    )
    segments = ["base", "intermediate", "subpeak", "peak"]
    out = C.stacked_segments(nations, [f"d{i}" for i in range(4)], [f"t{i}" for i in range(4)], segments)
    return out.select("c_nationkey", "segment", *[F.round(s, 6).alias(s) for s in segments])


@query(
    "c22_cap_at_group_maximum",
    """WITH u AS (SELECT s_nationkey, p_brand, l_suppkey, round(sum(l_extendedprice), 2) AS v, sum(l_quantity) AS q FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
         JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
       a AS (SELECT s_nationkey, p_brand, round(sum(v), 2) / sum(q) AS m FROM u GROUP BY 1, 2), c AS (SELECT p_brand, max(m) + 2 AS top FROM a GROUP BY 1)
       SELECT l_suppkey, p_brand, least(v / q, top) AS coef FROM u JOIN c USING (p_brand)""",
)
def _c22(t):
    units = (
        t.lineitem.groupBy("l_suppkey", F.col("l_partkey").alias("p_partkey"))
        .agg(F.sum("l_extendedprice").alias("v"), F.sum("l_quantity").alias("q"))
        .join(t.part.select("p_partkey", "p_brand"), "p_partkey")
        .groupBy("l_suppkey", "p_brand")
        .agg(F.round(F.sum("v"), 2).alias("v"), F.sum("q").alias("q"))
    )
    nation = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    top = (
        units.join(nation, "l_suppkey")
        .groupBy("s_nationkey", "p_brand")
        .agg(ratio(F.round(F.sum("v"), 2), F.sum("q")).alias("m"))
        .groupBy("p_brand")
        .agg((F.max("m") + 2).alias("top"))
    )
    rows = attach(units, top, ["p_brand"])
    return rows.select("l_suppkey", "p_brand", row_min(ratio("v", "q"), "top").alias("coef"))


@query(
    "c23_bracketed_mid_price",
    f"""WITH {RUN}, e AS (SELECT p_brand, max(total) AS m, min(price) AS base, max(price) FILTER (WHERE supply / total <= 0.5) AS a,
          arg_max(supply, price) FILTER (WHERE supply / total <= 0.5) AS q1, min(price) FILTER (WHERE supply / total >= 0.5) AS b,
          arg_min(supply, price) FILTER (WHERE supply / total >= 0.5) AS q2 FROM run GROUP BY 1),
        p AS (SELECT *, a - base AS p1, b - base AS p2 FROM e)
        SELECT p_brand, round(((p2 - p1) * m + 2 * q2 * p1 - 2 * q1 * p2) / nullif(2 * (q2 - q1), 0), 6) AS mid_price FROM p""",
)
def _c23(t):
    out = C.bracketed_mid_price(brand_curve(t), ["p_brand"], "p_retailprice", "supply")
    return out.withColumn("mid_price", F.round("mid_price", 6))


@query(
    "c24_global_regression_with_residual",
    f"""WITH {CY}, d AS (SELECT o_custkey, round(sum(value), 2) / 1e6 AS y, CAST(sum(n_orders) AS INTEGER) AS x FROM cy GROUP BY 1),
        m AS (SELECT regr_slope(y, x) AS b1, regr_intercept(y, x) AS b0, min(y) AS lo, max(y) AS hi FROM d)
        SELECT o_custkey, round(b0 + b1 * x, 8) AS fitted, round(y - (b0 + b1 * x), 8) AS residual, round(least(hi, greatest(lo, y)), 8) AS kept FROM d CROSS JOIN m""",
)
def _c24(t):
    rows = t.cy.groupBy("o_custkey").agg(
        (F.round(F.sum("value"), 2) / 1e6).alias("y"), F.sum("n_orders").cast("int").alias("x")
    )
    out = C.regression_with_residual(rows, "y", "x", "kept")
    return out.select("o_custkey", *[F.round(c, 8).alias(c) for c in ("fitted", "residual", "kept")])


@query(
    "c25_levelised_price_curve",
    """WITH p AS (SELECT p_type, p_size, round(((0.05 + 0.05 / (pow(1.05, 20) - 1)) * p_retailprice + 30) / (p_size / 100.0) / (24 * 365.25) / 3.6e-3, 6) AS price FROM part),
       g AS (SELECT p_type, price, sum(p_size) AS q FROM p GROUP BY 1, 2)
       SELECT p_type, price, CAST(sum(q) OVER (PARTITION BY p_type ORDER BY price) AS BIGINT) AS supply FROM g""",
)
def _c25(t):
    yearly = F.lit(fixed_charge_rate(0.05, 20)) * F.col("p_retailprice") + 30
    price = ratio(yearly, F.col("p_size") / 100.0) / UNIT_FACTORS["YEAR_HOURS"] / UNIT_FACTORS["KWH_GJ"]
    points = t.part.withColumn("price", F.round(price, 6))
    return C.supply_curve(points, ["p_type"], "price", "p_size").select("p_type", "price", "supply")
