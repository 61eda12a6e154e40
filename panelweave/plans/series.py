"""Queries for operators on yearly series."""

from pyspark.sql import Window, functions as F

from panelweave.functions.semantics import clamp, ratio
from panelweave.functions.units import ModelTime
from panelweave.operators import timeseries as S
from panelweave.operators.groups import with_panel
from panelweave.operators.joins import replicate_values
from panelweave.operators.regions import scenario_variants, set_years
from panelweave.operators.reshape import stack_tables
from panelweave.plans.registry import query
from panelweave.plans.views import CY, GAPS, TS, YEARS
from panelweave.session import cut_lineage

NATION = "PARTITION BY n_nationkey ORDER BY year"


def interpolation(table: str, key: str, x: str = "year", y: str = "value", name: str = "interp") -> str:
    """SQL for the neighbours of every row and their count per key."""
    forward = f"PARTITION BY {key} ORDER BY {x} ROWS UNBOUNDED PRECEDING"
    backward = f"PARTITION BY {key} ORDER BY {x} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    return f"""{name} AS (SELECT *, count({y}) OVER (PARTITION BY {key}) AS known,
      max(CASE WHEN {y} IS NOT NULL THEN {x} END) OVER ({forward}) AS x0,
      last_value({y} IGNORE NULLS) OVER ({forward}) AS y0,
      min(CASE WHEN {y} IS NOT NULL THEN {x} END) OVER ({backward}) AS x1,
      first_value({y} IGNORE NULLS) OVER ({backward}) AS y1 FROM {table})"""


BETWEEN = "y0 + (y1 - y0) * coalesce((year - x0) / nullif(x1 - x0, 0)::DOUBLE, 0)"


@query(
    "t1_linear_interpolation_inside",
    f"""WITH {GAPS}, {interpolation('gaps', 'o_custkey')}
        SELECT o_custkey, year, CASE WHEN known >= 2 THEN round({BETWEEN}, 6) END AS value FROM interp""",
)
def _t1(t):
    return S.interpolate(t.gaps, ["o_custkey"]).select("o_custkey", "year", F.round("value", 6).alias("value"))


@query(
    "t2_linear_interpolation_flat_ends",
    f"""WITH {GAPS}, {interpolation('gaps', 'o_custkey')}
        SELECT o_custkey, year, CASE WHEN known >= 2 THEN round(coalesce({BETWEEN}, y0, y1), 6) END AS value FROM interp""",
)
def _t2(t):
    return S.interpolate(t.gaps, ["o_custkey"], rule=2).select("o_custkey", "year", F.round("value", 6).alias("value"))


@query(
    "t3_step_interpolation",
    f"""WITH {GAPS}, {interpolation('gaps', 'o_custkey')}
        SELECT o_custkey, year, CASE WHEN y1 IS NOT NULL THEN y0 END AS inside, coalesce(y0, y1) AS everywhere FROM interp""",
)
def _t3(t):
    both = S.interpolate_step(t.gaps, ["o_custkey"], out="inside")
    return S.interpolate_step(both, ["o_custkey"], rule=2, out="everywhere").select(
        "o_custkey", "year", "inside", "everywhere"
    )


GRID = [890.0, 905.0, 925.05, 950.0, 975.02, 999.0, 1010.0]


@query(
    "t4_interpolation_on_price_axis",
    f"""WITH p AS (SELECT p_brand, p_retailprice AS x, avg(p_size) AS y FROM part GROUP BY 1, 2),
        n AS (SELECT p_brand, g.q, max(x) FILTER (WHERE x <= q) AS x0, arg_max(y, x) FILTER (WHERE x <= q) AS y0,
          min(x) FILTER (WHERE x >= q) AS x1, arg_min(y, x) FILTER (WHERE x >= q) AS y1
          FROM p CROSS JOIN (SELECT unnest({GRID!r}::DOUBLE[]) AS q) g GROUP BY 1, 2)
        SELECT p_brand, q AS price, round(y0 + (y1 - y0) * coalesce((q - x0) / nullif(x1 - x0, 0), 0), 6) AS size FROM n""",
)
def _t4(t):
    points = t.part.select("p_brand", F.col("p_retailprice").alias("price"), F.col("p_size").alias("size"))
    return S.resample(points, ["p_brand"], "price", "size", GRID).withColumn("size", F.round("size", 6))


@query(
    "t5_extend_years_and_fill",
    f"""WITH {CY}, grid AS (SELECT o_custkey, y AS year, value FROM (SELECT DISTINCT o_custkey FROM cy)
          CROSS JOIN (SELECT CAST(unnest(range(1990, 2006)) AS INTEGER) AS y) LEFT JOIN (SELECT o_custkey, year AS y, value FROM cy) USING (o_custkey, y)),
        {interpolation('grid', 'o_custkey')}
        SELECT o_custkey, year, CASE WHEN known >= 2 THEN round(coalesce({BETWEEN}, y0, y1), 6) END AS value FROM interp""",
)
def _t5(t):
    out = S.extend(t.cy.select("o_custkey", "year", "value"), ["o_custkey"], range(1990, 2006), rule=2)
    return out.withColumn("value", F.round("value", 6))


OUT_YEARS = [1995, 1998, 2001, 2005, 2010]


@query(
    "t6_decay_extrapolation",
    f"""WITH {TS}, costs AS (SELECT n_regionkey, n_nationkey, 'NATION_' || n_nationkey AS technology, year,
          CASE WHEN value >= avg(value) OVER (PARTITION BY n_nationkey) THEN value / 1e6 END AS value,
          CASE WHEN n_nationkey >= 3 THEN 0.02 + n_nationkey / 1000.0 END AS r, CASE WHEN n_nationkey >= 3 THEN 0.5 END AS m,
          CASE WHEN n_nationkey >= 20 THEN 'NATION_' || (n_nationkey - 5) END AS shadow FROM ts),
        tech AS (SELECT DISTINCT n_regionkey, technology, r, m, shadow FROM costs),
        grid AS (SELECT tech.*, y.year, c.value FROM tech
          CROSS JOIN (SELECT DISTINCT CAST(u AS INTEGER) AS year FROM (SELECT unnest({OUT_YEARS!r}) AS u UNION ALL SELECT unnest(range(1995, 2002)))) y
          LEFT JOIN costs c ON c.technology = tech.technology AND c.year = y.year),
        {interpolation('grid', 'technology')},
        f AS (SELECT n_regionkey, technology, r, m, shadow, year, CASE WHEN known >= 2 THEN {BETWEEN} END AS value FROM interp),
        b AS (SELECT *, max(CASE WHEN value IS NOT NULL THEN year END) OVER (PARTITION BY technology) AS b0 FROM f),
        own AS (SELECT *, max(CASE WHEN year = b0 THEN value END) OVER (PARTITION BY technology) AS v0 FROM b WHERE shadow IS NULL),
        alone AS (SELECT n_regionkey, technology, year, r, CASE WHEN r IS NULL THEN value
          ELSE coalesce(value, v0 * m + (v0 - v0 * m) * pow(1 - r, year - b0)) END AS value FROM own),
        pair AS (SELECT b.*, a.value AS lead FROM b LEFT JOIN alone a ON a.technology = b.shadow AND a.year = b.year AND a.r IS NOT NULL
          WHERE b.shadow IS NOT NULL),
        diff AS (SELECT *, max(CASE WHEN year = b0 THEN value - lead END) OVER (PARTITION BY technology) AS v0 FROM pair),
        both_kinds AS (SELECT n_regionkey, technology, year, value FROM alone UNION ALL
          SELECT n_regionkey, technology, year, coalesce(value, lead + v0 * m + (v0 - v0 * m) * pow(1 - r, year - b0)) FROM diff)
        SELECT n_regionkey, technology, year, round(value, 8) AS value FROM both_kinds WHERE year IN ({', '.join(map(str, OUT_YEARS))})""",
)
def _t6(t):
    rows = with_panel(t.ts, ["n_nationkey"], {"mean": F.avg("value")})
    given = F.col("n_nationkey") >= 3
    costs = rows.select(
        "n_regionkey",
        F.concat(F.lit("NATION_"), F.col("n_nationkey").cast("string")).alias("technology"),
        "year",
        F.when(F.col("value") >= F.col("mean"), F.col("value") / 1e6).alias("value"),
        F.when(given, F.lit(0.02) + F.col("n_nationkey") / 1000.0).alias("improvement_rate"),
        F.when(given, F.lit(0.5)).alias("improvement_max"),
        F.when(
            F.col("n_nationkey") >= 20, F.concat(F.lit("NATION_"), (F.col("n_nationkey") - 5).cast("string"))
        ).alias("improvement_shadow_technology"),
    )
    return S.decay_extrapolate(costs, ["n_regionkey"], OUT_YEARS).withColumn("value", F.round("value", 8))


@query(
    "t7_series_grafting",
    f"""WITH {TS}, s AS (SELECT * FROM (VALUES ('high', 1.1), ('low', 0.9)) s(scenario, g)),
        future AS (SELECT scenario, n_nationkey, year, value * pow(g, year - 1998) AS value FROM ts CROSS JOIN s WHERE year >= 1998),
        past AS (SELECT n_nationkey, year, value FROM ts WHERE year <= 1998),
        ratio AS (SELECT f.scenario, f.n_nationkey, f.year, f.value / b.value AS g FROM future f
          JOIN future b ON b.scenario = f.scenario AND b.n_nationkey = f.n_nationkey AND b.year = 1998 WHERE f.year > 1998)
        SELECT scenario, n_nationkey, year, round(value, 4) AS value FROM past CROSS JOIN (SELECT scenario FROM s)
        UNION ALL SELECT scenario, r.n_nationkey, r.year, round(p.value * g, 4) FROM ratio r JOIN past p ON p.n_nationkey = r.n_nationkey AND p.year = 1998""",
)
def _t7(t):
    series = t.ts.select("n_nationkey", "year", "value")
    growth = F.pow(F.col("g"), F.col("year") - 1998)
    variants = scenario_variants(series.where("year >= 1998").withColumn("g", F.lit(1.0)), {"high": 1.1, "low": 0.9}, "g")
    future = variants.select("scenario", "n_nationkey", "year", (F.col("value") * growth).alias("value"))
    past = series.where("year <= 1998")
    return S.graft(past, future, ["n_nationkey"]).withColumn("value", F.round("value", 4))


@query(
    "t8_copy_year",
    f"""WITH {CY} SELECT o_custkey, year, value FROM cy
        UNION ALL SELECT o_custkey, y.year, value FROM cy CROSS JOIN (VALUES (2005), (2010)) y(year) WHERE cy.year = 2001
        UNION ALL SELECT o_custkey, 1990, value FROM cy WHERE year = 1995""",
)
def _t8(t):
    series = t.cy.select("o_custkey", "year", "value")
    return S.copy_year(S.copy_year(series, 2001, [2005, 2010]), 1995, [1990])


@query(
    "t9_growth_rates_to_index",
    f"""WITH {TS}, g AS (SELECT n_nationkey, year, coalesce(100 * (value / lag(value) OVER ({NATION}) - 1), 0) AS rate FROM ts)
        SELECT n_nationkey, year, round(product(1 + rate / 100) OVER ({NATION}), 8) AS idx FROM g""",
)
def _t9(t):
    before = F.lag("value").over(S.over(["n_nationkey"]))
    rates = t.ts.withColumn("rate", F.coalesce((ratio("value", before) - 1) * 100, F.lit(0.0)))
    out = S.cumulative_product(rates.withColumn("f", 1 + F.col("rate") / 100), ["n_nationkey"], "f", "idx")
    return out.select("n_nationkey", "year", F.round("idx", 8).alias("idx"))


@query(
    "t10_step_length_compounding",
    f"""WITH {CY}, f AS (SELECT o_custkey, year, coalesce(pow(1 + n_orders / 100.0, year - lag(year) OVER w), 1) AS f
          FROM cy WINDOW w AS (PARTITION BY o_custkey ORDER BY year)),
        c AS (SELECT o_custkey, year, product(f) OVER (PARTITION BY o_custkey ORDER BY year) AS c FROM f)
        SELECT o_custkey, year, round(c / last_value(c) OVER (PARTITION BY o_custkey ORDER BY year
          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 9) AS level FROM c""",
)
def _t10(t):
    step = F.col("year") - F.lag("year").over(S.over(["o_custkey"]))
    factors = t.cy.withColumn("f", F.coalesce(F.pow(1 + F.col("n_orders") / 100.0, step), F.lit(1.0)))
    run = S.cumulative_product(factors, ["o_custkey"], "f", "c")
    based = with_panel(run, ["o_custkey"], {"base": F.max_by("c", "year")})
    return based.select("o_custkey", "year", F.round(ratio("c", "base"), 9).alias("level"))


@query(
    "t11_annualised_rate",
    f"""WITH {CY} SELECT o_custkey, year, round(pow(value / lag(value) OVER w, 1.0 / (year - lag(year) OVER w)) - 1, 8) AS rate
        FROM cy WINDOW w AS (PARTITION BY o_custkey ORDER BY year)""",
)
def _t11(t):
    rows = S.annualised_rate(t.cy, ["o_custkey"], "value", "rate")
    return rows.select("o_custkey", "year", F.round("rate", 8).alias("rate"))


@query(
    "t12_non_increasing_scaler",
    f"""WITH {TS}, f AS (SELECT n_nationkey, year, least(1, value / lag(value) OVER ({NATION})) AS f FROM ts)
        SELECT n_nationkey, year, round(product(f) OVER ({NATION}), 9) AS scaler FROM f WHERE year > 1995""",
)
def _t12(t):
    before = F.lag("value").over(S.over(["n_nationkey"]))
    factors = t.ts.withColumn("f", clamp(ratio("value", before), high=1.0)).where("year > 1995")
    return S.cumulative_product(factors, ["n_nationkey"], "f", "scaler").select(
        "n_nationkey", "year", F.round("scaler", 9).alias("scaler")
    )


@query(
    "t13_backcast_dissolved_parent",
    f"""WITH {TS}, parent AS (SELECT n_regionkey, year, sum(value) AS value FROM ts WHERE year < 1998 GROUP BY 1, 2),
        later AS (SELECT n_regionkey, n_nationkey, sum(value) AS v FROM ts WHERE year BETWEEN 1998 AND 2000 GROUP BY 1, 2)
        SELECT n_regionkey, 'N' || n_nationkey AS area, year, round(value, 4) AS value FROM ts WHERE year >= 1998
        UNION ALL SELECT p.n_regionkey, 'N' || n_nationkey, p.year, round(p.value * l.v / sum(l.v) OVER (PARTITION BY p.n_regionkey, p.year), 4)
        FROM parent p JOIN later l ON l.n_regionkey = p.n_regionkey""",
)
def _t13(t):
    rows = dissolved(cut_lineage(t.ts))
    out = S.backcast_parent(rows, F.col("area").startswith("R"), 1998, ["n_regionkey"], "area", account_years=2)
    return out.withColumn("value", F.round("value", 4))


def dissolved(ts):
    """Whole regions until 1997, their nations from 1998."""
    whole = ts.where("year < 1998").groupBy("n_regionkey", "year").agg(F.sum("value").alias("value"))
    parents = whole.select("n_regionkey", F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("area"), "year", "value")
    members = ts.where("year >= 1998").select(
        "n_regionkey", F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("area"), "year", "value"
    )
    return parents.unionByName(members)


@query(
    "t13_backcast_by_split_year_ratio",
    f"""WITH {TS}, r AS (SELECT n_regionkey, year, sum(value) AS v FROM ts WHERE year <= 1998 GROUP BY 1, 2),
        f AS (SELECT n_regionkey, year, v / max(CASE WHEN year = 1998 THEN v END) OVER (PARTITION BY n_regionkey) AS f FROM r)
        SELECT n_regionkey, 'N' || n_nationkey AS area, year, round(value, 4) AS value FROM ts WHERE year >= 1998
        UNION ALL SELECT t.n_regionkey, 'N' || n_nationkey, f.year, round(t.value * f.f, 4) FROM ts t JOIN f USING (n_regionkey) WHERE t.year = 1998 AND f.year < 1998""",
)
def _t13_ratio(t):
    rows = dissolved(cut_lineage(t.ts))
    out = S.backcast_by_ratio(rows, F.col("area").startswith("R"), 1998, ["n_regionkey"], "area")
    return out.withColumn("value", F.round("value", 4))


@query(
    "t13_backcast_many_splits",
    f"""WITH {TS}, ends AS (SELECT r_regionkey AS n_regionkey, 1997 + (r_regionkey // 3) AS y FROM region),
        rows AS (SELECT ts.* FROM ts JOIN ends USING (n_regionkey) WHERE year >= y),
        past AS (SELECT n_regionkey, year, sum(value) AS v FROM ts JOIN ends USING (n_regionkey) WHERE year < y GROUP BY 1, 2),
        sh AS (SELECT n_regionkey, n_nationkey, sum(value) AS s FROM ts JOIN ends USING (n_regionkey) WHERE year BETWEEN y AND y + 2 GROUP BY 1, 2),
        u AS (SELECT n_nationkey, year, value FROM rows UNION ALL
          SELECT n_nationkey, past.year, v * s / sum(s) OVER (PARTITION BY n_regionkey, past.year) FROM past JOIN sh USING (n_regionkey))
        SELECT CASE WHEN n_nationkey = 24 THEN 'N23' ELSE 'N' || n_nationkey END AS area, year, round(sum(value), 4) AS value FROM u GROUP BY 1, 2""",
)
def _t13_many(t):
    ts = cut_lineage(t.ts)
    split_year = (F.lit(1997) + F.floor(F.col("n_regionkey") / 3)).cast("int")
    name = lambda prefix, key: F.concat(F.lit(prefix), F.col(key).cast("string"))
    splits = t.nation.select(
        name("R", "n_regionkey").alias("parent"), name("N", "n_nationkey").alias("part"), split_year.alias("split_year")
    )
    dated = ts.withColumn("split_year", split_year)
    parents = (
        dated.where("year < split_year")
        .groupBy(name("R", "n_regionkey").alias("area"), "year")
        .agg(F.sum("value").alias("value"))
    )
    members = dated.where("year >= split_year").select(name("N", "n_nationkey").alias("area"), "year", "value")
    merges = t.spark.createDataFrame([("N24", "N23")], "part string, whole string")
    out = S.backcast_splits(parents.unionByName(members), splits, [], "area", account_years=2, merges=merges)
    return out.withColumn("value", F.round("value", 4))


def backfill_sql() -> str:
    steps = []
    prev = "base"
    for y in YEARS[-2::-1]:
        cols = ", ".join(
            f"CASE WHEN v{y} IS NULL THEN v{y + 1} * (t{y} - sum(coalesce(v{y}, 0)) OVER g)"
            f" / sum(CASE WHEN v{y} IS NULL THEN v{y + 1} END) OVER g ELSE v{y} END AS v{y}"
            if x == y
            else f"v{x}"
            for x in YEARS
        )
        totals = ", ".join(f"t{x}" for x in YEARS)
        steps.append(f"s{y} AS (SELECT c_nationkey, o_custkey, {cols}, {totals} FROM {prev} WINDOW g AS (PARTITION BY c_nationkey))")
        prev = f"s{y}"
    rows = " UNION ALL ".join(f"SELECT c_nationkey, o_custkey, {y} AS year, round(v{y}, 4) AS value FROM {prev}" for y in YEARS)
    values = ", ".join(f"max(CASE WHEN year = {y} THEN value END) AS v{y}" for y in YEARS)
    limits = ", ".join(f"1.25 * sum(CASE WHEN year = {y} THEN value END) AS t{y}" for y in YEARS)
    return f"""WITH {CY}, m AS (SELECT c_nationkey, cy.* FROM cy JOIN customer ON o_custkey = c_custkey),
      w AS (SELECT c_nationkey, o_custkey, {values} FROM m GROUP BY 1, 2),
      l AS (SELECT c_nationkey, {limits} FROM m GROUP BY 1),
      base AS (SELECT * FROM w JOIN l USING (c_nationkey)), {', '.join(steps)} {rows}"""


@query("t14_sequential_backfill_from_total", backfill_sql())
def _t14(t):
    who = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    members = t.cy.select("o_custkey", "year", "value").join(who, "o_custkey")
    totals = members.groupBy("c_nationkey", "year").agg((F.sum("value") * 1.25).alias("value"))
    out = S.fill_members_from_total(members, totals, ["c_nationkey"], ["o_custkey"], YEARS)
    return out.withColumn("value", F.round("value", 4))


@query(
    "t15_symbolic_year_tokens",
    """SELECT o_orderpriority, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 1975 WHEN 'O' THEN 2015 END AS from_year,
       CASE WHEN o_orderstatus = 'P' THEN 2100 ELSE 2000 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS to_year, count(*) AS n
       FROM orders GROUP BY 1, 2""",
)
def _t15(t):
    status = F.col("o_orderstatus")
    rows = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n")).select(
        "o_orderpriority",
        "o_orderstatus",
        F.when(status == "F", "start-year").when(status == "O", "final-calibration-year").otherwise("none").alias("from_year"),
        F.when(status == "P", "end-year")
        .otherwise(F.concat(F.lit("200"), F.substring("o_orderpriority", 1, 1)))
        .alias("to_year"),
        "n",
    )
    return set_years(rows, ["from_year", "to_year"])


@query(
    "t16_vintage_additions",
    f"""WITH {CY}, w AS (SELECT o_custkey, coalesce(max(CASE WHEN year = 1995 THEN value END), 0) AS a,
          coalesce(max(CASE WHEN year = 1997 THEN value END), 0) AS b, coalesce(max(CASE WHEN year = 2001 THEN value END), 0) AS c
          FROM cy GROUP BY 1),
        x AS (SELECT *, greatest(b - a, 0) AS nb FROM w), y AS (SELECT *, greatest(c - 0.75 * a - 0.25 * nb, 0) AS nc FROM x)
        SELECT o_custkey, 1995 AS year, a AS value, round(a, 4) AS additions FROM y
        UNION ALL SELECT o_custkey, 1997, b, round(nb, 4) FROM y UNION ALL SELECT o_custkey, 2001, c, round(nc, 4) FROM y""",
)
def _t16(t):
    periods = [1995, 1997, 2001]
    series = t.gaps.fillna(0.0, ["value"]).where(F.col("year").isin(periods))
    out = S.vintage_additions(series, ["o_custkey"], periods, lifetime=5, first_step=2)
    return out.withColumn("additions", F.round("additions", 4))


@query(
    "t17_model_clock",
    f"""WITH {CY}, d AS (SELECT year, count(*) AS keys, round(sum(value), 2) AS value FROM cy GROUP BY 1)
        SELECT year, keys, value, coalesce(year - lag(year) OVER (ORDER BY year), 15) AS timestep,
        CASE WHEN year <= 1998 THEN 'history' ELSE 'future' END AS period FROM d""",
)
def _t17(t):
    clock = ModelTime(base_years=tuple(YEARS[:4]), future_years=tuple(YEARS[4:]))
    yearly = t.cy.groupBy("year").agg(F.count(F.lit(1)).alias("keys"), F.round(F.sum("value"), 2).alias("value"))
    # One row per year, so the window without a partition key stays tiny.
    step = F.col("year") - F.lag("year").over(Window.orderBy("year"))
    return yearly.select(
        "year",
        "keys",
        "value",
        F.coalesce(step, F.lit(clock.first_timestep)).alias("timestep"),
        F.when(F.col("year").isin(list(clock.base_years)), "history").otherwise("future").alias("period"),
    )


@query(
    "t18_control_start_and_end",
    f"""WITH {CY}, c AS (SELECT o_custkey, min(year) AS start_year, CAST(sum(n_orders) AS INTEGER) AS lifetime, max(year) AS last_year FROM cy GROUP BY 1)
        SELECT o_custkey, start_year, start_year + lifetime AS end_year, least(last_year + 1, 2001) AS off_year, lifetime > 10 AS lasting FROM c""",
)
def _t18(t):
    clock = ModelTime(base_years=tuple(YEARS[:4]), future_years=tuple(YEARS[4:]))
    rules = t.cy.groupBy("o_custkey").agg(
        F.min("year").alias("start_year"), F.sum("n_orders").cast("int").alias("lifetime"), F.max("year").alias("last")
    )
    return S.control_years(rules, ["o_custkey"], "start_year", "lifetime", "last", clock)


def recurrence_sql() -> str:
    wide = ", ".join(f"max(CASE WHEN year = {y} THEN g END) AS g{y}" for y in YEARS)
    steps, prev = ["r1995 AS (SELECT *, 0.2 AS x1995 FROM w)"], "r1995"
    for y in YEARS[1:]:
        steps.append(
            f"r{y} AS (SELECT *, CASE WHEN g{y} IS NULL THEN 0.15 ELSE 0.04 + 0.01 * g{y} + 0.6 * x{y - 1} END AS x{y} FROM {prev})"
        )
        prev = f"r{y}"
    rows = " UNION ALL ".join(f"SELECT o_custkey, {y} AS year, round(x{y}, 9) AS savings FROM {prev}" for y in YEARS)
    return f"""WITH {GAPS}, gr AS (SELECT o_custkey, year, value / lag(value) OVER (PARTITION BY o_custkey ORDER BY year) - 1 AS g FROM gaps),
      w AS (SELECT o_custkey, {wide} FROM gr GROUP BY 1), {', '.join(steps)} {rows}"""


@query("t19_autoregressive_recurrence", recurrence_sql())
def _t19(t):
    before = F.lag("value").over(S.over(["o_custkey"]))
    rows = t.gaps.select("o_custkey", "year", (ratio("value", before) - 1).alias("g"))

    def step(last, row):
        usual = F.lit(0.04) + F.lit(0.01) * row["g"] + F.lit(0.6) * last
        return F.when(row["year"] == YEARS[0], F.lit(0.2)).when(row["g"].isNotNull() & last.isNotNull(), usual).otherwise(0.15)

    out = S.fold_years(rows, ["o_custkey"], ["g"], F.lit(0.2), step, "savings")
    return out.select("o_custkey", "year", F.round("savings", 9).alias("savings"))


@query(
    "t20_guard_against_decline",
    f"""WITH {TS}, a AS (SELECT n_nationkey, max(CASE WHEN year = 1995 THEN value END) AS v0, max(CASE WHEN year = 1998 THEN value END) AS v1,
          max(CASE WHEN year = 2000 THEN value END) AS v2 FROM ts GROUP BY 1)
        SELECT n_nationkey, year, round(CASE WHEN year = 1998 AND v1 < v0 THEN v0
          WHEN year = 2000 AND v2 < v0 THEN greatest(v0, v1 + (v1 - v0) * 2 / 3) ELSE value END, 4) AS value FROM ts JOIN a USING (n_nationkey)""",
)
def _t20(t):
    rows = S.guard_decline(t.ts, ["n_nationkey"], "value", 1995, 1998, 2000)
    return rows.select("n_nationkey", "year", F.round("value", 4).alias("value"))


@query(
    "t21_mean_carried_forward",
    f"""WITH {CY} SELECT o_custkey, year, round(value, 8) AS value FROM cy UNION ALL SELECT o_custkey, y.year, round(m, 8) FROM
        (SELECT o_custkey, avg(value) AS m FROM cy GROUP BY 1) CROSS JOIN (VALUES (2005), (2010)) y(year)""",
)
def _t21(t):
    means = t.cy.groupBy("o_custkey").agg(F.avg("value").alias("value"))
    future = replicate_values(means, "year", [2005, 2010])
    out = stack_tables([t.cy.select("o_custkey", "year", "value"), future])
    return out.withColumn("value", F.round("value", 8))


@query(
    "t22_first_active_year_as_base",
    f"""WITH {CY}, b AS (SELECT o_custkey, min(year) AS y0, arg_min(value, year) AS v0 FROM cy WHERE value > 0 GROUP BY 1)
        SELECT o_custkey, y0 AS base_year, year, round(least(0.5, greatest(-0.5, pow(value / v0, 1.0 / (year - y0)) - 1)), 8) AS rate
        FROM cy JOIN b USING (o_custkey) WHERE year > y0""",
)
def _t22(t):
    rows = S.rate_from_first_active(t.cy, ["o_custkey"], "value", "rate", -0.5, 0.5)
    return rows.select("o_custkey", "base_year", "year", F.round("rate", 8).alias("rate"))


@query(
    "t23_compound_decline_with_floor",
    f"""WITH {TS}, b AS (SELECT n_nationkey, value AS v0 FROM ts WHERE year = 1995)
        SELECT n_nationkey, y.year, round(greatest(v0 * (1 - 0.15), v0 * pow(1 + (pow(1 - n_nationkey / 100.0, 1.0 / 6) - 1), y.year - 1995)), 4) AS cost
        FROM b CROSS JOIN (SELECT CAST(unnest(range(1995, 2006)) AS INTEGER) AS year) y""",
)
def _t23(t):
    base = t.ts.where("year = 1995").select("n_nationkey", F.col("value").alias("v0"))
    total = F.col("n_nationkey") / 100.0
    rows = S.decline_with_floor(base, "v0", total, 6, 0.15, range(1995, 2006), "cost")
    return rows.select("n_nationkey", "year", F.round("cost", 4).alias("cost"))
