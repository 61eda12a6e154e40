"""Queries for trade and supply-use balances."""

from pyspark.sql import functions as F

from panelweave.operators import balances as B
from panelweave.operators.joins import checked_join
from panelweave.plans.registry import query
from panelweave.plans.views import BILAT, SUA, YEARS
from panelweave.session import cut_lineage

CELL = ["area", "item", "year"]


def areas(t):
    return t.nation.select(F.col("n_nationkey").alias("area"), F.col("n_regionkey").alias("region"))


def item_flows(t):
    """Flows between two nations per item and year."""
    return t.flows.groupBy("s_nation", "c_nation", "item", "year").agg(F.sum("qty").alias("value")).select(
        F.col("s_nation").alias("area"), F.col("c_nation").alias("source"), "item", "year", "value"
    )


@query(
    "d8_gross_trade_balance",
    f"""WITH {SUA}, x AS (SELECT area, item, year, element, CASE WHEN element = 'Import' THEN value * 0.9 ELSE value END AS value FROM sua),
        w AS (SELECT item, year, sum(CASE WHEN element = 'Export' THEN value END) AS e, sum(CASE WHEN element = 'Import' THEN value END) AS i,
          sum(CASE WHEN element = 'Production' THEN value END) AS p FROM x GROUP BY 1, 2)
        SELECT area, item, year, element, round(CASE WHEN element = 'Export' THEN CASE WHEN e / p > 0.87 AND i / p > 0.87 THEN value * ((e + i) / 2 / e) ELSE 0 END
          WHEN element = 'Import' THEN CASE WHEN e / p > 0.87 AND i / p > 0.87 THEN value * ((e + i) / 2 / i) ELSE 0 END ELSE value END, 4) AS value
        FROM x JOIN w USING (item, year)""",
)
def _d8(t):
    rows = t.sua.withColumn(
        "value", F.when(B.element("Import"), F.col("value") * 0.9).otherwise(F.col("value"))
    )
    out = B.balance_gross_trade(rows, "area", ["item", "year"], min_ratio=0.87)
    return out.select(*CELL, "element", F.round("value", 4).alias("value"))


@query(
    "d9_export_within_production",
    f"""WITH {SUA}, x AS (SELECT area, item, year, element, CASE WHEN element = 'Export' THEN value * 1.2 ELSE value END AS value FROM sua),
        r AS (SELECT area, item, year, greatest(sum(CASE WHEN element = 'Production' THEN value ELSE 0 END) - sum(CASE WHEN element = 'Export' THEN value ELSE 0 END),
          -sum(CASE WHEN element = 'Import' THEN value ELSE 0 END)) AS d FROM x GROUP BY 1, 2, 3)
        SELECT area, item, year, element, round(sum(value), 4) AS value FROM (
          SELECT * FROM x UNION ALL SELECT area, item, year, 'Export', d FROM r WHERE d < 0 UNION ALL SELECT area, item, year, 'Import', d FROM r WHERE d < 0)
        GROUP BY 1, 2, 3, 4""",
)
def _d9(t):
    rows = t.sua.withColumn(
        "value", F.when(B.element("Export"), F.col("value") * 1.2).otherwise(F.col("value"))
    )
    return B.trim_excess_exports(rows, CELL).withColumn("value", F.round("value", 4))


@query(
    "d10_bilateral_reconciliation",
    f"""WITH {BILAT}, e AS (SELECT s_nation, c_nation, CAST(CASE WHEN s_nation % 5 = 0 THEN year + 100 ELSE year END AS INTEGER) AS year, value FROM bilat),
        i AS (SELECT s_nation, c_nation, year, value * 0.95 AS value FROM bilat),
        b AS (SELECT s_nation, c_nation, year, least(e.value, i.value) AS value FROM e FULL JOIN i USING (s_nation, c_nation, year))
        SELECT r.n_regionkey AS reporter, p.n_regionkey AS partner, year, round(sum(value), 6) AS value FROM b
        JOIN nation r ON s_nation = r.n_nationkey JOIN nation p ON c_nation = p.n_nationkey GROUP BY 1, 2, 3""",
)
def _d10(t):
    # a fifth of the exporters report under other years, so that either side has rows of its own
    year = F.when(F.col("s_nation") % 5 == 0, F.col("year") + 100).otherwise(F.col("year")).cast("int")
    bilat = cut_lineage(t.bilat)
    exports = bilat.select(F.col("s_nation").alias("from"), F.col("c_nation").alias("to"), year.alias("year"), "value")
    imports = bilat.select(
        F.col("c_nation").alias("from"), F.col("s_nation").alias("to"), "year", (F.col("value") * 0.95).alias("value")
    )
    both = B.reconcile_bilateral(exports, imports, "from", "to", ["year"])
    region = t.nation.select("n_nationkey", "n_regionkey")
    mapped = checked_join(both, region.withColumnRenamed("n_regionkey", "reporter"), {"from": "n_nationkey"})
    mapped = checked_join(mapped, region.withColumnRenamed("n_regionkey", "partner"), {"to": "n_nationkey"})
    return mapped.groupBy("reporter", "partner", "year").agg(F.round(F.sum("value"), 6).alias("value"))


REGIONAL = f"""{SUA}, agg AS (SELECT n_regionkey AS region, item, year, element, sum(value) AS value FROM sua JOIN nation ON area = n_nationkey GROUP BY 1, 2, 3, 4),
  intra AS (SELECT s.n_regionkey AS region, item, year, -sum(qty) AS value FROM flows JOIN nation s ON s_nation = s.n_nationkey
    JOIN nation c ON c_nation = c.n_nationkey WHERE s.n_regionkey = c.n_regionkey AND s_nation <> c_nation GROUP BY 1, 2, 3),
  net AS (SELECT region, item, year, element, round(agg.value + CASE WHEN element IN ('Export', 'Import') THEN coalesce(intra.value, 0) ELSE 0 END, 2) AS value
    FROM agg LEFT JOIN intra USING (region, item, year))"""


@query("d11_remove_intra_region_trade", f"WITH {REGIONAL} SELECT * FROM net WHERE value <> 0")
def _d11(t):
    t.keep_flows()
    crossing = item_flows(t).where("area <> source")
    sums = B.sum_elements(checked_join(t.sua, areas(t), ["area"]), ["region", "item", "year"])
    intra = B.intra_region_trade(crossing, areas(t), "area", "source", "region", ["item", "year"])
    out = B.remove_intra_region(sums, intra, ["region", "item", "year"])
    return out.withColumn("value", F.round("value", 2))


@query(
    "d12_net_to_gross_split",
    f"""WITH {BILAT}, n AS (SELECT nation, year, round(sum(v), 4) AS net FROM (SELECT s_nation AS nation, year, value AS v FROM bilat
          UNION ALL SELECT c_nation, year, -value FROM bilat) GROUP BY 1, 2)
        SELECT nation, year, greatest(0, -net) AS imports, greatest(0, net) AS exports FROM n""",
)
def _d12(t):
    signed = F.array(
        F.struct(F.col("s_nation").alias("nation"), F.col("value").alias("v")),
        F.struct(F.col("c_nation").alias("nation"), (-F.col("value")).alias("v")),
    )
    net = t.bilat.select("year", F.inline(signed)).groupBy("nation", "year").agg(F.round(F.sum("v"), 4).alias("net"))
    zero = F.lit(0.0)
    return net.select(
        "nation", "year", F.greatest(zero, -F.col("net")).alias("imports"), F.greatest(zero, F.col("net")).alias("exports")
    )


USES = "('Food', 'Feed', 'Processed', 'Other uses', 'Seed', 'Loss')"
SUPPLY = "('Opening stocks', 'Production', 'Import')"
DEMAND = "('Export', 'Feed', 'Food', 'Loss', 'Processed', 'Seed', 'Other uses', 'Closing stocks')"


def split_sql(table: str, keys: str, source: str, part: str, rest: str, name: str) -> str:
    """SQL for a balance split in two by the covered share of the uses."""
    total = lambda cond: f"coalesce(sum(CASE WHEN {cond} THEN value END) OVER (PARTITION BY {keys}), 0)"
    src = total(f"element = '{source}'")
    use = total(f"element IN {USES}")
    return f"""{name}_c AS (SELECT *, least(coalesce({src} / nullif({use}, 0), 0), 1) AS cov FROM {table}),
      {name}_f AS (SELECT *, CASE WHEN element = '{source}' THEN value WHEN element IN {USES} THEN value * cov ELSE 0 END AS part FROM {name}_c),
      {name}_u AS (SELECT {keys}, element, '{part}' AS bal_source, part AS value FROM {name}_f
        UNION ALL SELECT {keys}, element, '{rest}', value - part FROM {name}_f)"""


def rebalance_sql(table: str, keys: str, name: str, stocks: bool) -> str:
    """SQL for the supply, demand, residual and stock rows recomputed from a split balance."""
    names = "('Regional supply', 'Regional demand', 'Residuals'" + (", 'Stock Variation')" if stocks else ")")
    stock = f" UNION ALL SELECT {keys}, 'Stock Variation', bal_source, v FROM {name}_b" if stocks else ""
    return f"""{name}_b AS (SELECT {keys}, bal_source, coalesce(sum(CASE WHEN element IN {SUPPLY} THEN value END), 0) AS s,
        coalesce(sum(CASE WHEN element IN {DEMAND} THEN value END), 0) AS d,
        greatest(max(CASE WHEN element = 'Closing stocks' THEN value END), 0) - greatest(max(CASE WHEN element = 'Opening stocks' THEN value END), 0) AS v
        FROM {table} WHERE element IN {SUPPLY} OR element IN {DEMAND} GROUP BY {keys}, bal_source),
      {name} AS (SELECT {keys}, element, bal_source, value FROM {table} WHERE element NOT IN {names}
        UNION ALL SELECT {keys}, 'Regional supply', bal_source, s FROM {name}_b
        UNION ALL SELECT {keys}, 'Regional demand', bal_source, d FROM {name}_b
        UNION ALL SELECT {keys}, 'Residuals', bal_source, s - d FROM {name}_b{stock})"""


def balance_sql(table: str, keys: str, name: str, years: str | None = None) -> str:
    """SQL for the imported, lagged and current parts of the balances of a table.

    With ``years``, a list, the lagged and current parts get zeros in the years they lack.
    """
    split, filled = f"{name}_s_u", ""
    if years:
        ids = ", ".join(k for k in keys.split(", ") if k != "year")
        filled = f"""{name}_ids AS (SELECT DISTINCT {ids}, element, bal_source FROM {split}),
      {name}_all AS (SELECT {keys}, element, bal_source, sum(value) AS value FROM (SELECT {keys}, element, bal_source, value FROM {split}
        UNION ALL BY NAME SELECT {ids}, CAST(unnest({years}) AS INTEGER) AS year, element, bal_source, 0.0 AS value FROM {name}_ids) GROUP BY {keys}, element, bal_source),"""
        split = f"{name}_all"
    return f"""{split_sql(table, keys, 'Import', 'bal_import', 'bal_domestic', name + '_i')},
      {rebalance_sql(name + '_i_u', keys, name + '_imp', False)},
      {name}_dom AS (SELECT {keys}, element, value FROM {name}_imp WHERE bal_source = 'bal_domestic'),
      {split_sql(name + '_dom', keys, 'Opening stocks', 'bal_domestic_lag', 'bal_domestic_current', name + '_s')},
      {filled}
      {rebalance_sql(split, keys, name + '_stk', True)},
      {name} AS (SELECT * FROM {name}_stk UNION ALL SELECT * FROM {name}_imp WHERE bal_source = 'bal_import')"""


KEYS = "area, item, year"


@query(
    "d13_import_and_domestic_balance",
    f"""WITH {SUA}, {split_sql('sua', KEYS, 'Import', 'bal_import', 'bal_domestic', 'i')}, {rebalance_sql('i_u', KEYS, 'imp', False)}
        SELECT {KEYS}, element, bal_source, round(value, 4) + 0 AS value FROM imp""",
)
def _d13(t):
    out = B.import_balance(t.sua, CELL)
    return out.select(*CELL, "element", "bal_source", (F.round("value", 4) + 0).alias("value"))


@query(
    "d14_stock_balance",
    f"""WITH {SUA}, {balance_sql('sua', KEYS, 'bal', years='range(1995, 2002)')} SELECT {KEYS}, element, bal_source, round(value, 4) + 0 AS value FROM bal""",
)
def _d14(t):
    out = B.stock_balance(B.import_balance(t.sua, CELL), CELL, YEARS)
    return out.select(*CELL, "element", "bal_source", (F.round("value", 4) + 0).alias("value"))


# Product tree on the part types: sink, its tier, its source and the least rate.
TREE = [
    ("A", "MEDIUM", 1, "STANDARD", 0.6),
    ("A", "SMALL", 2, "MEDIUM", 0.9),
    ("A", "SMALL", 2, "STANDARD", 0.9),
    ("B", "LARGE", 1, "ECONOMY", 0.0),
    ("B", "PROMO", 1, "ECONOMY", 0.0),
]
# Output-specific rates by which items are scaled before their tier is folded.
OUTPUT_RATES = {"SMALL": 0.8, "PROMO": 1.25}
ITEM_TIERS = {"STANDARD": ("A", 0), "MEDIUM": ("A", 1), "SMALL": ("A", 2), "ECONOMY": ("B", 0), "LARGE": ("B", 1), "PROMO": ("B", 1)}


def primary_sql() -> str:
    items = ", ".join(f"('{i}', '{c}', {n})" for i, (c, n) in ITEM_TIERS.items())
    ctes = [
        SUA,
        f"items AS (SELECT * FROM (VALUES {items}) v(item, comm, tier))",
        "r3 AS (SELECT comm, item, tier, area, year, element, value FROM sua JOIN items USING (item))",
    ]
    rows = "r3"
    for tier in (2, 1):
        sources = sorted({s for _, _, n, s, _ in TREE if n == tier})
        src = "(" + ", ".join(f"'{s}'" for s in sources) + ")"
        lows = {}
        for c, _, n, _, low in TREE:
            if n == tier:
                lows[c] = max(low, lows.get(c, 0.0))
        low = "CASE comm " + " ".join(f"WHEN '{c}' THEN {v}" for c, v in lows.items()) + " ELSE 0 END"
        k = f"k{tier}"
        keys = "comm, item, area, year"
        scale = "CASE item " + " ".join(f"WHEN '{i}' THEN {v}" for i, v in OUTPUT_RATES.items()) + " ELSE 1 END"
        ctes.append(f"{k}_in AS (SELECT * REPLACE (CASE WHEN tier = {tier} THEN value / {scale} ELSE value END AS value) FROM {rows})")
        rows = f"{k}_in"
        ctes += [
            f"{k}_cur AS (SELECT comm, item, area, year, element, value FROM {rows} WHERE tier = {tier})",
            balance_sql(f"{k}_cur", keys, f"{k}_bal", years=f"(SELECT list(DISTINCT year) FROM {k}_cur)"),
            f"""{k}_cells AS (SELECT comm, area, year,
                coalesce(sum(CASE WHEN tier = {tier} AND element = 'Production' THEN value END), 0) AS pr,
                coalesce(sum(CASE WHEN tier = {tier} AND element = 'Export' THEN value END), 0) AS ex,
                coalesce(sum(CASE WHEN tier < {tier} AND element = 'Processed' AND item IN {src} THEN value END), 0) AS pc
              FROM {rows} WHERE tier <= {tier} GROUP BY 1, 2, 3)""",
            f"""{k}_rate AS (SELECT *, greatest(coalesce(nullif(pr / nullif(pc, 0), 0),
                nullif(sum(pr) OVER (PARTITION BY comm, year) / nullif(sum(pc) OVER (PARTITION BY comm, year), 0), 0), 1), {low}) AS rate FROM {k}_cells)""",
            f"""{k}_all AS (SELECT *, coalesce(sum(ex) OVER (PARTITION BY comm, year) / nullif(sum(ex / nullif(rate, 0)) OVER (PARTITION BY comm, year), 0), rate) AS traded,
                coalesce(lag(rate) OVER (PARTITION BY comm, area ORDER BY year), rate) AS lagged FROM {k}_rate)""",
            f"""{k}_sum AS (SELECT b.comm, b.area, b.year, b.element, sum(coalesce(b.value / CASE b.bal_source WHEN 'bal_import' THEN traded
                WHEN 'bal_domestic_lag' THEN lagged ELSE rate END, 0)) AS value FROM {k}_bal b LEFT JOIN {k}_all a
                ON a.comm = b.comm AND a.area = b.area AND a.year = b.year GROUP BY 1, 2, 3, 4)""",
            f"""{k}_share AS (SELECT comm, item, tier, sum(value) / sum(sum(value)) OVER (PARTITION BY comm) AS share FROM {rows}
                WHERE element = 'Processed' AND tier < {tier} AND item IN {src} GROUP BY 1, 2, 3)""",
            f"""{k}_fold AS (SELECT s.comm, h.item, h.tier, s.area, s.year, s.element, s.value * h.share AS value
                FROM {k}_sum s JOIN {k}_share h ON h.comm = s.comm)""",
            f"""{k}_out AS (SELECT comm, item, tier, area, year, element, sum(value) AS value FROM (
                SELECT * FROM {rows} WHERE tier <> {tier} UNION ALL SELECT * FROM {k}_fold
                UNION ALL SELECT comm, item, tier, area, year, 'Production', -value FROM {k}_fold WHERE element = 'Production'
                UNION ALL SELECT comm, item, tier, area, year, 'Processed', -value FROM {k}_fold WHERE element = 'Production')
                GROUP BY 1, 2, 3, 4, 5, 6)""",
        ]
        rows = f"{k}_out"
    ctes += [
        f"""fin AS (SELECT comm, area, year, element, sum(value) AS value FROM {rows}
            WHERE element NOT IN ('Regional supply', 'Regional demand', 'Residuals') GROUP BY 1, 2, 3, 4)""",
        f"""bal AS (SELECT comm, area, year, coalesce(sum(CASE WHEN element IN {SUPPLY} THEN value END), 0) AS s,
            coalesce(sum(CASE WHEN element IN {DEMAND} THEN value END), 0) AS d FROM fin GROUP BY 1, 2, 3)""",
    ]
    return f"""WITH {', '.join(ctes)} SELECT comm, area, year, element, round(value, 3) + 0 AS value FROM fin
      UNION ALL SELECT comm, area, year, 'Regional supply', round(s, 3) + 0 FROM bal
      UNION ALL SELECT comm, area, year, 'Regional demand', round(d, 3) + 0 FROM bal
      UNION ALL SELECT comm, area, year, 'Residuals', round(s - d, 3) + 0 FROM bal"""


@query("d15_primary_equivalent", primary_sql())
def _d15(t):
    tiers = t.spark.createDataFrame(
        [(i, c, n) for i, (c, n) in ITEM_TIERS.items()], "item string, comm string, tier int"
    )
    sinks = t.spark.createDataFrame(
        TREE, "comm string, sink_item string, sink_tier int, source_item string, min_rate double"
    )
    rows = checked_join(t.sua, tiers, ["item"])
    rates = t.spark.createDataFrame(list(OUTPUT_RATES.items()), "item string, rate double")
    out = B.primary_equivalent(rows, sinks, "area", [1, 2], cut=cut_lineage, output_rates=rates)
    done = B.final_balance(out, ["comm", "area", "year"])
    return done.select("comm", "area", "year", "element", (F.round("value", 3) + 0).alias("value"))


@query(
    "d16_regional_supply_use",
    f"""WITH {REGIONAL}, x AS (SELECT * FROM net WHERE value <> 0),
        r AS (SELECT region, item, year, greatest(sum(CASE WHEN element = 'Production' THEN value ELSE 0 END) - sum(CASE WHEN element = 'Export' THEN value ELSE 0 END),
          -sum(CASE WHEN element = 'Import' THEN value ELSE 0 END)) AS d FROM x GROUP BY 1, 2, 3)
        SELECT region, item, year, element, round(sum(value), 2) AS value FROM (SELECT * FROM x
          UNION ALL SELECT region, item, year, 'Export', d FROM r WHERE d < 0 UNION ALL SELECT region, item, year, 'Import', d FROM r WHERE d < 0)
        GROUP BY 1, 2, 3, 4""",
)
def _d16(t):
    t.keep_flows()
    crossing = item_flows(t).where("area <> source")
    out = B.regional_balance(t.sua, crossing, areas(t), "area", "source", "region", ["item", "year"])
    return out.withColumn("value", F.round("value", 2))
