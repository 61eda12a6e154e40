"""Trade and supply-use balances on long element tables.

Tables have an area, an item, a year, an ``element`` name and a ``value``.
The arithmetic between elements of one cell uses conditional sums, which is
one combining aggregate per step instead of a pivot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelweave.functions.semantics import raise_if, ratio, sum_where
from panelweave.operators.groups import attach, with_group, with_panel
from panelweave.operators.joins import checked_join, complete_panel, full_join, keep_matching

# Names of the balance elements.
SUPPLY = ("Opening stocks", "Production", "Import")
DEMAND = ("Export", "Feed", "Food", "Loss", "Processed", "Seed", "Other uses", "Closing stocks")
USES = ("Food", "Feed", "Processed", "Other uses", "Seed", "Loss")
BALANCE = ("Regional supply", "Regional demand", "Residuals")


def element(name: str) -> Column:
    return F.col("element") == F.lit(name)


def sum_elements(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys, "element").agg(F.sum("value").alias("value"))


def balance_gross_trade(
    df: DataFrame, area: str, group: Sequence[str], min_ratio: float = 0.01
) -> DataFrame:
    """Scale exports and imports of each group to their common world mean.

    Trade of a group is dropped to zero where world trade or production is
    zero or trade is too thin against production.
    """
    world = {
        "__e": sum_where(element("Export"), "value"),
        "__i": sum_where(element("Import"), "value"),
        "__p": sum_where(element("Production"), "value"),
    }
    rows = with_group(df, group, world)
    e, i, p = F.col("__e"), F.col("__i"), F.col("__p")
    kept = (e != 0) & (i != 0) & (p != 0) & (ratio(e, p) > min_ratio) & (ratio(i, p) > min_ratio)
    mean = (e + i) / F.lit(2.0)
    scaled = (
        F.when(element("Export"), F.when(kept, F.col("value") * ratio(mean, e)).otherwise(0.0))
        .when(element("Import"), F.when(kept, F.col("value") * ratio(mean, i)).otherwise(0.0))
        .otherwise(F.col("value"))
    )
    return rows.withColumn("value", scaled).drop("__e", "__i", "__p")


def trim_excess_exports(df: DataFrame, cell: Sequence[str]) -> DataFrame:
    """Take exports beyond production out of both exports and imports.

    The amount is limited to the imports, and only cells that report one of
    the three elements are concerned.
    """
    flows = ("Production", "Import", "Export")
    sums = df.where(F.col("element").isin(*flows)).groupBy(*cell).agg(
        *[sum_where(element(n), "value").alias(f"__{n}") for n in flows]
    )
    excess = F.greatest(F.col("__Production") - F.col("__Export"), -F.col("__Import"))
    removed = sums.withColumn("value", excess).where(F.col("value") < 0)
    both = removed.select(*cell, F.explode(F.array(F.lit("Export"), F.lit("Import"))).alias("element"), "value")
    return sum_elements(df.select(*cell, "element", "value").unionByName(both), cell)


def reconcile_bilateral(exports: DataFrame, imports: DataFrame, reporter: str, partner: str, keys: Sequence[str]) -> DataFrame:
    """One export flow per pair from both partners' reports.

    Imports are read as the partner's exports; where both report, the lower
    value stands, where one reports, that value.
    """
    mirrored = imports.select(
        F.col(partner).alias(reporter), F.col(reporter).alias(partner), *keys, F.col("value").alias("__mirror")
    )
    pair = [reporter, partner, *keys]
    both = full_join(exports.select(*pair, "value"), mirrored, pair)
    return both.select(*pair, F.least("value", "__mirror").alias("value")).where(F.col("value").isNotNull())


def intra_region_trade(flows: DataFrame, areas: DataFrame, area: str, source: str, region: str, keys: Sequence[str]) -> DataFrame:
    """Trade between areas of one region, as a negative amount per region."""
    to = checked_join(flows, areas.select(area, region), [area])
    frm = checked_join(
        to, areas.select(F.col(area).alias("__area"), F.col(region).alias("__source_region")), {source: "__area"}
    )
    inside = frm.where(F.col(region) == F.col("__source_region"))
    return inside.groupBy(region, *keys).agg((-F.sum("value")).alias("value"))


def remove_intra_region(sums: DataFrame, intra: DataFrame, cell: Sequence[str]) -> DataFrame:
    """Net intra-region trade out of existing export and import cells; cells that become zero go."""
    both = intra.select(
        *cell, F.explode(F.array(F.lit("Export"), F.lit("Import"))).alias("element"), F.col("value").alias("__intra")
    )
    netted = attach(sums, both, [*cell, "element"])
    return (
        netted.withColumn("value", F.col("value") + F.coalesce("__intra", F.lit(0.0)))
        .where(F.col("value") != 0)
        .drop("__intra")
    )


def regional_balance(
    df: DataFrame, flows: DataFrame, areas: DataFrame, area: str, source: str, region: str, keys: Sequence[str]
) -> DataFrame:
    """Area balances to regions: sum, net out intra-region trade, trim excess exports."""
    cell = [region, *keys]
    sums = sum_elements(checked_join(df, areas.select(area, region), [area]), cell)
    intra = intra_region_trade(flows, areas, area, source, region, keys)
    return trim_excess_exports(remove_intra_region(sums, intra, cell), cell)


def _split_by_share(df, cell, source, part, rest, uses):
    """Split a balance in two by the share of uses that ``source`` covers.

    A cell holds one row per element, so a window over it is small.
    """
    use = F.col("element").isin(*uses)
    rows = with_panel(
        df,
        cell,
        {
            "__source": F.sum(F.when(element(source), F.col("value"))),
            "__uses": F.sum(F.when(use, F.col("value"))),
        },
    ).fillna(0.0, ["__source", "__uses"])
    covered = F.least(ratio("__source", "__uses", 0), F.lit(1.0))
    residual = F.col("__source") - F.col("__uses") * covered
    first = (
        F.when(element(source), F.col("value"))
        .when(use, F.col("value") * covered)
        .when(element("Residuals"), residual)
        .otherwise(0.0)
    )
    split = rows.withColumn("__first", first)
    parts = F.array(
        F.struct(F.lit(part).alias("source"), F.col("__first").alias("value")),
        F.struct(F.lit(rest).alias("source"), (F.col("value") - F.col("__first")).alias("value")),
    )
    return split.withColumn("__part", F.explode(parts)).select(
        *cell, "element", F.col("__part")["source"].alias("bal_source"), F.col("__part")["value"].alias("value")
    )


def _rebalance(split: DataFrame, cell: Sequence[str], stocks: bool) -> DataFrame:
    """Recompute the supply, demand and residual rows of every balance.

    Every row gives itself and its part in the recomputed rows, which one sum
    brings together.
    """
    supply, demand = F.col("element").isin(*SUPPLY), F.col("element").isin(*DEMAND)
    names = [*BALANCE, *(["Stock Variation"] if stocks else [])]
    value, zero = F.col("value"), F.lit(0.0)
    given = F.when(supply, value).otherwise(zero)
    taken = F.when(demand, value).otherwise(zero)
    stored = (
        F.when(element("Closing stocks"), F.greatest(value, zero))
        .when(element("Opening stocks"), -F.greatest(value, zero))
        .otherwise(zero)
    )
    shares = {
        "Regional supply": given,
        "Regional demand": taken,
        "Residuals": given - taken,
        "Stock Variation": stored,
    }
    own = F.struct(F.col("element").alias("element"), value.alias("value"))
    fresh = [F.struct(F.lit(n).alias("element"), shares[n].alias("value")) for n in names]
    rows = F.when(supply | demand, F.array(own, *fresh)).otherwise(F.array(own))
    return (
        split.where(~F.col("element").isin(*names))
        .select(*cell, "bal_source", F.inline(rows))
        .groupBy(*cell, "element", "bal_source")
        .agg(F.sum("value").alias("value"))
    )


def import_balance(df: DataFrame, cell: Sequence[str]) -> DataFrame:
    """Split a balance into an imported and a domestic part.

    Uses are imported in the ratio of imports to uses, at most 1; imports
    beyond the uses stay in the residual.
    """
    return _rebalance(_split_by_share(df, cell, "Import", "bal_import", "bal_domestic", USES), cell, False)


def stock_balance(df: DataFrame, cell: Sequence[str], years: Sequence[int] | Column | None = None) -> DataFrame:
    """Split the domestic part further into opening stocks and current output.

    With ``years``, also as an array column, either part gets zeros in the years it lacks.
    """
    domestic = df.where(F.col("bal_source") == "bal_domestic").drop("bal_source")
    split = _split_by_share(domestic, cell, "Opening stocks", "bal_domestic_lag", "bal_domestic_current", USES)
    if years is not None:
        keys = [c for c in split.columns if c not in ("year", "value")]
        split = complete_panel(split, keys, "year", years, fill={"value": 0.0})
    imported = df.where(F.col("bal_source") == "bal_import")
    return _rebalance(split, cell, True).unionByName(imported)


def extraction_rates(
    df: DataFrame, sinks: DataFrame, area: str, tier: int, min_rate: str = "min_rate"
) -> DataFrame:
    """Sink output per unit of processed source, per commodity, area and year.

    ``df`` holds all tiers with ``comm``, ``item``, ``tier``; ``sinks`` maps a
    sink item to its source item. Every area and year that holds a commodity gets
    a rate; one without a usable rate of its own takes the world rate; traded goods take the export-weighted rate; the lagged rate is that
    of the preceding year. One row per commodity, area, year and balance part.
    """
    current = sinks.where(F.col("sink_tier") == tier)
    sources = current.select(F.col("source_item").alias("item")).distinct()
    low = current.groupBy("comm").agg(F.max(min_rate).alias("__low"))
    from_source = attach(df, sources.withColumn("__source", F.lit(True)), ["item"])
    processed = F.col("__source") & (F.col("tier") < tier) & element("Processed")
    made = lambda name: (F.col("tier") == tier) & element(name)
    both = from_source.where(F.col("tier") <= tier).groupBy("comm", area, "year").agg(
        sum_where(made("Production"), "value").alias("__Production"),
        sum_where(made("Export"), "value").alias("__Export"),
        sum_where(processed, "value").alias("__Processed"),
    )
    # From here on there is one row per commodity, area and year, so windows
    # over the areas of a year and the years of an area are small.
    cells = attach(both, low, ["comm"]).withColumn("__low", F.coalesce("__low", F.lit(0.0)))
    world = with_panel(cells, ["comm", "year"], {"__wm": F.sum("__Production"), "__wp": F.sum("__Processed")})
    usable = lambda r: F.when(r != 0, r)
    rate = F.coalesce(usable(ratio("__Production", "__Processed")), usable(ratio("__wm", "__wp")), F.lit(1.0))
    rated = world.withColumn("__rate", F.greatest(rate, F.col("__low")))
    traded = with_panel(
        rated,
        ["comm", "year"],
        {"__te": F.sum("__Export"), "__tq": F.sum(ratio("__Export", "__rate"))},
    )
    by_year = Window.partitionBy("comm", area).orderBy("year")
    all_rates = traded.withColumn("__lag", F.lag("__rate").over(by_year))
    parts = F.array(
        F.struct(F.lit("bal_import").alias("s"), F.coalesce(ratio("__te", "__tq"), F.col("__rate")).alias("r")),
        F.struct(F.lit("bal_domestic_lag").alias("s"), F.coalesce("__lag", "__rate").alias("r")),
        F.struct(F.lit("bal_domestic_current").alias("s"), F.col("__rate").alias("r")),
    )
    return all_rates.withColumn("__p", F.explode(parts)).select(
        "comm", area, "year", F.col("__p")["s"].alias("bal_source"), F.col("__p")["r"].alias("extraction_rate")
    )


def source_shares(df: DataFrame, sinks: DataFrame, area: str, tier: int) -> DataFrame:
    """Share of each source item in the processed use of its commodity, the same in all areas and years."""
    sources = sinks.where(F.col("sink_tier") == tier).select(F.col("source_item").alias("item")).distinct()
    processed = keep_matching(df.where(element("Processed") & (F.col("tier") < tier)), sources, ["item"])
    sums = processed.groupBy("comm", "item", "tier").agg(F.sum("value").alias("__v"))
    shares = with_group(sums, ["comm"], {"__t": F.sum("__v"), "__n": F.count(F.lit(1))})
    return shares.select(
        "comm",
        F.col("item").alias("source_item"),
        F.col("tier").alias("source_tier"),
        F.coalesce(ratio("__v", "__t"), F.lit(1.0) / F.col("__n")).alias("source_share"),
    )


def prescale(df: DataFrame, rates: DataFrame, tier: int) -> DataFrame:
    """Divide a tier's values by the output-specific rate of their item, where ``rates`` has one.

    ``rates`` holds ``item`` and ``rate``; two rows of one item fail the job, a
    rate of 0 gives 0.
    """
    one = rates.groupBy("item").agg(F.max("rate").alias("__rate"), F.count(F.lit(1)).alias("__n"))
    one = one.where(raise_if(F.col("__n") > 1, "several output rates of one item")).drop("__n")
    concerned = (F.col("tier") == tier) & F.col("__rate").isNotNull()
    scaled = F.when(concerned, ratio("value", "__rate", 0)).otherwise(F.col("value"))
    return attach(df, one, ["item"]).withColumn("value", scaled).drop("__rate")


def primary_equivalent(
    df: DataFrame, sinks: DataFrame, area: str, tiers: Sequence[int], cut=None, output_rates: DataFrame | None = None
) -> DataFrame:
    """Fold processed items into their sources, highest tier first.

    Each tier's values are divided by the output-specific rates, where
    ``output_rates`` has them, then its balances are split into imported, stock
    and current parts, with zeros in the tier's years that a part lacks. Parts are divided by the
    matching extraction rate and added to the source items in
    proportion to their processed use; the source's processed use drops by the
    sink's production. ``cut`` may materialise the input and the table between
    tiers, which are read several times; the last result is not.
    """
    rows = df.select("comm", "item", "tier", area, "year", "element", "value")
    if cut is not None:
        rows = cut(rows)
    cell = ["comm", "item", area, "year"]
    for tier in sorted(tiers, reverse=True):
        if output_rates is not None:
            rows = prescale(rows, output_rates, tier)
        current = rows.where(F.col("tier") == tier).drop("tier")
        years = current.agg(F.collect_set("year").alias("years")).scalar()
        parts = stock_balance(import_balance(current, cell), cell, years)
        rates = extraction_rates(rows, sinks, area, tier)
        scaled = attach(parts, rates, ["comm", area, "year", "bal_source"]).withColumn(
            "value", F.coalesce(ratio("value", "extraction_rate"), F.lit(0.0))
        )
        shares = source_shares(rows, sinks, area, tier)
        folded = (
            attach(
                scaled.groupBy("comm", area, "year", "element").agg(F.sum("value").alias("value")),
                shares,
                ["comm"],
                "inner",
            )
            .select(
                "comm",
                F.col("source_item").alias("item"),
                F.col("source_tier").alias("tier"),
                area,
                "year",
                "element",
                (F.col("value") * F.col("source_share")).alias("value"),
            )
        )
        # The sink's production is no production of the source; it takes the
        # place of part of the source's processed use.
        entry = lambda name, value: F.struct(name.alias("element"), value.alias("value"))
        moved = F.when(
            element("Production"),
            F.array(entry(F.col("element"), F.lit(0.0)), entry(F.lit("Processed"), -F.col("value"))),
        ).otherwise(F.array(entry(F.col("element"), F.col("value"))))
        rows = (
            rows.where(F.col("tier") != tier)
            .unionByName(folded.select("comm", "item", "tier", area, "year", F.inline(moved)))
            .groupBy("comm", "item", "tier", area, "year", "element")
            .agg(F.sum("value").alias("value"))
        )
        if cut is not None and tier != min(tiers):
            rows = cut(rows)
    return sum_elements(rows, ["comm", area, "year"])


def final_balance(df: DataFrame, cell: Sequence[str]) -> DataFrame:
    """Supply, demand and residual recomputed from the elements of each cell."""
    one = df.withColumn("bal_source", F.lit("all"))
    return _rebalance(one, cell, False).drop("bal_source")
