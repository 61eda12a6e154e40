"""Write-out to regions and scenarios, naming, overrides and hierarchies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelweave.functions.semantics import paste
from panelweave.functions.units import ModelTime
from panelweave.operators.groups import attach, first_rows, with_group
from panelweave.operators.joins import drop_matching, keep_matching, override_rows, replicate, replicate_values
from panelweave.session import cut_lineage


def set_years(df: DataFrame, columns: Sequence[str], clock: ModelTime = ModelTime()) -> DataFrame:
    """Year words in the named columns to numbers; other text that is no number becomes null."""
    return df.withColumns({c: clock.year_number(F.col(c)) for c in columns})


def set_traded_names(df: DataFrame, traded: Column | None, home: str, columns: Sequence[str]) -> DataFrame:
    """Prefix the region to names of traded rows and move those rows to the home region."""
    chosen = F.lit(True) if traded is None else F.coalesce(traded, F.lit(False))
    names = {c: F.when(chosen, paste("region", c)).otherwise(F.col(c)) for c in columns}
    return df.withColumns(names).withColumn("region", F.when(chosen, F.lit(home)).otherwise(F.col("region")))


def write_to_regions(
    df: DataFrame,
    regions: DataFrame,
    columns: Sequence[str],
    year_columns: Sequence[str] = (),
    market: str | None = None,
    traded: Column | None = None,
    home: str | None = None,
    traded_columns: Sequence[str] = (),
) -> DataFrame:
    """Repeat rows for every region, set the market to the region, and rename traded goods."""
    out = replicate(set_years(df, year_columns), regions)
    if market:
        out = out.withColumn(market, F.col("region"))
    if home is not None:
        out = set_traded_names(out, traded, home, traded_columns)
    return out.select(*columns)


def write_to_members(df: DataFrame, members: DataFrame, columns: Sequence[str], region: str = "region") -> DataFrame:
    """Repeat national rows for every sub-region in place of their region."""
    return replicate(df.drop(region), members).select(*columns)


def share_weight(df: DataFrame, keys: Sequence[str], value: str, out: str = "share_weight") -> DataFrame:
    """1 where the group has positive output, else 0."""
    rows = with_group(df, keys, {"__sum": F.sum(value)})
    return rows.withColumn(out, F.when(F.col("__sum") > 0, 1).otherwise(0)).drop("__sum")


def node_names(
    df: DataFrame,
    nesting: DataFrame,
    leaf: str,
    levels: Sequence[str],
    kind: str,
    zone: str | None = None,
    suffix: str | None = None,
    delimiter: str = "_",
) -> DataFrame:
    """Hierarchy columns from a nesting table; zone and suffix are appended to the names."""
    picked = first_rows(nesting.select(leaf, *levels), [leaf], list(levels)).withColumnRenamed(leaf, kind)
    out = attach(df, picked, [kind]).withColumn("root", F.lit("root")).withColumn(leaf, F.col(kind))
    if zone:
        out = out.withColumns({c: paste(c, zone, sep=delimiter) for c in [leaf, *levels]})
    if suffix:
        out = out.withColumn(leaf, paste(leaf, suffix, sep=delimiter))
    return out


def income_group(value: Column, low: float, high: float) -> Column:
    """Strictly below, strictly between or strictly above two thresholds; null on a threshold."""
    return (
        F.when(value < low, F.lit("low"))
        .when((value > low) & (value < high), F.lit("medium"))
        .when(value > high, F.lit("high"))
    )


def scenario_variants(df: DataFrame, multipliers: Mapping[str, float], value: str, scenario: str = "scenario") -> DataFrame:
    """Every row once per scenario with its multiplier applied."""
    pairs = F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(float(m)).alias("factor")) for n, m in multipliers.items()]
    )
    return (
        df.withColumn("__s", F.explode(pairs))
        .withColumn(scenario, F.col("__s")["name"])
        .withColumn(value, F.col(value) * F.col("__s")["factor"])
        .drop("__s")
    )


def overlay(base: DataFrame, override: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A user's rows replace base rows of the same key and add new keys; lacking columns keep the base value."""
    lacking = [c for c in base.columns if c not in override.columns]
    if lacking:
        override = attach(override, base.select(*keys, *lacking), keys)
    return override_rows(base, override.select(*base.columns), keys)


def empty_branches(df: DataFrame, levels: Sequence[str], value: str) -> DataFrame:
    """Branches whose total is zero, at every level below the whole, in one pass.

    ``depth`` counts the levels that name the branch.
    """
    depth = sum([F.when(F.grouping(c) == 0, 1).otherwise(0) for c in levels], F.lit(0))
    sums = df.rollup(*levels).agg(F.sum(value).alias("total"), depth.cast("int").alias("depth"))
    return sums.where((F.col("total") == 0) & (F.col("depth") > 0)).select(*levels, "depth")


def prune_empty(df: DataFrame, levels: Sequence[str], value: str) -> DataFrame:
    """Drop the rows in a branch whose total is zero, at whichever level it is; a null total is no zero.

    Levels are judged on the whole table, as ``empty_branches`` does: leaves
    that cancel make their branch empty and go with it.
    """
    out = df
    for depth in range(1, len(levels) + 1):
        branch = list(levels[:depth])
        empty = df.groupBy(*branch).agg(F.sum(value).alias("__sum")).where("__sum = 0").drop("__sum")
        out = drop_matching(out, empty, branch)
    return out


def prune_references(df: DataFrame, pruned: DataFrame, kept: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the rows that name a branch which ``pruned`` had and ``kept`` has no more; other rows stay."""
    gone = drop_matching(pruned.select(*names).distinct(), kept, names)
    return drop_matching(df, gone, names)


def pass_through(
    df: DataFrame, chain: DataFrame, keys: Sequence[str], sector: str, fuel: str, output: str, out: str = "calibrated"
) -> DataFrame:
    """Output to be passed along a chain of sectors.

    A listed sector passes on what its input sector gives; where the input is
    itself listed, the amounts accumulate along the chain from its far end.
    ``chain`` has one row per sector and input with an integer ``position``.
    """
    sums = df.groupBy(*keys, sector).agg(F.sum(output).alias("__sum"))
    links = chain.select(F.col(fuel).alias("__fuel"), F.col(sector).alias("__sector"), "position")
    rows = sums.join(links, sums[sector] == links["__fuel"]).select(
        *keys, F.col("__sector").alias(sector), F.col("__fuel").alias(fuel), "position", "__sum"
    )
    run = Window.partitionBy(*keys).orderBy(F.col("position").desc()).rowsBetween(Window.unboundedPreceding, 0)
    listed = links.select(F.col("__sector").alias(fuel)).distinct().withColumn("__listed", F.lit(True))
    done = attach(rows.withColumn("__cum", F.sum("__sum").over(run)), listed, [fuel])
    return done.withColumn(
        out, F.when(F.col("__listed"), F.col("__cum")).otherwise(F.col("__sum"))
    ).select(*keys, sector, fuel, out)


def expand_technologies(df: DataFrame, mapping: DataFrame, keys: Sequence[str], renames: Mapping[str, str], allowed: Column) -> DataFrame:
    """One row per mapped technology, with the hierarchy moved down one level; rows not allowed go."""
    fanned = attach(df, mapping, keys)
    return fanned.withColumnsRenamed(dict(renames)).where(allowed)


def split_levels(df: DataFrame, leaf: str, node: str, levels: Sequence[str], delimiter: str = "_") -> DataFrame:
    """Turn a leaf into a node with one leaf per management level."""
    out = replicate_values(df, "__level", list(levels)).withColumn(node, F.col(leaf))
    return out.withColumn(leaf, F.concat_ws(delimiter, node, "__level")).drop("__level")


def rekey(
    df: DataFrame, key_map: DataFrame, old: Mapping[str, str], new: Mapping[str, str], columns: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Move a table to new keys, one old row per mapped key, without duplicates or gaps.

    ``old`` maps the key map's columns to the table's, ``new`` names the key
    map's columns in the result.
    """
    table_keys = list(old.values())
    known = keep_matching(key_map, df, old)
    picked = first_rows(df, table_keys, order_by).withColumnsRenamed({v: k for k, v in old.items()})
    joined = attach(known, picked, list(old))
    return joined.withColumnsRenamed(dict(new)).select(*columns).distinct().dropna()


def lineage_closure(edges: DataFrame, source: str, target: str) -> DataFrame:
    """All pairs of a table and the tables it feeds, directly or through others, with the fewest steps.

    Path doubling: with all pairs of up to n steps known, a pair of up to 2n
    steps is one of exactly n steps followed by a known one, so a chain of
    length m takes about log2 m rounds. Every round is written out, so the plan
    does not grow. A round without a pair of its full length is the last, with
    cycles too.
    """
    step = edges.select(F.col(source).alias("source"), F.col(target).alias("target")).distinct()
    fresh = cut_lineage(step.withColumn("depth", F.lit(1)))
    known, length = fresh, 1
    while not (whole := fresh.where(F.col("depth") == length)).isEmpty():
        head = whole.select("source", F.col("target").alias("__via"), F.col("depth").alias("__first"))
        reached = (
            head.join(known.withColumnsRenamed({"source": "__via", "depth": "__then"}), "__via")
            .groupBy("source", "target")
            .agg(F.min(F.col("__first") + F.col("__then")).alias("depth"))
        )
        fresh = cut_lineage(drop_matching(reached, known, ["source", "target"]))
        known, length = known.unionByName(fresh), 2 * length
    return known
