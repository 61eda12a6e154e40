"""Rule reports, balance checks, orphan checks and tolerance diffs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from panelweave.operators.joins import drop_matching, full_join



def expect(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Number of rows breaking each rule, in one pass; a null outcome counts as broken."""
    counts = df.agg(*[F.count(F.when(~F.coalesce(ok, F.lit(False)), 1)).alias(n) for n, ok in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules])
    return counts.select(F.inline(pairs))


def contract_report(df: DataFrame, required: Mapping[str, T.DataType]) -> list[tuple[str, str]]:
    """Schema findings, without running a job."""
    fields = {f.name: f for f in df.schema.fields}
    findings = []
    for name, kind in required.items():
        if name not in fields:
            findings.append((name, "missing"))
        elif fields[name].dataType != kind:
            findings.append((name, f"is {fields[name].dataType.simpleString()}, not {kind.simpleString()}"))
    if "year" in fields and not isinstance(fields["year"].dataType, T.NumericType):
        findings.append(("year", "not numeric"))
    if any("logit" in n for n in fields) and "logit.type" not in fields and "logit_type" not in fields:
        findings.append(("logit_type", "missing beside logit columns"))
    findings += [(name, "unexpected") for name in fields if name not in required]
    return findings


def contract_select(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The registered columns in their registered order; a missing one is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the table: {missing}")
    return df.select(*columns)


def cube_gaps(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Rows present against the product of distinct counts per dimension."""
    sizes = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_distinct(F.col(d)).alias(d) for d in dimensions]
    )
    product = F.lit(1).cast("long")
    for d in dimensions:
        product = product * F.col(d)
    return sizes.select("rows", product.alias("cells"), (product - F.col("rows")).alias("gap"))


def supply_use_report(
    df: DataFrame, area: str, item: str, free: Sequence[str], supply: Sequence[str], demand: Sequence[str], tolerance: float = 1e-4
) -> DataFrame:
    """Findings on a long balance table: nulls, negatives, world trade and cells out of balance, missing cells.

    ``free`` elements may be negative. One row per rule with its number of
    violations.
    """
    named = lambda names: F.col("element").isin(list(names))
    count = lambda cond: F.count(F.when(cond, 1))
    rows = df.agg(
        count(F.col("value").isNull()).alias("null value"),
        count(~named(free) & (F.col("value") < -0.001)).alias("negative value"),
    )
    part = lambda names: F.coalesce(F.sum(F.when(named(names), F.col("value"))), F.lit(0.0))
    world = df.groupBy("year", item).agg((part(["Import"]) - part(["Export"])).alias("d"))
    cells = df.groupBy("year", item, area).agg((part(supply) - part(demand)).alias("d"))
    off = lambda sums, name: sums.agg(count(F.abs("d") > tolerance).alias(name))
    gap = cube_gaps(df, ["year", item, area, "element"]).select(F.col("gap").alias("missing cell"))
    named_counts = {
        "null value": rows.select("null value"),
        "negative value": rows.select("negative value"),
        "trade imbalance": off(world, "n"),
        "supply differs from demand": off(cells, "n"),
        "missing cell": gap,
    }
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), one.scalar().alias("violations")) for n, one in named_counts.items()])
    return df.sparkSession.range(1).select(F.inline(pairs))


def mismatches(left: DataFrame, right: DataFrame, keys: Sequence[str], bad: Column) -> DataFrame:
    """Pairs of rows of two tables on which they contradict each other."""
    return full_join(left, right, keys).where(bad)


def negative_rows(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys with a negative value and how low it goes."""
    return df.where(F.col(value) < 0).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.min(value).alias("lowest")
    )


def table_diff(
    left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, rel: float = 3e-3, floor: float = 1e-4
) -> DataFrame:
    """Rows on which two tables differ, in any row order.

    Two whole numbers must be equal; other numbers may differ by
    ``rel * (floor + |left|)``.
    """
    other = right.select(*keys, F.col(value).alias("__right"), F.lit(True).alias("__in_right"))
    both = left.select(*keys, F.col(value).alias("left_value"), F.lit(True).alias("__in_left"))
    joined = full_join(both, other, keys, null_keys=True)
    lv, rv = F.col("left_value"), F.col("__right")
    whole = (lv == F.floor(lv)) & (rv == F.floor(rv))
    limit = F.when(whole, F.lit(0.0)).otherwise(F.lit(rel) * (F.lit(floor) + F.abs(lv)))
    status = (
        F.when(F.col("__in_left").isNull(), F.lit("only right"))
        .when(F.col("__in_right").isNull(), F.lit("only left"))
        .when(lv.isNull() & rv.isNull(), F.lit("same"))
        .when(lv.isNull() | rv.isNull(), F.lit("differs"))
        .when(F.abs(lv - rv) <= limit, F.lit("same"))
        .otherwise(F.lit("differs"))
    )
    return joined.select(
        *keys,
        "left_value",
        F.col("__right").alias("right_value"),
        status.alias("status"),
    ).where(F.col("status") != "same")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row counts."""
    return drop_matching(child.groupBy(key).agg(F.count(F.lit(1)).alias("rows")), parent, {key: parent_key})


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
