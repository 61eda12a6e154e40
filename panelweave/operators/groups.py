"""Group totals, first and last rows, and shares.

A value of a whole group is computed by a partial aggregate and joined back,
so a group that holds a large part of all rows never lands in one task as it
would with an unbounded window. Windows serve groups of known small size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelweave.functions.semantics import ratio


def null_safe_join(left: DataFrame, right: DataFrame, keys: Mapping[str, str], how: str) -> DataFrame:
    """Equi-join in which a null key matches a null key; right keys are dropped.

    ``keys`` maps left to right column names; the right names must differ from
    every left name.
    """
    cond = F.lit(True)
    for left_key, right_key in keys.items():
        cond = cond & left[left_key].eqNullSafe(right[right_key])
    return left.join(right, cond, how).drop(*keys.values())


def attach(df: DataFrame, summary: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a one-row-per-key summary back to its rows; null keys match."""
    renamed = {k: f"__{k}" for k in keys}
    return null_safe_join(df, summary.withColumnsRenamed(renamed), renamed, how)


def with_group(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column]) -> DataFrame:
    """Add group aggregates to every row of the group."""
    named = [agg.alias(name) for name, agg in aggregates.items()]
    if not keys:
        return with_total(df, aggregates)
    return attach(df, df.groupBy(*keys).agg(*named), keys)


def with_panel(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column]) -> DataFrame:
    """As ``with_group``, by a window, which reads its input once.

    For groups of known small size only: the years of one series, or the
    elements of one balance.
    """
    window = Window.partitionBy(*keys)
    return df.withColumns({name: agg.over(window) for name, agg in aggregates.items()})


def with_total(df: DataFrame, aggregates: Mapping[str, Column], source: DataFrame | None = None) -> DataFrame:
    """Add whole-table aggregates to every row through a one-row subquery."""
    source = df if source is None else source
    names = list(aggregates)
    one = source.agg(F.struct(*[agg.alias(n) for n, agg in aggregates.items()]).alias("one"))
    return (
        df.withColumn("__one", one.scalar())
        .select(*df.columns, *[F.col("__one")[n].alias(n) for n in names])
    )


def share(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    out: str = "share",
    equal_split: bool = False,
) -> DataFrame:
    """Share of the group total; null for a zero total, or 1/n with ``equal_split``."""
    rows = with_group(df, keys, {"__total": F.sum(value), "__n": F.count(F.lit(1))})
    part = ratio(value, "__total")
    if equal_split:
        part = F.coalesce(part, F.lit(1.0) / F.col("__n"))
    return rows.withColumn(out, part).drop("__total", "__n")


def _order_struct(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> tuple[Column, list[str]]:
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    flagged = [F.struct(F.col(c).isNull().alias("missing"), F.col(c).alias("value")).alias(c) for c in order_by]
    return F.struct(*flagged, *[F.col(c) for c in rest]), rest


def first_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], last: bool = False) -> DataFrame:
    """The first (or last) whole row of each key in the stated order.

    Computed as the least (greatest) struct, which combines map-side. Nulls
    sort behind known values; ties fall to the remaining columns, so the
    result does not depend on row order.
    """
    packed, rest = _order_struct(df, keys, order_by)
    pick = F.max if last else F.min
    picked = df.groupBy(*keys).agg(pick(packed).alias("__row"))
    columns = {c: F.col("__row")[c]["value"] for c in order_by} | {c: F.col("__row")[c] for c in rest}
    return picked.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in df.columns])
