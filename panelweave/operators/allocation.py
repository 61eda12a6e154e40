"""Downscaling, control totals and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelweave.functions.semantics import clamp, if_else, raise_if, ratio, weighted_mean
from panelweave.operators.groups import attach, share, with_group, with_panel, with_total
from panelweave.operators.joins import checked_join, complete_panel, replicate
from panelweave.operators.scans import quantiles
from panelweave.operators.timeseries import interpolate, over


def downscale(
    coarse: DataFrame, members: DataFrame, keys: Sequence[str], proxy: str, value: str = "value", equal_split: bool = True
) -> DataFrame:
    """Give each member its proxy share of every coarse row of its key; totals are preserved."""
    parts = share(members, proxy, keys, out="__share", equal_split=equal_split)
    return (
        attach(parts, coarse, keys, "inner")
        .withColumn(value, F.col(value) * F.col("__share"))
        .drop("__share")
    )


def chained_share(df: DataFrame, value: str, inner: Sequence[str], outer: Sequence[str], out: str) -> DataFrame:
    """Share within the inner group times the inner group's share of the outer group."""
    sums = df.groupBy(*inner).agg(F.sum(value).alias("__inner"))
    outer_keys = list(outer)
    if outer_keys:
        top = with_group(sums, outer_keys, {"__outer": F.sum("__inner")})
    else:
        top = with_total(sums, {"__outer": F.sum("__inner")})
    rows = attach(df, top.select(*inner, "__inner", "__outer"), inner)
    return rows.withColumn(out, ratio(value, "__inner") * ratio("__inner", "__outer")).drop("__inner", "__outer")


def control_scalers(
    detail: DataFrame, control: DataFrame, keys: Sequence[str], value: str, total: str, default: float | None = 1.0
) -> DataFrame:
    """Control total over bottom-up sum per key, ``default`` where either is missing or zero."""
    sums = detail.groupBy(*keys).agg(F.sum(value).alias("__bottom_up"))
    return attach(sums, control.select(*keys, total), keys).select(
        *keys, ratio(total, "__bottom_up", default).alias("scaler")
    )


def scale_to_control(
    detail: DataFrame,
    control: DataFrame,
    keys: Sequence[str],
    value: str,
    total: str,
    default: float | None = 1.0,
    out: str | None = None,
    short: bool = False,
) -> DataFrame:
    """Scale rows so that each key sums to its control total; keys without one keep ``default`` times their data.

    ``short`` states that a key has few rows, as an order has lines: its sum
    then comes from a window, and the rows are read and shuffled once. ``keys``
    must not be null then.
    """
    if short:
        summed = with_panel(detail, keys, {"__bottom_up": F.sum(value)}).join(control.select(*keys, total), list(keys), "left")
        scaled = F.col(value) * ratio(total, "__bottom_up", default)
        return summed.withColumn(out or value, scaled).select(*dict.fromkeys([*detail.columns, out or value]))
    scalers = control_scalers(detail, control, keys, value, total, default)
    return attach(detail, scalers, keys).withColumn(out or value, F.col(value) * F.col("scaler")).drop("scaler")


def scale_strict(
    detail: DataFrame, available: DataFrame, keys: Sequence[str], value: str, total: str, out: str, short: bool = False
) -> DataFrame:
    """As ``scale_to_control``, but a key without a control total fails the job."""
    if short:
        summed = with_panel(detail, keys, {"__bottom_up": F.sum(value)})
        both = checked_join(summed, available.select(*keys, total), keys)
        return both.withColumn(out, F.col(value) * ratio(total, "__bottom_up")).drop("__bottom_up", total)
    sums = detail.groupBy(*keys).agg(F.sum(value).alias("__bottom_up"))
    scalers = checked_join(sums, available.select(*keys, total), keys).select(
        *keys, ratio(total, "__bottom_up").alias("__scaler")
    )
    return checked_join(detail, scalers, keys).withColumn(out, F.col(value) * F.col("__scaler")).drop("__scaler")


def complete_with_median(targets: DataFrame, known: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Every target with its known value, or the median of all known values; ``filled`` marks the latter.

    """
    middle = quantiles(known, [], value, {"__middle": 0.5}).scalar()
    rows = attach(targets, known.select(*keys, value), keys)
    return rows.withColumns({"filled": F.col(value).isNull(), value: F.coalesce(F.col(value), middle)})


def deduct_in_order(
    df: DataFrame, first: str, second: str, deduction: str, max_fraction: float, first_out: str, second_out: str
) -> DataFrame:
    """Take a deduction from the first source up to a fraction of it and the rest from the second.

    A second source driven below zero fails the job.
    """
    room = F.col(first) * F.lit(max_fraction)
    fits = room >= F.col(deduction)
    left = F.col(first) * F.lit(1 - max_fraction)
    out = df.withColumn(first_out, if_else(fits, F.col(first) - F.col(deduction), left)).withColumn(
        second_out, if_else(fits, F.col(second), F.col(second) + room - F.col(deduction))
    )
    return out.where(raise_if(F.col(second_out) < 0, "deduction exceeds the second source"))


def absorb_negatives(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Set negative members to zero and shrink the positive ones so that the group total stays.

    A group whose total is negative cannot absorb; it fails the job.
    """
    negative = F.sum(F.when(F.col(value) < 0, F.col(value)).otherwise(0.0))
    positive = F.sum(F.when(F.col(value) >= 0, F.col(value)).otherwise(0.0))
    rows = with_group(df, keys, {"__neg": negative, "__pos": positive})
    rows = rows.where(raise_if(F.col("__neg") + F.col("__pos") < 0, "group total is negative"))
    scaler = F.when(F.col("__neg") == 0, F.lit(1.0)).otherwise(F.lit(1.0) + ratio("__neg", "__pos"))
    kept = F.when(F.col(value) < 0, F.lit(0.0)).otherwise(F.col(value) * scaler)
    return rows.withColumn(out, kept).drop("__neg", "__pos")


def cap_fraction(df: DataFrame, required: str, total: str, max_fraction: float, frac: str, out: str) -> DataFrame:
    """Part of a total in use, capped; the used amount is re-derived from the capped fraction."""
    part = ratio(required, total, 0)
    return df.withColumn(frac, clamp(part, high=F.lit(max_fraction))).withColumn(
        out, F.col(total) * F.col(frac)
    )


def shrink_group(df: DataFrame, keys: Sequence[str], value: str, extra: DataFrame, amount: str, out: str) -> DataFrame:
    """Shrink a group's members in proportion to free an amount; an amount above the total fails the job."""
    rows = attach(with_group(df, keys, {"__total": F.sum(value)}), extra.select(*keys, amount), keys)
    kept = ratio(F.col("__total") - F.coalesce(amount, F.lit(0.0)), "__total", 1)
    return (
        rows.where(raise_if(F.coalesce(amount, F.lit(0.0)) > F.col("__total"), "not enough to free"))
        .withColumn(out, F.col(value) * kept)
        .drop("__total", amount)
    )


def protected_split(df: DataFrame, current: str, base: str, least: str, fraction: str) -> DataFrame:
    """Protected and open part of an amount.

    The protected part is the fraction of the base-year amount; where the least
    amount in history is below that, it is the fraction of the current amount.
    """
    fixed = F.col(fraction) * F.col(base)
    moving = F.col(least) < fixed
    protected = if_else(moving, F.col(fraction) * F.col(current), fixed)
    return df.withColumn("protected", protected).withColumn(
        "open", if_else(moving, (F.lit(1.0) - F.col(fraction)) * F.col(current), F.col(current) - fixed)
    )


def emission_factors(
    activity: DataFrame,
    emissions: DataFrame,
    keys: Sequence[str],
    sector_keys: Sequence[str],
    amount: str,
    emitted: str,
    out: str = "factor",
) -> DataFrame:
    """Emissions per unit of activity; 0 without activity, 1 for a sector without any emissions."""
    joined = attach(activity, emissions.select(*keys, emitted), keys).fillna(0.0, [emitted])
    rows = with_group(joined, sector_keys, {"__sector": F.sum(emitted)})
    factor = F.when(F.col("__sector") == 0, F.lit(1.0)).otherwise(ratio(emitted, amount, 0))
    return rows.withColumn(out, factor).drop("__sector")


def mix_share(df: DataFrame, mean: str, low: str, high: str, margin: float) -> DataFrame:
    """Share of the low component in a mix with a known mean.

    A mean below the low component lowers it to the mean; a mean above the high
    component raises that to the mean plus a margin.
    """
    low_adj = if_else(F.col(mean) < F.col(low), F.col(mean), F.col(low))
    high_adj = if_else(F.col(mean) > F.col(high), F.col(mean) + F.lit(margin), F.col(high))
    return (
        df.withColumn("low_adj", low_adj)
        .withColumn("high_adj", high_adj)
        .withColumn("share_low", ratio(F.col(mean) - F.col("high_adj"), F.col("low_adj") - F.col("high_adj")))
    )


def fixed_charge_rate(rate: float, periods: int) -> float:
    """Yearly payment per unit of capital."""
    return rate + rate / ((1 + rate) ** periods - 1)


def priority_split(df: DataFrame, supply_a: str, supply_b: str, need_one: str, need_two: str) -> DataFrame:
    """Split two supplies between two uses.

    Supply A serves the first use up to its need; supply B covers what is left
    of that need; the second use gets the remainder of B. Coefficients are per
    unit of need.
    """
    total = F.col(supply_a) + F.col(supply_b)
    need = F.col(need_one) + F.col(need_two)
    per_unit = ratio(total, need, 0)
    return (
        df.withColumn("per_unit", per_unit)
        .withColumn("a_one", clamp(ratio(supply_a, need_one, 0), high=F.col("per_unit")))
        .withColumn("b_one", F.col("per_unit") - F.col("a_one"))
        .withColumn("b_left", F.greatest(F.col(supply_b) - F.col("b_one") * F.col(need_one), F.lit(0.0)))
        .withColumn("b_two", ratio("b_left", need_two, 0))
    )


def impute_by_ratio(df: DataFrame, known: str, other: str, out: str) -> DataFrame:
    """Missing values from another column times the ratio of sums over rows that have both."""
    both = F.col(known).isNotNull() & F.col(other).isNotNull()
    rows = with_total(
        df,
        {"__known": F.sum(F.when(both, F.col(known))), "__other": F.sum(F.when(both, F.col(other)))},
    )
    return rows.withColumn(out, F.coalesce(known, F.col(other) * ratio("__known", "__other"))).drop("__known", "__other")


def index_to_member(df: DataFrame, keys: Sequence[str], member: Column, value: str, out: str) -> DataFrame:
    """Value relative to one reference member of the group, null without it."""
    rows = with_group(df, keys, {"__ref": F.max(F.when(member, F.col(value)))})
    return rows.withColumn(out, ratio(value, "__ref")).drop("__ref")


def extend_scalers(scalers: DataFrame, keys: Sequence[str], years: Sequence[int]) -> DataFrame:
    """Scalers for further years: linear between known years, flat outside them."""
    return interpolate(complete_panel(scalers, keys, "year", years), keys, y="scaler", rule=2)


def scale_with_alternate(
    detail: DataFrame,
    control: DataFrame,
    keys: Sequence[str],
    category: str,
    alternate: str,
    value: str,
    total: str,
    out: str,
) -> DataFrame:
    """Scale to control totals, with the alternate category's scaler where a category has none.

    Where the bottom-up sum of a controlled category is zero, its members share
    the control total equally.
    """
    full = [*keys, category]
    sums = detail.groupBy(*full).agg(F.sum(value).alias("__sum"), F.count(F.lit(1)).alias("__n"))
    matched = attach(control.select(*full, total), sums, full, "left").select(
        *full, F.col(total).alias("__total"), ratio(total, "__sum").alias("__own"), "__n"
    )
    spare = matched.where(F.col(category) == F.lit(alternate)).select(*keys, F.col("__own").alias("__spare"))
    rows = attach(attach(detail, matched, full), spare, keys)
    shared = ratio("__total", "__n")
    scaled = F.when(F.col("__total").isNotNull() & F.col("__own").isNull(), shared).otherwise(
        F.col(value) * F.coalesce("__own", "__spare")
    )
    return rows.withColumn(out, scaled).drop("__total", "__own", "__n", "__spare")


def fill_from_class(
    observed: DataFrame, average: DataFrame, members: Sequence[str], class_keys: Sequence[str], item: str, value: str
) -> DataFrame:
    """Observed shares, else the class average; every item of a member's class is kept.

    ``members`` are the keys of the observations, ``class_keys`` those of the average.
    """
    who_keys = list(dict.fromkeys([*members, *class_keys]))
    who = observed.select(*who_keys).distinct()
    wanted = attach(who, average.select(*class_keys, item, F.col(value).alias("__mean")), class_keys, "inner")
    seen = observed.select(*members, item, F.col(value).alias("__seen"))
    return attach(wanted, seen, [*members, item]).select(
        *who_keys, item, F.coalesce("__seen", "__mean").alias(value)
    )


def impute_by_index(
    prices: DataFrame, index: DataFrame, area: str, item: str, value: str, references: Sequence, names: Sequence[str]
) -> DataFrame:
    """Missing prices from a reference area's price times the area's index to it, the first reference that has one.

    ``prices`` may lack cells; every area of ``index`` gets every item. The
    index column of the i-th reference is ``names[i]``.
    """
    items = prices.groupBy(item).agg(
        *[
            F.max(F.when(F.col(area) == F.lit(ref), F.col(value))).alias(f"__ref{i}")
            for i, ref in enumerate(references)
        ]
    )
    grid = attach(replicate(index, items), prices.select(area, item, F.col(value).alias("__own")), [area, item])
    guesses = [F.col(f"__ref{i}") * F.col(n) for i, n in enumerate(names)]
    return grid.select(area, item, F.coalesce("__own", *guesses).alias(value))


def yield_index(
    df: DataFrame, members: DataFrame, member: str, item: str, made: str, area: str, zone: str, out: str
) -> DataFrame:
    """Per zone, the mean over its members' items of local yield over the item's yield everywhere, weighted by area.

    ``df`` has one row per member and item with output ``made`` and ``area``;
    ``members`` gives the zone of each member, and a member without one fails the job.
    """
    rows = with_group(df, [item], {"__made": F.sum(made), "__area": F.sum(area)})
    rows = rows.withColumn("__ratio", ratio(made, area) / ratio("__made", "__area"))
    mapped = checked_join(rows, members.select(member, zone), [member])
    return mapped.groupBy(zone).agg(weighted_mean("__ratio", area).alias(out))


def survey_conversion(df: DataFrame, keys: Sequence[str], value: str, turn: int, out: str, year: str = "year") -> DataFrame:
    """Factor from a key's neighbouring survey to each row: the next one before the year ``turn``, else the one before.

    1 where there is no such survey, or no finite factor.
    """
    w = over(keys, year)
    later, earlier = ratio(value, F.lead(value).over(w)), ratio(value, F.lag(value).over(w))
    factor = F.when(F.col(year) < turn, later).otherwise(earlier)
    return df.withColumn(out, F.coalesce(factor, F.lit(1.0)))
