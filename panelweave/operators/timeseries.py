"""Operators on yearly series.

Windows here run within one key over its years. The number of years bounds
the size of a window, provided that the input has one row per key and year
(aggregate first). Axes without such a bound use ``resample``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelweave.functions.semantics import clamp, raise_if, ratio
from panelweave.operators.groups import attach, with_group, with_panel
from panelweave.operators.joins import complete_panel, replicate, replicate_values
from panelweave.operators.reshape import spread
from panelweave.session import cut_lineage


def over(keys: Sequence[str], order: str | Column = "year"):
    return Window.partitionBy(*keys).orderBy(order)


def _knots(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Nearest known point at or before and at or after each row.

    All windows share one partitioning, and all but one share one order.
    """
    by_x = Window.partitionBy(*keys).orderBy(F.col(x).asc())
    whole = by_x.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known_x = F.when(F.col(y).isNotNull(), F.col(x))
    known = df.withColumns(
        {
            "__y": F.avg(y).over(by_x.rangeBetween(0, 0)),
            "__several": F.min(known_x).over(whole) < F.max(known_x).over(whole),
        }
    ).withColumn(
        "__point", F.when(F.col("__y").isNotNull(), F.struct(F.col(x).alias("x"), F.col("__y").alias("y")))
    )
    so_far = (Window.unboundedPreceding, Window.currentRow)
    forward = by_x.rowsBetween(*so_far)
    backward = Window.partitionBy(*keys).orderBy(F.col(x).desc()).rowsBetween(*so_far)
    return known.withColumn("__prev", F.last("__point", ignorenulls=True).over(forward)).withColumn(
        "__next", F.last("__point", ignorenulls=True).over(backward)
    )


def interpolate(
    df: DataFrame, keys: Sequence[str], x: str = "year", y: str = "value", rule: int = 1, out: str | None = None
) -> DataFrame:
    """Linear interpolation between known points.

    Rows sharing an ``x`` use their mean. Outside the known range rule 1 gives
    null and rule 2 the nearest known value. Fewer than two distinct known
    points give null everywhere.
    """
    prev, next_ = F.col("__prev"), F.col("__next")
    part = ratio(F.col(x) - prev["x"], next_["x"] - prev["x"], 0)
    inner = prev["y"] + (next_["y"] - prev["y"]) * part
    if rule == 2:
        inner = F.coalesce(inner, prev["y"], next_["y"])
    cols = list(dict.fromkeys([*df.columns, out or y]))
    return _knots(df, keys, x, y).withColumn(out or y, F.when(F.col("__several"), inner)).select(*cols)


def interpolate_step(
    df: DataFrame, keys: Sequence[str], x: str = "year", y: str = "value", rule: int = 1, out: str | None = None
) -> DataFrame:
    """Step interpolation: the last known value holds until the next. One known point is enough."""
    prev, next_ = F.col("__prev")["y"], F.col("__next")["y"]
    filled = F.coalesce(prev, next_) if rule == 2 else F.when(next_.isNotNull(), prev)
    cols = list(dict.fromkeys([*df.columns, out or y]))
    return _knots(df, keys, x, y).withColumn(out or y, filled).select(*cols)


def resample(
    df: DataFrame, keys: Sequence[str], x: str, y: str, grid: Sequence[float], rule: int = 1
) -> DataFrame:
    """Linear interpolation at a fixed list of query points.

    For every query point the neighbours are a conditional maximum and
    minimum, which combine map-side, so a key may have any number of points.
    """
    points = df.where(F.col(y).isNotNull()).groupBy(*keys, x).agg(F.avg(y).alias(y))
    return _resample_points(points, keys, x, y, grid, rule)


def _resample_points(points, keys, x, y, grid, rule):
    aggs = [F.min(x).alias("__min"), F.max(x).alias("__max")]
    for i, q in enumerate(grid):
        q = F.lit(float(q))
        below, above = F.when(F.col(x) <= q, F.col(x)), F.when(F.col(x) >= q, F.col(x))
        aggs += [
            F.max(below).alias(f"x0_{i}"),
            F.max_by(y, below).alias(f"y0_{i}"),
            F.min(above).alias(f"x1_{i}"),
            F.min_by(y, above).alias(f"y1_{i}"),
        ]
    wide = points.groupBy(*keys).agg(*aggs)
    cells = [
        F.struct(
            F.lit(float(q)).alias(x),
            *[F.col(f"{part}_{i}").cast("double").alias(part) for part in ("x0", "y0", "x1", "y1")],
        )
        for i, q in enumerate(grid)
    ]
    long = wide.select(*keys, "__min", "__max", F.explode(F.array(*cells)).alias("p"))
    p = F.col("p")
    value = p["y0"] + (p["y1"] - p["y0"]) * ratio(p[x] - p["x0"], p["x1"] - p["x0"], 0)
    if rule == 2:
        value = F.coalesce(value, p["y0"], p["y1"])
    return long.select(*keys, p[x].alias(x), F.when(F.col("__min") < F.col("__max"), value).alias(y))


def extend(df: DataFrame, keys: Sequence[str], years: Sequence[int], rule: int = 1) -> DataFrame:
    """Add the missing years of each key, then interpolate."""
    return interpolate(complete_panel(df, keys, "year", years), keys, rule=rule)


def decay_extrapolate(
    df: DataFrame,
    keys: Sequence[str],
    out_years: Sequence[int],
    tech: str = "technology",
    rate: str = "improvement_rate",
    floor: str = "improvement_max",
    shadow: str = "improvement_shadow_technology",
    value: str = "value",
) -> DataFrame:
    """Fill gaps linearly, then decay exponentially toward a floor beyond the last known year.

    The floor is ``floor`` times the last known value. A row naming a shadow
    technology follows that technology and decays only the difference to it; a
    shadow technology without a value for the year fails the job. Rows without
    parameters keep their gaps. ``df`` is long, with one row per key,
    technology and year; the parameters are constant within a key. The
    completed series are written once, for leaders and followers alike.
    """
    ids = [*keys, tech]
    years = sorted(set(out_years))
    params = [rate, floor, shadow]
    grid = complete_panel(df, [*ids, *params], "year", years)
    filled = interpolate(grid, [*ids, *params], y=value)
    whole = Window.partitionBy(*ids, *params)
    known_year = F.when(F.col(value).isNotNull(), F.col("year"))
    based = cut_lineage(filled.withColumn("__y0", F.max(known_year).over(whole)))

    def decay(v0: Column) -> Column:
        fade = F.pow(F.lit(1.0) - F.col(rate), F.col("year") - F.col("__y0"))
        return v0 * F.col(floor) + (v0 - v0 * F.col(floor)) * fade

    given = F.col(rate).isNotNull() & F.col(floor).isNotNull()
    alone = (
        based.where(F.col(shadow).isNull())
        .withColumn("__v0", F.max(F.when(F.col("year") == F.col("__y0"), F.col(value))).over(whole))
        .withColumn(value, F.when(given, F.coalesce(F.col(value), decay(F.col("__v0")))).otherwise(F.col(value)))
    )
    lead = alone.where(given).select(
        *keys, F.col(tech).alias(shadow), "year", F.col(value).alias("__lead")
    )
    gap = F.col(value) - F.col("__lead")
    followers = based.where(F.col(shadow).isNotNull())
    followers = (
        attach(followers, lead.withColumn("__led", F.lit(True)), [*keys, shadow, "year"])
        .where(raise_if(given & F.col("__led").isNull(), "shadow technology is missing"))
        .withColumn("__v0", F.max(F.when(F.col("year") == F.col("__y0"), gap)).over(whole))
        .withColumn(
            value,
            F.when(given, F.coalesce(F.col(value), F.col("__lead") + decay(F.col("__v0")))).otherwise(F.col(value)),
        )
    )
    cols = [*ids, "year", value]
    return alone.select(*cols).unionByName(followers.select(*cols)).where(F.col("year").isin(years))


def graft(past: DataFrame, future: DataFrame, keys: Sequence[str], value: str = "value", scenario: str = "scenario") -> DataFrame:
    """Continue the past by the growth of the future series.

    The future is rebased at the latest year both tables hold. Scenarios found
    in the future are given to the past.
    """
    common = past.select("year").intersect(future.select("year")).agg(F.max("year").alias("base"))
    later = future.withColumn("__base", common.scalar())
    at_base = F.col("year") == F.col("__base")
    anchored = anchor_value(later, [scenario, *keys], at_base, value, "__anchor")
    growth = anchored.where(F.col("year") > F.col("__base")).withColumn("__growth", ratio(value, "__anchor"))
    history = replicate(past, growth.select(scenario).distinct())
    base = past.withColumn("__base", common.scalar()).where(F.col("year") == F.col("__base"))
    base = base.select(*keys, F.col(value).alias("__value"))
    cols = [scenario, *keys, "year", value]
    future_rows = attach(growth, base, keys).where(F.col("__value").isNotNull())
    return history.select(*cols).unionByName(
        future_rows.withColumn(value, F.col("__value") * F.col("__growth")).select(*cols)
    )


def copy_year(df: DataFrame, source: int, targets: Sequence[int]) -> DataFrame:
    """Repeat the rows of one year under other years."""
    copies = replicate_values(df.where(F.col("year") == source).drop("year"), "year", [int(t) for t in targets])
    return df.unionByName(copies.withColumn("year", F.col("year").cast(df.schema["year"].dataType)))


def cumulative_product(df: DataFrame, keys: Sequence[str], factor: str, out: str) -> DataFrame:
    window = over(keys).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.product(F.col(factor)).over(window))


def anchor_value(df: DataFrame, keys: Sequence[str], cond: Column, value: str, out: str) -> DataFrame:
    """Give every row of a series the value of its row that meets ``cond``."""
    return with_panel(df, keys, {out: F.max(F.when(cond, F.col(value)))})


def moving_average(df: DataFrame, keys: Sequence[str], value: str, out: str, periods: int = 5) -> DataFrame:
    """Centred mean over an odd number of rows; null where the window is cut or holds a null."""
    if periods % 2 == 0:
        raise ValueError("periods must be odd")
    half = periods // 2
    window = over(keys).rowsBetween(-half, half)
    full = F.count(value).over(window) == periods
    return df.withColumn(out, F.when(full, F.avg(value).over(window)))


def backcast_parent(
    df: DataFrame,
    parent: Column,
    split_year: int,
    item_keys: Sequence[str],
    member: str,
    account_years: int = 3,
    value: str = "value",
) -> DataFrame:
    """Spread a dissolved parent's history over its successors.

    ``parent`` marks the parent's rows. Shares come from the successors' sums
    in the years from the split to ``account_years`` later, or are equal where
    those sums are zero. Members must be listed in at least one of those years.
    """
    later = df.where(~parent & F.col("year").between(split_year, split_year + account_years))
    sums = later.groupBy(*item_keys, member).agg(F.sum(F.coalesce(value, F.lit(0.0))).alias("__sum"))
    shares = with_group(sums, item_keys, {"__total": F.sum("__sum"), "__n": F.count(F.lit(1))}).select(
        *item_keys,
        member,
        F.coalesce(ratio("__sum", "__total"), F.lit(1.0) / F.col("__n")).alias("__share"),
    )
    history = df.where(parent & (F.col("year") < split_year)).drop(member)
    spread_back = attach(shares.withColumnRenamed(member, "__member"), history, item_keys, "inner")
    spread_back = spread_back.withColumn(value, F.col(value) * F.col("__share")).withColumnRenamed(
        "__member", member
    )
    kept = df.where(~parent & (F.col("year") >= split_year))
    return kept.unionByName(spread_back.select(*df.columns))


def backcast_by_ratio(
    df: DataFrame, parent: Column, split_year: int, item_keys: Sequence[str], member: str, value: str = "value"
) -> DataFrame:
    """Give each successor its split-year value moved by the whole area's trend before the split.

    The trend is the sum over parent and successors relative to the split
    year; an item without one gets zeros. Only the successors are returned.
    """
    whole = df.where(F.col("year") <= split_year).groupBy(*item_keys, "year").agg(F.sum(value).alias("__all"))
    trend = with_panel(
        whole, item_keys, {"__base": F.max(F.when(F.col("year") == split_year, F.col("__all")))}
    ).where(F.col("year") < split_year)
    factors = trend.select(*item_keys, "year", ratio("__all", "__base", 0).alias("__factor"))
    start = df.where(~parent & (F.col("year") == split_year)).drop("year")
    earlier = attach(start, factors, item_keys, "inner").withColumn(
        value, F.coalesce(F.col(value) * F.col("__factor"), F.lit(0.0))
    )
    return df.where(~parent & (F.col("year") >= split_year)).unionByName(earlier.select(*df.columns))


def backcast_splits(
    df: DataFrame,
    splits: DataFrame,
    item_keys: Sequence[str],
    member: str,
    account_years: int = 3,
    merges: DataFrame | None = None,
    value: str = "value",
) -> DataFrame:
    """``backcast_parent`` for many dissolved parents at once.

    ``splits`` lists parent, successor (``part``) and ``split_year``. Areas in
    none of them keep all their rows; a successor that dissolves later itself
    needs a second call. ``merges`` maps an area (``part``) to the area
    (``whole``) it is summed into afterwards.
    """
    parts = splits.select("parent", F.col("part").alias(member), "split_year")
    mapped = attach(df, parts, [member])
    is_parent = splits.select(F.col("parent").alias(member), F.lit(True).alias("__gone")).distinct()
    mapped = attach(mapped, is_parent, [member])
    since = F.col("year") - F.col("split_year")
    kept = mapped.where(F.col("__gone").isNull() & (F.col("split_year").isNull() | (since >= 0)))
    later = mapped.where(since.between(0, account_years))
    sums = later.groupBy("parent", *item_keys, member).agg(F.sum(F.coalesce(value, F.lit(0.0))).alias("__sum"))
    shares = with_group(
        sums, ["parent", *item_keys], {"__total": F.sum("__sum"), "__n": F.count(F.lit(1))}
    ).select(
        "parent",
        *item_keys,
        F.col(member).alias("__member"),
        F.coalesce(ratio("__sum", "__total"), F.lit(1.0) / F.col("__n")).alias("__share"),
    )
    years = splits.groupBy(F.col("parent").alias(member)).agg(F.max("split_year").alias("__until"))
    past = attach(df, years, [member], "inner").where(F.col("year") < F.col("__until"))
    past = past.withColumnRenamed(member, "parent")
    history = (
        attach(past, shares, ["parent", *item_keys], "inner")
        .withColumn(value, F.col(value) * F.col("__share"))
        .withColumnRenamed("__member", member)
    )
    out = kept.select(*df.columns).unionByName(history.select(*df.columns))
    if merges is None:
        return out
    named = attach(out, merges.select(F.col("part").alias(member), "whole"), [member])
    keys = [c for c in df.columns if c not in (member, value)]
    return named.groupBy(F.coalesce("whole", member).alias(member), *keys).agg(F.sum(value).alias(value))


def fold_years(
    df: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    start: Column,
    step,
    out: str,
    order: str = "year",
) -> DataFrame:
    """A recurrence along the years of each key.

    ``step(previous, row)`` gives a row's result from the previous row's
    result. The years of a key are gathered into one sorted array, so the input
    must have one row per key and year; a second one fails the job.
    """
    packed = df.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(order, *fields))).alias("__rows")
    )
    taken = F.transform("__rows", lambda row: row[order])
    packed = packed.where(raise_if(F.size("__rows") > F.size(F.array_distinct(taken)), f"several rows of one key and {order}"))
    kind = "double"
    result = F.aggregate(
        "__rows",
        F.struct(start.cast(kind).alias("last"), F.array().cast(f"array<{kind}>").alias("all")),
        lambda acc, row: F.struct(
            step(acc["last"], row).cast(kind).alias("last"),
            F.concat(acc["all"], F.array(step(acc["last"], row).cast(kind))).alias("all"),
        ),
    )["all"]
    zipped = F.explode(F.arrays_zip(F.col("__rows").alias("row"), result.alias("res")))
    return packed.select(*keys, zipped.alias("z")).select(
        *keys, *[F.col("z.row")[f].alias(f) for f in (order, *fields)], F.col("z.res").alias(out)
    )


def _year_cells(df: DataFrame, keys: Sequence[str], years: Sequence[int], value: str, prefix: str) -> DataFrame:
    """One column per listed year; a second row of a key and year, or another year, fails the job."""
    cells = df.select(*keys, F.concat(F.lit(prefix), F.col("year").cast("string")).alias("__cell"), value)
    return spread(cells, keys, "__cell", value, [f"{prefix}{y}" for y in years])


def fill_members_from_total(
    members: DataFrame, totals: DataFrame, group: Sequence[str], member: Sequence[str], years: Sequence[int], value: str = "value"
) -> DataFrame:
    """Fill missing members of a group so that it reaches its total, from the newest year back.

    What the known members leave of a year's total goes to the missing ones in
    proportion to their (known or filled) values a year later. A filled value
    is therefore the member's next known value times one factor per group and
    year. One aggregate collects, for each pair of years, the known values
    that members missing in between carry back; the factors follow year by
    year from these sums, and one join brings them to the members. ``years``
    is a short list, ``members`` one row per member and year, ``totals`` one
    per group and year. A second row, or a year that is not listed, fails the job.
    """
    years = sorted(years)
    rows = _year_cells(members, [*group, *member], years, value, "v")
    carried = []
    for i, year in enumerate(years):
        gap = F.lit(True)
        for last, later in zip(years[i:], years[i + 1 :]):
            gap = gap & F.col(f"v{last}").isNull()
            carried.append(F.sum(F.when(gap, F.col(f"v{later}"))).alias(f"s{year}_{later}"))
    known = [F.sum(F.coalesce(f"v{y}", F.lit(0.0))).alias(f"k{y}") for y in years]
    limits = _year_cells(totals, group, years, value, "t")
    sums = attach(rows.groupBy(*group).agg(*known, *carried), limits, group)
    for i in reversed(range(len(years) - 1)):
        year, base, factor = years[i], F.lit(0.0), F.lit(1.0)
        for last, later in zip(years[i:], years[i + 1 :]):
            if last != year:
                factor = factor * F.col(f"f{last}")
            base = base + F.coalesce(F.col(f"s{year}_{later}") * factor, F.lit(0.0))
        sums = sums.withColumn(f"f{year}", ratio(F.col(f"t{year}") - F.col(f"k{year}"), base))
    filled = attach(rows, sums.select(*group, *[f"f{y}" for y in years[:-1]]), group)
    for year, later in reversed(list(zip(years, years[1:]))):
        filled = filled.withColumn(
            f"v{year}", F.coalesce(F.col(f"v{year}"), F.col(f"v{later}") * F.col(f"f{year}"))
        )
    cells = [F.struct(F.lit(y).alias("year"), F.col(f"v{y}").alias(value)) for y in years]
    return filled.select(*group, *member, F.inline(F.array(*cells)))


def control_years(
    rules: DataFrame, keys: Sequence[str], start: str, lifetime: str, last: str, clock, lasting: int = 10
) -> DataFrame:
    """When a control begins, ends by its lifetime, and is switched off after its last year in use.

    ``off_year`` is the model period after ``last``; ``lasting`` marks lifetimes of over so many years.
    """
    return rules.select(
        *keys,
        F.col(start).alias("start_year"),
        (F.col(start) + F.col(lifetime)).alias("end_year"),
        clock.next_year(F.col(last)).alias("off_year"),
        (F.col(lifetime) > lasting).alias("lasting"),
    )


def vintage_additions(
    df: DataFrame,
    keys: Sequence[str],
    years: Sequence[int],
    lifetime: int,
    first_step: int = 15,
    value: str = "value",
    out: str = "additions",
) -> DataFrame:
    """New capacity per period such that the vintages in use meet the observed totals.

    A vintage works at full output up to the last year of its life; in the
    period in which it retires it gives the part of the period it worked.
    Additions are what observed output leaves over, never negative, and the
    first period's output is all new. ``df`` has one row per key and year; a
    second one, or a year that is not listed, fails the job.
    """
    years = sorted(years)
    steps = dict(zip(years, [first_step, *[b - a for a, b in zip(years, years[1:])]]))
    wide = _year_cells(df, keys, years, value, "v")
    added: dict[int, Column] = {}
    for year in years:
        working = F.lit(0.0)
        for vintage in years:
            if vintage >= year:
                break
            working = working + F.coalesce(f"a{vintage}", F.lit(0.0)) * F.lit(
                vintage_factor(vintage, year, years, steps[vintage], lifetime)
            )
        new = F.col(f"v{year}") if year == years[0] else F.greatest(F.col(f"v{year}") - working, F.lit(0.0))
        wide = wide.withColumn(f"a{year}", F.when(F.col(f"v{year}").isNotNull(), new))
    cells = [
        F.struct(F.lit(y).alias("year"), F.col(f"v{y}").alias(value), F.col(f"a{y}").alias(out)) for y in years
    ]
    return wide.select(*keys, F.inline(F.array(*cells)))


def vintage_factor(vintage: int, year: int, years: Sequence[int], step: int, lifetime: int) -> float:
    """Part of a vintage's output still given in a later year."""
    last = min(years[-1], vintage - step + lifetime)
    before = years[years.index(year) - 1]
    if year <= last:
        return 1.0
    if before >= last:
        return 0.0
    return (year - last) / (year - before)


def annualised_rate(df: DataFrame, keys: Sequence[str], value: str, out: str, year: str = "year") -> DataFrame:
    """Yearly growth rate from a key's row before, over however many years lie between.

    Null in a key's first row, and where either value is null or the one before is 0.
    """
    w = over(keys, year)
    growth, step = ratio(value, F.lag(value).over(w)), F.col(year) - F.lag(year).over(w)
    return df.withColumn(out, F.pow(growth, F.lit(1.0) / step) - 1)


def guard_decline(
    df: DataFrame, keys: Sequence[str], value: str, first: int, check: int, last: int, year: str = "year"
) -> DataFrame:
    """Later values of a key do not fall below its value in ``first``; all other rows stay.

    In ``check`` a lower value becomes that of ``first``. In ``last`` it becomes
    the straight line through the values of both years, or that of ``first``
    if the line lies lower. Keys without a value in ``first`` stay as they are.
    """
    at = lambda y: F.max(F.when(F.col(year) == y, F.col(value)))
    rows = with_panel(df, keys, {"__v0": at(first), "__v1": at(check), "__v2": at(last)})
    v0, v1, v2, now = F.col("__v0"), F.col("__v1"), F.col("__v2"), F.col(year)
    line = F.greatest(v0, v1 + (v1 - v0) * (last - check) / (check - first))
    guarded = F.when((now == check) & (v1 < v0), v0).when((now == last) & (v2 < v0), line).otherwise(F.col(value))
    return rows.withColumn(value, guarded).drop("__v0", "__v1", "__v2")


def rate_from_first_active(
    df: DataFrame, keys: Sequence[str], value: str, out: str, low: float, high: float, year: str = "year"
) -> DataFrame:
    """Rows after a key's first year with a positive value, with that ``base_year`` and the yearly rate since then.

    The rate is held between ``low`` and ``high``. Keys that are never active give no row.
    """
    active = F.when(F.col(value) > 0, F.col(year))
    rows = with_panel(df, keys, {"base_year": F.min(active), "__base": F.min_by(value, active)})
    rate = F.pow(ratio(value, "__base"), F.lit(1.0) / (F.col(year) - F.col("base_year"))) - 1
    return rows.where(F.col(year) > F.col("base_year")).withColumn(out, clamp(rate, low, high)).drop("__base")


def decline_with_floor(
    base: DataFrame, value: str, total: Column, over_years: int, floor: float, years: Sequence[int], out: str
) -> DataFrame:
    """Each base row for all ``years``, its value declining from the first year at a steady yearly rate.

    The rate takes off the part ``total`` within ``over_years`` years; the
    value never loses more than the part ``floor``.
    """
    rate = F.pow(F.lit(1.0) - total, F.lit(1.0 / over_years)) - 1
    rows = replicate_values(base, "year", list(years))
    falling = F.col(value) * F.pow(1 + rate, F.col("year") - years[0])
    return rows.withColumn(out, F.greatest(F.col(value) * F.lit(1 - floor), falling))
