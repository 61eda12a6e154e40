"""Supply and abatement curves, fits and clipping."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelweave.functions.semantics import bin_label, clamp, ratio, weighted_mean
from panelweave.operators.groups import attach, share, with_group, with_total
from panelweave.operators.scans import quantiles, running_total
from panelweave.session import cut_lineage


def smooth_supply(exponent: Column, mid: Column, base: Column, maximum: Column, price: Column) -> Column:
    """Supply on a smooth curve; zero below the base price."""
    above = F.pow(F.greatest(price - base, F.lit(0.0)), exponent)
    return F.when(price < base, F.lit(0.0)).otherwise(ratio(above, F.pow(mid, exponent) + above, 0) * maximum)


def price_at_share(exponent: Column, mid: Column, base: Column, share: float = 0.95) -> Column:
    """Price at which a smooth curve supplies a share of its maximum."""
    return F.pow(F.lit(share / (1 - share)), F.lit(1.0) / exponent) * mid + base


def s_curve(steepness: Column, half_life: Column, t: Column) -> Column:
    """Share still in use after ``t`` years."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(steepness * (t - half_life)))


def gompertz(saturation: Column, a: Column, density: Column, b: Column, c: Column, income: Column, bias: Column) -> Column:
    """Demand per head on a Gompertz curve with a bias term."""
    return (saturation - a * F.log(density)) * F.exp(-b * F.exp(-c * F.log(income))) + bias


def improvement_rate(target: Column, start: Column, floor: Column, years: Column) -> Column:
    """Yearly rate at which a decaying cost reaches a target; null if it cannot."""
    base = ratio(target - start * floor, start - start * floor)
    return F.when((base >= 0) & (base <= 1), F.lit(1.0) - F.pow(base, F.lit(1.0) / years))


def supply_curve(
    points: DataFrame, keys: Sequence[str], price: str, quantity: str, supply: str = "supply"
) -> DataFrame:
    """Cumulative supply by rising price, one row per key and distinct price, with the key's total.

    Equal prices are summed before the scan.
    """
    merged = points.groupBy(*keys, price).agg(F.sum(quantity).alias(quantity))
    return running_total(
        merged,
        {supply: quantity},
        keys,
        [F.col(price)],
        totals={f"{supply}_total": supply},
    )


def half_supply_price(curve: DataFrame, keys: Sequence[str], price: str, supply: str, out: str = "mid_price") -> DataFrame:
    """Lowest price supplying at least half of the total of a ``supply_curve``, with base price and maximum."""
    total = F.col(f"{supply}_total")
    return curve.groupBy(*keys).agg(
        F.min(price).alias("base_price"),
        F.max(total).alias("max_supply"),
        F.min(F.when(F.col(supply) >= F.lit(0.5) * total, F.col(price))).alias(out),
    )


def bracketed_mid_price(curve: DataFrame, keys: Sequence[str], price: str, supply: str, out: str = "mid_price") -> DataFrame:
    """Price at half supply on the line between the points around it; prices count from the base price."""
    part = F.col(supply) / F.col(f"{supply}_total")
    low, high = F.when(part <= 0.5, F.col(price)), F.when(part >= 0.5, F.col(price))
    ends = curve.groupBy(*keys).agg(
        F.max(f"{supply}_total").alias("__m"),
        F.min(price).alias("__base"),
        F.max(low).alias("p1"),
        F.max_by(supply, low).alias("q1"),
        F.min(high).alias("p2"),
        F.min_by(supply, high).alias("q2"),
    )
    q1, q2, m = (F.col(c).cast("double") for c in ("q1", "q2", "__m"))
    p1, p2 = (F.col(c) - F.col("__base") for c in ("p1", "p2"))
    line = ratio((p2 - p1) * m + 2 * q2 * p1 - 2 * q1 * p2, 2 * (q2 - q1))
    return ends.withColumn(out, line).select(*keys, out)


def aggregate_curves(
    members: DataFrame, keys: Sequence[str], exponent: str, mid: str, base: str, maximum: str, step: float, share: float = 0.95
) -> DataFrame:
    """Sum member curves on the shared price axis of their group.

    The axis runs from the lowest base price to the highest price at which a
    member supplies ``share`` of its maximum.
    """
    cols = [F.col(c) for c in (exponent, mid, base)]
    ends = with_group(
        members,
        keys,
        {"__low": F.min(base), "__high": F.max(price_at_share(*cols, share))},
    )
    steps = F.sequence(F.lit(0), F.floor((F.col("__high") - F.col("__low")) / F.lit(step) + F.lit(1e-9)).cast("int"))
    priced = ends.withColumn("__i", F.explode(steps)).withColumn(
        "price", F.col("__low") + F.col("__i") * F.lit(step)
    )
    supply = smooth_supply(*cols, F.col(maximum), F.col("price"))
    return priced.groupBy(*keys, F.col("__i").alias("step")).agg(
        F.min("price").alias("price"), F.sum(supply).alias("supply")
    )


def fit_by_grid(
    points: DataFrame,
    keys: Sequence[str],
    parameters: Mapping[str, tuple[float, float]],
    error: Column | Callable[..., Column],
    rounds: Sequence[int],
) -> DataFrame:
    """Parameters with the least sum of squared errors, by successively finer grids.

    ``parameters`` gives each range and ``rounds`` the number of intervals per
    range in each round. A round looks one interval of the previous round to
    each side. ``error`` is a function of the parameters that gives an
    expression over the point columns: the errors at all values of the last
    parameter are then sums of one aggregate, and points are repeated for the
    other parameters only. As a plain expression over point and parameter
    columns it costs a copy of the points per grid cell. Sums combine map-side,
    so a key may have any number of points.
    """
    if callable(error):
        return _fit_by_sums(points, keys, parameters, error, rounds)
    names = list(parameters)
    centre = None
    width = {n: hi - lo for n, (lo, hi) in parameters.items()}
    for parts in rounds:
        rows = points if centre is None else attach(points, centre, keys)
        step = {n: width[n] / parts for n in names}
        for n in names:
            lo, hi = parameters[n]
            index = F.explode(F.sequence(F.lit(0), F.lit(parts)))
            low = F.lit(lo) if centre is None else F.col(f"__{n}") - F.lit(width[n] / 2)
            rows = rows.withColumn("__i", index).withColumn(
                n, clamp(low + F.col("__i") * F.lit(step[n]), F.lit(lo), F.lit(hi))
            )
        sums = rows.groupBy(*keys, *names).agg(F.sum(error * error).alias("sse"))
        best = sums.groupBy(*keys).agg(F.min(F.struct("sse", *names)).alias("__best"))
        centre = best.select(*keys, *[F.col("__best")[n].alias(f"__{n}") for n in names], F.col("__best")["sse"].alias("sse"))
        width = {n: 2 * step[n] for n in names}
        last = centre
        centre = centre.drop("sse")
    return last.withColumnsRenamed({f"__{n}": n for n in names})


def _fit_by_sums(points, keys, parameters, error, rounds):
    *others, last = parameters
    centre, width = None, {n: hi - lo for n, (lo, hi) in parameters.items()}
    for parts in rounds:
        rows = points if centre is None else attach(points, centre.drop("sse"), keys)
        step = {n: width[n] / parts for n in parameters}
        low = {n: F.lit(lo) if centre is None else F.col(f"__{n}") - F.lit(width[n] / 2) for n, (lo, _) in parameters.items()}
        at = lambda n, begin, i: clamp(begin + i * F.lit(step[n]), *map(F.lit, parameters[n]))
        for n in others:
            rows = rows.withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(parts)))).withColumn(n, at(n, low[n], F.col("__i")))
        rows = rows.withColumn("__low", low[last])
        squares = []
        for i in range(parts + 1):
            e = error(**{n: F.col(n) for n in others}, **{last: at(last, F.col("__low"), F.lit(i))})
            squares.append(F.sum(e * e).alias(f"__s{i}"))
        sums = rows.groupBy(*keys, *others, "__low").agg(*squares)
        cells = [
            F.struct(F.col(f"__s{i}").alias("sse"), *others, at(last, F.col("__low"), F.lit(i)).alias(last)) for i in range(parts + 1)
        ]
        best = sums.select(*keys, F.least(*cells).alias("__cell")).groupBy(*keys).agg(F.min("__cell").alias("__best"))
        centre = best.select(*keys, *[F.col("__best")[n].alias(f"__{n}") for n in parameters], F.col("__best")["sse"].alias("sse"))
        width = {n: 2 * step[n] for n in parameters}
    return centre.withColumnsRenamed({f"__{n}": n for n in parameters})


def lifetimes_by_bin(
    df: DataFrame, keys: Sequence[str], size: str, weight: str, breaks: Sequence, labels: Sequence[str], shift: float = 0.0
) -> DataFrame:
    """Weighted mean lifetime of each bin, in whole years and 1 where negative, and the bin's share of the key's size.

    The lifetime of a row is its ``size`` less ``shift``; bins are right-closed.
    """
    binned = df.withColumn("bin", bin_label(size, breaks, labels)).withColumn("__life", F.col(size) - F.lit(shift))
    sums = binned.groupBy(*keys, "bin").agg(
        F.bround(weighted_mean("__life", weight), 0).alias("lifetime"), F.sum(size).alias("__size")
    )
    life = F.when(F.col("lifetime") < 0, 1.0).otherwise(F.col("lifetime") + 0)
    return share(sums.withColumn("lifetime", life), "__size", keys).select(*keys, "bin", "lifetime", "share")


def abatement_shares(
    reductions: DataFrame, baseline: DataFrame, keys: Sequence[str], cost: str, amount: str, total: str, cap: float = 0.95
) -> DataFrame:
    """Cumulative reduction by cost as a share of the baseline.

    A share of 1 or more is set to ``cap``; a missing baseline gives 0.
    """
    curve = supply_curve(reductions, keys, cost, amount, supply="__cum")
    rows = attach(curve.drop("__cum_total"), baseline.select(*keys, total), keys)
    part = ratio("__cum", total, 0)
    return rows.select(*keys, cost, F.when(part >= 1, F.lit(cap)).otherwise(part).alias("share"))


def cap_outliers(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    order_id: str,
    quantile_p: float,
    top_share: float,
    out: str,
    by_group: Column | None = None,
    limit: float | None = None,
) -> DataFrame:
    """Replace missing values and outliers by a median of the group, under one of two rules per row.

    A null value counts as 0 in every threshold and median. Members are ranked
    by weight, largest first, and an integer id; the top members are those that
    make up ``top_share`` of the weight (the largest member at least), without
    later members of weight 0. Where ``by_group`` holds, values above the
    smaller of the group's quantile and the largest top value become the
    median of the top members. Elsewhere, and where it is null, values above
    the absolute ``limit`` become the median of the whole group. Without
    ``by_group`` the first rule holds for all rows. The input is written once,
    as it is read several times.
    """
    if by_group is not None and limit is None:
        raise ValueError("rows outside the group rule need a limit")
    rule = F.lit(True) if by_group is None else F.coalesce(by_group, F.lit(False))
    df = cut_lineage(df.withColumns({"__known": F.coalesce(F.col(value), F.lit(0)), "__rule": rule}))
    ranked = running_total(
        df.select(*keys, "__known", weight, order_id),
        {"__cum": weight},
        keys,
        [F.col(weight).desc(), F.col(order_id).asc()],
        totals={"__total": "__cum"},
        write=False,
    )
    least = df.groupBy(*keys).agg(ratio(F.max(weight), F.sum(weight), 0).alias("__least"))
    top = cut_lineage(
        attach(ranked.withColumn("__part", ratio("__cum", "__total", 0)), least, keys)
        .where(F.col("__part") <= F.greatest(F.col("__least"), F.lit(top_share)))
        .where(~((F.col(weight) == 0) & (F.col("__part") > 0)))
        .select(*keys, "__known")
    )
    whole = {"__upper": quantile_p} | ({} if by_group is None else {"__middle": 0.5})
    limits = attach(quantiles(df, keys, "__known", whole), quantiles(top, keys, "__known", {"__median": 0.5}), keys)
    limits = attach(limits, top.groupBy(*keys).agg(F.max("__known").alias("__largest")), keys)
    v = F.col(value)
    made = F.when(v.isNull() | (v > F.least("__upper", "__largest")), F.col("__median")).otherwise(v)
    if by_group is not None:
        other = F.when(v.isNull() | (v > F.lit(float(limit))), F.col("__middle")).otherwise(v)
        made = F.when(F.col("__rule"), made).otherwise(other)
    return attach(df, limits, keys).withColumn(out, made).drop("__known", "__rule", "__largest", "__median", *whole)


def cap_by_spread(df: DataFrame, keys: Sequence[str], value: str, out: str, times: float = 2.0) -> DataFrame:
    """Cap at the median plus a multiple of the interquartile range."""
    limits = quantiles(df, keys, value, {"__q1": 0.25, "__q2": 0.5, "__q3": 0.75})
    upper = F.col("__q2") + F.lit(times) * (F.col("__q3") - F.col("__q1"))
    return attach(df, limits, keys).withColumn(out, F.least(F.col(value), upper)).drop("__q1", "__q2", "__q3")


def narrow_band(df: DataFrame, keys: Sequence[str], value: str, low: float, high: float, out: str) -> DataFrame:
    """Move values outside a quantile band to its edge."""
    limits = quantiles(df, keys, value, {"__low": low, "__high": high})
    return attach(df, limits, keys).withColumn(
        out, clamp(value, F.col("__low"), F.col("__high"))
    ).drop("__low", "__high")


def regression(df: DataFrame, keys: Sequence[str], y: str, x: str) -> DataFrame:
    """Least-squares line per key with the number of points."""
    return df.groupBy(*keys).agg(
        F.count(F.when(F.col(y).isNotNull() & F.col(x).isNotNull(), 1)).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.avg(y).alias("mean"),
    )


def regression_with_residual(df: DataFrame, y: str, x: str, out: str) -> DataFrame:
    """One line for all rows; each row keeps its residual and stays in the observed range."""
    rows = with_total(
        df,
        {
            "__b1": F.regr_slope(y, x),
            "__b0": F.regr_intercept(y, x),
            "__lo": F.min(y),
            "__hi": F.max(y),
        },
    )
    fitted = F.col("__b0") + F.col("__b1") * F.col(x)
    return rows.withColumn("fitted", fitted).withColumn("residual", F.col(y) - F.col("fitted")).withColumn(
        out, clamp(F.col("fitted") + F.coalesce("residual", F.lit(0.0)), F.col("__lo"), F.col("__hi"))
    ).drop("__b0", "__b1", "__lo", "__hi")


def stacked_segments(df: DataFrame, demands: Sequence[str], times: Sequence[str], names: Sequence[str], segment: str = "segment") -> DataFrame:
    """Share of each stacked segment in the demand of each load period.

    Segment k covers what the earlier ones leave of period k and, in the
    periods after it, the same load for their time. Shares are per period.
    """
    n = len(names)
    load = [[F.lit(0.0)] * n for _ in range(n)]
    for k in range(n):
        left = F.col(demands[k])
        for earlier in range(k):
            left = left - load[earlier][k]
        for j in range(k, n):
            load[k][j] = left if j == k else left * ratio(times[j], times[k])
    totals = [sum((load[k][j] for k in range(n)), F.lit(0.0)) for j in range(n)]
    keep = [c for c in df.columns if c not in demands and c not in times]
    cells = F.array(
        *[
            F.struct(
                F.lit(names[k]).alias(segment),
                *[ratio(load[k][j], totals[j]).alias(names[j]) for j in range(n)],
            )
            for k in range(n)
        ]
    )
    return df.select(*keep, F.inline(cells))


def quartile_grades(curve: DataFrame, keys: Sequence[str], price: str, quantity: str) -> DataFrame:
    """The four curve points at the quartiles of a key's points, as marginal amounts per grade."""
    merged = curve.groupBy(*keys, price).agg(F.sum(quantity).alias("__q")).withColumn("__one", F.lit(1))
    run = running_total(
        merged,
        {"cumulative": "__q", "__rank": "__one"},
        keys,
        [F.col(price)],
        totals={"__n": "__rank"},
    )
    hits = [F.ceil(F.col("__n") * F.lit(p)) == F.col("__rank") for p in (0.25, 0.5, 0.75, 1.0)]
    picked = run.where(hits[0] | hits[1] | hits[2] | hits[3])
    # At most four rows per key are left.
    by_price = Window.partitionBy(*keys).orderBy(price)
    before = F.coalesce(F.lag("cumulative").over(by_price), F.lit(0))
    return picked.select(
        *keys,
        price,
        F.concat(F.lit("grade "), F.row_number().over(by_price).cast("string")).alias("grade"),
        (F.col("cumulative") - before).alias("marginal"),
    )


def log_price_grades(
    df: DataFrame, keys: Sequence[str], base_price: str, resource: str, used: str, elasticity: Column, max_increase: float, grades: int
) -> DataFrame:
    """Graded resource on log-spaced prices; each grade gives what is available at the next price."""
    grid = df.withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(grades - 1))))
    price = F.exp(F.col("__i") * F.lit(math.log(max_increase) / (grades - 1)) + F.log(base_price))
    priced = grid.withColumn("price", price).withColumn(
        "__avail", F.col(resource) * F.pow(F.col("price") / F.col(base_price), elasticity) - F.col(used)
    )
    # One row per grade and key.
    by_grade = Window.partitionBy(*keys).orderBy("__i")
    return priced.select(
        *keys,
        "price",
        F.lead("__avail", 1, 0.0).over(by_grade).alias("available"),
        F.concat(F.lit("grade"), (F.col("__i") + 1).cast("string")).alias("grade"),
    )


def lookup_interpolated(x: Column, knots: Sequence[tuple[float, float]], rule: int = 1) -> Column:
    """Straight-line lookup in a short literal list of points."""
    knots = sorted(knots)
    first, last = knots[0], knots[-1]
    out = F.when(x < first[0], F.lit(first[1]) if rule == 2 else F.lit(None).cast("double"))
    for (x0, y0), (x1, y1) in zip(knots, knots[1:]):
        out = out.when(x <= x1, F.lit(y0) + F.lit(y1 - y0) * (x - F.lit(x0)) / F.lit(x1 - x0))
    return out.when(x > last[0], F.lit(last[1]) if rule == 2 else F.lit(None).cast("double"))


def log_elasticity(q: Column, q0: Column, y: Column, y0: Column, limit: float = 10.0) -> Column:
    """Log change of one amount per log change of another, kept within a limit.

    Without a change in the second amount it is at the limit in the direction of
    the first, and unknown if neither changes.
    """
    up, over = F.log(ratio(q, q0)), F.log(ratio(y, y0))
    unbounded = F.when(up != 0, F.signum(up) * F.lit(limit))
    return F.when(over == 0, unbounded).otherwise(clamp(ratio(up, over), -limit, limit))
