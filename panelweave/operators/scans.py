"""Running totals and exact quantiles over groups of any size.

Running totals cut the rows into ranges of about equal size along keys and
order, at splitters that Spark samples; their number follows the row count.
Ranges are scanned in parallel, and a second scan over one row per range
supplies what came before. Quantiles narrow each wanted rank to a band of
values, round by round, until what lies in the bands is small enough to be
sorted per key; ranks are counted, so results are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelweave.functions.semantics import clamp, raise_if, ratio
from panelweave.operators.groups import attach
from panelweave.session import cut_lineage

#: Rows of a range that one task scans.
ROWS = 250_000
#: Equal shares at whose limits a band is cut, and the accuracy of the limits (a tenth of a share).
SHARES, ACCURACY = 256, 2560
#: Rows of a key, or of a band, that one task sorts.
FEW = 1 << 18


def running_total(
    df: DataFrame,
    values: Mapping[str, str],
    keys: Sequence[str],
    order_by: Sequence[Column],
    totals: Mapping[str, str] | None = None,
    rows: int = ROWS,
    write: bool = True,
) -> DataFrame:
    """Add inclusive running sums; ``values`` maps output to input columns.

    ``order_by`` should end in a column that tells rows apart, or rows be summed
    by it before: rows of equal order follow each other in any order and stay in
    one range. ``totals`` maps further columns to running sums whose key total
    they get. The input is written once, unless ``write`` is false because it
    was just written; with more than ``rows`` rows it is written again by
    ranges, as a range's number must not change.
    """
    totals = dict(totals or {})
    kept = cut_lineage(df) if write else df
    n = -(-kept.count() // rows)
    if n <= 1:
        inside = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
        whole = {out: F.sum(values[name]).over(Window.partitionBy(*keys)) for out, name in totals.items()}
        return kept.withColumns({name: F.sum(c).over(inside) for name, c in values.items()} | whole)
    ranged = kept.repartitionByRange(n, *[F.col(k) for k in keys], *order_by)
    ranged = cut_lineage(ranged.withColumn("__range", F.spark_partition_id()))
    # one row per key and range
    sums = ranged.groupBy(*keys, "__range").agg(*[F.sum(c).alias(f"__sum_{name}") for name, c in values.items()])
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *keys,
        "__range",
        *[F.coalesce(F.sum(f"__sum_{name}").over(before), F.lit(0)).alias(f"__before_{name}") for name in values],
        *[F.sum(f"__sum_{name}").over(Window.partitionBy(*keys)).alias(out) for out, name in totals.items()],
    )
    inside = Window.partitionBy(*keys, "__range").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    scanned = ranged.withColumns({f"__in_{name}": F.sum(c).over(inside) for name, c in values.items()})
    joined = attach(scanned, offsets, [*keys, "__range"])
    return joined.select(
        *df.columns, *[(F.col(f"__before_{n}") + F.col(f"__in_{n}")).alias(n) for n in values], *totals
    )


def _beside(rows: DataFrame, limits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows with their key's limits; without keys the limits are one row."""
    if keys:
        return attach(rows, limits, keys)
    one = limits.select(F.struct(*limits.columns).alias("one")).scalar()
    return rows.withColumn("__one", one).select(*rows.columns, "__one.*")


def _inside(value: Column, name: str) -> Column:
    low, high = F.col(f"__low_{name}"), F.col(f"__high_{name}")
    return (low.isNull() | (value >= low)) & (high.isNull() | (value <= high))


def _narrowed(
    rows: DataFrame, limits: DataFrame | None, keys: Sequence[str], value: Column, kind, ranks: Mapping[str, tuple]
) -> DataFrame:
    """Narrower bands around the wanted ranks, from the limits of equal shares of each band's rows.

    Without ``limits`` each key's band holds all its rows, and one sketch serves
    all ranks. ``__most`` counts the rows between the ends of the band that was
    cut; it shrinks each round, however many rows one value holds. A rank lies within a tenth of a share of its place among the
    limits, so the band from two limits below to two above holds it.
    """
    probs = F.array(*[F.lit(i / SHARES) for i in range(SHARES + 1)])
    if limits is None:
        held = F.count(F.lit(1))
        cut = F.percentile_approx(value, probs, F.lit(ACCURACY))
        sums = [held.alias("__total")]
        for name in ranks:
            sums += [cut.alias(f"__cut_{name}"), F.lit(0).alias(f"__below_{name}"), held.alias(f"__in_{name}")]
            sums += [F.lit(None).cast(kind).alias(f"__{end}_{name}") for end in ("low", "high")]
        found = rows.groupBy(*keys).agg(*sums)
    else:
        sums = [F.max("__total").alias("__total")]
        for name in ranks:
            low, high = F.col(f"__low_{name}"), F.col(f"__high_{name}")
            # the ends of a band may be held by very many rows, which are not cut again
            inside = (low.isNull() | (value > low)) & (high.isNull() | (value < high))
            sums += [
                F.percentile_approx(F.when(inside, value), probs, F.lit(ACCURACY)).alias(f"__cut_{name}"),
                F.count(F.when(value <= low, 1)).alias(f"__below_{name}"),
                F.count(F.when(inside, 1)).alias(f"__in_{name}"),
                *[F.max(f"__{end}_{name}").alias(f"__{end}_{name}") for end in ("low", "high")],
            ]
        found = _beside(rows, limits, keys).groupBy(*keys).agg(*sums)
    out = {}
    for name, (first, last) in ranks.items():
        below, held, cut = (F.col(f"__{c}_{name}") for c in ("below", "in", "cut"))
        place = lambda rank: clamp(ratio((rank - below) * F.lit(SHARES), held, 0), -2.0, SHARES + 2.0)
        at = F.least(F.floor(place(first)).cast("int") - 1, F.lit(SHARES))
        to = F.greatest(F.ceil(place(last + 1)).cast("int") + 1, F.lit(0))
        out[f"__low_{name}"] = F.when((held > 0) & (at >= 0), F.get(cut, at)).otherwise(F.col(f"__low_{name}"))
        out[f"__high_{name}"] = F.when((held > 0) & (to <= SHARES), F.get(cut, to)).otherwise(F.col(f"__high_{name}"))
    ends = [F.col(f"__in_{name}") for name in ranks]
    most = F.greatest(*ends) if len(ends) > 1 else ends[0]
    return found.select(*keys, "__total", *[c.alias(n) for n, c in out.items()], most.alias("__most"))


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    steps: Mapping[str, float] | None = None,
    few: int = FEW,
) -> DataFrame:
    """Exact quantiles per key without gathering a key's values.

    ``probs`` names probabilities to be interpolated linearly between order
    statistics, ``steps`` those that give the smallest value whose cumulative
    share reaches them. Keys of more than ``few`` rows have each wanted rank
    narrowed to a band of values first: a round is one aggregate over the rows
    and leaves about a fiftieth of a band. Rows are then counted below, and per
    value inside, the bands; a rank outside its band would fail the job. Only
    the limits of the bands are written, one row per key and round.
    """
    steps = dict(steps or {})
    rows = df.where(F.col(value).isNotNull()).select(*keys, value)
    total, v = F.col("__total"), F.col(value)
    most = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).agg(F.max("__n")).first()[0] or 0
    rank = {name: (total - 1) * F.lit(float(p)) for name, p in probs.items()}
    ranks = {name: (F.floor(r), F.ceil(r)) for name, r in rank.items()}
    for name, p in steps.items():
        at = F.greatest(F.ceil(total * F.lit(float(p)) - F.lit(1e-9)) - 1, F.lit(0))
        ranks[name] = (at, at)
    ends = [f"__{end}_{name}" for name in ranks for end in ("low", "high")]
    limits = None
    while most > few:
        limits = cut_lineage(_narrowed(rows, limits, keys, v, df.schema[value].dataType, ranks))
        most = limits.agg(F.max("__most")).first()[0] * 5 // SHARES
        limits = limits.drop("__most")
    banded = limits is not None
    if banded:
        every = _beside(rows, limits, keys)
        cell = F.when(reduce(lambda a, b: a | b, [_inside(v, name) for name in ranks]), v)
        below = [F.count(F.when(v < F.col(f"__low_{name}"), 1)).alias(f"__below_{name}") for name in ranks]
        held = [F.max(c).alias(c) for c in ("__total", *ends)]
        counts = every.groupBy(*keys, cell.alias(value)).agg(F.count(F.lit(1)).alias("__n"), *below, *held)
    else:
        counts = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
        counts = counts.withColumn("__total", F.sum("__n").over(Window.partitionBy(*keys)))
    whole = Window.partitionBy(*keys)
    run = whole.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    if not banded:
        counts = counts.withColumn("__upto", F.sum("__n").over(run))
    picks = []
    for name, (first, last) in ranks.items():
        inside, upto = F.lit(True), F.col("__upto")
        if banded:
            inside = _inside(v, name) & v.isNotNull()
            upto = F.sum(F.when(inside, F.col("__n"))).over(run) + F.sum(f"__below_{name}").over(whole)
            counts = counts.withColumn(f"__upto_{name}", upto)
            upto = F.col(f"__upto_{name}")
        reached = lambda at, upto=upto, inside=inside: F.min(F.when(inside & (upto > at), v))
        picks += [reached(first).alias(f"__first_{name}"), reached(last).alias(f"__last_{name}")]
    found = counts.groupBy(*keys).agg(F.max("__total").alias("__total"), *picks)
    lost = reduce(lambda a, b: a | b, [F.col(f"__last_{name}").isNull() for name in ranks])
    found = found.where(raise_if((total > 0) & lost, "a quantile lies outside the values looked at"))
    out = []
    for name in probs:
        low = F.col(f"__first_{name}")
        out.append((low + (rank[name] - F.floor(rank[name])) * (F.col(f"__last_{name}") - low)).cast("double").alias(name))
    return found.select(*keys, *out, *[F.col(f"__first_{name}").cast("double").alias(name) for name in steps])


def with_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """Add interpolated quantiles of the group to every row."""
    return attach(df, quantiles(df, keys, value, probs), keys)
