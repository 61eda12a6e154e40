"""Lookup, completion and override joins.

No broadcast hints: the planner and adaptive execution pick the strategy from
measured sizes, so a lookup table that outgrows memory falls back to a
shuffled join. Joins against an aggregate compare keys null-safely, which gives
the aggregate a shuffle of its own: only then can adaptive execution split a
hot key of the other side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from panelweave.functions.semantics import any_null, raise_if
from panelweave.operators.groups import attach, first_rows, null_safe_join
from panelweave.session import cut_lineage


def _pairs(on: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    return dict(on) if isinstance(on, Mapping) else {k: k for k in on}


def checked_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    ignore: Sequence[str] = (),
    null_keys: bool = False,
) -> DataFrame:
    """Left join that fails the job when a lookup misses or is ambiguous.

    Every left row must find exactly one right row, and no joined column may
    be null except those in ``ignore``. The check is part of the plan, so it
    costs no extra action, and no later filter can skip it. Right keys are
    counted by a combining aggregate over the keys alone; only a duplicate that
    a left row asks for is an error. A null key counts as a miss unless
    ``null_keys`` lets it match a null key.
    """
    pairs = _pairs(on)
    new = [c for c in right.columns if c not in pairs.values()]
    renamed = {r: f"__key_{r}" for r in pairs.values()}
    counts = right.groupBy(*[F.col(r).alias(f"__n{k}") for r, k in renamed.items()]).agg(
        F.count(F.lit(1)).alias("__matches")
    )
    # Plain equality unless a null key may match: the lookup then is shuffled
    # anew for the join with ``left``, which lets a hot key of ``left`` be split.
    lookup, named = right.withColumnsRenamed(renamed), {k: f"__n{k}" for k in renamed.values()}
    if null_keys:
        lookup = null_safe_join(lookup, counts, named, "inner")
    else:
        lookup = lookup.join(counts, [F.col(k) == F.col(n) for k, n in named.items()]).drop(*named.values())
    joined = null_safe_join(left, lookup, {lk: renamed[rk] for lk, rk in pairs.items()}, "left")
    bad = F.col("__matches").isNull() | (F.col("__matches") > 1)
    bad = reduce(lambda rest, c: rest | F.col(c).isNull(), [c for c in new if c not in ignore], bad)
    if not null_keys:
        bad = bad | any_null(*pairs)
    return joined.where(raise_if(bad, f"lookup on {sorted(pairs)} missed or is ambiguous")).drop("__matches")


def _matching(df: DataFrame, other: DataFrame, on, how: str) -> DataFrame:
    renamed = {l: f"__key_{l}" for l in _pairs(on)}
    keys = other.select(*[F.col(r).alias(renamed[l]) for l, r in _pairs(on).items()]).distinct()
    return null_safe_join(df, keys, renamed, how)


def keep_matching(df: DataFrame, other: DataFrame, on: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Rows whose key occurs in the other table; its keys are collapsed before the shuffle."""
    return _matching(df, other, on, "left_semi")


def drop_matching(df: DataFrame, other: DataFrame, on: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Rows whose key does not occur in the other table."""
    return _matching(df, other, on, "left_anti")


def _hot_keys(df: DataFrame, keys: Sequence[str], share: float, least: int) -> DataFrame:
    """Keys that hold more than ``share`` of the rows and more than ``least`` of them."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    return counts.where((F.col("__n") > F.lit(least)) & (F.col("__n") > total * F.lit(share))).select(*keys)


def full_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    null_keys: bool = False,
    share: float = 0.001,
    least: int = 100_000,
) -> DataFrame:
    """Full outer join whose hot keys are split; a row without a partner comes once.

    A full outer join cannot be split at a hot key, as no part of one side knows
    whether the others found a partner. Keys with more than ``share`` of a
    side's rows, and more than ``least``, are found by a count and written: at
    most 2 / ``share`` rows, which are broadcast. Their rows are joined by an inner join,
    which adaptive execution may split on either side, and those whose key the
    other side lacks are added; all other rows go through the plain join. A null
    key finds no partner unless ``null_keys``; then it meets null. Columns: keys,
    then the others of ``left`` and of ``right``, whose names must differ.
    """
    keys = list(keys)
    mine, theirs = ([c for c in df.columns if c not in keys] for df in (left, right))
    twice = set(mine) & set(theirs)
    if twice:
        raise ValueError(f"both sides have columns named {sorted(twice)}")
    kinds = {f.name: f.dataType for f in [*left.schema.fields, *right.schema.fields]}
    pad = lambda df: df.select(*keys, *[F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in mine + theirs])
    alone = []
    if not null_keys:
        missing = any_null(*keys)
        alone = [pad(df.where(missing)) for df in (left, right)]
        left, right = (df.where(~missing) for df in (left, right))
    hot = cut_lineage(_hot_keys(left, keys, share, least).unionByName(_hot_keys(right, keys, share, least)).distinct())
    named = {k: f"__{k}" for k in keys}

    def joined(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
        made = b.withColumnsRenamed(named)
        cond = reduce(lambda x, y: x & y, [a[k].eqNullSafe(made[n]) for k, n in named.items()])
        return a.join(made, cond, how).select(*[F.coalesce(k, n).alias(k) for k, n in named.items()], *mine, *theirs)

    if hot.isEmpty():
        parts = [joined(left, right, "full"), *alone]
    else:
        few = F.broadcast(hot.withColumnsRenamed(named))
        pick = lambda df, how: df.join(few, reduce(lambda x, y: x & y, [df[k].eqNullSafe(few[n]) for k, n in named.items()]), how)
        a, b = pick(left, "left_semi"), pick(right, "left_semi")
        parts = [
            joined(pick(left, "left_anti"), pick(right, "left_anti"), "full"),
            joined(a, b, "inner"),
            pad(drop_matching(a, b, keys)),
            pad(drop_matching(b, a, keys)),
            *alone,
        ]
    return reduce(DataFrame.unionByName, parts)


def keep_first_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], order_by: Sequence[str], last: bool = False
) -> DataFrame:
    """Left join to the first right row of each key in a stated order."""
    return attach(left, first_rows(right, on, order_by, last=last), on)


def replicate(df: DataFrame, other: DataFrame, blocks: int | None = None) -> DataFrame:
    """Every row of ``df`` with every row of ``other``.

    Written as an equi-join on a block number: rows of ``df`` are spread over
    blocks and ``other`` is present in each, so the product is spread evenly
    over tasks when ``other`` is too large to be sent to all of them. There are
    as many blocks as shuffle partitions unless the caller states a number.
    """
    blocks = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.withColumn("__block", F.pmod(F.xxhash64(*df.columns), F.lit(blocks)).cast("int"))
    copies = other.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return spread.join(copies, "__block").drop("__block")


def replicate_values(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Every row once per literal value, without a join."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def combinations(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """All pairings of the distinct left and distinct right column values."""
    return replicate(df.select(*left).distinct(), df.select(*right).distinct())


def complete(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    values: Sequence,
    fill: Mapping[str, float] | None = None,
) -> DataFrame:
    """Every existing key combination with every value; rows beyond them survive.

    Missing rows get nulls, or ``fill``. Only distinct keys are shuffled; the
    rows themselves pass through.
    """
    kind = df.schema[name].dataType
    present = df.select(*keys, name).distinct()
    grid = replicate_values(present.select(*keys).distinct(), "__value", values)
    grid = grid.withColumn(name, F.col("__value").cast(kind)).drop("__value")
    lacking = [f for f in df.schema.fields if f.name not in keys and f.name != name]
    blanks = drop_matching(grid, present, [*keys, name]).select(
        *keys, name, *[F.lit(None).cast(f.dataType).alias(f.name) for f in lacking]
    )
    done = df.unionByName(blanks)
    return done.fillna(dict(fill)) if fill else done


def complete_panel(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    values: Sequence | Column,
    fill: Mapping[str, float] | None = None,
) -> DataFrame:
    """As ``complete``, reading its input once and leaving it partitioned by key.

    ``values`` may be a column that holds an array, the same in every row.

    A key's rows are gathered to see which values lack, so a key must have one
    row per value, such as a year; aggregate first. A second row of one key and
    value fails the job.
    """
    rest = [f for f in df.schema.fields if f.name not in keys and f.name != name]
    kind = df.schema[name].dataType
    rows = df.groupBy(*keys).agg(F.collect_list(F.struct(name, *[f.name for f in rest])).alias("__rows"))
    taken = F.transform("__rows", lambda row: row[name])
    rows = rows.where(raise_if(F.size("__rows") > F.size(F.array_distinct(taken)), f"several rows of one key and {name}"))
    wanted = values if isinstance(values, Column) else F.array(*[F.lit(v).cast(kind) for v in values])
    rows = rows.withColumn("__wanted", wanted)
    lacking = F.array_except("__wanted", F.transform("__rows", lambda row: row[name]))
    blanks = F.transform(
        lacking,
        lambda v: F.struct(v.alias(name), *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest]),
    )
    done = rows.select(*keys, F.inline(F.concat("__rows", blanks))).select(*df.columns)
    return done.fillna(dict(fill)) if fill else done


def fallback_join(
    df: DataFrame,
    rules: DataFrame,
    levels: Sequence[Sequence[str]],
    value: str,
    order_by: Sequence[str],
    ambiguous: str | None = None,
) -> DataFrame:
    """Value of the most specific rule that applies.

    ``levels`` lists key sets from specific to general. The rules of one key
    at one level are reduced to the first in the stated order, so no level fans
    out; a null value falls through to the next level. ``ambiguous`` names a
    column that says whether rules of the level that decided gave the key
    different values; it is null where no rule applies. Null keys match.

    All levels are matched in one join, on the distinct keys of ``df``, and
    ranked by a combining aggregate, so the rows themselves are joined once.
    """
    keys = list(dict.fromkeys(k for level in levels for k in level))
    by = {c: f"__by_{c}" for c in order_by}

    def spread(rows: DataFrame, *rest: Column) -> DataFrame:
        """Every row once per level, with keys that do not belong to the level set to null."""
        leveled = rows.select(F.explode(F.array(*map(F.lit, range(len(levels))))).alias("__level"), *keys, *rest)
        belongs = {k: [i for i, level in enumerate(levels) if k in level] for k in keys}
        return leveled.withColumns({f"__at_{k}": F.when(F.col("__level").isin(at), F.col(k)) for k, at in belongs.items()})

    at = ["__level", *[f"__at_{k}" for k in keys]]
    given = spread(rules, F.col(value).alias("__value"), *[F.col(c).alias(n) for c, n in by.items()])
    picked = first_rows(given.select(*at, *by.values(), "__value"), at, list(by.values())).select(*at, "__value")
    many = given.groupBy(*at).agg((F.min("__value") != F.max("__value")).alias("__many"))
    found = attach(picked, many, at) if ambiguous else picked.withColumn("__many", F.lit(None).cast("boolean"))
    asked = attach(spread(df.select(*keys).distinct()), found.where(F.col("__value").isNotNull()), at, "inner")
    best = asked.groupBy(*keys).agg(F.min(F.struct("__level", "__value", "__many")).alias("__best"))
    out = {value: F.col("__best")["__value"]} | ({ambiguous: F.col("__best")["__many"]} if ambiguous else {})
    return attach(df, best, keys).select(*df.columns, *[c.alias(name) for name, c in out.items()])


def derived_rows(
    df: DataFrame,
    base: Column,
    rules: DataFrame,
    levels: Sequence[Sequence[str]],
    fractions: Mapping[str, str],
    label: str,
    value: str,
) -> DataFrame:
    """Add rows made from the base rows by fractions that fall back over rule levels.

    ``fractions`` maps the label of the new rows to the rule column with their
    fraction. A row for which no level has a fraction gets a null value.
    """
    out = df
    for name, column in fractions.items():
        known = rules.where(F.col(column).isNotNull())
        made = fallback_join(df.where(base), known, levels, column, [column])
        made = made.withColumn(value, F.col(value) * F.col(column)).withColumn(label, F.lit(name))
        out = out.unionByName(made.select(*df.columns).distinct())
    return out


def swap_codes(df: DataFrame, column: str, codes: DataFrame, code: str, name: str, pattern: str) -> DataFrame:
    """Replace codes by names if every value looks like a code, else names by codes.

    Both sides of the code table must be unique; a duplicate fails the job.
    """
    all_codes = df.agg(F.bool_and(F.col(column).rlike(pattern)).alias("all")).scalar()
    ends = codes.select(
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("from_code"), F.col(code).alias("old"), F.col(name).alias("new")),
                F.struct(F.lit(False).alias("from_code"), F.col(name).alias("old"), F.col(code).alias("new")),
            )
        ).alias("p")
    ).select("p.*")
    unique = (
        ends.groupBy("from_code", "old")
        .agg(F.count(F.lit(1)).alias("n"), F.first("new").alias("__new"))
        .where(raise_if(F.col("n") > 1, "code table has duplicates"))
        .drop("n")
        .withColumnsRenamed({"from_code": "__from", "old": "__old"})
    )
    rows = df.withColumn("__dir", all_codes)
    joined = rows.join(
        unique, rows["__dir"].eqNullSafe(unique["__from"]) & rows[column].eqNullSafe(unique["__old"]), "left"
    )
    return joined.select(*[F.col("__new").alias(c) if c == column else F.col(c) for c in df.columns])


def override_rows(generic: DataFrame, specific: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Specific rows replace the generic rows that share their key."""
    return drop_matching(generic, specific, keys).unionByName(specific)


def revise(df: DataFrame, revised: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Take the revised value where there is one."""
    new = revised.select(*keys, F.col(value).alias("__revised"))
    return attach(df, new, keys).withColumn(value, F.coalesce("__revised", value)).drop("__revised")


def shifted(df: DataFrame, keys: Sequence[str], year: str, value: str, by: int, out: str) -> DataFrame:
    """Value of the same key ``by`` years earlier, by a self-join."""
    earlier = df.select(*keys, (F.col(year) + F.lit(by)).alias(year), F.col(value).alias(out))
    return attach(df, earlier, [*keys, year])


def first_year_reaching(
    rules: DataFrame,
    series: DataFrame,
    keys: Sequence[str],
    threshold: Column,
    start: str,
    year: str = "year",
    value: str = "value",
) -> DataFrame:
    """Stated start year, else the first year in which the series reaches the rule's threshold."""
    rule_cols = rules.columns
    joined = attach(rules, series.select(*keys, year, value), keys, "left")
    reached = joined.groupBy(*rule_cols).agg(
        F.min(F.when(F.col(value) >= threshold, F.col(year))).alias("__first")
    )
    return (
        reached.withColumn(start, F.coalesce(F.col(start), F.col("__first")))
        .where(F.col(start).isNotNull())
        .select(*rule_cols)
    )
