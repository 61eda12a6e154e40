"""Wide and long forms, column names and stacking."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from panelweave.functions.semantics import raise_if

YEAR_PATTERN = r"^(1|2)[0-9]{3}$"


def year_columns(df: DataFrame, pattern: str = YEAR_PATTERN) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def gather_years(
    df: DataFrame, value: str = "value", pattern: str = YEAR_PATTERN, drop_null: bool = False
) -> DataFrame:
    """Year columns to rows with an integer ``year``."""
    years = year_columns(df, pattern)
    ids = [F.col(f"`{c}`") for c in df.columns if c not in years]
    long = df.unpivot(ids, [F.col(f"`{c}`") for c in years], "year", value)
    long = long.withColumn("year", F.col("year").cast("int"))
    return long.where(F.col(value).isNotNull()) if drop_null else long


def spread(
    df: DataFrame,
    ids: Sequence[str],
    key: str,
    value: str,
    names: Sequence,
    fill=None,
    others: str = "fail",
) -> DataFrame:
    """One column per name; two rows for one cell fail the job.

    So does a key value that is not listed, unless ``others`` is "drop".
    """
    unlisted = F.col(key).isNull() | ~F.col(key).isin(list(names)) if names else F.lit(True)
    cells = [F.count(F.when(unlisted, F.lit(1))).alias("__others")]
    for name in names:
        hit = F.col(key) == F.lit(name)
        cells += [
            F.max(F.when(hit, F.col(value))).alias(str(name)),
            F.count(F.when(hit, F.lit(1))).alias(f"__n_{name}"),
        ]
    wide = df.groupBy(*ids).agg(*cells)
    crowded = F.greatest(*[F.col(f"`__n_{n}`") for n in names], F.lit(0)) > 1
    wide = wide.where(raise_if(crowded, f"several rows for one cell of {key}"))
    if others == "fail":
        wide = wide.where(raise_if(F.col("__others") > 0, f"{key} has a value that is not listed"))
    wide = wide.select(*ids, *[F.col(f"`{n}`") for n in names])
    return wide.fillna(fill, subset=[str(n) for n in names]) if fill is not None else wide


def protect_years(df: DataFrame) -> DataFrame:
    """``2005`` becomes ``X2005``, so that the name needs no quoting."""
    return df.toDF(*[re.sub(r"^([0-9]+)$", r"X\1", c) for c in df.columns])


def unprotect_years(df: DataFrame) -> DataFrame:
    return df.toDF(*[re.sub(r"^X([0-9]+)$", r"\1", c) for c in df.columns])


def numeric_columns(df: DataFrame, except_for: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in except_for
    ]


def columns_without_null(df: DataFrame, candidates: Sequence[str] | None = None) -> list[str]:
    """Names of the columns that hold no null, from one aggregate row.

    The names shape the schema, so this runs a job; the row it returns has one
    number per column whatever the table's size.
    """
    candidates = list(candidates or df.columns)
    row = df.agg(*[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(c) for c in candidates]).first()
    return [c for c in candidates if row[c] == 0]


def stack_tables(tables: Sequence[DataFrame], renames: Sequence[Mapping[str, str]] | None = None) -> DataFrame:
    """Union by name after renaming; columns a table lacks become null."""
    renames = renames or [{}] * len(tables)
    out = None
    for df, names in zip(tables, renames):
        df = df.withColumnsRenamed(dict(names))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def equivalence_rows(df: DataFrame, group: str, tag: str) -> DataFrame:
    """One row per group with the list of its distinct tags in order, however many there are."""
    return df.groupBy(group).agg(F.sort_array(F.collect_set(tag)).alias("tags"))
