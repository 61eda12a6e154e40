"""Table and document sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelweave.operators.quality import contract_select

# Kinds of choice function; the first is the default.
LOGIT_TYPES = ("relative-cost-logit", "absolute-cost-logit")


def with_suffix(path: str, suffix: str | None) -> str:
    """Path with a scenario suffix ahead of its extension."""
    if not suffix:
        return path
    stem, dot, extension = path.rpartition(".")
    return f"{stem}{suffix}.{extension}" if dot and "/" not in extension else f"{path}{suffix}"


def split_by_type(df: DataFrame, column: str = "logit_type", types: Sequence[str] = LOGIT_TYPES) -> dict[str, DataFrame]:
    """One table per type without the type column, and the whole table; a missing type is the default."""
    filled = df.fillna(types[0], [column])
    parts = {name: filled.where(F.col(column) == name).drop(column) for name in types}
    return parts | {"all": filled.drop(column)}


def nest(df: DataFrame, keys: Sequence[str], child: str, order: Sequence[str]) -> DataFrame:
    """Gather the rest of each row into a sorted array per key.

    For keys with a bounded number of rows, such as the years of a series.
    """
    rest = [*order, *[c for c in df.columns if c not in keys and c not in order]]
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias(child))


def nest_levels(df: DataFrame, levels: Sequence[Sequence[str]], names: Sequence[str]) -> DataFrame:
    """Nested documents from flat rows.

    ``levels`` lists key columns from the outer to the inner level; ``names``
    are the array columns of the levels below the outermost. Rows must be
    unique over all keys.
    """
    out = df
    for depth in range(len(levels) - 1, 0, -1):
        outer = [c for level in levels[:depth] for c in level]
        out = nest(out, outer, names[depth - 1], list(levels[depth]))
    return out


def write_document(
    tables: Mapping[str, DataFrame],
    path: str,
    contracts: Mapping[str, Sequence[str]] | None = None,
    root: str = "scenario",
    suffix: str | None = None,
) -> dict[str, str]:
    """Write each table as document rows under its header tag; returns a folder per tag.

    Column order follows the registered contract of the tag, where there is one.
    """
    out = {}
    for tag, df in tables.items():
        if contracts and tag in contracts:
            df = contract_select(df, contracts[tag])
        target = with_suffix(f"{path}/{tag}", suffix)
        df.write.mode("overwrite").format("xml").option("rootTag", root).option("rowTag", tag).save(target)
        out[tag] = target
    return out


def write_one_document(
    tables: Mapping[str, DataFrame],
    path: str,
    contracts: Mapping[str, Sequence[str]] | None = None,
    root: str = "scenario",
    suffix: str | None = None,
) -> str:
    """Write several tables as the rows of one document, each under its header tag; returns the folder.

    Tables follow each other in the order given; within a table rows have no
    order. The part files in the order of their names are the document. It is
    cut by ranges of table and row, so a large table is written by many tasks.
    """
    pieces = []
    for place, (tag, df) in enumerate(tables.items(), 1):
        if contracts and tag in contracts:
            df = contract_select(df, contracts[tag])
        line = _one_line(F.to_xml(F.struct(*df.columns), {"rowTag": tag, "indent": ""}))
        pieces.append(df.select(F.lit(place).alias("place"), line.alias("line")))
    spark = pieces[0].sparkSession
    for place, line in ((0, f"<{root}>"), (len(pieces) + 1, f"</{root}>")):
        pieces.append(spark.range(1).select(F.lit(place).alias("place"), F.lit(line).alias("line")))
    return _write_lines(reduce(DataFrame.unionByName, pieces), ["place"], with_suffix(path, suffix))


def write_nested_document(
    df: DataFrame,
    levels: Mapping[str, str],
    leaf: str,
    path: str,
    root: str = "scenario",
    suffix: str | None = None,
) -> str:
    """Write flat rows as one document of nested elements; returns the folder.

    ``levels`` maps element tags, from the outer to the inner, to the column
    that names the element; the other columns become the ``leaf`` element of
    the row. Elements of a level stand in the order of their names, null first
    and without a name attribute; rows of one element have no order, and
    repeated rows stay. No element is gathered: opening and closing tags are
    rows of their own, sorted around what they hold, so a single element of any
    size is written by many tasks. The part files in the order of their names
    are the document.
    """
    tags, columns = list(levels), list(levels.values())
    rest = [c for c in df.columns if c not in columns]
    order = [c for i in range(len(levels)) for c in (f"key{i}", f"side{i}")]

    def lines(rows: DataFrame, depth: int, side: Column, text: Column) -> DataFrame:
        """Rows at a depth: inside all elements around them, before (0), in (1) or behind (2) the last."""
        places = []
        for i, name in enumerate(columns):
            held = F.col(name) if i < depth else F.lit(None).cast(df.schema[name].dataType)
            at = side if i == depth - 1 else F.lit(1 if i < depth else None).cast("int")
            places += [held.alias(f"key{i}"), at.alias(f"side{i}")]
        return rows.select(F.lit(1).alias("place"), *places, _one_line(text).alias("line"))

    pieces = [lines(df, len(levels), F.lit(1), F.to_xml(F.struct(*rest), {"rowTag": leaf, "indent": ""}))]
    inner = df.select(*columns)
    for depth in range(len(levels), 0, -1):
        inner = inner.select(*columns[:depth]).distinct()
        tag, name = tags[depth - 1], F.col(columns[depth - 1]).cast("string")
        for mark, attribute in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            name = F.replace(name, F.lit(mark), F.lit(attribute))
        opened = F.concat(F.lit(f"<{tag}"), F.coalesce(F.concat(F.lit(' name="'), name, F.lit('"')), F.lit("")), F.lit(">"))
        ends = inner.withColumn("__side", F.explode(F.array(F.lit(0), F.lit(2))))
        pieces.append(lines(ends, depth, F.col("__side"), F.when(F.col("__side") == 0, opened).otherwise(f"</{tag}>")))
    frame = df.sparkSession.range(1)
    blank = [F.lit(None).cast(pieces[0].schema[c].dataType).alias(c) for c in order]
    for place, line in ((0, f"<{root}>"), (2, f"</{root}>")):
        pieces.append(frame.select(F.lit(place).alias("place"), *blank, F.lit(line).alias("line")))
    return _write_lines(reduce(DataFrame.unionByName, pieces), ["place", *order], with_suffix(path, suffix))


def _one_line(text: Column) -> Column:
    """The text as one line; a line end inside a value is written as its character reference."""
    return F.replace(F.regexp_replace(text, r"\n\z", ""), F.lit("\n"), F.lit("&#10;"))


def _write_lines(lines: DataFrame, order: Sequence[str], target: str) -> str:
    """Write the column ``line`` sorted, by ranges of the order; rows of one place are spread by their hash."""
    whole = lines.withColumn("spread", F.xxhash64("line"))
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = whole.repartitionByRange(parts, *order, "spread").sortWithinPartitions(*order, "spread")
    ordered.select("line").write.mode("overwrite").text(target)
    return target


def read_from_document(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """The rows under a header tag of a document that ``write_one_document`` wrote."""
    lines = spark.read.text(path).where(F.col("value").rlike(f"^<{tag}[ >/]"))
    return lines.select(F.from_xml("value", schema, {"rowTag": tag}).alias("row")).select("row.*")


def write_by_scenario(df: DataFrame, path: str, column: str = "scenario") -> str:
    """One folder per scenario."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)
    return path


def write_tables(
    tables: Mapping[str, DataFrame], flags: Mapping[str, Sequence[str]], path: str, write_inputs: bool = False
) -> dict[str, str]:
    """Write tables as Parquet; inputs only on request, tables flagged ``no_output`` never."""
    out = {}
    for name, df in tables.items():
        marks = flags.get(name, ())
        if "no_output" in marks or ("input" in marks and not write_inputs):
            continue
        out[name] = f"{path}/{name}"
        df.write.mode("overwrite").parquet(out[name])
    return out
