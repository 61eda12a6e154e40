"""CSV files whose leading ``#`` lines declare column types and metadata."""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from panelweave.sources.tables import path_missing

# One letter per column in the types line.
TYPE_CODES: dict[str, T.DataType | None] = {
    "c": T.StringType(),
    "n": T.DoubleType(),
    "d": T.DoubleType(),
    "i": T.IntegerType(),
    "l": T.BooleanType(),
    "-": None,
    "_": None,
}

# Labels of the header lines and the metadata they fill.
LABELS = {
    "file": r"File:",
    "title": r"Title:",
    "units": r"Units?:",
    "comments": r"(?:Comments|Description):",
    "reference": r"(?:References?|Sources?):",
    "types": r"Column types:",
}
SEVERAL_LINES = {"comments", "reference"}
REQUIRED = {"file", "title", "units", "types"}
EXTENSIONS = (".csv", ".csv.gz", "")


class HeaderError(ValueError):
    """The header breaks its contract."""


@dataclass
class Annotated:
    df: DataFrame
    metadata: dict[str, str] = field(default_factory=dict)


def parse_header(lines: Sequence[str], name: str, required=frozenset(REQUIRED)) -> dict[str, str]:
    """Metadata from header lines; ``name`` must be the declared file name."""
    if any(line.startswith('"#') for line in lines):
        raise HeaderError(f"quoted comment in {name}")
    body = [line[1:].strip() for line in lines if line.startswith("#")]
    any_label = re.compile(r"^[A-Za-z /]+:")
    found: dict[str, str] = {}
    for key, label in LABELS.items():
        hits = [i for i, line in enumerate(body) if re.match(label, line)]
        if len(hits) > 1:
            raise HeaderError(f"label {key} on several lines in {name}")
        if not hits:
            if key in required:
                raise HeaderError(f"label {key} missing in {name}")
            continue
        text = [re.sub(rf"^{label}", "", body[hits[0]]).strip()]
        if key in SEVERAL_LINES:
            for line in body[hits[0] + 1 :]:
                if any_label.match(line) or set(line) <= {"-"}:
                    break
                text.append(line)
        if any(re.search(r",,+$", t) for t in text):
            raise HeaderError(f"trailing commas in the header of {name}")
        found[key] = "\n".join(t for t in text if t)
        if not found[key]:
            raise HeaderError(f"label {key} is empty in {name}")
    if "file" in required and found["file"].rstrip(",") != name:
        raise HeaderError(f"header names {found['file']}, file is {name}")
    return found


def schema_from_codes(codes: str, names: Sequence[str]) -> tuple[T.StructType, list[str]]:
    """Read schema and the columns to keep."""
    codes = codes.strip()
    if len(codes) != len(names):
        raise HeaderError(f"{len(codes)} type letters for {len(names)} columns")
    unknown = set(codes) - set(TYPE_CODES)
    if unknown:
        raise HeaderError(f"unknown type letters {sorted(unknown)}")
    fields = [T.StructField(n, TYPE_CODES[c] or T.StringType()) for c, n in zip(codes, names)]
    return T.StructType(fields), [n for c, n in zip(codes, names) if TYPE_CODES[c] is not None]


def find_table(spark: SparkSession, base: str, optional: bool = False) -> str | None:
    """First existing path among the known extensions."""
    for extension in EXTENSIONS:
        try:
            spark.read.text(base + extension)
            return base + extension
        except AnalysisException as error:
            if not path_missing(error):
                raise
    if optional:
        return None
    raise FileNotFoundError(base)


def _leading_lines(spark: SparkSession, path: str) -> tuple[list[str], str]:
    """Header lines and the column line: the top of the first split, never the whole file."""
    size = 64
    while True:
        lines = [row.value for row in spark.read.text(path).take(size)]
        head = [i for i, line in enumerate(lines) if not line.startswith(("#", '"#'))]
        if head:
            return lines[: head[0]], lines[head[0]]
        if len(lines) < size:
            raise HeaderError(f"no column line in {path}")
        size *= 2


def read_annotated(spark: SparkSession, path: str, name: str | None = None) -> Annotated:
    """Typed table and metadata; any parse problem fails the job.

    ``path`` is a file that starts with its header lines, or a folder written
    by ``write_annotated`` whose header lies beside it.
    """
    name = name or path.rstrip("/").rsplit("/", 1)[-1]
    try:
        header = [r.value for r in spark.read.text(path + ".header").orderBy("value").collect()]
        header = [re.sub(r"^[0-9]{4} ", "", line) for line in header]
        columns = _leading_lines(spark, path)[1]
    except AnalysisException as error:
        if not path_missing(error):
            raise
        header, columns = _leading_lines(spark, path)
        name = re.sub(r"\.gz$", "", name)
    metadata = parse_header(header, name)
    schema, keep = schema_from_codes(metadata["types"], next(csv.reader([columns])))
    df = (
        spark.read.schema(schema)
        .option("comment", "#")
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", "NA")
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return Annotated(df.select(*[F.col(f"`{c}`") for c in keep]), metadata)


def read_many(spark: SparkSession, bases: Sequence[str], optional: Mapping[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """Several tables by name; a name given twice is read once, an absent optional one is empty."""
    out: dict[str, DataFrame] = {}
    for base in dict.fromkeys(bases):
        schema = (optional or {}).get(base)
        path = find_table(spark, base, optional=schema is not None)
        out[base] = spark.createDataFrame([], schema) if path is None else read_annotated(spark, path).df
    return out


def type_codes(df: DataFrame) -> str:
    letters = {T.StringType(): "c", T.DoubleType(): "n", T.IntegerType(): "i", T.BooleanType(): "l"}
    return "".join(letters.get(f.dataType, "c") for f in df.schema.fields)


def write_annotated(
    df: DataFrame,
    path: str,
    title: str,
    units: str,
    comments: Sequence[str] = (),
    flags: Sequence[str] = (),
    compression: str = "none",
) -> str:
    """CSV folder with a column line per part file, and its header lines beside it."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    lines = [f"# File: {name}", f"# Title: {title}", f"# Units: {units}"]
    if comments:
        lines += [f"# Comments: {comments[0]}", *[f"# {c}" for c in comments[1:]]]
    lines += [f"# Column types: {type_codes(df)}", *[f"# {flag}" for flag in flags], "# ----------"]
    rows = [(f"{i:04d} {line}",) for i, line in enumerate(lines)]
    df.sparkSession.createDataFrame(rows, "value string").coalesce(1).write.mode("overwrite").text(path + ".header")
    df.write.mode("overwrite").option("header", True).option("nullValue", "NA").option(
        "compression", compression
    ).csv(path)
    return path


def read_quirky(
    spark: SparkSession, path: str, schema: T.StructType, skip: str, keep: Column | None = None
) -> DataFrame:
    """CSV without a usable header: own names and types, lines matching ``skip`` left out.

    Lines are filtered as text, so a file may be split over tasks.
    """
    lines = spark.read.text(path).where(~F.col("value").rlike(skip))
    parsed = F.from_csv("value", schema.toDDL(), {"mode": "FAILFAST"})
    rows = lines.select(parsed.alias("r")).select("r.*")
    return rows if keep is None else rows.where(keep)
