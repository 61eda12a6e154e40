"""Small helpers around ``mapInArrow`` and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

import panelweave
from panelweave.session import scratch_dir

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package to the session's Python workers, as --py-files would; once per application."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    _SHIPPED.add(spark.sparkContext.applicationId)
    root = os.path.dirname(os.path.abspath(panelweave.__file__))
    if not os.path.isdir(root):
        return  # it came in an archive, which the workers have too
    path = os.path.join(tempfile.mkdtemp(), "panelweave.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, files in os.walk(root):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)


def map_batches(df: DataFrame, columns: Sequence, make: Callable, schema: str) -> DataFrame:
    """Rows that ``make`` yields for each Arrow batch of the given columns.

    ``make`` gets a record batch and returns an iterator of dicts of columns.
    """
    names = [c.split()[0] for c in schema.split(", ")]
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for made in make(batch):
                yield pa.RecordBatch.from_arrays([_array(made[n]) for n in names], names)

    return df.select(*columns).mapInArrow(run, schema)


def _array(values) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)


def written(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back, for steps that read it again."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, text: str = "text"):
    """The text column, null as empty."""
    return F.coalesce(F.col(text), F.lit("")).alias(text)
