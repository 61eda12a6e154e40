"""Parquet tables, optional tables, fallbacks and table metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def optional_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty one of the given schema where it is absent."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if not path_missing(error):
            raise
        return spark.createDataFrame([], schema)


def path_missing(error: AnalysisException) -> bool:
    """Whether nothing is there; a table that is there but cannot be read is an error."""
    return error.getCondition() == "PATH_NOT_FOUND"


def with_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """The primary table, or the fallback where the primary is empty; decided inside the plan."""
    return primary.unionByName(fallback.select(*primary.columns).where(~primary.exists()))


def with_units(df: DataFrame, units: Mapping[str, str]) -> DataFrame:
    """Units as column metadata."""
    return df.select(
        *[F.col(c).alias(c, metadata={"units": units[c]}) if c in units else F.col(c) for c in df.columns]
    )


class Annotations:
    """Table metadata as key and value rows, and precursor edges.

    Titles and units replace earlier ones; comments, flags, references and
    precursors add up.
    """

    SINGLE = ("title", "units", "legacy_name")
    MANY = ("comments", "reference", "flags", "precursors")
    SCHEMA = "table string, key string, position int, value string"

    def __init__(self) -> None:
        self._values: dict[tuple[str, str], list[str]] = {}

    def add(self, table: str, key: str, *values: str) -> Annotations:
        if key in self.SINGLE:
            self._values[table, key] = [values[-1]]
        elif key in self.MANY:
            self._values.setdefault((table, key), []).extend(values)
        else:
            raise KeyError(key)
        return self

    def get(self, table: str, key: str) -> list[str]:
        return list(self._values.get((table, key), []))

    def same(self, table: str, other: str, keys: Sequence[str] = SINGLE + MANY) -> Annotations:
        """Copy metadata from another table."""
        for key in keys:
            values = self.get(other, key)
            if values:
                self._values[table, key] = values
        return self

    def rows(self) -> list[tuple[str, str, int, str]]:
        return [(t, k, i, v) for (t, k), vs in self._values.items() for i, v in enumerate(vs)]

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), self.SCHEMA)

    def edges(self, spark: SparkSession) -> DataFrame:
        rows = [(v, t) for t, k, _, v in self.rows() if k == "precursors"]
        return spark.createDataFrame(rows, "source string, target string")

    def data_map(self, spark: SparkSession) -> DataFrame:
        """One row per table with its metadata joined into text."""
        keys = list(self.SINGLE + self.MANY)
        sorted_values = F.array_sort(F.collect_list(F.struct("position", "value")))
        joined = self.to_df(spark).groupBy("table", "key").agg(
            F.array_join(F.transform(sorted_values, lambda s: s["value"]), "; ").alias("value")
        )
        return joined.groupBy("table").pivot("key", keys).agg(F.first("value"))
