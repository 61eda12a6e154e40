"""The query registry and the views shared by queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Entry:
    build: Callable
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that gives the same rows."""

    def wrap(build):
        if name in REGISTRY:
            raise ValueError(f"{name} registered twice")
        REGISTRY[name] = Entry(build, sql)
        return build

    return wrap


def runner(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
    from panelweave.plans.views import Tables

    return lambda spark, sf_dir: entry.build(Tables(spark, sf_dir))
