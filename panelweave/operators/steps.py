"""User steps: named tables in, named tables out, with declared inputs and outputs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Step:
    """A function over named tables.

    ``inputs`` and ``outputs`` map table names to the columns that must be
    there; an empty list asks for none in particular.
    """

    name: str
    inputs: Mapping[str, Sequence[str]]
    outputs: Mapping[str, Sequence[str]]
    run: Callable[[Mapping[str, DataFrame]], Mapping[str, DataFrame]]


def _check(step: str, side: str, declared: Mapping[str, Sequence[str]], tables: Mapping[str, DataFrame]) -> None:
    missing = [name for name in declared if name not in tables]
    if missing:
        raise KeyError(f"{step}: {side} {missing} missing")
    for name, columns in declared.items():
        lacking = [c for c in columns if c not in tables[name].columns]
        if lacking:
            raise ValueError(f"{step}: {side} {name} lacks columns {lacking}")


def run_step(step: Step, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with the step's outputs added.

    The step sees its declared inputs only. A missing input, an output that is
    not returned, lacks a column or is not declared is an error.
    """
    _check(step.name, "input", step.inputs, tables)
    made = dict(step.run({name: tables[name] for name in step.inputs}))
    _check(step.name, "output", step.outputs, made)
    extra = sorted(set(made) - set(step.outputs))
    if extra:
        raise ValueError(f"{step.name}: outputs {extra} are not declared")
    return dict(tables) | made


def run_steps(steps: Sequence[Step], tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Runs every step as soon as its inputs are there; steps that never get theirs are an error."""
    known, waiting = dict(tables), list(steps)
    while waiting:
        ready = [s for s in waiting if set(s.inputs) <= set(known)]
        if not ready:
            raise KeyError(f"no step makes the inputs of {[s.name for s in waiting]}")
        for step in ready:
            known = run_step(step, known)
            waiting.remove(step)
    return known


def rows_per_group(
    df: DataFrame,
    keys: Sequence[str],
    function: Callable[[pa.Table], pa.Table],
    schema: str,
    order_by: Sequence[str] = (),
    bound: int = 1_000_000,
) -> DataFrame:
    """Rows that a caller's function makes of the rows of each key; null keys are a group like others.

    The function gets a group as one Arrow table with all columns of ``df``,
    sorted by ``order_by``, and returns any number of rows with the columns of
    ``schema``; further columns are dropped, a lacking one fails the job. Rows
    arrive in one shuffle, batch by batch, and a group fails the job as soon as
    more than ``bound`` of its rows have come, so no task holds a larger one.
    For groups without such a bound use aggregates, windows over sampled
    ranges (``running_total``) or joins.
    """
    made = to_arrow_schema(StructType.fromDDL(schema))
    order = [(c, "ascending") for c in order_by]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            n += batch.num_rows
            if n > bound:
                raise ValueError(f"a group on {list(keys)} has over {bound} rows")
            held.append(batch)
        table = pa.Table.from_batches(held)
        out = function(table.sort_by(order) if order else table)
        yield from out.select(made.names).cast(made).to_batches()

    return df.groupBy(*keys).applyInArrow(run, schema)
