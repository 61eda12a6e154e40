"""Connected components of a link table, by joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelweave.llm.arrow import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest member) of every linked node.

    ``links`` has ``a`` and ``b``. Each round replaces the links by shorter
    ones: a node's neighbours are tied to the smallest of them and itself,
    first upwards, then downwards, until every link leads to a component's
    smallest member. Rounds grow with the logarithm of a component's width.
    Each round is written to the shared folder. A hot node only ever meets a
    sum over its links, so its rows are combined before they are shuffled.
    """
    rows = written(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    while True:
        large = _star(rows, both=True)
        small = written(_star(large, both=False), "links")
        if rows.count() == small.count() and not small.exceptAll(rows).head(1):
            break
        rows = small
    return rows.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        rows.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _star(rows: DataFrame, both: bool) -> DataFrame:
    """Ties each node's neighbours to the smallest of them; ``both`` ties only the larger ones."""
    near = rows.select(F.col("a").alias("node"), F.col("b").alias("other"))
    if both:
        near = near.unionByName(rows.select(F.col("b").alias("node"), F.col("a").alias("other")))
    least = near.groupBy("node").agg(F.min("other").alias("other_least"))
    least = least.select(F.col("node").alias("of"), F.least("node", "other_least").alias("least"))
    joined = near.join(least, near["node"].eqNullSafe(least["of"]))
    if both:
        made = joined.where("other > node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    else:
        made = joined.select(
            F.explode(
                F.array(
                    F.struct(F.col("other").alias("a"), F.col("least").alias("b")),
                    F.struct(F.col("node").alias("a"), F.col("least").alias("b")),
                )
            ).alias("e")
        ).select("e.*")
    return made.where("a != b").distinct()
