"""A corpus pipeline over ``documents``: quality, lines, near-duplicates, benchmark leaks, pieces.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read back as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelweave.llm import decontam, lines, minhash, pieces, quality
from panelweave.llm.arrow import written
from panelweave.llm.queries import piece_model, table


#: What a row is known by: 128 bits of its id and text, so that null and repeated ids are told apart.
ROW = ["__a", "__b"]


def known(docs: DataFrame) -> DataFrame:
    """The documents with the columns ``ROW``."""
    parts = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").isNull(), F.col("text")]
    return docs.withColumns({"__a": F.xxhash64(*parts), "__b": F.xxhash64(F.lit(1), *parts)})


def keyed(docs: DataFrame) -> DataFrame:
    """``known`` with a key ``__row`` that is in the order of the ids, null last."""
    rows = known(docs)
    return rows.withColumn("__row", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *ROW))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep."""
    rows = known(docs)
    judged = quality.judge(rows, table(spark, sf_dir, "labels"), also=ROW)
    return rows.join(judged.where("kept").select(*ROW), ROW, "left_semi").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source; ``n_chars`` follows the text."""
    cut = lines.drop_boilerplate(docs)
    length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near-duplicates; rows of equal id and text count as one.

    Null ids come after all others, and a hash of the text decides among rows of one id.
    """
    rows = keyed(docs)
    kept = minhash.near_duplicates(rows, key="__row").where("kept").select(*[F.col(f"__row.{c}") for c in ROW])
    return rows.join(kept, ROW, "left_semi").dropDuplicates(ROW).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of a benchmark item."""
    rows = keyed(docs)
    found = decontam.leaks(rows, table(spark, sf_dir, "benchmark"), key="__row")
    # written first: leaks are few as a rule, and the planner then need not move the texts to them
    bad = written(found.select(*[F.col(f"__row.{c}") for c in ROW]).distinct(), "leaks")
    return rows.join(bad, ROW, "left_anti").select(*docs.columns)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of the pieces of every text."""
    return pieces.digests(docs, piece_model())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

#: SQL cannot express the forest; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
