"""Line dedup by site-relative frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelweave.llm.arrow import written
from panelweave.operators.groups import null_safe_join

#: Values of the registered query and of the pipeline.
RATIO, PAGES = 0.05, 4


def _split(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _digest(line: Column) -> Column:
    """128 bits of a line, so that long lines are neither shuffled nor kept."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(
    docs: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, pages: int = PAGES
) -> DataFrame:
    """Digests of each site's boilerplate lines: ``site`` and an array ``lines``.

    Pages of a site with one text are one page, so that copies alone make no
    boilerplate. A line counts once per page. It is boilerplate if it stands on
    at least ``pages`` pages and on more than ``ratio`` of the site's pages. A
    site has at most (mean distinct lines of a page) / ``ratio`` such lines, so
    an array stays short whatever the number of pages. Blank lines never count;
    pages without a site form a site of their own.
    """
    page = _digest(F.coalesce(F.col(text), F.lit(""))).alias("__page")
    totals = docs.select(F.col(site).alias("__of"), page).distinct().groupBy("__of").agg(F.count(F.lit(1)).alias("total"))
    line = F.filter(F.array_distinct(_split(text)), lambda x: F.trim(x) != "")
    every = docs.select(F.col(site).alias("__site"), page, F.transform(line, _digest).alias("__lines"))
    seen = every.dropDuplicates(["__site", "__page"]).select("__site", F.explode("__lines").alias("line"))
    counts = seen.groupBy("__site", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= pages)
    common = null_safe_join(counts, totals, {"__site": "__of"}, "inner").where(F.col("n") > F.col("total") * ratio)
    return common.groupBy("__site").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(
    docs: DataFrame,
    site: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    pages: int = PAGES,
) -> DataFrame:
    """The documents without their site's boilerplate lines, with ``n_lines`` and ``n_removed``.

    Every row stays, with its other columns, and every boilerplate line goes,
    also from a page that holds little else (its text may become empty). A null
    text stays null and has no lines; an empty text has one blank line. Columns
    named like the results are replaced.
    """
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    # written first: the planner then knows its size before it plans to move the texts
    known = written(boilerplate(docs, site, text, ratio, pages), "boilerplate")
    known = known.withColumnRenamed("lines", "__lines")
    joined = null_safe_join(docs.select(*others), known, {site: "__site"}, "left")
    kept = F.when(
        F.col("__lines").isNotNull(),
        F.filter("__split", lambda x: ~F.array_contains("__lines", _digest(x))),
    ).otherwise(F.col("__split"))
    return (
        joined.withColumn("__split", _split(text))
        .withColumn("__kept", kept)
        .withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(F.size("__split")))
        .withColumn("n_removed", F.size("__split") - F.size("__kept"))
        .withColumn(text, F.when(F.col(text).isNotNull(), F.concat_ws("\n", "__kept")))
        .select(*others, "n_lines", "n_removed")
    )


def twin(docs: str = "documents", ratio: float = RATIO, pages: int = PAGES) -> str:
    """SQL over whole lines and whole texts; gives all columns of ``documents`` and the counts."""
    return f"""
with pages_of as (select distinct source, coalesce(text, '') page from {docs}),
totals as (select source, count(*) total from pages_of group by source),
lines_of as (select source, unnest(list_distinct(string_split(page, chr(10)))) line from pages_of),
common as (
  select l.source, l.line from (
    select source, line, count(*) n from lines_of where trim(line, ' ') <> '' group by source, line) l
  join totals p on l.source is not distinct from p.source
  where n >= {pages} and n > total * cast({ratio} as double)),
lists as (select source, list(line) lines from common group by source),
cut as (
  select d.*, string_split(coalesce(d.text, ''), chr(10)) every,
    [x for x in string_split(coalesce(d.text, ''), chr(10)) if not list_contains(coalesce(l.lines, []), x)] few
  from {docs} d left join lists l on d.source is not distinct from l.source)
select doc_id, case when text is not null then array_to_string(few, chr(10)) end as text, lang, source, n_chars,
  cast(case when text is null then 0 else len(every) end as integer) n_lines,
  cast(len(every) - len(few) as integer) n_removed
from cut"""
