"""URL filters: host-suffix and path-prefix expressions joined on short hash prefixes.

DataFrame functions only. Every URL is expanded into its host suffixes and its
path prefixes up to each slash; a rule is found by the first bytes of the
SHA-256 of its own host and directory, then confirmed by the full digest and by
the rest of its path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelweave.operators.groups import null_safe_join

#: (verdict, host, path) of the registered query.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Hex digits of the digest that the join compares.
SHORT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str) -> Column:
    """What follows the first ``://`` up to a slash, question mark, hash or the end; A-Z lowered."""
    return F.translate(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: str) -> Column:
    """What follows the host up to a question mark, hash or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_suffixes(host: Column, most: Column) -> Column:
    """The host's last labels, from one to ``most`` of them."""
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), most)), lambda n: F.array_join(F.slice(labels, -n, n), ".")
    )


def path_prefixes(path: Column, most: Column) -> Column:
    """The empty path and the path up to each of its first ``most`` slashes."""
    parts = F.split(path, "/", -1)
    return F.transform(
        F.sequence(F.lit(0), F.least(F.size(parts) - 1, most)),
        lambda i: F.when(i == 0, "").otherwise(F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))),
    )


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The pages with ``host``, ``path``, ``rule`` (its host and path) and ``verdict``.

    A rule fits its host and all subdomains if the page's path starts with the
    rule's path. The longest rule wins; of equally long ones that with the
    longer host, then a block. Pages that no rule fits get a null rule and the
    default verdict. A null URL or one without ``://`` has an empty host and
    path, which only a rule for the empty host could fit. Each page row gets
    one result; columns of the pages that clash with the results are replaced.
    """
    limits = rules.agg(
        F.max(F.size(F.split("host", r"\.", -1))).alias("__labels"), F.max(F.size(F.split("path", "/", -1)) - 1).alias("__slashes")
    )
    seen = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(url), "path": path_of(url)})
    known = rules.select(
        F.translate("host", UPPER, LOWER).alias("__host"),
        F.col("path").alias("__path"),
        F.col("verdict").alias("__verdict"),
        F.regexp_extract("path", "(?s)^(.*/)?", 0).alias("__directory"),
    ).distinct()
    known = known.withColumn("__digest", _digest(F.col("__host"), F.col("__directory")))
    known = known.withColumn("__short", F.substring("__digest", 1, SHORT))

    # one expansion for each distinct host and path; expressions beyond the rules' longest would find nothing
    each = seen.select("host", "path").distinct()
    each = each.withColumn("labels", limits.select("__labels").scalar()).withColumn("slashes", limits.select("__slashes").scalar())
    made = each.withColumn("suffix", F.explode(host_suffixes(F.col("host"), F.col("labels"))))
    made = made.withColumn("prefix", F.explode(path_prefixes(F.col("path"), F.col("slashes"))))
    made = made.withColumn("digest", _digest(F.col("suffix"), F.col("prefix")))
    made = made.withColumn("__near", F.substring("digest", 1, SHORT)).drop("suffix", "prefix", "labels", "slashes")
    met = made.join(known, F.col("__near") == F.col("__short"))
    met = met.where((F.col("digest") == F.col("__digest")) & F.startswith("path", F.col("__path")))
    rank = F.struct(
        (F.length("__host") + F.length("__path")).alias("size"),
        F.length("__host").alias("deep"),
        F.when(F.col("__verdict") == "block", 1).otherwise(0).alias("strict"),
    )
    best = met.groupBy(F.col("host").alias("__of_host"), F.col("path").alias("__of_path")).agg(
        F.max_by(F.struct(F.concat("__host", "__path").alias("rule"), F.col("__verdict").alias("verdict")), rank).alias("__won")
    )
    out = null_safe_join(seen, best, {"host": "__of_host", "path": "__of_path"}, "left")
    return out.select(
        *seen.columns, F.col("__won.rule").alias("rule"), F.coalesce("__won.verdict", F.lit(default)).alias("verdict")
    )


def twin(rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow") -> str:
    """The registered query in SQL, each rule tried by plain comparison."""
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return rf"""
with rules(verdict, h, p) as (values {values}),
parts as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) path, row_number() over () n from pages),
fit as (
  select n, h || p as rule, verdict,
    row_number() over (partition by n order by length(h || p) desc, length(h) desc, verdict desc) as place
  from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p))
select page_id, host, path, rule, coalesce(verdict, '{default}') as verdict
from parts left join (select * from fit where place = 1) using (n)"""
