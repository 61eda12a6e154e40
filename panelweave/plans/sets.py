"""Queries for set operators."""

from pyspark.sql import functions as F

from panelweave.functions.semantics import year_between
from panelweave.operators.quality import duplicate_keys
from panelweave.operators.reshape import stack_tables
from panelweave.plans.registry import query


@query(
    "u1_union_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
)
def _u1(t):
    people = t.customer.select("c_custkey", "c_name", "c_acctbal", F.col("c_mktsegment").alias("segment"))
    firms = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    return stack_tables(
        [people, firms],
        [
            {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance"},
            {"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance"},
        ],
    )


@query(
    "u2_row_difference",
    """SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O'
       EXCEPT SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'""",
)
def _u2(t):
    part = lambda s: t.orders.where(F.col("o_orderstatus") == s).select("o_custkey", "o_orderpriority")
    return part("O").subtract(part("F"))


ACTIVE = "SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = "


@query(
    "u3_value_set_operations",
    f"""SELECT 'both' AS kind, o_custkey FROM ({ACTIVE} 1995 INTERSECT {ACTIVE} 1996)
        UNION ALL SELECT 'either', o_custkey FROM ({ACTIVE} 1995 UNION {ACTIVE} 1996)
        UNION ALL SELECT 'only first', o_custkey FROM ({ACTIVE} 1995 EXCEPT {ACTIVE} 1996)""",
)
def _u3(t):
    active = lambda y: t.orders.where(year_between("o_orderdate", y)).select("o_custkey")
    a, b = active(1995), active(1996)
    tag = lambda df, kind: df.select(F.lit(kind).alias("kind"), "o_custkey")
    return (
        tag(a.intersect(b), "both").unionByName(tag(a.union(b).distinct(), "either")).unionByName(tag(a.subtract(b), "only first"))
    )


@query(
    "u4_split_treat_recombine",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS qty
       FROM lineitem""",
)
def _u4(t):
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", signed.alias("qty"))


@query(
    "u5_duplicate_detection",
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def _u5(t):
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])
