"""Key checks between the TPC-H-like tables; parents are dropped by value to get orphans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from medallion.catalog import Query, table
from medallion.catalog.merges import COLUMNS, HISTORY, KEYS, ONE_CUT, TWO, FIRST, batch
from medallion.catalog.sqltext import ctes
from medallion.operators.integrity import (
    cascade_delete, missing_rows, new_keys, orphan_keys, orphans, restricting_children,
    set_null_delete,
)
from medallion.operators.merge import open_versions

ORDER_KEY = {"l_orderkey": "o_orderkey"}
CUSTOMER_KEY = {"o_custkey": "c_custkey"}


def _orders(spark: SparkSession, sf_dir: str, urgent: bool) -> DataFrame:
    chosen = F.col("o_orderpriority") == "1-URGENT"
    return table(spark, sf_dir, "orders").where(chosen if urgent else ~chosen)


def new_keys_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = open_versions(batch(spark, sf_dir, 0, ONE_CUT), HISTORY, FIRST)
    return new_keys(batch(spark, sf_dir, 1, ONE_CUT), current, KEYS)


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders that are not there when urgent orders are gone."""
    return orphans(table(spark, sf_dir, "lineitem"), _orders(spark, sf_dir, False), ORDER_KEY).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


def fk_orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_keys(table(spark, sf_dir, "lineitem"), _orders(spark, sf_dir, False), ORDER_KEY)


def cascade_delete_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade_delete(table(spark, sf_dir, "lineitem"), _orders(spark, sf_dir, True),
                          ORDER_KEY).select("l_orderkey", "l_linenumber", "l_extendedprice")


def restrict_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that stop the delete of customers with a negative balance."""
    poor = table(spark, sf_dir, "customer").where("c_acctbal < 0")
    return restricting_children(table(spark, sf_dir, "orders"), poor, CUSTOMER_KEY)


def set_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    poor = table(spark, sf_dir, "customer").where("c_acctbal < 0")
    return set_null_delete(table(spark, sf_dir, "orders"), poor, CUSTOMER_KEY).select(
        "o_orderkey", "o_custkey", "o_totalprice")


def expected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label."""
    return missing_rows(table(spark, sf_dir, "documents").select("doc_id", "lang"),
                        table(spark, sf_dir, "labels"), ["doc_id"])


URGENT = "(SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')"
POOR = "(SELECT c_custkey FROM customer WHERE c_acctbal < 0)"

QUERIES = {
    "new_keys": Query(new_keys_query, ctes(*TWO, final=f"""SELECT
        {', '.join('s.' + c for c in COLUMNS)} FROM b1 s LEFT JOIN b0 t
        ON s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber
        WHERE t.l_orderkey IS NULL""")),
    "fk_orphans": Query(fk_orphans, f"""SELECT l_orderkey, l_linenumber, l_partkey,
        l_extendedprice FROM lineitem WHERE l_orderkey IN {URGENT}"""),
    "fk_orphan_keys": Query(fk_orphan_keys, f"""SELECT DISTINCT l_orderkey FROM lineitem
        WHERE l_orderkey IN {URGENT}"""),
    "cascade_delete": Query(cascade_delete_query, f"""SELECT l_orderkey, l_linenumber,
        l_extendedprice FROM lineitem WHERE l_orderkey NOT IN {URGENT}"""),
    "restrict_delete": Query(restrict_delete, f"""SELECT o_custkey, count(*) AS n_children
        FROM orders WHERE o_custkey IN {POOR} GROUP BY o_custkey"""),
    "set_null_delete": Query(set_null, f"""SELECT o_orderkey, CASE WHEN o_custkey NOT IN {POOR}
        THEN o_custkey END AS o_custkey, o_totalprice FROM orders"""),
    "expected_rows": Query(expected_rows, """SELECT doc_id, lang FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""),
}
