"""Latest versions, content versions, insert-if-absent, keyset reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from medallion.catalog import Query, table
from medallion.functions.casts import content_hash
from medallion.operators.selection import end_point, keyset_page, resume_point
from medallion.operators.versions import (
    content_versions, insert_if_absent, latest_by, latest_per_key, with_content_hash,
    with_content_id, with_surrogate_ids,
)
from medallion.sources.layout import as_view, literal_rows, read_footers

LINE = ["l_orderkey", "l_linenumber"]


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col(c).desc_nulls_last() for c in
             ("l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey")]
    return latest_per_key(table(spark, sf_dir, "lineitem"), LINE, order).select(
        *LINE, "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"
    )


def latest_by_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("o_orderdate").desc_nulls_first(), F.col("o_orderkey").desc_nulls_last()]
    return latest_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], order)


def latest_in_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    return latest_by(rows, ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"])


def content_hash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the canonical JSON of every event property and of every document text."""
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), F.col("event_id")).alias("id"),
        content_hash(F.col("props")).alias("digest"))
    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("id"), F.sha2("text", 256).alias("digest"))
    return events.unionByName(documents)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw versions: user and type are the key, the properties are the content."""
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("app_id"), F.col("event_type").alias("review_id"),
        F.col("props").alias("raw_json"), F.col("ts").alias("inserted_at"),
        F.col("event_id").alias("run_id"),
    )
    return with_content_hash(rows)


SPLIT = "2024-01-15 00:00:00"


def content_versions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New versions of the second half of the month against those of the first."""
    raw = _raw(spark, sf_dir)
    at = F.lit(SPLIT).cast("timestamp_ntz")
    held = content_versions(None, raw.where(F.col("inserted_at") < at))
    new = content_versions(held, raw.where(F.col("inserted_at") >= at))
    return with_content_id(new).select(
        "app_id", "review_id", "raw_json", "inserted_at", "run_id",
        F.length("raw_id").cast("bigint").alias("id_length"),
    )


def insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text no French or German document has; the smallest id stands for copies."""
    rows = table(spark, sf_dir, "documents").withColumn("digest", F.sha2("text", 256))
    target = insert_if_absent(None, rows.where(F.col("lang").isin("fr", "de")), ["digest"],
                              ["doc_id"])
    fresh = insert_if_absent(target, rows, ["digest"], ["doc_id"])
    return fresh.select("doc_id", "lang", "digest", "n_chars")


def surrogate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of orders numbered without a global sort: ids are unique inside a batch."""
    orders = table(spark, sf_dir, "orders")
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    numbered = with_surrogate_ids(orders.where(~late), 1).unionByName(
        with_surrogate_ids(orders.where(late), 2))
    return numbered.groupBy("batch_id").agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("row_in_batch").alias("n_ids"),
    )


def keyset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyset_page(table(spark, sf_dir, "orders"), "o_orderkey", 5000, 1000).select(
        "o_orderkey", "o_totalprice")


def _checkpoint(spark: SparkSession, sf_dir: str, name: str, at: F.Column) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(at.alias("last_raw_id_processed")).select(
        F.lit(name).alias("pipeline_name"), "last_raw_id_processed")


def resume_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pipeline in the middle, one that is done and one that never ran."""
    orders = table(spark, sf_dir, "orders")
    state = _checkpoint(spark, sf_dir, "half", F.floor(F.max("l_orderkey") / 2).cast("bigint"))
    state = state.unionByName(_checkpoint(spark, sf_dir, "done", F.max("l_orderkey") * 10))
    parts = [resume_point(orders, state, "o_orderkey", name) for name in ("half", "done", "new")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def max_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return end_point(table(spark, sf_dir, "orders"), "o_orderkey")


def max_id_from_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end point of the same table without reading a row of it."""
    return end_point(read_footers(spark, f"{sf_dir}/orders.parquet"), "o_orderkey")


def view_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model on a model: inline rows with a NULL, a view over them, joined to the line items."""
    as_view(literal_rows(spark, [(1,), (None,)], "id int"), "starter_rows")
    chosen = as_view(spark.table("starter_rows").where("id = 1"), "starter_rows_chosen")
    lines = table(spark, sf_dir, "lineitem")
    return (
        lines.join(chosen, lines["l_linenumber"] == chosen["id"], "left_semi")
        .groupBy("l_returnflag").agg(F.count("*").alias("n_rows"))
    )


_RAW_SQL = f"""raw AS (SELECT user_id, event_type, props, ts, event_id FROM events),
held AS (SELECT DISTINCT user_id, event_type, props FROM raw WHERE ts < TIMESTAMP '{SPLIT}'),
later AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, props
  ORDER BY ts, event_id) AS rn FROM raw WHERE ts >= TIMESTAMP '{SPLIT}')"""

QUERIES = {
    "latest_version": Query(latest_version, """SELECT l_orderkey, l_linenumber, l_shipdate,
        l_extendedprice, l_partkey, l_suppkey FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
         l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) = 1"""),
    "latest_by_author": Query(latest_by_author, """SELECT * FROM orders QUALIFY row_number() OVER
        (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""),
    "latest_in_batch": Query(latest_in_batch, """SELECT o.* FROM orders o WHERE NOT EXISTS (
        SELECT 1 FROM orders n WHERE n.o_custkey = o.o_custkey
        AND n.o_orderstatus = o.o_orderstatus
        AND (n.o_orderdate, n.o_orderkey) > (o.o_orderdate, o.o_orderkey))"""),
    "content_hash": Query(content_hash_query, """SELECT 'e' || CAST(event_id AS VARCHAR) AS id,
        sha256('{"k":' || json_extract_string(props, '$.k') || '}') AS digest FROM events
        UNION ALL SELECT 'd' || CAST(doc_id AS VARCHAR), sha256(text) FROM documents"""),
    "content_versions": Query(content_versions_query, f"""WITH {_RAW_SQL}
        SELECT user_id AS app_id, event_type AS review_id, props AS raw_json, ts AS inserted_at,
        event_id AS run_id,
        CAST(length(CAST(user_id AS VARCHAR)) + length(event_type) + 66 AS BIGINT) AS id_length
        FROM later l WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM held h WHERE
        h.user_id = l.user_id AND h.event_type = l.event_type AND h.props = l.props)"""),
    "insert_absent": Query(insert_absent, """SELECT min(doc_id) AS doc_id,
        arg_min(lang, doc_id) AS lang, sha256(text) AS digest, arg_min(n_chars, doc_id) AS n_chars
        FROM documents WHERE text NOT IN (SELECT text FROM documents WHERE lang IN ('fr', 'de'))
        GROUP BY text"""),
    "surrogate_ids": Query(surrogate_ids, """SELECT CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01'
        THEN CAST(2 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS batch_id, count(*) AS n_rows,
        count(*) AS n_ids FROM orders GROUP BY 1"""),
    "keyset_page": Query(keyset, """SELECT o_orderkey, o_totalprice FROM orders
        WHERE o_orderkey > 5000 ORDER BY o_orderkey LIMIT 1000"""),
    "resume_point": Query(resume_points, """SELECT 'half' AS pipeline_name, min(o_orderkey)
        AS resume_id FROM orders WHERE o_orderkey > (SELECT CAST(floor(max(l_orderkey) / 2)
        AS BIGINT) FROM lineitem) UNION ALL SELECT 'done', -1 UNION ALL SELECT 'new', 1"""),
    "max_id": Query(max_id, "SELECT max(o_orderkey) AS end_id FROM orders"),
    "max_id_from_footers": Query(
        max_id_from_footers, "SELECT max(o_orderkey) AS end_id FROM orders"),
    "view_chain": Query(view_chain, """SELECT l_returnflag, count(*) AS n_rows FROM lineitem
        WHERE l_linenumber = 1 GROUP BY 1"""),
}
