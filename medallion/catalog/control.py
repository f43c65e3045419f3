"""Ledger, cursors and backfill state on ``events`` read as a run ledger.

A user is an application, a user's day is a run, the five event types are the ledger events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from medallion.catalog import Query, table
from medallion.catalog.feed import page_feed, page_rows_sql
from medallion.operators.ledger import (
    backfill_state, dedupe_metrics, failed_run_rows, failure_report, finished_run_rows,
    last_success_cursors, latest_run_state, page_stop_states, start_cursors, state_cursors,
    upsert_cursors,
)
from medallion.operators.versions import first_by

KINDS = {"view": "start", "click": "progress", "purchase": "success", "signup": "skipped",
         "error": "failed"}
NOW = "2024-01-30 12:00:00"


def _mapped(column: str, values: dict[str, str]) -> F.Column:
    mapping = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return mapping[F.col(column)]


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    kind = (
        F.when(F.col("value") > 100, "STEAM_HTTP").when(F.col("value") > 30, "STEAM_API")
        .when(F.col("value") > 10, "STEAM_VALIDATION").otherwise("KeyError")
    )
    return table(spark, sf_dir, "events").select(
        F.concat_ws("/", F.col("user_id"), F.to_date("ts")).alias("run_id"),
        F.col("user_id").alias("app_id"), _mapped("event_type", KINDS).alias("event"),
        F.concat(F.lit("c"), F.col("event_id")).alias("cursor"),
        F.floor("value").cast("bigint").alias("rows"), "ts",
        F.when(failed, kind).alias("error_type"),
        F.when(failed, F.col("props")).alias("error_message"), "event_id",
    )


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_run_state(ledger(spark, sf_dir), ("ts", "event_id"))


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(spark, sf_dir)


def last_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_success_cursors(_runs(spark, sf_dir))


def _apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers: more applications than ever had a run."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("app_id"))


def start_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return start_cursors(_apps(spark, sf_dir), _runs(spark, sf_dir), NOW, "1 day")


def _state(spark: SparkSession, sf_dir: str, late: bool) -> DataFrame:
    at = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    rows = ledger(spark, sf_dir).where((F.col("ts") >= at) if late else (F.col("ts") < at))
    return rows.where(F.col("event") == "success").select(
        "app_id", F.col("cursor").alias("last_cursor"), F.col("ts").alias("last_run_at"),
        F.lit("SUCCESS").alias("last_run_status"))


def cursor_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursor table after the runs of the first half and then of the second half of the month."""
    empty = _state(spark, sf_dir, False).where(F.lit(False))
    held = upsert_cursors(empty, _state(spark, sf_dir, False))
    return upsert_cursors(held, _state(spark, sf_dir, True))


def state_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_cursors(_apps(spark, sf_dir), cursor_upsert(spark, sf_dir))


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failure_report(_runs(spark, sf_dir))


def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    bronze = events.select(
        F.col("user_id").cast("string").alias("app_id"),
        F.unix_seconds(F.col("ts").cast("timestamp")).cast("string").alias("timestamp_created"))
    return backfill_state(_runs(spark, sf_dir), bronze, ledger(spark, sf_dir), NOW)


def dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run fetches its event properties; only the first copy per user is new."""
    fetched = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("app_id"), "props", "ts", "event_id",
        F.concat_ws("/", F.col("user_id"), F.to_date("ts")).alias("run_id"))
    inserted = first_by(fetched, ["app_id", "props"], ["ts", "event_id"])
    return dedupe_metrics(fetched, inserted)


def finished_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ledger row per page; pages of the last days failed instead."""
    stamp = F.col("ingestion_date").cast("timestamp_ntz")
    pages = page_feed(spark, sf_dir).select(
        "run_id", F.col("steam_app_id").alias("app_id"), stamp.alias("started_at"),
        stamp.alias("ended_at"), F.lit("*").alias("start_cursor"),
        F.lit("timeout").alias("failure_reason"), "raw_data", "ingestion_date")
    late = F.col("ingestion_date") >= F.lit("2024-01-28").cast("date")
    return finished_run_rows(pages.where(~late)).unionByName(failed_run_rows(pages.where(late)))


def stop_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of three pages one has nothing to read, one is empty and one has rows."""
    kind = F.col("block") % 3
    summary = r'"query_summary":\{[^}]*\}'
    pages = page_feed(spark, sf_dir).withColumn("raw_data", F.when(
        kind == 0, F.regexp_replace("raw_data", summary, '"query_summary":{"num_reviews":0}')
    ).when(kind == 1, F.regexp_replace(
        "raw_data", summary, '"query_summary":{"num_reviews":0,"total_reviews":50}')
    ).otherwise(F.col("raw_data")))
    lax = page_stop_states(pages).withColumn("rule", F.lit("missing is zero"))
    strict = page_stop_states(pages, False).withColumn("rule", F.lit("missing is unknown"))
    return lax.union(strict).groupBy("rule", "app_id", "state").agg(F.count("*").alias("n_pages"))


def stop_state_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = page_feed(spark, sf_dir)
    return page_stop_states(pages, total_missing_is_zero=False).groupBy("app_id", "state").agg(
        F.count("*").alias("n_pages"))


_KIND_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in KINDS.items()) + " END"
_LEDGER = f"""ledger AS (SELECT CAST(user_id AS VARCHAR) || '/' || CAST(CAST(ts AS DATE) AS VARCHAR)
 AS run_id, user_id AS app_id, {_KIND_SQL} AS event, 'c' || CAST(event_id AS VARCHAR) AS cursor,
 CAST(floor(value) AS BIGINT) AS rows, ts, event_id,
 CASE WHEN event_type = 'error' THEN CASE WHEN value > 100 THEN 'STEAM_HTTP'
  WHEN value > 30 THEN 'STEAM_API' WHEN value > 10 THEN 'STEAM_VALIDATION'
  ELSE 'KeyError' END END AS error_type,
 CASE WHEN event_type = 'error' THEN props END AS error_message FROM events)"""


def _last(column: str, kinds: str) -> str:
    return (f"(SELECT {column} FROM ledger l WHERE l.run_id = r.run_id AND l.event IN ({kinds}) "
            f"ORDER BY l.ts DESC, l.event_id DESC LIMIT 1)")


_STATUS = ("CASE {} WHEN 'start' THEN 'running' WHEN 'progress' THEN 'running' "
           "WHEN 'success' THEN 'success' WHEN 'skipped' THEN 'skipped_no_reviews' "
           "ELSE 'failed' END")
_ANY = "'start', 'progress', 'success', 'skipped', 'failed'"
_RUNS = f"""{_LEDGER}, runs AS (SELECT r.run_id, r.app_id,
 {_STATUS.format(_last('event', _ANY))} AS status,
 {_last('cursor', "'start'")} AS start_cursor,
 {_last('cursor', "'progress', 'success', 'skipped'")} AS end_cursor,
 {_last('cursor', "'progress', 'success'")} AS last_success_cursor,
 r.started_at, r.finished_at, r.rows_fetched,
 {_last('error_type', "'failed'")} AS error_type,
 {_last('error_message', "'failed'")} AS error_message
 FROM (SELECT run_id, min(app_id) AS app_id, min(ts) FILTER (event = 'start') AS started_at,
  max(ts) FILTER (event <> 'start') AS finished_at,
  CAST(coalesce(sum(rows) FILTER (event IN ('progress', 'success')), 0) AS BIGINT) AS rows_fetched
  FROM ledger GROUP BY run_id) r)"""
_CURSORS = """cursors AS (SELECT app_id, last_success_cursor, finished_at FROM runs
 WHERE last_success_cursor IS NOT NULL QUALIFY row_number() OVER (PARTITION BY app_id
 ORDER BY finished_at DESC NULLS FIRST, run_id DESC) = 1)"""
_STATE = """state AS (SELECT app_id, cursor AS last_cursor, ts AS last_run_at,
 'SUCCESS' AS last_run_status FROM ledger WHERE event = 'success'
 QUALIFY row_number() OVER (PARTITION BY app_id ORDER BY ts DESC, cursor DESC) = 1)"""

QUERIES = {
    "run_ledger": Query(run_ledger, f"WITH {_RUNS} SELECT * FROM runs"),
    "last_cursor": Query(last_cursor, f"WITH {_RUNS}, {_CURSORS} SELECT * FROM cursors"),
    "start_cursor": Query(start_cursor, f"""WITH {_RUNS}, {_CURSORS} SELECT c_custkey AS app_id,
        CASE WHEN TIMESTAMP '{NOW}' <= finished_at + INTERVAL 1 DAY THEN last_success_cursor
        ELSE '*' END AS start_cursor FROM customer LEFT JOIN cursors ON app_id = c_custkey"""),
    "cursor_upsert": Query(cursor_upsert, f"WITH {_LEDGER}, {_STATE} SELECT * FROM state"),
    "state_cursor": Query(state_cursor, f"""WITH {_LEDGER}, {_STATE} SELECT c_custkey AS app_id,
        coalesce(last_cursor, '*') AS start_cursor FROM customer
        LEFT JOIN state ON app_id = c_custkey"""),
    "failure_report": Query(failures, f"""WITH {_RUNS} SELECT CASE WHEN error_type = 'KeyError'
        THEN 'OTHER' ELSE error_type END AS error_class, count(*) AS n_runs,
        max(finished_at) AS last_failed_at FROM runs WHERE status = 'failed' GROUP BY 1"""),
    "backfill_state": Query(backfill, f"""WITH {_RUNS}, ended AS (SELECT * FROM runs
         WHERE finished_at IS NOT NULL),
        good AS (SELECT app_id, max(finished_at) AS at FROM ended WHERE status <> 'failed' GROUP BY 1),
        bad AS (SELECT e.app_id, count(*) AS n FROM ended e LEFT JOIN good g USING (app_id)
         WHERE e.status = 'failed' AND (g.at IS NULL OR e.finished_at > g.at) GROUP BY 1),
        newest AS (SELECT app_id, status, finished_at FROM ended QUALIFY row_number() OVER
         (PARTITION BY app_id ORDER BY finished_at DESC, run_id DESC) = 1),
        cur AS (SELECT app_id, end_cursor FROM ended WHERE end_cursor IS NOT NULL QUALIFY
         row_number() OVER (PARTITION BY app_id ORDER BY finished_at DESC, run_id DESC) = 1),
        apps AS (SELECT user_id AS app_id, date_trunc('second', min(ts)) AS oldest,
         count(*) FILTER (event_type = 'click') AS pages FROM events GROUP BY 1)
        SELECT app_id, end_cursor AS last_cursor, oldest AS oldest_seen_timestamp,
        pages AS pages_completed, TIMESTAMP '{NOW}' AS updated_at, CASE WHEN status IS NULL THEN 'not_started'
        WHEN status = 'failed' THEN 'failed' WHEN status = 'running' THEN 'in_progress'
        ELSE 'complete' END AS status, finished_at AS last_run_at,
        coalesce(n, 0) AS consecutive_failures
        FROM apps LEFT JOIN newest USING (app_id) LEFT JOIN cur USING (app_id)
        LEFT JOIN bad USING (app_id)"""),
    "dedupe_metrics": Query(dedupe, """WITH f AS (SELECT CAST(user_id AS VARCHAR) || '/' ||
        CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, row_number() OVER (PARTITION BY user_id, props
        ORDER BY ts, event_id) AS rn FROM events)
        SELECT run_id, count(*) AS rows_fetched, count(*) FILTER (rn = 1) AS rows_inserted,
        count(*) FILTER (rn > 1) AS rows_deduplicated FROM f GROUP BY run_id"""),
    "finished_runs": Query(finished_runs, f"""WITH rows AS ({page_rows_sql()}),
        pages AS (SELECT app_id, block, count(*) AS n, date_trunc('day', min(ts)) AS day
         FROM rows GROUP BY app_id, block)
        SELECT 'run:' || CAST(block AS VARCHAR) || '+0' AS run_id, app_id,
        CAST(day AS TIMESTAMP) AS started_at, CAST(day AS TIMESTAMP) AS ended_at,
        '*' AS start_cursor, CASE WHEN day < DATE '2024-01-28' THEN
        'c' || CAST(block AS VARCHAR) END AS end_cursor,
        CASE WHEN day < DATE '2024-01-28' THEN n END AS rows_loaded,
        CASE WHEN day < DATE '2024-01-28' THEN 'SUCCESS' ELSE 'FAILED' END AS status,
        CASE WHEN day >= DATE '2024-01-28' THEN 'timeout' END AS failure_reason FROM pages"""),
    "stop_states": Query(stop_states, f"""WITH pages AS (SELECT DISTINCT app_id, block
        FROM ({page_rows_sql()})), stated AS (
        SELECT 'missing is zero' AS rule, app_id, CASE block % 3 WHEN 0 THEN 'skipped_no_reviews'
         WHEN 1 THEN 'empty_page' ELSE 'success' END AS state FROM pages
        UNION ALL SELECT 'missing is unknown', app_id, CASE block % 3 WHEN 2 THEN 'success'
         ELSE 'empty_page' END FROM pages)
        SELECT rule, app_id, state, count(*) AS n_pages FROM stated GROUP BY ALL"""),
    "stop_state_strict": Query(stop_state_strict, f"""WITH rows AS ({page_rows_sql()})
        SELECT app_id, 'success' AS state, count(DISTINCT block) AS n_pages FROM rows
        GROUP BY app_id"""),
}
