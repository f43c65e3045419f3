"""Run ledger, cursors and backfill state as ordinary tables, for all applications at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from medallion.functions.casts import to_bigint, to_timestamp_ntz
from medallion.operators.merge import CurrentMerge, merge_current
from medallion.operators.versions import latest_by
from medallion.schemas import PAGE_SCHEMA, START_CURSOR

# States of a run and the kinds of failure.
RUNNING, SUCCESS, SKIPPED, FAILED = "running", "success", "skipped_no_reviews", "failed"
FAILURE_TYPES = ["STEAM_VALIDATION", "STEAM_HTTP", "STEAM_API"]

_STATES = {"start": RUNNING, "progress": RUNNING, "success": SUCCESS, "skipped": SKIPPED,
           "failed": FAILED}

CURSOR_MERGE = CurrentMerge(
    keys=("app_id",),
    columns=("app_id", "last_cursor", "last_run_at", "last_run_status"),
    update=("last_cursor", "last_run_at", "last_run_status"),
)


def latest_run_state(events: DataFrame, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """One row per run from its append-only events.

    A start gives the start cursor, progress adds rows and moves the cursors, a skip moves the end
    cursor only, a failure none; every event but the start sets the finish time.
    """
    at = F.struct(*order)
    event = F.col("event")

    def newest(value: Column, kinds: tuple[str, ...]) -> Column:
        return F.max_by(value, F.when(event.isin(*kinds), at))

    state = F.create_map(*[F.lit(x) for pair in _STATES.items() for x in pair])
    return events.groupBy("run_id").agg(
        F.min_by("app_id", at).alias("app_id"),
        F.max_by(state[event], at).alias("status"),
        newest(F.col("cursor"), ("start",)).alias("start_cursor"),
        newest(F.col("cursor"), ("progress", "success", "skipped")).alias("end_cursor"),
        newest(F.col("cursor"), ("progress", "success")).alias("last_success_cursor"),
        F.min(F.when(event == "start", F.col("ts"))).alias("started_at"),
        F.max(F.when(event != "start", F.col("ts"))).alias("finished_at"),
        F.coalesce(F.sum(F.when(event.isin("progress", "success"), F.col("rows"))),
                   F.lit(0)).cast("bigint").alias("rows_fetched"),
        newest(F.col("error_type"), ("failed",)).alias("error_type"),
        newest(F.col("error_message"), ("failed",)).alias("error_message"),
    )


def last_success_cursors(runs: DataFrame) -> DataFrame:
    """Per application the newest run with a success cursor; an unfinished run counts as newest."""
    return (
        runs.where(F.col("last_success_cursor").isNotNull())
        .groupBy("app_id")
        .agg(F.max_by(
            F.struct("last_success_cursor", "finished_at"),
            F.struct(F.col("finished_at").isNull(), F.col("finished_at"), F.col("run_id")),
        ).alias("run"))
        .select("app_id", "run.last_success_cursor", "run.finished_at")
    )


def start_cursors(
    apps: DataFrame, runs: DataFrame, now: Column | str, keep_for: str = "1 hour",
) -> DataFrame:
    """Start cursor per application: the last success cursor while fresh, else the first page."""
    at = (F.lit(now) if isinstance(now, str) else now).cast("timestamp_ntz")
    fresh = at <= F.col("finished_at") + F.expr(f"interval {keep_for}")
    return (
        apps.join(last_success_cursors(runs), "app_id", "left")
        .select(
            "app_id",
            F.when(fresh, F.col("last_success_cursor")).otherwise(F.lit(START_CURSOR))
            .alias("start_cursor"),
        )
    )


def state_cursors(apps: DataFrame, state: DataFrame) -> DataFrame:
    """Start cursor per application from the cursor table, without expiry."""
    return (
        apps.join(state.select("app_id", "last_cursor"), "app_id", "left")
        .select("app_id", F.coalesce("last_cursor", F.lit(START_CURSOR)).alias("start_cursor"))
    )


def upsert_cursors(state: DataFrame, finished: DataFrame) -> DataFrame:
    """Cursor table after the newest finished run of each application in ``finished``."""
    newest = latest_by(finished, ["app_id"], ["last_run_at", "last_cursor"])
    return merge_current(state, newest, CURSOR_MERGE)


def finished_run_rows(pages: DataFrame) -> DataFrame:
    """Ledger rows of runs that loaded one page each; ``rows_loaded`` is the page's own count.

    Pages carry ``run_id``, ``started_at``, ``ended_at``, ``start_cursor`` and ``raw_data``.
    """
    page = F.from_json("raw_data", PAGE_SCHEMA)
    return pages.withColumn("page", page).select(
        "run_id", F.col("page.app_id").alias("app_id"), "started_at", "ended_at", "start_cursor",
        F.col("page.cursor").alias("end_cursor"),
        to_bigint(F.col("page.query_summary.num_reviews")).alias("rows_loaded"),
        F.lit("SUCCESS").alias("status"), F.lit(None).cast("string").alias("failure_reason"),
    )


def failed_run_rows(runs: DataFrame) -> DataFrame:
    """Ledger rows of failed runs; a page that was never fetched leaves cursor and count NULL."""
    return runs.select(
        "run_id", F.col("app_id").cast("string").alias("app_id"), "started_at", "ended_at",
        "start_cursor", F.lit(None).cast("string").alias("end_cursor"),
        F.lit(None).cast("bigint").alias("rows_loaded"), F.lit("FAILED").alias("status"),
        "failure_reason",
    )


def stop_state(
    total_reviews: Column, num_reviews: Column, total_missing_is_zero: bool = True,
) -> Column:
    """What a page says about its run: nothing to read, an empty page, or rows.

    Pages after the first carry no total; the reference behaviour takes that as zero.
    """
    total = F.coalesce(total_reviews, F.lit(0)) if total_missing_is_zero else total_reviews
    return (
        F.when((total == 0) & (num_reviews == 0), F.lit(SKIPPED))
        .when(num_reviews == 0, F.lit("empty_page"))
        .otherwise(F.lit(SUCCESS))
    )


def page_stop_states(landing: DataFrame, total_missing_is_zero: bool = True) -> DataFrame:
    summary = F.col("page.query_summary")
    return landing.withColumn("page", F.from_json("raw_data", PAGE_SCHEMA)).select(
        F.col("page.app_id").alias("app_id"), F.col("page.cursor").alias("cursor"),
        stop_state(to_bigint(summary["total_reviews"]), to_bigint(summary["num_reviews"]),
                   total_missing_is_zero).alias("state"),
    )


def new_run_id() -> Column:
    """A random id per row for the runs of a ledger; take it once, on write."""
    return F.expr("uuid()")


def failure_class(error_type: Column) -> Column:
    """Known failure kinds keep their name, any other is ``OTHER``."""
    return F.when(error_type.isin(*FAILURE_TYPES), error_type).otherwise(F.lit("OTHER"))


def failure_report(runs: DataFrame) -> DataFrame:
    """Failed runs per kind."""
    return (
        runs.where(F.col("status") == FAILED)
        .groupBy(failure_class(F.col("error_type")).alias("error_class"))
        .agg(F.count("*").alias("n_runs"), F.max("finished_at").alias("last_failed_at"))
    )


def backfill_state(
    runs: DataFrame, bronze: DataFrame, events: DataFrame, now: Column | str | None = None,
) -> DataFrame:
    """Per application: how far back the reviews reach, pages done, failures in a row, status.

    ``updated_at`` is the time of the run, or ``now``.
    """
    at = F.localtimestamp() if now is None else (F.lit(now) if isinstance(now, str) else now)
    reached = bronze.groupBy(F.col("app_id").try_cast("bigint").alias("app_id")).agg(
        F.min(to_timestamp_ntz(F.col("timestamp_created"))).alias("oldest_seen_timestamp")
    )
    pages = events.groupBy("app_id").agg(
        F.sum((F.col("event") == "progress").cast("bigint")).alias("pages_completed")
    )
    ended = runs.where(F.col("finished_at").isNotNull())
    totals = ended.groupBy("app_id").agg(
        F.max(F.when(F.col("status") != FAILED, F.col("finished_at"))).alias("last_good_at"),
        F.max("finished_at").alias("last_run_at"),
        F.max_by("status", F.struct("finished_at", "run_id")).alias("last_status"),
        F.max_by("end_cursor", F.when(F.col("end_cursor").isNotNull(),
                                      F.struct("finished_at", "run_id"))).alias("last_cursor"),
    )
    failed = ended.where(F.col("status") == FAILED).select("app_id", "finished_at")
    in_a_row = (
        failed.join(totals.select("app_id", "last_good_at"), "app_id")
        .where(F.col("last_good_at").isNull() | (F.col("finished_at") > F.col("last_good_at")))
        .groupBy("app_id").agg(F.count("*").alias("consecutive_failures"))
    )
    status = (
        F.when(F.col("last_status").isNull(), F.lit("not_started"))
        .when(F.col("last_status") == FAILED, F.lit("failed"))
        .when(F.col("last_status") == RUNNING, F.lit("in_progress"))
        .otherwise(F.lit("complete"))
    )
    return (
        pages.join(totals, "app_id", "left").join(in_a_row, "app_id", "left")
        .join(reached, "app_id", "left")
        .select(
            "app_id", "last_cursor", "oldest_seen_timestamp", "pages_completed",
            status.alias("status"), "last_run_at",
            F.coalesce("consecutive_failures", F.lit(0)).cast("bigint")
            .alias("consecutive_failures"),
            at.cast("timestamp_ntz").alias("updated_at"),
        )
    )


def dedupe_metrics(fetched: DataFrame, inserted: DataFrame) -> DataFrame:
    """Per run: rows fetched, rows that were new, rows that were already there."""
    seen = fetched.groupBy("run_id").agg(F.count("*").alias("rows_fetched"))
    new = inserted.groupBy("run_id").agg(F.count("*").alias("rows_inserted"))
    n_new = F.coalesce("rows_inserted", F.lit(0)).cast("bigint")
    return seen.join(new, "run_id", "left").select(
        "run_id", "rows_fetched", n_new.alias("rows_inserted"),
        (F.col("rows_fetched") - n_new).alias("rows_deduplicated"),
    )
