"""Pages: files, landing, flattening, page checks, validated records, selections."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from medallion.catalog import Query, table
from medallion.catalog.feed import (
    as_run, bronze_feed, bronze_feed_sql, landing_feed, page_feed, page_rows_sql,
)
from medallion.operators.flatten import (
    accepted_pages, clean_players, clean_reviews, flatten_reviews, page_errors, record_dump,
    rejected_pages, rejected_records, split_page_elements, unreadable_pages, valid_records,
    validate_records,
)
from medallion.operators.ledger import page_stop_states
from medallion.operators.selection import newest_first, range_batch, select_reviews
from medallion.schemas import BRONZE_TEXT
from medallion.session import scratch_folder
from medallion.sources.layout import write_bucketed, write_by_day
from medallion.sources.pages import read_pages, read_parsed_pages, to_landing, write_pages

NOW = "2026-03-01 00:00:00"
ROWS = f"WITH rows AS ({page_rows_sql()})"
LISTED = ", ".join([*BRONZE_TEXT, "ingested_at"])
LATE_ERROR = "(event_type = 'error' AND value > 150)"


def page_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_reviews(landing_feed(spark, sf_dir))


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as files in key folders, written twice, read back and flattened."""
    folder = scratch_folder(spark, "pages")
    pages = as_run(page_feed(spark, sf_dir), "load")
    write_pages(pages, folder)
    # A second run of the same keys replaces the first.
    write_pages(pages, folder)
    return flatten_reviews(to_landing(read_pages(spark, folder), NOW))


def page_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages per application and day, counted from the path keys and the parsed documents."""
    folder = scratch_folder(spark, "pages")
    write_pages(as_run(page_feed(spark, sf_dir), "load"), folder)
    return (
        read_parsed_pages(spark, folder)
        .groupBy("steam_app_id", "ingestion_date")
        .agg(F.count("*").alias("n_pages"),
             F.sum(F.size("reviews")).cast("bigint").alias("n_reviews"))
    )


def clean_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean reviews written by day and clustered, then counted from the written table."""
    folder = scratch_folder(spark, "clean")
    write_by_day(record_valid(spark, sf_dir), folder, "timestamp_created",
                 ["app_id", "voted_positive"], mode="overwrite")
    return (
        spark.read.parquet(folder)
        .groupBy(F.col("day").cast("date").alias("day"), "voted_positive")
        .agg(F.count("*").alias("n_rows"), F.max("review_id").alias("last_review_id"))
    )


def bucketed_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table bucketed by its key is aggregated by the key without a shuffle."""
    name = f"bucketed_{uuid.uuid4().hex}"
    rows = bronze_feed(spark, sf_dir).select("app_id", "review_id", "votes_up")
    write_bucketed(rows, name, scratch_folder(spark, name), ["app_id", "review_id"], 8)
    return spark.table(name).groupBy("app_id", "review_id").agg(
        F.count("*").alias("n_rows"), F.max("votes_up").alias("votes_up"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    elements = split_page_elements(landing_feed(spark, sf_dir))
    return validate_records(elements)


def record_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 review grain of the valid records."""
    raw = valid_records(_records(spark, sf_dir)).withColumn("raw_id", F.lit("r"))
    rows = clean_reviews(raw)
    return rows.withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("timestamp_created", "timestamp_updated")
    })


def record_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 player grain of the valid records."""
    rows = clean_players(valid_records(_records(spark, sf_dir)))
    return rows.withColumn("last_played", F.col("last_played").cast("timestamp_ntz"))


def record_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_records(_records(spark, sf_dir)).select(
        "app_id", F.get_json_object("raw_json", "$.recommendationid").alias("review_id"),
        F.array_join("record_errors", ",").alias("errors"),
    )


def record_without_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored text of a record leaves out fields that are not there."""
    valid = valid_records(_records(spark, sf_dir))
    dump = record_dump(F.col("record"))
    return valid.select(
        F.col("record.recommendationid").alias("review_id"),
        dump.contains("developer_response").alias("has_response"),
        F.get_json_object(dump, "$.author.playtime_at_review").alias("playtime_at_review"),
        F.get_json_object(dump, "$.weighted_vote_score").cast("double").alias("score"),
    )


def _page_key(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.get_json_object("raw_data", "$.app_id").alias("app_id"),
        F.get_json_object("raw_data", "$.cursor").alias("cursor"),
    )


def page_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three of four pages are broken, each kind in its own way: no page is lost on the way.

    Every page has its own load time, by which its outcome is found again: the reason, or the
    number of its bronze rows.
    """
    block = F.col("block")
    broken = (
        F.when(block % 4 == 0, F.substring("raw_data", 1, 200))
        .when(block % 4 == 1, F.concat(F.lit('{"app_id": '), F.col("steam_app_id"),
                                       F.lit(', "reviews": 5}')))
        .when(block % 4 == 2, F.lit('{"success": 1}')).otherwise(F.col("raw_data"))
    )
    loaded = F.timestamp_seconds(block).cast("timestamp_ntz")
    landing = page_feed(spark, sf_dir).select(
        broken.alias("raw_data"), loaded.alias("ingested_at"))
    bad = unreadable_pages(landing).select(
        "ingested_at", F.array_join("page_failure_reasons", ",").alias("outcome"),
        F.lit(0).cast("bigint").alias("n_rows"))
    good = flatten_reviews(landing).groupBy("ingested_at").agg(F.count("*").alias("n_rows"))
    return bad.union(good.select("ingested_at", F.lit("bronze"), "n_rows"))


PAGE_QUARANTINE_SQL = """
WITH pages AS (SELECT CAST(floor(event_id / 100) AS BIGINT) AS block, count(*) AS n
               FROM events GROUP BY 1)
SELECT make_timestamp(block * 1000000) AS ingested_at,
 CASE block % 4 WHEN 0 THEN 'page:unreadable' WHEN 3 THEN 'bronze'
      ELSE 'page:reviews_malformed' END AS outcome,
 CASE WHEN block % 4 = 3 THEN n ELSE 0 END AS n_rows FROM pages"""


def page_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = rejected_pages(page_errors(landing_feed(spark, sf_dir)))
    return rejected.select(
        F.get_json_object("raw_data", "$.app_id").alias("app_id"),
        F.get_json_object("raw_data", "$.cursor").alias("cursor"),
        F.array_join("page_errors", ",").alias("errors"),
    )


def page_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_key(accepted_pages(page_errors(landing_feed(spark, sf_dir))))


def stop_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_stop_states(landing_feed(spark, sf_dir))


def select_positive_bought(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = select_reviews(flatten_reviews(landing_feed(spark, sf_dir)), language="german",
                            review_type="positive", purchase_type="steam")
    return chosen.select("app_id", "review_id", "timestamp_created")


def select_negative_not_bought(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = select_reviews(bronze_feed(spark, sf_dir), review_type="negative",
                            purchase_type="non_steam_purchase")
    return chosen.select("app_id", "review_id", "language")


def newest_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 most recently updated reviews (a top-k report)."""
    reviews = flatten_reviews(landing_feed(spark, sf_dir))
    return reviews.orderBy(*newest_first("updated")).limit(100).select(
        "review_id", "timestamp_updated"
    )


def range_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bounded batch out of a key range: the first 1000 orders from key 500 on."""
    return range_batch(table(spark, sf_dir, "orders"), "o_orderkey", 500, 1_000_000, 1000).select(
        "o_orderkey", "o_custkey"
    )


QUERIES = {
    "bucketed_layout": Query(bucketed_layout, f"""SELECT app_id, review_id, count(*) AS n_rows,
        max(votes_up) AS votes_up FROM ({bronze_feed_sql()}) GROUP BY 1, 2"""),
    "page_quarantine": Query(page_quarantine, PAGE_QUARANTINE_SQL),
    "page_flatten": Query(page_flatten, f"{ROWS} SELECT {LISTED} FROM rows"),
    "page_files": Query(page_files, f"{ROWS} SELECT {LISTED} FROM rows"),
    "page_folders": Query(page_folders, f"""{ROWS}, pages AS (
        SELECT app_id, block, CAST(min(ts) AS DATE) AS day, count(*) AS n
        FROM rows GROUP BY app_id, block)
        SELECT CAST(app_id AS BIGINT) AS steam_app_id, day AS ingestion_date,
         count(*) AS n_pages, CAST(sum(n) AS BIGINT) AS n_reviews FROM pages GROUP BY app_id, day"""),
    "clean_by_day": Query(clean_by_day, f"""{ROWS} SELECT
        CAST(make_timestamp(CAST(timestamp_created AS BIGINT) * 1000000) AS DATE) AS day,
        value > 50 AS voted_positive, count(*) AS n_rows,
        max(CAST(review_id AS BIGINT)) AS last_review_id
        FROM rows WHERE NOT {LATE_ERROR} GROUP BY 1, 2"""),
    "record_valid": Query(record_valid, f"""{ROWS} SELECT CAST(app_id AS BIGINT) AS app_id,
        CAST(review_id AS BIGINT) AS review_id, language, review AS review_text,
        make_timestamp(CAST(timestamp_created AS BIGINT) * 1000000) AS timestamp_created,
        make_timestamp(CAST(timestamp_updated AS BIGINT) * 1000000) AS timestamp_updated,
        value > 50 AS voted_positive, CAST(votes_up AS BIGINT) AS votes_helpful,
        CAST(0 AS BIGINT) AS votes_funny, value AS weighted_vote_score,
        CAST(2 AS BIGINT) AS review_comment_count, event_type = 'purchase' AS steam_purchase,
        false AS received_for_free, false AS written_during_early_access,
        false AS primarily_play_on_steam_deck, 'r' AS source_raw_id
        FROM rows WHERE NOT {LATE_ERROR}"""),
    "record_players": Query(record_players, f"""{ROWS} SELECT CAST(app_id AS BIGINT) AS app_id,
        CAST(review_id AS BIGINT) AS review_id, CAST(author_steam_id AS BIGINT) AS steam_user_id,
        user_id AS num_games_owned, CAST(author_playtime_forever AS BIGINT) AS total_playtime_mins,
        CAST(30 AS BIGINT) AS playtime_last_two_weeks_mins,
        CAST(60 AS BIGINT) AS playtime_at_review_mins,
        make_timestamp(CAST(author_last_played AS BIGINT) * 1000000) AS last_played
        FROM rows WHERE NOT {LATE_ERROR}"""),
    "record_rejects": Query(record_rejects, f"""{ROWS} SELECT CAST(app_id AS BIGINT) AS app_id, review_id,
        'timestamp_created' AS errors FROM rows WHERE {LATE_ERROR}"""),
    "record_without_nulls": Query(record_without_nulls, f"""{ROWS} SELECT review_id,
        false AS has_response, '60' AS playtime_at_review, value AS score
        FROM rows WHERE NOT {LATE_ERROR}"""),
    "page_reject": Query(page_reject, f"""{ROWS} SELECT app_id, 'c' || CAST(block AS VARCHAR)
        AS cursor, 'reviews' AS errors FROM rows GROUP BY app_id, block
        HAVING bool_or({LATE_ERROR})"""),
    "page_accept": Query(page_accept, f"""{ROWS} SELECT app_id, 'c' || CAST(block AS VARCHAR)
        AS cursor FROM rows GROUP BY app_id, block HAVING NOT bool_or({LATE_ERROR})"""),
    "stop_state": Query(stop_state, f"""{ROWS} SELECT DISTINCT app_id,
        'c' || CAST(block AS VARCHAR) AS cursor, 'success' AS state FROM rows"""),
    "select_positive_bought": Query(select_positive_bought, f"""{ROWS} SELECT app_id, review_id,
        timestamp_created FROM rows WHERE event_type = 'purchase' AND value > 50"""),
    "select_negative_not_bought": Query(select_negative_not_bought,
        f"""WITH bronze AS ({bronze_feed_sql()}) SELECT app_id, review_id, language FROM bronze
        WHERE voted_up IN ('false', 'f', 'no', 'n', 'off', '0') AND steam_purchase = 'no'"""),
    "newest_updates": Query(newest_updates, f"""{ROWS} SELECT review_id, timestamp_updated FROM rows
        ORDER BY CAST(timestamp_updated AS BIGINT) DESC, review_id LIMIT 100"""),
    "range_read": Query(range_read, """SELECT o_orderkey, o_custkey FROM orders
        WHERE o_orderkey BETWEEN 500 AND 1000000 ORDER BY o_orderkey LIMIT 1000"""),
}
