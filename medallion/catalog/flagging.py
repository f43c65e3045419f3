"""Typed casts, rule flags, quarantines and clean splits of the derived review rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from medallion.catalog import Query, table
from medallion.catalog.feed import FLAGGED_CTES, bronze_feed
from medallion.catalog.sqltext import ctes
from medallion.functions.casts import epoch_utc, to_number
from medallion.operators.flatten import flag_reviews, type_reviews
from medallion.operators.quarantine import (
    clean_player_rows, clean_review_rows, player_quarantine, reason_report, review_quarantine,
)
from medallion.schemas import FIELDS, PLAYER_ROW, REVIEW_ROW


def flagged(spark: SparkSession, sf_dir: str, *grains: str) -> DataFrame:
    """The flagged rows with the reasons of the named grains, or of both."""
    return flag_reviews(bronze_feed(spark, sf_dir), grains or ("review", "author"))


def typed_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All twenty casts, raw text beside the typed value."""
    return type_reviews(bronze_feed(spark, sf_dir))


def epoch_utc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id", epoch_utc(seconds).cast("timestamp_ntz").alias("at")
    )


def number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_feed(spark, sf_dir).groupBy(
        "votes_funny", to_number(F.col("votes_funny")).cast("bigint").alias("number")
    ).agg(F.count("*").alias("n_rows"))


def flag_reasons_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged(spark, sf_dir, "review").select(
        "review_id", "app_id", "ingested_at", "author_playtime_forever_raw",
        F.array_join("review_failure_reasons", ",").alias("reasons"),
    )


def flag_reasons_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged(spark, sf_dir, "author").select(
        "review_id", "author_steam_id", "ingested_at", "author_playtime_forever_raw",
        F.array_join("review_player_failure_reasons", ",").alias("reasons"),
    )


def flagged_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per grain verdict and rule set: the flagship report."""
    return (
        flagged(spark, sf_dir)
        .groupBy(F.array_join("review_failure_reasons", ",").alias("review_reasons"),
                 F.array_join("review_player_failure_reasons", ",").alias("author_reasons"))
        .agg(F.count("*").alias("n_rows"))
    )


def dlq_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = review_quarantine(flagged(spark, sf_dir, "review"))
    return rows.withColumn("review_failure_reasons", F.array_join("review_failure_reasons", ","))


def dlq_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    reasons = "review_player_failure_reasons"
    rows = player_quarantine(flagged(spark, sf_dir, "author"))
    return rows.withColumn(reasons, F.array_join(reasons, ","))


def clean_reviews_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_review_rows(flagged(spark, sf_dir, "review"))


def clean_players_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_player_rows(flagged(spark, sf_dir, "author")).select(*PLAYER_ROW)


def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flagged(spark, sf_dir)
    return reason_report(rows, "review_failure_reasons").unionByName(
        reason_report(rows, "review_player_failure_reasons")
    )


def _raw(grain: str, name: str) -> str:
    fields = [f for f in FIELDS if f.grain == grain]
    return ", ".join(f"{f.bronze}_raw AS {getattr(f, name)}" for f in fields)


_TYPED = ", ".join(f"{f.bronze}_raw, {f.typed}" for f in FIELDS)

QUERIES = {
    "typed_casts": Query(typed_casts, ctes(*FLAGGED_CTES[:2], final=f"""SELECT review_id, app_id,
        author_steam_id, language, review, developer_response, {_TYPED}, ingested_at FROM typed""")),
    "epoch_utc": Query(epoch_utc_query, """SELECT event_id,
        make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS at FROM events"""),
    "number_text": Query(number_text, ctes(FLAGGED_CTES[0], final="""SELECT votes_funny,
        TRY_CAST(TRY_CAST(votes_funny AS DECIMAL(38,0)) AS BIGINT) AS number, count(*) AS n_rows
        FROM bronze GROUP BY 1, 2""")),
    "flag_reasons_review": Query(flag_reasons_review, ctes(*FLAGGED_CTES, final="""SELECT review_id,
        app_id, ingested_at, author_playtime_forever_raw, review_reasons AS reasons FROM flagged""")),
    "flag_reasons_author": Query(flag_reasons_author, ctes(*FLAGGED_CTES, final="""SELECT review_id,
        author_steam_id, ingested_at, author_playtime_forever_raw, author_reasons AS reasons
        FROM flagged""")),
    "flagged_summary": Query(flagged_summary, ctes(*FLAGGED_CTES, final="""SELECT review_reasons,
        author_reasons, count(*) AS n_rows FROM flagged GROUP BY 1, 2""")),
    "dlq_review": Query(dlq_review, ctes(*FLAGGED_CTES, final=f"""SELECT review_id, app_id, language,
        review, {_raw('review', 'typed')}, developer_response, ingested_at,
        review_reasons AS review_failure_reasons FROM flagged WHERE review_reasons <> ''""")),
    "dlq_player": Query(dlq_player, ctes(*FLAGGED_CTES, final=f"""SELECT review_id, app_id,
        author_steam_id, {_raw('author', 'bronze')}, ingested_at,
        author_reasons AS review_player_failure_reasons FROM flagged
        WHERE author_reasons <> ''""")),
    "clean_reviews_split": Query(clean_reviews_split, ctes(*FLAGGED_CTES, final=f"""SELECT
        {', '.join(REVIEW_ROW)} FROM flagged WHERE review_reasons = ''""")),
    "clean_players_split": Query(clean_players_split, ctes(*FLAGGED_CTES, final=f"""SELECT
        {', '.join(PLAYER_ROW)} FROM flagged WHERE author_reasons = ''""")),
    "reason_counts": Query(reason_counts, ctes(*FLAGGED_CTES, final="""SELECT reason,
        count(*) AS n_rows FROM (
        SELECT unnest(string_split(concat_ws(',', nullif(review_reasons, ''),
         nullif(author_reasons, '')), ',')) AS reason FROM flagged)
        WHERE reason <> '' GROUP BY reason""")),
}
