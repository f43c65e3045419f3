"""The four declared quality suites."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from medallion.operators.quality import (
    JoinTest, RowTest, Test, TypeTest, UniqueTest, t_accepted, t_app_date, t_between, t_no_later,
    t_not_empty, t_not_null, t_reactions, t_within,
)
from medallion.schemas import LANGUAGES

# Bounds of the checks and the application with a launch date.
CONTENT_FROM = datetime(2003, 9, 12)
AUDIT_FROM = datetime(2026, 1, 1)
LAUNCHED_APP, LAUNCH_DATE = 730, datetime(2012, 8, 21)

FLAGS = [
    "is_primarily_steam_deck_player", "is_received_for_free", "is_steam_purchase",
    "is_written_during_early_access", "voted_positive",
]
COUNTS = ["comment_count", "votes_funny", "votes_helpful"]
PLAYER_MINIMA = {
    "author_num_games_owned": 0,
    "author_num_reviews": 1,
    "author_playtime_forever_mins": 5,
    "author_playtime_last_two_weeks_mins": 0,
    "author_playtime_at_review_mins": 5,
    "author_deck_playtime_at_review_mins": 0,
}


def _stamp(value: datetime):
    return F.lit(value).cast("timestamp_ntz")


def _dated(column: str, low: datetime, now: datetime) -> RowTest:
    return t_within(column, _stamp(low), _stamp(now))


def _flag(column: str) -> list[Test]:
    return [t_not_null(column), TypeTest(column, "boolean"), t_accepted(column, [True, False])]


def _amount(column: str, kind: str, low: int) -> list[Test]:
    return [t_not_null(column), TypeTest(column, kind), t_between(column, low)]


def _moment(column: str, low: datetime, now: datetime) -> list[Test]:
    return [t_not_null(column), TypeTest(column, "timestamp_ntz"), _dated(column, low, now)]


def _validity(now: datetime) -> list[Test]:
    return [
        *_flag("is_current"),
        t_not_null("start_timestamp"), _dated("start_timestamp", AUDIT_FROM, now),
        _dated("end_timestamp", AUDIT_FROM, now),
        t_no_later("valid_start_no_later_than_end", "start_timestamp", "end_timestamp"),
    ]


def _audit(now: datetime) -> list[Test]:
    return [t_not_null("_dlt_updated_at"), _dated("_dlt_updated_at", AUDIT_FROM, now)]


def _reviews(now: datetime) -> list[Test]:
    tests: list[Test] = [
        t_not_null("app_id"), t_not_empty("app_id"),
        t_not_null("review_id"), t_not_empty("review_id"),
        t_not_null("review"),
        t_not_null("language"), t_accepted("language", LANGUAGES),
        t_not_null("reactions"), t_reactions("reactions"),
    ]
    for column in COUNTS:
        tests += _amount(column, "number", 0)
    tests += _amount("weighted_vote_score", "float", 0)
    for column in FLAGS:
        tests += _flag(column)
    tests += _moment("ingested_at", AUDIT_FROM, now)
    tests += _moment("timestamp_created", CONTENT_FROM, now)
    tests += _moment("timestamp_updated", CONTENT_FROM, now)
    tests.append(_dated("timestamp_dev_responded", CONTENT_FROM, now))
    tests += _audit(now)
    tests += [
        t_no_later("updated_no_earlier_than_created", "timestamp_created", "timestamp_updated"),
        t_no_later("responded_no_earlier_than_created", "timestamp_created",
                   "timestamp_dev_responded"),
        t_app_date("created_not_before_launch", "app_id", LAUNCHED_APP, "timestamp_created",
                   _stamp(LAUNCH_DATE)),
        t_app_date("updated_not_before_launch", "app_id", LAUNCHED_APP, "timestamp_updated",
                   _stamp(LAUNCH_DATE)),
    ]
    return tests


def _players(now: datetime, reviews: str) -> list[Test]:
    tests: list[Test] = [t_not_null("author_steam_id"), UniqueTest("review_id")]
    for column, low in PLAYER_MINIMA.items():
        tests += _amount(column, "number", low)
    tests += _moment("author_last_played_timestamp", CONTENT_FROM, now)
    tests += _moment("ingested_at", AUDIT_FROM, now)
    tests += _audit(now)
    tests.append(JoinTest(
        "last_played_not_before_launch", "author_last_played_timestamp", reviews, "review_id",
        "app_id", LAUNCHED_APP, _stamp(LAUNCH_DATE),
    ))
    return tests


def reviews_scd1_suite(now: datetime) -> list[Test]:
    return [*_reviews(now), UniqueTest("review_id")]


def reviews_scd2_suite(now: datetime) -> list[Test]:
    return [*_reviews(now), *_validity(now)]


def players_scd1_suite(now: datetime) -> list[Test]:
    return [*_players(now, "reviews_scd1"), t_not_null("review_id")]


def players_scd2_suite(now: datetime) -> list[Test]:
    return [*_players(now, "reviews_scd2"), *_validity(now)]


SUITES = {
    "reviews_scd1": reviews_scd1_suite,
    "reviews_scd2": reviews_scd2_suite,
    "players_scd1": players_scd1_suite,
    "players_scd2": players_scd2_suite,
}
