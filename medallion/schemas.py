"""Declared schemas and column lists of every layer. No pipeline infers a schema."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# --- fixed values: field names of the page documents, in document order --------------------

AUTHOR_FIELDS = [
    "steamid", "num_games_owned", "num_reviews", "playtime_forever", "playtime_last_two_weeks",
    "playtime_at_review", "deck_playtime_at_review", "last_played",
]

REVIEW_FIELDS = [
    "recommendationid", "author", "language", "review", "timestamp_created", "timestamp_updated",
    "voted_up", "votes_up", "votes_funny", "weighted_vote_score", "comment_count",
    "steam_purchase", "received_for_free", "written_during_early_access", "developer_response",
    "timestamp_dev_responded", "primarily_steam_deck", "reactions",
]

SUMMARY_FIELDS = [
    "num_reviews", "review_score", "review_score_desc", "total_positive", "total_negative",
    "total_reviews",
]

# --- fixed values end ----------------------------------------------------------------------


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


AUTHOR_SCHEMA = _strings(AUTHOR_FIELDS)

# Every leaf is read as text: numbers and booleans arrive as their JSON text and typing is a
# later, checked step.
REVIEW_SCHEMA = T.StructType([
    T.StructField(name, AUTHOR_SCHEMA if name == "author" else T.StringType())
    for name in REVIEW_FIELDS
])

PAGE_SCHEMA = T.StructType([
    T.StructField("success", T.StringType()),
    T.StructField("app_id", T.StringType()),
    T.StructField("cursor", T.StringType()),
    T.StructField("query_summary", _strings(SUMMARY_FIELDS)),
    T.StructField("reviews", T.ArrayType(REVIEW_SCHEMA)),
])

# The V1 store keeps one review per row and each element as its own JSON text.
RAW_ELEMENT_PAGE_SCHEMA = T.StructType([
    T.StructField("app_id", T.StringType()),
    T.StructField("reviews", T.ArrayType(T.StringType())),
])

PAGE_PARTITIONS = T.StructType([
    T.StructField("steam_app_id", T.LongType()),
    T.StructField("ingestion_date", T.DateType()),
])

LANDING_SCHEMA = T.StructType([
    T.StructField("raw_data", T.StringType()),
    T.StructField("ingested_at", T.TimestampNTZType()),
])


class Field(NamedTuple):
    """One bronze text column and the typed silver column made from it."""

    bronze: str
    typed: str
    kind: str  # bigint, double, boolean, timestamp, json
    grain: str  # review, author


# --- fixed values: bronze text column, silver column, silver type --------------------------

FIELDS = [
    Field("author_num_games_owned", "author_num_games_owned", "bigint", "author"),
    Field("author_num_reviews", "author_num_reviews", "bigint", "author"),
    Field("author_playtime_forever", "author_playtime_forever_mins", "bigint", "author"),
    Field("author_playtime_last_two_weeks", "author_playtime_last_two_weeks_mins", "bigint",
          "author"),
    Field("author_playtime_at_review", "author_playtime_at_review_mins", "bigint", "author"),
    Field("author_deck_playtime_at_review", "author_deck_playtime_at_review_mins", "bigint",
          "author"),
    Field("author_last_played", "author_last_played_timestamp", "timestamp", "author"),
    Field("timestamp_created", "timestamp_created", "timestamp", "review"),
    Field("timestamp_updated", "timestamp_updated", "timestamp", "review"),
    Field("voted_up", "voted_positive", "boolean", "review"),
    Field("votes_up", "votes_helpful", "bigint", "review"),
    Field("votes_funny", "votes_funny", "bigint", "review"),
    Field("weighted_vote_score", "weighted_vote_score", "double", "review"),
    Field("comment_count", "comment_count", "bigint", "review"),
    Field("steam_purchase", "is_steam_purchase", "boolean", "review"),
    Field("received_for_free", "is_received_for_free", "boolean", "review"),
    Field("written_during_early_access", "is_written_during_early_access", "boolean", "review"),
    Field("timestamp_dev_responded", "timestamp_dev_responded", "timestamp", "review"),
    Field("primarily_steam_deck", "is_primarily_steam_deck_player", "boolean", "review"),
    Field("reactions", "reactions", "json", "review"),
]

REVIEW_DATA = [
    "app_id", "language", "review", "timestamp_created", "timestamp_updated", "voted_positive",
    "votes_helpful", "votes_funny", "weighted_vote_score", "comment_count", "is_steam_purchase",
    "is_received_for_free", "is_written_during_early_access", "developer_response",
    "timestamp_dev_responded", "is_primarily_steam_deck_player", "reactions",
]

PLAYER_MEASURES = [
    "author_num_games_owned", "author_num_reviews", "author_playtime_forever_mins",
    "author_playtime_last_two_weeks_mins", "author_playtime_at_review_mins",
    "author_deck_playtime_at_review_mins", "author_last_played_timestamp",
]

CLEAN_REVIEW_DATA = [
    "language", "review_text", "timestamp_created", "timestamp_updated", "voted_positive",
    "votes_helpful", "votes_funny", "weighted_vote_score", "review_comment_count",
    "steam_purchase", "received_for_free", "written_during_early_access",
    "primarily_play_on_steam_deck", "source_raw_id",
]

CLEAN_PLAYER_MEASURES = [
    "num_games_owned", "total_playtime_mins", "playtime_last_two_weeks_mins",
    "playtime_at_review_mins", "last_played",
]

LANGUAGES = [
    "all", "arabic", "bulgarian", "schinese", "tchinese", "czech", "danish", "dutch", "english",
    "finnish", "french", "german", "greek", "hungarian", "indonesian", "italian", "japanese",
    "koreana", "norwegian", "polish", "portuguese", "brazilian", "romanian", "russian", "spanish",
    "latam", "swedish", "thai", "turkish", "ukrainian", "vietnamese",
]

PURCHASE_TYPES = ["all", "non_steam_purchase", "steam"]
REVIEW_TYPES = ["all", "positive", "negative"]
ORDER_FILTERS = ["all", "recent", "updated"]

START_CURSOR = "*"

# --- fixed values end ----------------------------------------------------------------------

BRONZE_TEXT = (
    ["app_id", "review_id", "author_steam_id"]
    + ["author_" + name for name in AUTHOR_FIELDS[1:]]
    + REVIEW_FIELDS[2:]
)

BRONZE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in BRONZE_TEXT]
    + [T.StructField("ingested_at", T.TimestampNTZType())]
)

REVIEW_ROW = ["review_id", *REVIEW_DATA, "ingested_at"]
PLAYER_ROW = ["author_steam_id", "review_id", *PLAYER_MEASURES, "ingested_at"]
CLEAN_REVIEW_ROW = ["app_id", "review_id", *CLEAN_REVIEW_DATA]
CLEAN_PLAYER_ROW = ["app_id", "review_id", "steam_user_id", *CLEAN_PLAYER_MEASURES]

VALIDITY = ["start_timestamp", "end_timestamp", "is_current", "_dlt_updated_at"]

_SPARK_TYPES = {
    "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "timestamp": T.TimestampNTZType(), "json": T.StringType(),
}


def silver_schema(columns: list[str]) -> T.StructType:
    """Schema of a silver row: typed columns by ``FIELDS``, stamps as NTZ, all others text."""
    kinds = {field.typed: _SPARK_TYPES[field.kind] for field in FIELDS}
    kinds["is_current"] = T.BooleanType()
    for stamp in ("ingested_at", "start_timestamp", "end_timestamp", "_dlt_updated_at"):
        kinds[stamp] = T.TimestampNTZType()
    return T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in columns])


CLEAN_REVIEW_SCHEMA = T.StructType([
    T.StructField("app_id", T.LongType()),
    T.StructField("review_id", T.LongType()),
    T.StructField("language", T.StringType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("timestamp_created", T.TimestampType()),
    T.StructField("timestamp_updated", T.TimestampType()),
    T.StructField("voted_positive", T.BooleanType()),
    T.StructField("votes_helpful", T.LongType()),
    T.StructField("votes_funny", T.LongType()),
    T.StructField("weighted_vote_score", T.DoubleType()),
    T.StructField("review_comment_count", T.LongType()),
    T.StructField("steam_purchase", T.BooleanType()),
    T.StructField("received_for_free", T.BooleanType()),
    T.StructField("written_during_early_access", T.BooleanType()),
    T.StructField("primarily_play_on_steam_deck", T.BooleanType()),
    T.StructField("source_raw_id", T.StringType()),
])

CLEAN_PLAYER_SCHEMA = T.StructType([
    T.StructField("app_id", T.LongType()),
    T.StructField("review_id", T.LongType()),
    T.StructField("steam_user_id", T.LongType()),
    T.StructField("num_games_owned", T.LongType()),
    T.StructField("total_playtime_mins", T.LongType()),
    T.StructField("playtime_last_two_weeks_mins", T.LongType()),
    T.StructField("playtime_at_review_mins", T.LongType()),
    T.StructField("last_played", T.TimestampType()),
])

LEDGER_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("app_id", T.LongType()),
    T.StructField("event", T.StringType()),  # start, progress, success, skipped, failed
    T.StructField("cursor", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("error_message", T.StringType()),
])

CURSOR_SCHEMA = T.StructType([
    T.StructField("app_id", T.LongType()),
    T.StructField("last_cursor", T.StringType()),
    T.StructField("last_run_at", T.TimestampNTZType()),
    T.StructField("last_run_status", T.StringType()),
])
