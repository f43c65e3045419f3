"""Pages to review rows: parsing, flattening, typing, flagging, validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from medallion.functions.casts import CASTS, epoch_utc, to_bigint, to_boolean, to_double
from medallion.functions.predicates import any_of
from medallion.functions.rules import Rule, author_rules, failure_reasons, review_rules
from medallion.schemas import (
    AUTHOR_FIELDS, BRONZE_TEXT, FIELDS, PAGE_SCHEMA, RAW_ELEMENT_PAGE_SCHEMA, REVIEW_FIELDS,
    REVIEW_SCHEMA,
)
from medallion.session import with_small_methods

NO_DECK_PLAYTIME = "0"

# The column of broken rules of each grain.
REASONS = {"review": "review_failure_reasons", "author": "review_player_failure_reasons"}


def _parsed_once(rows: DataFrame, text: str, schema, name: str) -> DataFrame:
    """The text parsed into ``name``, by way of a one-element explode.

    A filter on something computed from the parsed value would be pushed below the projection and
    take the parser with it, once for each field it looks at. It cannot pass an explode.
    """
    return rows.withColumn(name, F.explode(F.array(F.from_json(text, schema))))


def parse_pages(landing: DataFrame) -> DataFrame:
    """Landing rows with the document parsed into ``page``; every leaf stays text."""
    return landing.withColumn("page", F.from_json("raw_data", PAGE_SCHEMA)).drop("raw_data")


def unreadable_pages(landing: DataFrame) -> DataFrame:
    """Quarantine of the pages that give no bronze row though they are not empty.

    ``page_failure_reasons`` names ``page:unreadable`` for a document that is no JSON and
    ``page:reviews_malformed`` for one whose ``reviews`` is missing or no array. All other pages are
    flattened by ``flatten_reviews``, so every page is in one of the two, or has no reviews.
    """
    parsed = _parsed_once(landing, "raw_data", PAGE_SCHEMA, "page")
    readable = F.try_parse_json("raw_data").isNotNull()
    reasons = failure_reasons([
        Rule("page:unreadable", ~readable), Rule("page:reviews_malformed", readable),
    ])
    return parsed.where(F.col("page.reviews").isNull()).select(
        "raw_data", "ingested_at", reasons.alias("page_failure_reasons"))


def flatten_reviews(landing: DataFrame) -> DataFrame:
    """Bronze: one all-text row per review, page columns repeated; an empty page gives none."""
    elements = parse_pages(landing).select(
        F.col("page.app_id").alias("app_id"), "ingested_at",
        F.explode("page.reviews").alias("r"),
    )
    paths = {
        "app_id": F.col("app_id"),
        "review_id": F.col("r.recommendationid"),
        "author_steam_id": F.col("r.author.steamid"),
        **{f"author_{name}": F.col(f"r.author.{name}") for name in AUTHOR_FIELDS[1:]},
        **{name: F.col(f"r.{name}") for name in REVIEW_FIELDS[2:]},
    }
    deck = "author_deck_playtime_at_review"
    paths[deck] = F.coalesce(paths[deck], F.lit(NO_DECK_PLAYTIME))
    return elements.select(*[paths[name].alias(name) for name in BRONZE_TEXT], "ingested_at")


def type_reviews(bronze: DataFrame) -> DataFrame:
    """Typed copy beside each raw text column (``*_raw``); no row is dropped."""
    columns: list[Column] = [F.col("review_id"), F.col("app_id"), F.col("author_steam_id")]
    columns += [F.col("language"), F.col("review"), F.col("developer_response")]
    for field in FIELDS:
        raw = F.col(field.bronze)
        columns.append(raw.alias(f"{field.bronze}_raw"))
        columns.append(CASTS[field.kind](raw).alias(field.typed))
    return with_small_methods(bronze).select(*columns, "ingested_at")


def flag_reviews(bronze: DataFrame, grains: Sequence[str] = ("review", "author")) -> DataFrame:
    """Flagged silver: typed row plus the broken rules of the review and of the author grain.

    A reader of one grain's reasons names it: no column pruning passes the generator below, so the
    casts and rules of the other grain would be done for nothing.
    """
    typed = type_reviews(bronze)
    rules = {"review": review_rules, "author": author_rules}
    reasons = F.struct(
        *[failure_reasons(rules[grain]()).alias(REASONS[grain]) for grain in grains])
    # By way of a generator: a filter on the reasons would take all rules and casts along with it.
    # The rules stand below it, in a projection: outside a compiled stage a generator is interpreted.
    return typed.withColumn("_reasons", reasons).select(
        *typed.columns, F.inline(F.array("_reasons")))


# --- V1: validated records ------------------------------------------------------------------


def split_page_elements(landing: DataFrame) -> DataFrame:
    """One row per review of a page with the review kept as its own JSON text ``raw_json``."""
    parsed = _parsed_once(landing, "raw_data", RAW_ELEMENT_PAGE_SCHEMA, "page")
    return parsed.select(
        to_whole(F.col("page.app_id")).alias("app_id"), "ingested_at",
        F.posexplode("page.reviews").alias("place", "raw_json"),
    )


# Fields a validated review and its author must have, and the type of each.
REQUIRED_REVIEW = {
    "recommendationid": "bigint", "language": "string", "review": "string",
    "timestamp_created": "bigint", "timestamp_updated": "bigint", "voted_up": "boolean",
    "votes_up": "bigint", "votes_funny": "bigint", "weighted_vote_score": "double",
    "comment_count": "bigint", "steam_purchase": "boolean", "received_for_free": "boolean",
    "written_during_early_access": "boolean", "primarily_steam_deck": "boolean",
    "reactions": "array",
}
REQUIRED_AUTHOR = {
    "steamid": "string", "num_games_owned": "bigint", "num_reviews": "bigint",
    "playtime_forever": "bigint", "playtime_last_two_weeks": "bigint",
    "playtime_at_review": "bigint", "last_played": "bigint",
}


def to_whole(text: Column) -> Column:
    """Whole numbers only: a fraction is an error here, not something to round."""
    exact = text.try_cast("decimal(38,10)")
    return F.coalesce(
        text.try_cast("bigint"),
        F.when(exact == F.round(exact, 0), to_bigint(text)),
    )


_FITS = {
    "string": lambda c: c,
    "bigint": to_whole,
    "double": to_double,
    "boolean": to_boolean,
    "array": lambda c: F.from_json(c, "array<string>"),
}


def record_rules(review: Column) -> list[Rule]:
    """Required-and-typed rules of one parsed review struct (author nested)."""
    rules = [
        Rule(name, _FITS[kind](review[name]).isNull()) for name, kind in REQUIRED_REVIEW.items()
    ]
    author = review["author"]
    return rules + [
        Rule(f"author.{name}", _FITS[kind](author[name]).isNull())
        for name, kind in REQUIRED_AUTHOR.items()
    ]


def validate_records(raw: DataFrame) -> DataFrame:
    """Adds the parsed ``record`` and ``record_errors``, the fields that do not validate."""
    parsed = _parsed_once(raw, "raw_json", REVIEW_SCHEMA, "record")
    rules = record_rules(F.col("record"))
    if "app_id" in raw.columns:
        rules = [Rule("app_id", F.col("app_id").isNull()), *rules]
    return parsed.withColumn("record_errors", failure_reasons(rules))


def valid_records(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("record_errors") == 0).drop("record_errors")


def rejected_records(validated: DataFrame) -> DataFrame:
    """Quarantine of records that do not validate, with the reasons."""
    return validated.where(F.size("record_errors") > 0).drop("record")


def clean_reviews(
    records: DataFrame, source_id: str = "raw_id", keep: Sequence[str] = (),
) -> DataFrame:
    """V1 review grain of valid records: renamed, typed, epoch seconds to instants."""
    r = F.col("record")
    return records.select(
        *keep, "app_id",
        to_whole(r["recommendationid"]).alias("review_id"),
        r["language"].alias("language"),
        F.coalesce(r["review"], F.lit("")).alias("review_text"),
        epoch_utc(to_whole(r["timestamp_created"])).alias("timestamp_created"),
        epoch_utc(to_whole(r["timestamp_updated"])).alias("timestamp_updated"),
        to_boolean(r["voted_up"]).alias("voted_positive"),
        to_whole(r["votes_up"]).alias("votes_helpful"),
        to_whole(r["votes_funny"]).alias("votes_funny"),
        to_double(r["weighted_vote_score"]).alias("weighted_vote_score"),
        to_whole(r["comment_count"]).alias("review_comment_count"),
        to_boolean(r["steam_purchase"]).alias("steam_purchase"),
        to_boolean(r["received_for_free"]).alias("received_for_free"),
        to_boolean(r["written_during_early_access"]).alias("written_during_early_access"),
        to_boolean(r["primarily_steam_deck"]).alias("primarily_play_on_steam_deck"),
        F.col(source_id).alias("source_raw_id"),
    )


def clean_players(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """V1 player grain of valid records."""
    r, author = F.col("record"), F.col("record.author")
    return records.select(
        *keep, "app_id",
        to_whole(r["recommendationid"]).alias("review_id"),
        to_whole(author["steamid"]).alias("steam_user_id"),
        to_whole(author["num_games_owned"]).alias("num_games_owned"),
        to_whole(author["playtime_forever"]).alias("total_playtime_mins"),
        to_whole(author["playtime_last_two_weeks"]).alias("playtime_last_two_weeks_mins"),
        to_whole(author["playtime_at_review"]).alias("playtime_at_review_mins"),
        epoch_utc(to_whole(author["last_played"])).alias("last_played"),
    )


def record_dump(record: Column) -> Column:
    """Canonical text of a valid record: typed, known fields only, missing ones left out.

    Two raw reviews have the same dump exactly when their validated values are the same, so
    ``"900"`` and ``900`` or another key order do not make a new version.
    """
    author = record["author"]
    typed = {
        "bigint": to_whole, "double": to_double, "boolean": to_boolean, "string": lambda c: c,
    }
    fields = [
        typed[kind](record[name]).alias(name)
        for name, kind in REQUIRED_REVIEW.items() if kind != "array"
    ]
    members = [typed[kind](author[name]).alias(name) for name, kind in REQUIRED_AUTHOR.items()]
    return F.to_json(F.struct(
        F.struct(*members).alias("author"), *fields,
        F.try_parse_json(record["reactions"]).alias("reactions"),
    ))


# Whole numbers of the page summary that may be missing.
OPTIONAL_SUMMARY = ["review_score", "total_positive", "total_negative", "total_reviews"]

# --- page level -----------------------------------------------------------------------------


def page_errors(landing: DataFrame) -> DataFrame:
    """Pages with ``page_errors``: broken page fields, and ``reviews`` when one member is bad.

    The members are checked inside the row, so no page is taken apart and shuffled for it.
    """
    page = F.col("page")

    def bad_review(review: Column) -> Column:
        return any_of(rule.broken for rule in record_rules(review))

    rules = [
        Rule("success", to_whole(page["success"]).isNull()),
        Rule("num_reviews", to_whole(page["query_summary"]["num_reviews"]).isNull()),
        *[Rule(name, page["query_summary"][name].isNotNull()
               & to_whole(page["query_summary"][name]).isNull()) for name in OPTIONAL_SUMMARY],
        Rule("cursor", page["cursor"].isNull()),
        Rule("app_id", to_whole(page["app_id"]).isNull()),
        Rule("reviews", F.coalesce(F.exists(page["reviews"], bad_review), F.lit(True))),
    ]
    parsed = _parsed_once(landing, "raw_data", PAGE_SCHEMA, "page")
    return parsed.withColumn("page_errors", failure_reasons(rules))


def accepted_pages(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("page_errors") == 0).drop("page_errors", "page")


def rejected_pages(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("page_errors") > 0).drop("page")


def gated_pages(landing: DataFrame) -> DataFrame:
    """Landing rows with ``page_errors`` and ``outcome``: accepted, rejected or unreadable.

    Unreadable is a text that is no JSON object; every page has exactly one outcome.
    """
    checked = page_errors(landing)
    unreadable = F.col("page").isNull() | F.try_parse_json("raw_data").isNull()
    outcome = F.when(unreadable, "unreadable").when(
        F.size("page_errors") > 0, "rejected").otherwise("accepted")
    return checked.withColumn("outcome", outcome).drop("page")
