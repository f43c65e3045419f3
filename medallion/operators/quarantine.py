"""Splits of the flagged table; one row may land in both quarantines, in one or in none."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from medallion.schemas import FIELDS, PLAYER_ROW, REVIEW_ROW


def _raw_as(names: dict[str, str]) -> list:
    return [F.col(f"{bronze}_raw").alias(name) for bronze, name in names.items()]


def review_quarantine(flagged: DataFrame) -> DataFrame:
    """Raw values, under the silver names, of rows that break a review rule."""
    names = {f.bronze: f.typed for f in FIELDS if f.grain == "review"}
    columns = {name: column for name, column in zip(names.values(), _raw_as(names))}
    columns.update({c: F.col(c) for c in REVIEW_ROW if c not in columns})
    return (
        flagged.where(F.size("review_failure_reasons") > 0)
        .select(*[columns[c] for c in REVIEW_ROW], "review_failure_reasons")
    )


def player_quarantine(flagged: DataFrame) -> DataFrame:
    """Raw author values of rows that break an author rule; the review keys stay for tracing."""
    names = {f.bronze: f.bronze for f in FIELDS if f.grain == "author"}
    return (
        flagged.where(F.size("review_player_failure_reasons") > 0)
        .select("review_id", "app_id", "author_steam_id", *_raw_as(names), "ingested_at",
                "review_player_failure_reasons")
    )


def clean_review_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.size("review_failure_reasons") == 0).select(*REVIEW_ROW)


def clean_player_rows(flagged: DataFrame, clean_by: str = "author") -> DataFrame:
    """Author rows that are clean by the rules of the ``author`` or of the ``review`` grain.

    The current-state players go by the author rules, the player history by the review rules.
    ``timestamp_updated`` is kept because it orders the versions of one author.
    """
    reasons = {
        "author": "review_player_failure_reasons", "review": "review_failure_reasons",
    }[clean_by]
    return flagged.where(F.size(reasons) == 0).select(*PLAYER_ROW, "timestamp_updated")


def reason_report(flagged: DataFrame, reasons: str) -> DataFrame:
    """Rows per broken rule."""
    return (
        flagged.select(F.explode(reasons).alias("reason"))
        .groupBy("reason").agg(F.count("*").alias("n_rows"))
    )
