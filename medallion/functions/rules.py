"""Named row rules and the array of the names a row breaks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from medallion.schemas import FIELDS


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for rows that break the rule."""

    name: str
    broken: Column


def failure_reasons(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules in rule order; an empty array for a clean row.

    ``array_except`` drops the NULL slots like ``array_compact`` would, but stays inside the
    generated code of the stage, where ``array_compact`` (a lambda) would end it. Rule names are
    unique, so its removal of duplicates changes nothing. Its hash set is built for every row, so
    rows that break no rule go around it.
    """
    slots = [F.when(rule.broken, F.lit(rule.name)) for rule in rules]
    none = F.array().cast("array<string>")
    names = F.array_except(F.array(*slots), F.array(F.lit(None).cast("string")))
    return F.when(F.coalesce(*slots).isNull(), none).otherwise(names)


def _malformed(grain: str, prefix: str) -> list[Rule]:
    return [
        Rule(
            f"{grain}:{field.bronze.removeprefix(prefix)}_malformed",
            F.col(f"{field.bronze}_raw").isNotNull() & F.col(field.typed).isNull(),
        )
        for field in FIELDS
        if field.grain == grain
    ]


def review_rules() -> list[Rule]:
    """The 19 rules of the review grain, on a typed row."""
    missing = [
        # Rule name and the column that must be there.
        ("review:miss_review_id", "review_id"),
        ("review:miss_app_id", "app_id"),
        ("review:miss_review_text", "review"),
        ("review:miss_language", "language"),
        ("review:miss_timestamp_created", "timestamp_created_raw"),
        ("review:miss_voted_up", "voted_up_raw"),
    ]
    required = {column: Rule(name, F.col(column).isNull()) for name, column in missing}
    malformed = {rule.name: rule for rule in _malformed("review", "")}
    ordered: list[Rule] = [required.pop(c) for c in ("review_id", "app_id", "review", "language")]
    # A missing value is named right before the malformed value of the same field.
    for field in FIELDS:
        if field.grain != "review":
            continue
        if f"{field.bronze}_raw" in required:
            ordered.append(required.pop(f"{field.bronze}_raw"))
        ordered.append(malformed[f"review:{field.bronze}_malformed"])
    return ordered


def author_rules() -> list[Rule]:
    """The 8 rules of the author grain, on a typed row."""
    return [Rule("author:miss_author_steam_id", F.col("author_steam_id").isNull())] + _malformed(
        "author", "author_"
    )
