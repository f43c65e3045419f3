"""Selections over bronze rows: the review options, keyset pages, ranges."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from medallion.functions.casts import to_boolean, to_timestamp_ntz
from medallion.schemas import LANGUAGES, ORDER_FILTERS, PURCHASE_TYPES, REVIEW_TYPES


class SelectionError(ValueError):
    """An option outside its domain."""

    error_type = "VALIDATION"


def _checked(name: str, value: str, domain: list[str]) -> str:
    if value not in domain:
        raise SelectionError(f"{name} must be one of {domain}, not {value!r}")
    return value


def check_request(app_id: int, num_per_page: int) -> None:
    """Bounds of a request: the smallest application id and the page size."""
    if not isinstance(app_id, int) or app_id < 10:
        raise SelectionError("app_id must be a whole number from 10 on")
    if not isinstance(num_per_page, int) or not 20 <= num_per_page <= 100:
        raise SelectionError("num_per_page must be a whole number from 20 to 100")


def select_reviews(
    reviews: DataFrame, language: str = "all", review_type: str = "all",
    purchase_type: str = "all",
) -> DataFrame:
    """Bronze rows of a language, a sentiment and a purchase type; ``all`` takes any."""
    _checked("language", language, LANGUAGES)
    _checked("review_type", review_type, REVIEW_TYPES)
    _checked("purchase_type", purchase_type, PURCHASE_TYPES)
    kept = reviews
    if language != "all":
        kept = kept.where(F.col("language") == language)
    if review_type != "all":
        kept = kept.where(to_boolean(F.col("voted_up")) == (review_type == "positive"))
    if purchase_type != "all":
        kept = kept.where(to_boolean(F.col("steam_purchase")) == (purchase_type == "steam"))
    return kept


def newest_first(filter_name: str) -> list[Column]:
    """Sort order of the ``recent`` (created) and ``updated`` filters; ``all`` has none but the id."""
    _checked("filter", filter_name, ORDER_FILTERS)
    by = {"recent": "timestamp_created", "updated": "timestamp_updated"}.get(filter_name)
    newest = [] if by is None else [to_timestamp_ntz(F.col(by)).desc_nulls_last()]
    return [*newest, F.col("review_id")]


def keyset_page(rows: DataFrame, key: str, after: Any, size: int) -> DataFrame:
    """The next ``size`` rows after a key, in key order (a top-k, not a full sort)."""
    return rows.where(F.col(key) > F.lit(after)).orderBy(key).limit(size)


def range_batch(
    rows: DataFrame, key: str, start: Any, stop: Any, size: int | None = None,
) -> DataFrame:
    """Rows with ``start <= key <= stop`` in key order, at most ``size`` of them."""
    batch = rows.where(F.col(key).between(start, stop))
    return batch if size is None else batch.orderBy(key).limit(size)


def resume_point(rows: DataFrame, checkpoint: DataFrame, key: str, pipeline: str) -> DataFrame:
    """Where a pipeline goes on: the smallest key after its checkpoint.

    -1 when all rows are done, 1 when the pipeline never ran. The checkpoint enters the filter on
    the rows as a scalar, so only later keys are read.
    """
    last = checkpoint.where(F.col("pipeline_name") == pipeline).agg(
        F.max("last_raw_id_processed").alias("last_id")
    )
    return (
        rows.where(F.col(key) > last.scalar())
        .agg(F.min(key).alias("next_id"))
        .select(
            F.lit(pipeline).alias("pipeline_name"),
            F.when(last.scalar().isNull(), F.lit(1).cast("bigint"))
            .otherwise(F.coalesce(F.col("next_id"), F.lit(-1).cast("bigint")))
            .alias("resume_id"),
        )
    )


def end_point(rows: DataFrame, key: str) -> DataFrame:
    """The greatest key, -1 for an empty table."""
    return rows.agg(F.coalesce(F.max(key), F.lit(-1).cast("bigint")).alias("end_id"))
