"""Latest version per key, content versions, insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from medallion.functions.casts import content_hash


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in ``order``; NULL is one key.

    The filter on the row number lets Spark keep one row per key in every map task before the
    shuffle, so a key holding a large share of the rows sends only one row per task.
    """
    ranked = rows.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def arrival_order(columns: Sequence[str], tie_breakers: Sequence[Column] = ()) -> list[Column]:
    """Newest load first, then newest update, NULL update last.

    Rows of one page share the load time, so a tie breaker is needed for a repeatable choice; the
    hash of the row is taken where none is given.
    """
    ties = list(tie_breakers) or [F.xxhash64(*columns).desc()]
    return [F.col("ingested_at").desc_nulls_first(), F.col("timestamp_updated").desc_nulls_last(),
            *ties]


def latest_by(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the greatest ``order`` tuple per key, combined on the map side."""
    rest = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def first_by(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the smallest ``order`` tuple per key."""
    rest = [c for c in rows.columns if c not in keys]
    oldest = rows.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return oldest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def with_content_hash(rows: DataFrame, json_column: str = "raw_json") -> DataFrame:
    return rows.withColumn("hash_raw_json", content_hash(F.col(json_column)))


def insert_if_absent(
    target: DataFrame | None, source: DataFrame, keys: Sequence[str], order: Sequence[str],
) -> DataFrame:
    """Rows to append: the earliest source row of each key the target does not hold yet.

    The source is reduced to one row per key before any join, so copies never reach one. The keys
    of the target are first cut down to those of the source: with a source that turns out small
    at run time this is a broadcast, and the target keys, of all tables the largest, stay in place.
    """
    fresh = first_by(source, keys, order)
    if target is None:
        return fresh
    present = target.select(*keys).join(fresh.select(*keys), list(keys), "left_semi")
    return fresh.join(present, list(keys), "left_anti")


def content_versions(
    target: DataFrame | None, source: DataFrame, order: Sequence[str] = ("inserted_at", "run_id"),
) -> DataFrame:
    """New content versions keyed by ``(app_id, review_id, hash_raw_json)``."""
    return insert_if_absent(target, source, ("app_id", "review_id", "hash_raw_json"), order)


def with_surrogate_ids(rows: DataFrame, batch_id: int) -> DataFrame:
    """Ordering pair ``(batch_id, row_in_batch)``: rises from batch to batch without a global sort.

    Take it once, on write: a recomputation may number the rows of a batch differently.
    """
    return rows.withColumns({
        "batch_id": F.lit(batch_id).cast("bigint"),
        "row_in_batch": F.monotonically_increasing_id(),
    })


def with_ordered_id(
    rows: DataFrame, batch_id: int, loaded: str, updated: str, place: str, digest: str,
) -> DataFrame:
    """Surrogate text id that rises with batch, load time, update time and place in the page.

    All parts come from the data, so a repeated batch gives the same ids, and the order of the ids
    is the order of arrival: of two versions of one load the one updated later is the later one.
    The digest only tells apart what is equal in all that.
    """
    return rows.withColumn("raw_id", F.concat_ws(
        "-", F.lpad(F.lit(batch_id).cast("string"), 12, "0"),
        F.date_format(loaded, "yyyyMMddHHmmssSSSSSS"),
        F.lpad(F.greatest(F.coalesce(F.col(updated), F.lit(0)), F.lit(0)).cast("string"), 19, "0"),
        F.lpad(F.col(place).cast("string"), 6, "0"), F.substring(digest, 1, 16)))


def with_content_id(rows: DataFrame) -> DataFrame:
    """Repeatable id made of the version key: an identity, without any order."""
    return rows.withColumn(
        "raw_id", F.concat_ws("-", F.col("app_id"), F.col("review_id"), F.col("hash_raw_json"))
    )
