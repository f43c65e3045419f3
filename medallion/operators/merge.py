"""Merges without MERGE: upserts, SCD type 1, SCD type 2 and change feeds.

Every merge takes the current rows and one source row per key and gives the new rows. Both sides
hold a key at most once, so the equi join on the key has no hot group; rows with a NULL key never
match and are led around the join where they can occur in numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from medallion.functions.predicates import all_of, any_distinct, any_of, distinct_from
from medallion.schemas import VALIDITY

# A source is broadcast only when its measured size stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class CurrentMerge:
    """How a current-state table takes a source row.

    A matched row is updated when a ``compare`` column differs (no ``compare``: always) and, with
    ``newer_by``, only when the source is strictly newer. ``update`` columns are then overwritten,
    all other columns keep the value of their first insert.
    """

    keys: Sequence[str]
    columns: Sequence[str]
    compare: Sequence[str] = ()
    update: Sequence[str] = ()
    newer_by: str | None = None
    stamp: str | None = None


@dataclass(frozen=True)
class HistoryMerge:
    """How a history table takes a source row; ``columns`` are the data columns with the keys."""

    keys: Sequence[str]
    columns: Sequence[str]
    compare: Sequence[str] = field(default_factory=tuple)
    stamp_closed: bool = True
    null_keys: bool = False


def _on_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    return all_of(F.col(f"{left}.`{k}`") == F.col(f"{right}.`{k}`") for k in keys)


def _marked(rows: DataFrame, mark: str) -> DataFrame:
    """A literal marks the side as present; a NULL key cannot be told from a missing row."""
    return rows.withColumn(mark, F.lit(True)).alias(mark)


def _timestamp(now: Column | str) -> Column:
    return (F.lit(now) if isinstance(now, str) else now).cast("timestamp_ntz")


def merge_current(
    target: DataFrame, source: DataFrame, merge: CurrentMerge, now: Column | str | None = None,
    with_action: bool = False, broadcast_source: bool = False,
) -> DataFrame:
    """New state of a current-state table.

    ``with_action`` adds ``_action``: insert, update or keep. ``broadcast_source`` avoids the
    shuffle of the target; set it only for a source whose size was checked against
    ``BROADCAST_BYTES`` (see ``measured_bytes``).
    """
    if broadcast_source:
        return _merge_small(target, source, merge, now, with_action)
    joined = _marked(target, "_t").join(
        _marked(source, "_s"), _on_keys("_t", "_s", merge.keys), "full_outer"
    )
    return _resolve(joined, merge, now, with_action)


def _merge_small(target, source, merge, now, with_action):
    small = F.broadcast(source)
    kept = _marked(target, "_t").join(
        _marked(small, "_s"), _on_keys("_t", "_s", merge.keys), "left"
    )
    present = target.select(*merge.keys).join(
        F.broadcast(source.select(*merge.keys)), list(merge.keys), "left_semi"
    )
    missing = source.join(present, list(merge.keys), "left_anti")
    return _resolve(kept, merge, now, with_action).unionByName(
        _insert(missing, merge, now, with_action)
    )


def _insert(source, merge, now, with_action):
    columns = [F.col(c) for c in merge.columns]
    if merge.stamp:
        columns.append(_timestamp(now).alias(merge.stamp))
    if with_action:
        columns.append(F.lit("insert").alias("_action"))
    return source.select(*columns)


def _resolve(joined: DataFrame, merge: CurrentMerge, now, with_action: bool) -> DataFrame:
    def of(side: str, name: str) -> Column:
        return F.col(f"{side}.`{name}`")

    fits = any_distinct("_t", "_s", merge.compare) if merge.compare else F.lit(True)
    if merge.newer_by:
        fits = fits & F.coalesce(of("_s", merge.newer_by) > of("_t", merge.newer_by), F.lit(False))
    new = F.col("_t._t").isNull()
    action = (
        F.when(F.col("_s._s").isNull(), "keep").when(new, "insert").when(fits, "update")
        .otherwise("keep")
    )
    decided = joined.withColumn("_action", action)
    inserted, taken = F.col("_action") == "insert", F.col("_action") != "keep"

    def merged(name: str) -> Column:
        if name in merge.keys:
            return F.coalesce(of("_t", name), of("_s", name))
        if name in merge.update:
            return F.when(taken, of("_s", name)).otherwise(of("_t", name))
        return F.when(inserted, of("_s", name)).otherwise(of("_t", name))

    columns = [merged(c).alias(c) for c in merge.columns]
    if merge.stamp:
        stamp = F.when(taken, _timestamp(now)).otherwise(of("_t", merge.stamp))
        columns.append(stamp.alias(merge.stamp))
    if with_action:
        columns.append(F.col("_action"))
    return decided.select(*columns)


def merge_batches(
    target: DataFrame, source: DataFrame, merge: CurrentMerge, batch: str, before: int,
) -> DataFrame:
    """What ``merge_current`` would do with the batches of ``source`` one after the other, in one pass.

    ``source`` has one row per key and batch. Gives the target rows, with ``before`` as their batch,
    and every source row, each with its ``_action``. The rule must overwrite all columns, by
    ``compare`` or by ``newer_by``: then the state a row meets has the compared values of the row
    before it, or the greatest ``newer_by`` before it. No part of a key may be NULL.
    """
    if set(merge.columns) - {*merge.keys, *merge.update} or merge.stamp:
        raise ValueError("only for rules that overwrite whole rows")
    if bool(merge.compare) == bool(merge.newer_by):
        raise ValueError("give either compare or newer_by")
    rows = target.select(F.lit(before).cast("bigint").alias(batch), *merge.columns).unionByName(
        source.select(batch, *merge.columns))
    by_key = Window.partitionBy(*merge.keys).orderBy(batch)
    if merge.newer_by:
        # A state without a time is never older than anything.
        at, earlier = F.col(merge.newer_by), by_key.rowsBetween(Window.unboundedPreceding, -1)
        fits = F.coalesce(at > F.max(at).over(earlier), F.lit(False)) & F.first(at).over(
            earlier).isNotNull()
    else:
        fits = any_of(distinct_from(F.col(c), F.lag(c).over(by_key)) for c in merge.compare)
    action = (
        F.when(F.col(batch) == before, "keep").when(F.row_number().over(by_key) == 1, "insert")
        .when(fits, "update").otherwise("keep")
    )
    return rows.withColumn("_action", action)


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows per action of a merge made with ``with_action``."""
    return merged.groupBy("_action").agg(F.count("*").alias("n_rows"))


def measured_bytes(rows: DataFrame) -> int:
    """Size of flat rows: eight bytes a column and the bytes of all text, from one small job."""
    width = len(rows.columns) * 8
    text = [
        F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)).cast("bigint")
        for f in rows.schema.fields if f.dataType.typeName() == "string"
    ]
    total = F.sum(sum(text, F.lit(width).cast("bigint")))
    return rows.agg(F.coalesce(total, F.lit(0)).alias("bytes")).first()["bytes"]


# --- SCD type 2 -----------------------------------------------------------------------------


def open_versions(source: DataFrame, merge: HistoryMerge, now: Column | str) -> DataFrame:
    """Source rows as open versions starting now."""
    start = _timestamp(now)
    return source.select(
        *merge.columns, start.alias("start_timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("end_timestamp"),
        F.lit(True).alias("is_current"), start.alias("_dlt_updated_at"),
    )


def merge_history(
    current: DataFrame, source: DataFrame, merge: HistoryMerge, now: Column | str,
) -> DataFrame:
    """Rows that replace ``current``: kept and new open versions, and the versions closed now.

    Closed versions of earlier batches never take part: a caller holds them apart and only adds to
    them, or leaves them in and gets them back. One join does the new/expire/reopen branches.
    """
    if not merge.null_keys:
        return _merge_history(current, source, merge, now)
    known = all_of(F.col(k).isNotNull() for k in merge.keys)
    columns = [*merge.columns, *VALIDITY]
    return (
        _merge_history(current.where(known), source.where(known), merge, now)
        .unionByName(current.where(~known).select(*columns))
        .unionByName(open_versions(source.where(~known), merge, now))
    )


def _versions(merge: HistoryMerge, now) -> dict[str, Column]:
    """Structs of the joined row: the old version kept, the old version closed, the new one."""
    at = _timestamp(now)
    data_t = [F.col(f"_t.`{c}`").alias(c) for c in merge.columns]
    data_s = [F.col(f"_s.`{c}`").alias(c) for c in merge.columns]
    start = F.col("_t.start_timestamp").alias("start_timestamp")
    touched = F.col("_t._dlt_updated_at")
    never = F.lit(None).cast("timestamp_ntz")

    def validity(start_at, end_at, is_current, stamp):
        return [start_at.alias("start_timestamp"), end_at.alias("end_timestamp"),
                is_current.alias("is_current"), stamp.alias("_dlt_updated_at")]

    return {
        "kept": F.struct(*data_t, *validity(start, F.col("_t.end_timestamp"),
                                            F.col("_t.is_current"), touched)),
        "closed": F.struct(*data_t, *validity(start, at, F.lit(False),
                                              at if merge.stamp_closed else touched)),
        "opened": F.struct(*data_s, *validity(at, never, F.lit(True), at)),
    }


def _merge_history(current, source, merge, now):
    # Closed versions match nothing and pass through as they are.
    joined = _marked(current, "_t").join(
        _marked(source, "_s"), _on_keys("_t", "_s", merge.keys) & F.col("_t.is_current"),
        "full_outer",
    )
    version = _versions(merge, now)
    changed = any_distinct("_t", "_s", merge.compare)
    rows = (
        F.when(F.col("_t._t").isNull(), F.array(version["opened"]))
        .when(F.col("_s._s").isNotNull() & changed,
              F.array(version["closed"], version["opened"]))
        .otherwise(F.array(version["kept"]))
    )
    return joined.select(F.inline(rows))


def history_actions(
    current: DataFrame, source: DataFrame, merge: HistoryMerge, now: Column | str,
) -> DataFrame:
    """The tagged change rows INSERT, UPDATE_EXPIRE and UPDATE_INSERT of one batch."""
    joined = _marked(source, "_s").join(
        _marked(current, "_t"), _on_keys("_t", "_s", merge.keys), "left"
    )
    version = _versions(merge, now)

    def tagged(tag: str, row: Column) -> Column:
        return F.struct(F.lit(tag).alias("action_type"), row.alias("row"))

    rows = (
        F.when(F.col("_t._t").isNull(), F.array(tagged("INSERT", version["opened"])))
        .when(any_distinct("_t", "_s", merge.compare),
              F.array(tagged("UPDATE_EXPIRE", version["closed"]),
                      tagged("UPDATE_INSERT", version["opened"])))
    )
    return joined.select(F.inline(rows)).select("row.*", "action_type")


# --- change feed ----------------------------------------------------------------------------


def change_feed(
    before: DataFrame, after: DataFrame, keys: Sequence[str], compare: Sequence[str],
) -> DataFrame:
    """Changes between two snapshots; an update is a DELETE of the old and an INSERT of the new."""
    columns = list(before.columns)
    joined = _marked(before, "_t").join(
        _marked(after.select(*columns), "_s"), _on_keys("_t", "_s", keys), "full_outer"
    )

    def row(side: str, action: str, is_update: bool) -> Column:
        return F.struct(*[F.col(f"{side}.`{c}`").alias(c) for c in columns],
                        F.lit(action).alias("_action"), F.lit(is_update).alias("_is_update"))

    rows = (
        F.when(F.col("_t._t").isNull(), F.array(row("_s", "INSERT", False)))
        .when(F.col("_s._s").isNull(), F.array(row("_t", "DELETE", False)))
        .when(any_distinct("_t", "_s", compare),
              F.array(row("_t", "DELETE", True), row("_s", "INSERT", True)))
    )
    return joined.select(F.inline(rows))


def inserted_rows(feed: DataFrame) -> DataFrame:
    """The INSERT side of a change feed; deletes are not followed."""
    return feed.where(F.col("_action") == "INSERT").drop("_action", "_is_update")
