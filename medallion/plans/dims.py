"""The merges of the four dimensions and of the two V1 clean tables, by their column lists."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from medallion.operators.merge import (
    BROADCAST_BYTES, CurrentMerge, HistoryMerge, measured_bytes, merge_current, merge_history,
)
from medallion.operators.flatten import REASONS
from medallion.operators.quarantine import clean_player_rows, clean_review_rows
from medallion.operators.versions import arrival_order, latest_by, latest_per_key
from medallion.schemas import (
    CLEAN_PLAYER_MEASURES, CLEAN_PLAYER_ROW, CLEAN_REVIEW_DATA, CLEAN_REVIEW_ROW, PLAYER_MEASURES,
    PLAYER_ROW, REVIEW_DATA, REVIEW_ROW, VALIDITY, silver_schema,
)
from medallion.sources.snapshots import SnapshotTable

# Loading an unchanged review again counts as a change here: the load time is compared.
REVIEWS_SCD1 = CurrentMerge(
    keys=("review_id",), columns=REVIEW_ROW, compare=[*REVIEW_DATA, "ingested_at"],
    update=[*REVIEW_DATA, "ingested_at"], stamp="_dlt_updated_at",
)

# The review of the first insert stays with the player.
PLAYERS_SCD1 = CurrentMerge(
    keys=("author_steam_id",), columns=PLAYER_ROW, compare=PLAYER_MEASURES,
    update=[*PLAYER_MEASURES, "ingested_at"], stamp="_dlt_updated_at",
)

REVIEWS_SCD2 = HistoryMerge(keys=("review_id",), columns=REVIEW_ROW, compare=REVIEW_DATA)

# Clean by the review rules, so unknown authors come in: each batch opens one more such row.
PLAYERS_SCD2 = HistoryMerge(
    keys=("author_steam_id",), columns=PLAYER_ROW, compare=PLAYER_MEASURES,
    stamp_closed=False, null_keys=True,
)

CLEAN_REVIEWS = CurrentMerge(
    keys=("app_id", "review_id"), columns=CLEAN_REVIEW_ROW, update=CLEAN_REVIEW_DATA,
    newer_by="timestamp_updated",
)

CLEAN_PLAYERS = CurrentMerge(
    keys=("app_id", "review_id"), columns=CLEAN_PLAYER_ROW, compare=CLEAN_PLAYER_MEASURES,
    update=["steam_user_id", *CLEAN_PLAYER_MEASURES],
)


@dataclass(frozen=True)
class Dimension:
    """One consumer of the flagged table: how it picks its rows and how it merges them.

    ``grain`` is the one by whose rules its rows are clean.
    """

    name: str
    pick: Callable[[DataFrame], DataFrame]
    merge: CurrentMerge | HistoryMerge
    columns: Sequence[str]
    grain: str = "review"

    @property
    def reads(self) -> list[str]:
        """The columns of the flagged table the consumer looks at: its own, the order, the reasons."""
        own = [*self.columns, "timestamp_updated", "ingested_at", REASONS[self.grain]]
        return list(dict.fromkeys(own))

    def source(self, flagged: DataFrame, tie_breakers: Sequence[Column] = ()) -> DataFrame:
        """Newest clean row per key of a batch of flagged rows."""
        rows = self.pick(flagged)
        newest = latest_per_key(rows, self.merge.keys, arrival_order(rows.columns, tie_breakers))
        return newest.select(*self.columns)

    def table(self, path: str, buckets: int = 64) -> SnapshotTable:
        stamps = VALIDITY if isinstance(self.merge, HistoryMerge) else ["_dlt_updated_at"]
        return SnapshotTable(path, silver_schema([*self.columns, *stamps]), self.merge.keys,
                             buckets)

    def merged(
        self, target: DataFrame, source: DataFrame, now: Column | str, late_policy="last_batch",
        broadcast_source: bool = False,
    ) -> DataFrame:
        """``late_policy``: ``last_batch`` takes any later batch, ``newer_wins`` only newer loads."""
        if isinstance(self.merge, HistoryMerge):
            if late_policy != "last_batch":
                # Closed versions are older than the current one and say nothing about lateness.
                source = newer_than_current(target.where("is_current"), source, self.merge.keys)
            return merge_history(target, source, self.merge, now)
        merge = self.merge
        if late_policy != "last_batch":
            merge = CurrentMerge(merge.keys, merge.columns, merge.compare, merge.update,
                                 newer_by="ingested_at", stamp=merge.stamp)
        return merge_current(target, source, merge, now, broadcast_source=broadcast_source)

    def run(self, spark, table: SnapshotTable, batch_id: int, flagged: DataFrame, now,
            late_policy: str = "last_batch", consumed_upto: int | None = None,
            origin: str = "") -> bool:
        """Merge one batch of flagged rows into the written dimension."""
        def merge(current: DataFrame, staged: DataFrame) -> DataFrame:
            # The staged source is a written table, so measuring it is a scan of the batch only.
            small = (isinstance(self.merge, CurrentMerge)
                     and measured_bytes(staged) <= BROADCAST_BYTES)
            return self.merged(current, staged, now, late_policy, broadcast_source=small)

        return table.apply(spark, batch_id, self.source(flagged), merge, consumed_upto, origin)


def newer_than_current(
    current: DataFrame, source: DataFrame, keys: Sequence[str], by: str = "ingested_at",
) -> DataFrame:
    """Source rows that are not older than or as old as the current row of their key."""
    held = current.select(*keys, F.col(by).alias("_held"))
    joined = source.join(held, list(keys), "left")
    return joined.where(F.col("_held").isNull() | (F.col(by) > F.col("_held"))).select(
        *source.columns
    )


DIMENSIONS = {
    dim.name: dim
    for dim in (
        Dimension("reviews_scd1", clean_review_rows, REVIEWS_SCD1, REVIEW_ROW),
        Dimension("reviews_scd2", clean_review_rows, REVIEWS_SCD2, REVIEW_ROW),
        Dimension("players_scd1", clean_player_rows, PLAYERS_SCD1, PLAYER_ROW, "author"),
        Dimension("players_scd2", lambda f: clean_player_rows(f, "review"), PLAYERS_SCD2,
                  PLAYER_ROW),
    )
}


def latest_in_batch(raw: DataFrame, order: Sequence[str] = ("inserted_at", "raw_id")) -> DataFrame:
    """V1: newest raw version of each review in a batch."""
    return latest_by(raw, ("app_id", "review_id"), order)
