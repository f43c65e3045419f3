"""Upserts, SCD merges and change feeds on the versions found in ``lineitem`` and ``events``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from medallion.catalog import Query, table
from medallion.catalog.sqltext import (
    any_distinct, ctes, current_step, history_step, listed, newest, opened,
)
from medallion.operators.merge import (
    BROADCAST_BYTES, CurrentMerge, HistoryMerge, action_counts, change_feed, history_actions, inserted_rows,
    measured_bytes, merge_current, merge_history, open_versions,
)
from medallion.operators.versions import latest_per_key
from medallion.plans.dims import newer_than_current
from medallion.session import scratch_folder
from medallion.sources.layout import write_bucketed

KEYS = ["l_orderkey", "l_linenumber"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"]
COLUMNS = [*KEYS, "l_partkey", "l_suppkey", *MEASURES]
ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"]
FIRST, SECOND, THIRD = "2026-01-01 00:00:00", "2026-01-02 00:00:00", "2026-01-03 00:00:00"
CUTS = ["1997-01-01 00:00:00", "1999-01-01 00:00:00"]

UPSERT = CurrentMerge(KEYS, COLUMNS, compare=MEASURES, update=["l_partkey", *MEASURES],
                      stamp="stamp")
NEWER = CurrentMerge(KEYS, COLUMNS, update=["l_partkey", "l_suppkey", *MEASURES],
                     newer_by="l_extendedprice")
HISTORY = HistoryMerge(KEYS, COLUMNS, compare=MEASURES)


def batch(spark: SparkSession, sf_dir: str, number: int, cuts=CUTS) -> DataFrame:
    """Newest line of each key among those shipped in one span of time; the spans cover all."""
    at = [F.lit(c).cast("timestamp_ntz") for c in cuts]
    rows = table(spark, sf_dir, "lineitem").select(*COLUMNS)
    if number > 0:
        rows = rows.where(F.col("l_shipdate") >= at[number - 1])
    if number < len(cuts):
        rows = rows.where(F.col("l_shipdate") < at[number])
    return latest_per_key(rows, KEYS, [F.col(c).desc_nulls_last() for c in ORDER])


def stamped(rows: DataFrame, at: str) -> DataFrame:
    return rows.withColumn("stamp", F.lit(at).cast("timestamp_ntz"))


ONE_CUT = [CUTS[0]]


def upsert_if_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = stamped(batch(spark, sf_dir, 0, ONE_CUT), FIRST)
    return merge_current(target, batch(spark, sf_dir, 1, ONE_CUT), UPSERT, SECOND)


def upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into a table bucketed by its keys: only the batch is dealt out."""
    name = f"upsert_{uuid.uuid4().hex}"
    write_bucketed(stamped(batch(spark, sf_dir, 0, ONE_CUT), FIRST), name,
                   scratch_folder(spark, "upsert"), KEYS, 16)
    return merge_current(spark.table(name), batch(spark, sf_dir, 1, ONE_CUT), UPSERT, SECOND)


def upsert_newer_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price plays the update time, so about half of the matched rows are older and are refused."""
    return merge_current(batch(spark, sf_dir, 0, ONE_CUT), batch(spark, sf_dir, 1, ONE_CUT), NEWER)


def upsert_small_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The broadcast form of the upsert, taken because the measured source is small."""
    segments = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(
        F.max("c_acctbal").alias("c_acctbal"), F.count("*").alias("n_rows"))
    held = table(spark, sf_dir, "customer").select(
        "c_mktsegment", F.lit(0.0).alias("c_acctbal"), F.lit(0).cast("bigint").alias("n_rows")
    ).where(F.col("c_mktsegment") != "BUILDING").distinct()
    merge = CurrentMerge(["c_mktsegment"], ["c_mktsegment", "c_acctbal", "n_rows"],
                         compare=["c_acctbal", "n_rows"], update=["c_acctbal", "n_rows"])
    small = measured_bytes(segments) <= BROADCAST_BYTES
    return merge_current(held, segments, merge, with_action=True, broadcast_source=small)


def upsert_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = stamped(batch(spark, sf_dir, 0, ONE_CUT), FIRST)
    return action_counts(merge_current(target, batch(spark, sf_dir, 1, ONE_CUT), UPSERT, SECOND,
                                       with_action=True))


def scd1_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches; the supplier of the first insert stays (a column that is never updated)."""
    state = stamped(batch(spark, sf_dir, 0), FIRST)
    for number, at in ((1, SECOND), (2, THIRD)):
        state = merge_current(state, batch(spark, sf_dir, number), UPSERT, at)
    return state


def _history(spark: SparkSession, sf_dir: str, cuts) -> DataFrame:
    stamps = [FIRST, SECOND, THIRD]
    rows = open_versions(batch(spark, sf_dir, 0, cuts), HISTORY, stamps[0])
    for number in range(1, len(cuts) + 1):
        rows = merge_history(rows, batch(spark, sf_dir, number, cuts), HISTORY, stamps[number])
    return rows


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir, ONE_CUT)


def scd2_three_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir, CUTS)


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir, CUTS).where("is_current").select(*COLUMNS)


def scd2_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later of two batches once more changes nothing."""
    return merge_history(_history(spark, sf_dir, ONE_CUT), batch(spark, sf_dir, 1, ONE_CUT), HISTORY,
                         THIRD)


EVENT_COLUMNS = ["who", "event_id", "value", "props"]
EVENT_HISTORY = HistoryMerge(["who"], EVENT_COLUMNS, compare=["value", "props"],
                             stamp_closed=False, null_keys=True)
EVENT_CUT = "2024-01-15 00:00:00"


def _event_batch(spark: SparkSession, sf_dir: str, late: bool) -> DataFrame:
    at = F.lit(EVENT_CUT).cast("timestamp_ntz")
    rows = table(spark, sf_dir, "events").where(F.col("ts") >= at if late else F.col("ts") < at)
    known = rows.withColumn("who", F.when(F.col("event_type") != "error", F.col("user_id")))
    newest_first = [F.col("ts").desc_nulls_first(), F.col("event_id").desc()]
    return latest_per_key(known, ["who"], newest_first).select(*EVENT_COLUMNS)


def scd2_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of unknown users (errors) share the NULL key, which never matches."""
    current = open_versions(_event_batch(spark, sf_dir, False), EVENT_HISTORY, FIRST)
    return merge_history(current, _event_batch(spark, sf_dir, True), EVENT_HISTORY, SECOND)


def tagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = open_versions(batch(spark, sf_dir, 0, ONE_CUT), HISTORY, FIRST)
    return history_actions(current, batch(spark, sf_dir, 1, ONE_CUT), HISTORY, SECOND)


def change_feed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_feed(batch(spark, sf_dir, 0, ONE_CUT), batch(spark, sf_dir, 1, ONE_CUT), KEYS,
                       MEASURES)


def change_feed_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inserted_rows(change_feed_query(spark, sf_dir))


def late_newer_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A late batch (the older lines) under the newer-wins policy brings new keys only."""
    current, late = batch(spark, sf_dir, 1, ONE_CUT), batch(spark, sf_dir, 0, ONE_CUT)
    return newer_than_current(current, late, KEYS, by="l_shipdate")


def _batch_cte(number: int, cuts=CUTS) -> tuple[str, str]:
    low = f"l_shipdate >= TIMESTAMP '{cuts[number - 1]}'" if number else "true"
    high = f"l_shipdate < TIMESTAMP '{cuts[number]}'" if number < len(cuts) else "true"
    order = ", ".join(f"{c} DESC" for c in ORDER)
    return f"b{number}", newest(f"lineitem WHERE {low} AND {high}", KEYS, COLUMNS, order)


def _batches(cuts) -> list[tuple[str, str]]:
    return [_batch_cte(n, cuts) for n in range(len(cuts) + 1)]


TWO = _batches(ONE_CUT)
THREE = _batches(CUTS)
CHANGED = any_distinct(MEASURES)
UPDATE = ["l_partkey", *MEASURES]
STAMPED = ("t0", f"SELECT *, TIMESTAMP '{FIRST}' AS stamp FROM b0")


def _upsert(action: bool = False) -> str:
    return current_step("t0", "b1", KEYS, COLUMNS, UPDATE, CHANGED, ("stamp", SECOND), action)


def _history_ctes(batches) -> list[tuple[str, str]]:
    steps = [("h0", opened("b0", COLUMNS, FIRST))]
    for number, at in zip(range(1, len(batches)), (SECOND, THIRD)):
        steps.append((f"h{number}", history_step(f"h{number - 1}", f"b{number}", KEYS, COLUMNS,
                                                 MEASURES, at)))
    return [*batches, *steps]


def _feed_sql() -> str:
    match = "t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber"
    return f"""
SELECT {listed(COLUMNS, 's')}, 'INSERT' AS _action, false AS _is_update FROM b1 s
 WHERE NOT EXISTS (SELECT 1 FROM b0 t WHERE {match})
UNION ALL SELECT {listed(COLUMNS, 't')}, 'DELETE', false FROM b0 t
 WHERE NOT EXISTS (SELECT 1 FROM b1 s WHERE {match})
UNION ALL SELECT {listed(COLUMNS, 't')}, 'DELETE', true FROM b0 t JOIN b1 s ON {match} WHERE {CHANGED}
UNION ALL SELECT {listed(COLUMNS, 's')}, 'INSERT', true FROM b0 t JOIN b1 s ON {match} WHERE {CHANGED}"""


def _tagged_sql() -> str:
    match = "t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber"
    new = opened("b1", COLUMNS, SECOND).replace(" FROM b1 s", ", '{}' AS action_type FROM b1 s")
    return f"""
{new.format('INSERT')} LEFT JOIN h0 t ON {match} WHERE t.l_orderkey IS NULL
UNION ALL SELECT {listed(COLUMNS, 't')}, t.start_timestamp, TIMESTAMP '{SECOND}', false,
 TIMESTAMP '{SECOND}', 'UPDATE_EXPIRE' FROM b1 s JOIN h0 t ON {match} WHERE {CHANGED}
UNION ALL {new.format('UPDATE_INSERT')} JOIN h0 t ON {match} WHERE {CHANGED}"""


def _event_ctes() -> list[tuple[str, str]]:
    named = ("named", "SELECT CASE WHEN event_type <> 'error' THEN user_id END AS who, * FROM events")
    order = "ts DESC, event_id DESC"
    return [
        named,
        ("b0", newest(f"named WHERE ts < TIMESTAMP '{EVENT_CUT}'", ["who"], EVENT_COLUMNS, order)),
        ("b1", newest(f"named WHERE ts >= TIMESTAMP '{EVENT_CUT}'", ["who"], EVENT_COLUMNS, order)),
        ("h0", opened("b0", EVENT_COLUMNS, FIRST)),
        ("h1", history_step("h0", "b1", ["who"], EVENT_COLUMNS, ["value", "props"], SECOND, False)),
    ]


_SEGMENTS = ("""SELECT c_mktsegment, max(c_acctbal) AS c_acctbal, count(*) AS n_rows,
 CASE WHEN c_mktsegment = 'BUILDING' THEN 'insert' ELSE 'update' END AS _action
 FROM customer GROUP BY c_mktsegment""")

QUERIES = {
    "upsert_if_distinct": Query(upsert_if_distinct, ctes(*TWO, STAMPED, final=_upsert())),
    "upsert_bucketed": Query(upsert_bucketed, ctes(*TWO, STAMPED, final=_upsert())),
    "upsert_newer_wins": Query(upsert_newer_wins, ctes(*TWO, final=current_step(
        "b0", "b1", KEYS, COLUMNS, ["l_partkey", "l_suppkey", *MEASURES],
        "s.l_extendedprice > t.l_extendedprice"))),
    "upsert_small_source": Query(upsert_small_source, _SEGMENTS),
    "upsert_actions": Query(upsert_actions, ctes(*TWO, STAMPED, ("merged", _upsert(True)),
        final="SELECT _action, count(*) AS n_rows FROM merged GROUP BY _action")),
    "scd1_merge": Query(scd1_merge, ctes(*THREE, STAMPED, ("t1", _upsert()), final=current_step(
        "t1", "b2", KEYS, COLUMNS, UPDATE, CHANGED, ("stamp", THIRD)))),
    "scd2_merge": Query(scd2_merge, ctes(*_history_ctes(TWO), final="SELECT * FROM h1")),
    "scd2_three_batches": Query(scd2_three_batches,
                                ctes(*_history_ctes(THREE), final="SELECT * FROM h2")),
    "scd2_current": Query(scd2_current, ctes(*_history_ctes(THREE),
        final=f"SELECT {listed(COLUMNS)} FROM h2 WHERE is_current")),
    "scd2_replay": Query(scd2_replay, ctes(*_history_ctes(TWO), final="SELECT * FROM h1")),
    "scd2_null_key": Query(scd2_null_key, ctes(*_event_ctes(), final="SELECT * FROM h1")),
    "tagged_union": Query(tagged_union, ctes(*_history_ctes(TWO)[:3], final=_tagged_sql())),
    "change_feed": Query(change_feed_query, ctes(*TWO, final=_feed_sql())),
    "change_feed_inserts": Query(change_feed_inserts, ctes(*TWO, ("feed", _feed_sql()),
        final=f"SELECT {listed(COLUMNS)} FROM feed WHERE _action = 'INSERT'")),
    "late_newer_wins": Query(late_newer_wins, ctes(*TWO, final=f"""SELECT {listed(COLUMNS, 's')}
        FROM b0 s LEFT JOIN b1 t ON t.l_orderkey = s.l_orderkey
        AND t.l_linenumber = s.l_linenumber
        WHERE t.l_orderkey IS NULL OR s.l_shipdate > t.l_shipdate""")),
}
