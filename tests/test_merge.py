import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from medallion.operators.merge import (
    CurrentMerge, HistoryMerge, change_feed, measured_bytes, merge_current, merge_history,
    open_versions,
)
from medallion.operators.versions import (
    insert_if_absent, latest_by, latest_per_key, with_surrogate_ids,
)
from medallion.plans.dims import DIMENSIONS
from medallion.sources.snapshots import SnapshotTable
from medallion.session import scratch_folder
from medallion.operators.flatten import flag_reviews, flatten_reviews
from tests.fixture_pages import page, review
from tests.test_flatten import landing

SCHEMA = "k string, v int, w int"
T1, T2, T3 = ("2026-01-01 00:00:00", "2026-01-02 00:00:00", "2026-01-03 00:00:00")
D1, D2 = datetime(2026, 1, 1), datetime(2026, 1, 2)
MERGE = CurrentMerge(["k"], ["k", "v", "w"], compare=["v"], update=["v"], stamp="at")
HISTORY = HistoryMerge(["k"], ["k", "v", "w"], compare=["v"])


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def stamped(rows, at):
    return rows.withColumn("at", F.lit(at).cast("timestamp_ntz"))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_merge_current_cases(spark, small):
    target = stamped(frame(spark, [("same", 1, 1), ("new_value", 1, 1), ("from_null", None, 1),
                                   ("null_null", None, 1), ("alone", 1, 1)]), T1)
    source = frame(spark, [("same", 1, 9), ("new_value", 2, 9), ("from_null", 5, 9),
                           ("null_null", None, 9), ("added", 3, 9)])
    merged = merge_current(target, source, MERGE, T2, with_action=True, broadcast_source=small)
    assert rows_of(merged) == sorted([
        ("same", 1, 1, D1, "keep"), ("new_value", 2, 1, D2, "update"),
        ("from_null", 5, 1, D2, "update"), ("null_null", None, 1, D1, "keep"),
        ("alone", 1, 1, D1, "keep"), ("added", 3, 9, D2, "insert")], key=repr)


def test_newer_wins_refuses_equal_older_and_unknown_times(spark):
    merge = CurrentMerge(["k"], ["k", "v", "w"], update=["v", "w"], newer_by="v")
    target = frame(spark, [("older", 5, 0), ("equal", 5, 0), ("newer", 5, 0), ("unknown", 5, 0)])
    source = frame(spark, [("older", 4, 1), ("equal", 5, 1), ("newer", 6, 1), ("unknown", None, 1)])
    assert rows_of(merge_current(target, source, merge)) == [
        ("equal", 5, 0), ("newer", 6, 1), ("older", 5, 0), ("unknown", 5, 0)]


def test_broadcast_and_shuffle_merges_agree_on_random_batches(spark):
    random.seed(7)
    def batch(n):
        keys = random.sample(range(40), n)
        return frame(spark, [(str(k), random.choice([None, 1, 2]), n) for k in keys])
    target, source = stamped(batch(30), T1), batch(20)
    assert rows_of(merge_current(target, source, MERGE, T2)) == rows_of(
        merge_current(target, source, MERGE, T2, broadcast_source=True))


def test_history_properties(spark):
    """Replay changes nothing, one open version per key, intervals of a key do not overlap."""
    random.seed(3)
    rows, brute = None, {}
    for at in (T1, T2, T3):
        data = [(str(k), random.choice([None, 1, 2]), 0) for k in random.sample(range(12), 8)]
        source = frame(spark, data)
        if rows is None:
            rows = open_versions(source, HISTORY, at)
        else:
            merged = merge_history(rows.where("is_current"), source, HISTORY, at)
            rows = rows.where("NOT is_current").unionByName(merged)
        for k, v, _ in data:
            if k not in brute or brute[k][-1] != v:
                brute.setdefault(k, []).append(v)
        again = merge_history(rows.where("is_current"), source, HISTORY, "2027-01-01 00:00:00")
        assert rows_of(again) == rows_of(rows.where("is_current"))
    found = {}
    for r in sorted(rows.collect(), key=lambda r: (r["k"], r["start_timestamp"])):
        found.setdefault(r["k"], []).append(r)
    assert {k: [r["v"] for r in v] for k, v in found.items()} == brute
    for versions in found.values():
        assert [r["is_current"] for r in versions] == [False] * (len(versions) - 1) + [True]
        for before, after in zip(versions, versions[1:]):
            assert before["end_timestamp"] == after["start_timestamp"]


def test_history_null_keys_never_match(spark):
    merge = HistoryMerge(["k"], ["k", "v", "w"], compare=["v"], stamp_closed=False, null_keys=True)
    current = open_versions(frame(spark, [(None, 1, 0), ("a", 1, 0)]), merge, T1)
    merged = merge_history(current, frame(spark, [(None, 1, 0), ("a", 2, 0)]), merge, T2)
    assert merged.where("k IS NULL AND is_current").count() == 2
    closed = merged.where("NOT is_current").first()
    assert closed["end_timestamp"] == D2 and closed["_dlt_updated_at"] == D1


def test_change_feed(spark):
    before = frame(spark, [("gone", 1, 0), ("same", 1, 0), ("other", 1, 0)])
    after = frame(spark, [("same", 1, 0), ("other", 2, 0), ("new", 1, 0)])
    feed = rows_of(change_feed(before, after, ["k"], ["v"]).select("k", "v", "_action"))
    assert feed == [("gone", 1, "DELETE"), ("new", 1, "INSERT"), ("other", 1, "DELETE"),
                    ("other", 2, "INSERT")]


def test_latest_and_insert_if_absent(spark):
    rows = frame(spark, [("a", 1, 1), ("a", 2, 2), ("a", 2, 3), (None, 1, 1), (None, 4, 1)])
    newest = latest_per_key(rows, ["k"], [F.col("v").desc(), F.col("w").desc()])
    assert rows_of(newest) == rows_of(latest_by(rows, ["k"], ["v", "w"])) == [
        ("a", 2, 3), (None, 4, 1)]
    source = frame(spark, [("a", 1, 1), ("b", 1, 2), ("b", 1, 1), ("b", 2, 1)])
    fresh = insert_if_absent(frame(spark, [("a", 1, 0)]), source, ["k", "v"], ["w"])
    assert rows_of(fresh) == [("b", 1, 1), ("b", 2, 1)]
    held = frame(spark, [("a", 1, 0)]).unionByName(fresh)
    assert insert_if_absent(held, source, ["k", "v"], ["w"]).count() == 0


def test_surrogate_ids_rise_from_batch_to_batch(spark):
    ids = with_surrogate_ids(frame(spark, [("a", 1, 1)] * 5), 3)
    pairs = [(r["batch_id"], r["row_in_batch"]) for r in ids.collect()]
    assert len(set(pairs)) == 5 and {b for b, _ in pairs} == {3}


def test_measured_bytes(spark):
    assert measured_bytes(frame(spark, [("abc", 1, 1), (None, 1, 1)])) == 2 * 3 * 8 + 3
    assert measured_bytes(frame(spark, [])) == 0


def dim_batch(spark, *reviews, at=T1):
    rows = flag_reviews(flatten_reviews(landing(spark, [page(list(reviews))])))
    return rows.withColumn("ingested_at", F.lit(at).cast("timestamp_ntz"))


def test_written_dimension_is_repeatable_and_touches_only_its_buckets(spark):
    dim = DIMENSIONS["reviews_scd2"]
    table = dim.table(scratch_folder(spark, "test"), buckets=16)
    first = [review(recommendationid=str(i)) for i in range(30)]
    assert dim.run(spark, table, 0, dim_batch(spark, *first), T1)
    changed = dim_batch(spark, review(recommendationid="7", votes_up=99), at=T2)
    assert dim.run(spark, table, 1, changed, T2)
    once = rows_of(table.read(spark))
    assert not dim.run(spark, table, 1, changed, T2)
    assert rows_of(table.read(spark)) == once and len(once) == 31
    assert table.commits(spark).where("batch_id = 1").count() == 1
    assert table.history(spark).count() == 1
    assert table.consumed_upto(spark) == 1


def test_uncommitted_batch_is_not_seen(spark):
    dim = DIMENSIONS["reviews_scd1"]
    table = dim.table(scratch_folder(spark, "test"), buckets=4)
    dim.run(spark, table, 0, dim_batch(spark, review()), T1)
    class Stop(SnapshotTable):
        def _commit(self, *_):
            raise RuntimeError("lost driver")
    broken = Stop(table.path, table.schema, table.keys, table.buckets)
    later = dim_batch(spark, review(votes_up=77), at=T2)
    with pytest.raises(RuntimeError):
        dim.run(spark, broken, 1, later, T2)
    assert table.read(spark).first()["votes_helpful"] == 4
    dim.run(spark, table, 1, later, T2)
    assert table.read(spark).first()["votes_helpful"] == 77


def test_dimension_quirks(spark):
    """Unchanged but loaded again: SCD1 reviews update, SCD2 does not; the player keeps its review."""
    reviews1, reviews2 = DIMENSIONS["reviews_scd1"], DIMENSIONS["reviews_scd2"]
    again = dim_batch(spark, review(), at=T2)
    early = dim_batch(spark, review(), at=T1)
    target = reviews1.source(early).withColumn("_dlt_updated_at", F.lit(T1).cast("timestamp_ntz"))
    assert reviews1.merged(target, reviews1.source(again), T2).first()["_dlt_updated_at"] == D2
    late = reviews1.merged(target, reviews1.source(early), T2, late_policy="newer_wins")
    assert late.first()["_dlt_updated_at"] == D1
    current = open_versions(reviews2.source(early), reviews2.merge, T1)
    assert reviews2.merged(current, reviews2.source(again), T2).count() == 1
    players = DIMENSIONS["players_scd1"]
    other = review(recommendationid="901", author={"playtime_forever": 700})
    target = players.source(early).withColumn("_dlt_updated_at", F.lit(T1).cast("timestamp_ntz"))
    row = players.merged(target, players.source(dim_batch(spark, other, at=T2)), T2).first()
    assert (row["review_id"], row["author_playtime_forever_mins"]) == ("900", 700)


def test_late_row_between_a_closed_and_the_current_version_is_left_out(spark):
    dim = DIMENSIONS["reviews_scd2"]
    opened_at_t1 = open_versions(dim.source(dim_batch(spark, review(votes_up=1), at=T1)), dim.merge, T1)
    held = dim.merged(opened_at_t1, dim.source(dim_batch(spark, review(votes_up=9), at=T3)), T3)
    late = dim.source(dim_batch(spark, review(votes_up=5), at=T2))
    assert held.count() == 2
    after = dim.merged(held, late, T3, late_policy="newer_wins")
    assert sorted(map(str, after.collect())) == sorted(map(str, held.collect()))
