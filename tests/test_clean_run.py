"""The V1 incremental run and its bucketed store."""

from functools import reduce

import pytest
from pyspark.sql import DataFrame, functions as F

from medallion.operators.merge import CurrentMerge, merge_batches, merge_current
from medallion.operators.versions import latest_by
from medallion.plans import clean_run
from medallion.plans.clean import STORED_SCHEMA, RawStore, append_raw, clean_batches
from medallion.plans.clean_run import CleanRun, ingest_and_clean
from medallion.plans.dims import CLEAN_REVIEWS
from medallion.schemas import CLEAN_REVIEW_SCHEMA
from medallion.session import scratch_folder
from medallion.sources.layout import write_bucketed
from medallion.sources.pages import to_landing
from tests.fixture_pages import page, review

NOW = "2026-03-01 00:00:00"
OLD, SAME, NEW = 1700000000, 1700000500, 1700000900


def landing(spark, *reviews, at=NOW):
    return to_landing(spark.createDataFrame([(page(list(reviews)),)], "raw_data string"), at)


def pipeline(spark, batch_rows=1000, full_every=16):
    root = scratch_folder(spark, "test")
    return CleanRun(f"{root}/clean", RawStore(f"{root}/raw", buckets=8), batch_rows=batch_rows,
                    full_every=full_every)


def loads():
    def one(n, at, text):
        return review(recommendationid=str(n), timestamp_updated=at, review=text)

    return [[one(n, SAME, "first") for n in range(1, 7)],
            [one(1, NEW, "newer"), one(2, SAME, "equal"), one(3, OLD, "older")],
            [one(1, NEW, "newer"), one(7, SAME, "added")]]


def state(spark, clean):
    reviews = {r["review_id"]: r["review_text"] for r in clean.table(spark, "reviews").collect()}
    players = {r["review_id"] for r in clean.table(spark, "players").collect()}
    return reviews, players


@pytest.mark.parametrize("batch_rows, full_every", [(1000, 16), (2, 3)])
def test_only_newer_updates_count_whatever_the_batch_size(spark, batch_rows, full_every):
    clean = pipeline(spark, batch_rows, full_every)
    for number, load in enumerate(loads()):
        ingest_and_clean(spark, clean, landing(spark, *load), number, f"run-{number}")
    reviews, players = state(spark, clean)
    assert reviews == {1: "newer", **dict.fromkeys(range(2, 7), "first"), 7: "added"}
    assert players == set(reviews)
    rows = sorted(clean.commits(spark).collect(), key=lambda r: r["run"])
    assert [r["run"] for r in rows] == list(range(len(rows)))
    assert max(r["rows_read"] for r in rows) <= batch_rows
    assert sum(r["rows_read"] for r in rows) == 10
    assert sum(r["reviews_inserted"] for r in rows) == 7
    assert sum(r["reviews_updated"] for r in rows) == 1
    assert clean.run(spark) == 0
    # A load that holds nothing new starts nothing.
    assert ingest_and_clean(spark, clean, landing(spark, *loads()[1]), 9, "again") == (0, 0)


def test_a_crash_between_the_two_writes_leaves_neither(spark, monkeypatch):
    clean = pipeline(spark)
    ingest_and_clean(spark, clean, landing(spark, *loads()[0]), 0, "run-0")
    before, position = state(spark, clean), clean.last_commit(spark)["last_raw_id"]
    append_raw(spark, clean.raw.path, landing(spark, *loads()[1]), 1, F.lit("run-1"), 8)
    whole = CleanRun._write

    def broken(self, spark, name, *rest):
        if name == "players":
            raise RuntimeError("lost")
        return whole(self, spark, name, *rest)

    monkeypatch.setattr(clean_run.CleanRun, "_write", broken)
    with pytest.raises(RuntimeError):
        clean.run(spark)
    assert spark.read.parquet(f"{clean.path}/reviews").where("run = 1").count() == 1
    assert state(spark, clean) == before
    assert clean.last_commit(spark)["last_raw_id"] == position
    monkeypatch.undo()
    assert clean.run(spark) == 1
    assert state(spark, clean)[0][1] == "newer"


def plan_of(rows):
    """The plan before it runs; with adaptive execution the text holds the final plan too."""
    plan = rows._jdf.queryExecution().executedPlan()
    return (plan.initialPlan() if "Adaptive" in plan.nodeName() else plan).toString()


def test_a_batch_reads_its_buckets_only_and_never_moves_the_store(spark):
    store = RawStore(scratch_folder(spark, "test"), buckets=16)
    rows = spark.range(400).select(
        F.col("id").cast("string").alias("raw_id"), F.lit(1).cast("long").alias("app_id"),
        F.col("id").alias("review_id"), F.lit("h").alias("hash_raw_json"),
        F.lit("{}").alias("raw_json"), F.lit(NOW).cast("timestamp_ntz").alias("inserted_at"),
        F.lit("r").alias("run_id"), F.lit(0).cast("long").alias("batch_id"),
        F.concat_ws("-", F.lit(1), F.col("id"), F.lit("h")).alias("version_id"))
    store.add(spark, rows)
    few = rows.where("review_id in (3, 5)").unionByName(rows.where("review_id = 7").withColumn(
        "version_id", F.lit("1-7-other")))
    few.write.parquet(f"{store.path}_few")
    found = store.absent(spark, spark.read.parquet(f"{store.path}_few"))
    assert [r["version_id"] for r in found.collect()] == ["1-7-other"]
    plan = plan_of(found)
    chosen = int(plan.split("SelectedBucketsCount: ")[1].split(" ")[0])
    assert chosen <= 3
    # Of the two sides only the batch is dealt out.
    assert plan.count("Exchange hashpartitioning(version_id") == plan.count("Exchange") == 1
    # Beyond the ids that go into a plan all buckets are read, the store still in place.
    for mark in ("", "x", "y"):
        rows.withColumn("version_id", F.concat("version_id", F.lit(mark))).write.mode(
            "append").parquet(f"{store.path}_many")
    many = store.absent(spark, spark.read.parquet(f"{store.path}_many"))
    assert many.count() == 800
    assert plan_of(many).count("Exchange") == 1


def test_a_store_opened_again_keeps_its_rows(spark):
    store = RawStore(scratch_folder(spark, "test"), buckets=4)
    append_raw(spark, store.path, landing(spark, *loads()[0]), 0, F.lit("r"), 4)
    spark.sql(f"DROP TABLE {store.name}")
    assert store.table(spark).count() == 6
    assert append_raw(spark, store.path, landing(spark, *loads()[1]), 1, F.lit("r"), 4) == 3
    assert store.table(spark).count() == 9
    assert store.table(spark).schema.fieldNames() == STORED_SCHEMA.fieldNames()


def test_a_bucketed_target_is_merged_where_it_lies(spark):
    rows = spark.range(50).select(*[
        (F.col("id") if f.name == "review_id" else F.lit(1) if f.name == "app_id"
         else F.timestamp_seconds(F.lit(SAME)) if f.name == "timestamp_updated"
         else F.lit(None)).cast(f.dataType).alias(f.name) for f in CLEAN_REVIEW_SCHEMA.fields])
    name, path = "bucketed_target", scratch_folder(spark, "test")
    write_bucketed(rows, name, path, ["app_id", "review_id"], 4)
    source = rows.where("review_id < 5").unionByName(
        rows.where("review_id < 3").withColumn("review_id", F.col("review_id") + 100)).withColumn(
        "timestamp_updated", F.timestamp_seconds(F.lit(NEW))).hint("merge")
    merged = merge_current(spark.table(name), source, CLEAN_REVIEWS)
    plain = merge_current(rows, source, CLEAN_REVIEWS)
    key = lambda r: (r["review_id"], str(r["timestamp_updated"]))
    assert sorted(map(key, merged.collect())) == sorted(map(key, plain.collect()))
    assert plan_of(merged).count("Exchange") == plan_of(plain).count("Exchange") - 1


def test_many_batches_are_one_pass_that_changes_what_each_would_alone(spark):
    clean = pipeline(spark, batch_rows=2)
    ingest_and_clean(spark, clean, landing(spark, *loads()[0]), 0, "run-0")
    # Three batches, one file of changes and one of commits; each batch can be read as of its commit.
    rows = sorted(clean.commits(spark).collect(), key=lambda r: r["run"])
    assert [r["rows_read"] for r in rows] == [2, 2, 2]
    assert clean.commits(spark).select(F.input_file_name()).distinct().count() == 1
    assert [clean.table(spark, "reviews", r).count() for r in rows] == [2, 4, 6]


def test_merged_batches_equal_merges_one_after_the_other(spark):
    def rows(ids, at, amount):
        return spark.createDataFrame([(1, n, at + n % 3, amount) for n in ids],
                                     "a bigint, k bigint, at bigint, amount bigint")

    batches = [rows(range(8), 10, 1), rows(range(4, 12), 9, 1), rows(range(0, 12, 2), 11, 2),
               rows(range(12), 11, 1)]
    numbered = reduce(DataFrame.unionByName, [
        b.withColumn("batch", F.lit(n + 1).cast("bigint")) for n, b in enumerate(batches)])
    start, update = rows(range(3), 10, 5), ["at", "amount"]
    for rule in ({"newer_by": "at"}, {"compare": ["amount"]}):
        merge = CurrentMerge(("a", "k"), ["a", "k", *update], update=update, **rule)
        state, actions = start, {}
        for n, b in enumerate(batches):
            merged = merge_current(state, b, merge, with_action=True)
            for r in merged.where("_action <> 'keep'").groupBy("_action").count().collect():
                actions[n + 1, r[0]] = r[1]
            state = spark.createDataFrame(merged.drop("_action").collect(), start.schema)
        whole = merge_batches(start, numbered, merge, "batch", 0)
        found = {(r[0], r[1]): r[2] for r in whole.where("_action <> 'keep'").groupBy(
            "batch", "_action").count().collect()}
        assert found == actions
        newest = latest_by(whole.where("batch = 0 or _action <> 'keep'"), ("a", "k"), ["batch"])
        assert sorted(newest.select(*start.columns).collect()) == sorted(state.collect())


def test_what_is_needed_on_the_way_only_is_cleared(spark):
    clean = pipeline(spark, batch_rows=2)
    added = [ingest_and_clean(spark, clean, landing(spark, *load), n, f"run-{n}")[0]
             for n, load in enumerate(loads())]
    assert added == [6, 3, 1] and clean.raw.table(spark).count() == 10
    for folder in (f"{clean.raw.path}_staged", f"{clean.raw.path}_fresh", f"{clean.path}/staged"):
        assert spark.read.parquet(folder).count() == 0
    # A batch that is repeated makes them again.
    assert append_raw(spark, clean.raw.path, landing(spark, *loads()[0]), 0, F.lit("run-0"), 8) == 0


def test_the_text_of_a_version_is_not_dealt_out_by_key(spark):
    store = RawStore(scratch_folder(spark, "test"), buckets=4)
    for number, load in enumerate(loads()):
        append_raw(spark, store.path, landing(spark, *load), number, F.lit("r"), 4)
    for rows in clean_batches(store.table(spark), "batch_id"):
        below = [line for line in plan_of(rows).splitlines() if "Aggregate" in line]
        assert below and not any("raw_json" in line for line in below)
        assert rows.count() == 10
