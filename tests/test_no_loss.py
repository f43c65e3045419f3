"""Nothing is dropped or doubled: pages, records, keys, versions, batches."""

import pytest
from pyspark.sql import functions as F

from medallion.operators.flatten import flag_reviews, flatten_reviews, unreadable_pages
from medallion.operators.quarantine import review_quarantine
from medallion.operators.selection import newest_first
from medallion.plans.clean import RAW_SCHEMA, append_raw, clean_batch
from medallion.plans.dims import DIMENSIONS
from medallion.session import scratch_folder
from medallion.sources.pages import to_landing
from medallion.streaming.incremental import consume_batches, finished_upto, write_batch
from tests.fixture_pages import page, review

NOW, LATER = "2026-03-01 00:00:00", "2026-03-01 01:00:00"


def landing(spark, *documents, at=NOW):
    return to_landing(spark.createDataFrame([(d,) for d in documents], "raw_data string"), at)


def test_every_page_is_flattened_or_in_the_quarantine(spark):
    rows = landing(spark, page([review()]), page([review()])[:60], '{"app_id": 730, "reviews": 5}',
                   '{"app_id": 730}', "", None, page([]))
    reasons = sorted(r["page_failure_reasons"][0] for r in unreadable_pages(rows).collect())
    assert reasons == ["page:reviews_malformed"] * 2 + ["page:unreadable"] * 3
    assert flatten_reviews(rows).count() == 1


def test_raw_store_keeps_rejects_and_adds_nothing_on_replay(spark):
    root = scratch_folder(spark, "test")
    no_app = page([review(recommendationid="5")]).replace('"app_id"', '"other_id"')
    rows = landing(spark, page([review(recommendationid=900.0), review(recommendationid="x"),
                                review(voted_up="maybe", recommendationid="7")]), no_app, "{broken")
    for batch in (0, 1):
        append_raw(spark, f"{root}/raw", rows, batch, F.lit("run"))
    raw = spark.read.parquet(f"{root}/raw")
    assert [(r["review_id"], r["batch_id"]) for r in raw.collect()] == [(900, 0)]
    rejects = spark.read.parquet(f"{root}/raw_rejects").where("batch_id = 0").collect()
    assert sorted(r["record_errors"][0] for r in rejects) == ["app_id", "recommendationid", "voted_up"]
    assert spark.read.parquet(f"{root}/raw_bad_pages").where("batch_id = 0").count() == 1


@pytest.mark.parametrize("turned", [False, True])
def test_the_version_updated_later_wins_within_a_load(spark, turned):
    root = scratch_folder(spark, "test")
    pairs = [[review(recommendationid=str(i), review="old", timestamp_updated=1700000000),
              review(recommendationid=str(i), review="new", timestamp_updated=1700000500)]
             for i in range(40)]
    reviews = [r for pair in pairs for r in (pair[::-1] if turned else pair)]
    append_raw(spark, root, landing(spark, page(reviews)), 3, F.lit("run"))
    raw = spark.read.parquet(root).select(*RAW_SCHEMA.fieldNames())
    assert raw.count() == 80
    assert {r["review_text"] for r in clean_batch(raw)[0].collect()} == {"new"}


def test_ids_rise_over_batches(spark):
    root = scratch_folder(spark, "test")
    for batch, at in ((2, LATER), (10, NOW)):
        rows = landing(spark, page([review(recommendationid=str(batch))]), at=at)
        append_raw(spark, root, rows, batch, F.lit("run"))
    ids = {r["review_id"]: r["raw_id"] for r in spark.read.parquet(root).collect()}
    assert ids[2] < ids[10]


def flagged(spark, *reviews):
    return flag_reviews(flatten_reviews(landing(spark, page(list(reviews)))))


def test_a_batch_that_comes_too_late_is_refused(spark):
    dim = DIMENSIONS["reviews_scd1"]
    table = dim.table(scratch_folder(spark, "test"), buckets=4)
    assert dim.run(spark, table, 2, flagged(spark, review(recommendationid="1")), NOW)
    with pytest.raises(ValueError, match="comes after"):
        dim.run(spark, table, 1, flagged(spark, review(recommendationid="2")), NOW)
    assert not dim.run(spark, table, 2, flagged(spark, review(recommendationid="3")), NOW)
    # Another source counts on its own: a new checkpoint starts at 0 again.
    assert dim.run(spark, table, 0, flagged(spark, review(recommendationid="4")), NOW, origin="b")
    assert {r["review_id"] for r in table.read(spark).collect()} == {"1", "4"}


def test_the_number_of_buckets_is_checked(spark):
    dim, path = DIMENSIONS["reviews_scd1"], scratch_folder(spark, "test")
    dim.run(spark, dim.table(path, buckets=8), 0, flagged(spark, review()), NOW)
    with pytest.raises(ValueError, match="buckets"):
        dim.table(path, buckets=5).read(spark)


def test_two_source_rows_of_a_key_are_refused(spark):
    dim = DIMENSIONS["reviews_scd1"]
    table = dim.table(scratch_folder(spark, "test"), buckets=4)
    rows = dim.source(flagged(spark, review()))
    with pytest.raises(ValueError, match="two rows of one key"):
        table.apply(spark, 0, rows.union(rows), lambda current, source: source)


def test_batches_are_taken_in_an_unbroken_run(spark):
    root = scratch_folder(spark, "test")
    dim = DIMENSIONS["reviews_scd1"]
    table = dim.table(f"{root}/dim", buckets=4)
    put = lambda n: write_batch(
        flagged(spark, review(recommendationid=str(n))), f"{root}/in", n)
    take = lambda: consume_batches(spark, f"{root}/in", dim, table, NOW)
    put(0), put(2)
    assert take() == 0
    put(1)
    assert take() == 2 and take() == 2
    assert {r["review_id"] for r in table.read(spark).collect()} == {"0", "1", "2"}
    assert finished_upto(spark, f"{root}/none", 4) == 4


def test_the_quarantine_evaluates_the_rules_once(spark):
    rows = review_quarantine(flagged(spark, review()))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_except") == 2  # one per grain


def test_all_reviews_can_be_ordered(spark):
    rows = flatten_reviews(landing(spark, page([review(recommendationid="2"), review(
        recommendationid="1")])))
    for name in ("all", "recent", "updated"):
        assert rows.orderBy(*newest_first(name)).count() == 2


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Session:
        class conf:  # noqa: N801
            values = {"spark.master": "spark://host:7077"}

            @classmethod
            def get(cls, name, default=None):
                return cls.values.get(name, default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(Session, "x")
    Session.conf.values["spark.checkpoint.dir"] = "/shared"
    assert scratch_folder(Session, "x").startswith("/shared/medallion/x-")


def test_a_bucketed_table_needs_no_shuffle(spark):
    from medallion.catalog.bronze import bucketed_layout

    plan = bucketed_layout(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
    assert "Exchange hash" not in plan.toString()


def test_run_ids_differ():
    from pyspark.sql import SparkSession

    from medallion.operators.ledger import new_run_id

    spark = SparkSession.getActiveSession()
    ids = [r[0] for r in spark.range(5).select(new_run_id()).collect()]
    assert len(set(ids)) == 5 and all(len(i) == 36 for i in ids)


def test_a_stream_goes_on_by_the_clock(spark):
    """With a lag instead of ``None`` the stream keeps running until it is stopped."""
    from medallion.streaming.incremental import start_page_quarantine

    root = scratch_folder(spark, "test")
    landing(spark, "{broken", page([review()])).write.parquet(f"{root}/landing")
    stream = start_page_quarantine(spark, f"{root}/landing", f"{root}/bad", f"{root}/state",
                                   trigger="1 second")
    try:
        stream.processAllAvailable()
        landing(spark, "").write.mode("append").parquet(f"{root}/landing")
        stream.processAllAvailable()
        assert stream.isActive
    finally:
        stream.stop()
    assert spark.read.parquet(f"{root}/bad").count() == 2


@pytest.mark.parametrize("name", ["reviews_scd1", "reviews_scd2", "players_scd2"])
def test_what_a_batch_writes_follows_the_batch(spark, name):
    """Layers and compaction give the rows of a table that is compacted after every batch."""
    from dataclasses import replace

    dim = DIMENSIONS[name]
    layered = replace(dim.table(scratch_folder(spark, "test"), buckets=4), compact_every=3)
    whole = replace(layered, path=scratch_folder(spark, "test"), compact_every=1)
    batches = [[review(recommendationid=str(i), author={"steamid": str(i)}) for i in range(40)]]
    for n in range(1, 5):
        batches.append([review(recommendationid=str(i), votes_up=n,
                               author={"steamid": str(i), "num_reviews": n})
                        for i in (n, n + 7, 40 + n)])
    for number, reviews in enumerate(batches):
        now = f"2026-03-0{number + 1} 00:00:00"
        rows = flag_reviews(flatten_reviews(landing(spark, page(reviews), at=now)))
        for table in (layered, whole):
            assert dim.run(spark, table, number, rows, now)
        seen = [sorted(map(str, t.read(spark).collect())) for t in (layered, whole)]
        assert seen[0] == seen[1]
    def rows(layer):
        found = spark.read.parquet(f"{layered.path}/{layer}").groupBy("batch_id").count().collect()
        return {r["batch_id"]: r["count"] for r in found}
    assert rows("data")[0] == 40 and all(rows("data")[n] <= 6 for n in (1, 2, 4, 5))
    assert rows("base") == {3: 42}  # after three batches: the current rows, no more
    assert len(layered._layers(spark)[1]) == 2
