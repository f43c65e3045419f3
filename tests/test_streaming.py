from pyspark.sql import functions as F

from medallion.operators.flatten import flag_reviews, flatten_reviews
from medallion.operators.quarantine import review_quarantine
from medallion.plans.dims import DIMENSIONS
from medallion.session import scratch_folder
from medallion.sources.pages import read_pages, to_landing, write_pages
from medallion.streaming.incremental import (
    consume_batches, flagged_schema, last_batch, read_batches, start_bronze, start_consumer,
    start_flagged, start_landing, start_quarantine, write_batch,
)
from tests.fixture_pages import page, review

NOW = "2026-03-01 00:00:00"


def pages_of(spark, *documents, run):
    rows = [(730, f"{run}:{i}+0", doc) for i, doc in enumerate(documents)]
    made = spark.createDataFrame(rows, "steam_app_id bigint, run_id string, raw_data string")
    return made.withColumn("ingestion_date", F.lit("2026-03-01").cast("date"))


def test_streams_take_each_file_once_and_equal_the_batch(spark):
    root = scratch_folder(spark, "test")
    def run():
        start_landing(spark, f"{root}/pages", f"{root}/landing", f"{root}/s1",
                      max_files=1).awaitTermination()
        start_bronze(spark, f"{root}/landing", f"{root}/bronze", f"{root}/s2").awaitTermination()
        start_flagged(spark, f"{root}/bronze", f"{root}/flagged", f"{root}/s3").awaitTermination()
        start_quarantine(spark, f"{root}/flagged", f"{root}/dlq", f"{root}/s4").awaitTermination()
        start_consumer(spark, f"{root}/flagged", dim, table, f"{root}/s5", now=NOW).awaitTermination()
        return spark.read.parquet(f"{root}/bronze").count()
    dim = DIMENSIONS["reviews_scd1"]
    table = dim.table(f"{root}/dim", buckets=4)
    good = [review(recommendationid=str(i)) for i in range(4)]
    write_pages(pages_of(spark, page(good[:2]), page([review(voted_up="maybe")]), run="a"),
                f"{root}/pages")
    assert run() == 3
    write_pages(pages_of(spark, page(good[2:]), run="b"), f"{root}/pages")
    assert run() == 5
    assert run() == 5
    landing = to_landing(read_pages(spark, f"{root}/pages"), NOW)
    flagged = flag_reviews(flatten_reviews(landing))
    streamed = spark.read.parquet(f"{root}/flagged").drop("ingested_at")
    batch = flagged.drop("ingested_at")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    assert spark.read.parquet(f"{root}/dlq").count() == review_quarantine(flagged).count() == 1
    assert {r["review_id"] for r in table.read(spark).collect()} == {"0", "1", "2", "3"}


def test_pages_of_a_run_are_replaced_by_its_retry(spark):
    root = scratch_folder(spark, "test")
    write_pages(pages_of(spark, page([review()]), run="a"), root)
    write_pages(pages_of(spark, page([review(), review()]), run="a"), root)
    write_pages(pages_of(spark, page([review()]), run="b"), root)
    assert flatten_reviews(to_landing(read_pages(spark, root), NOW)).count() == 3


def test_each_consumer_keeps_its_own_position(spark):
    root = scratch_folder(spark, "test")
    tables = {name: DIMENSIONS[name].table(f"{root}/{name}", buckets=4)
              for name in ("reviews_scd2", "players_scd1")}
    def put(number, *reviews):
        made = spark.createDataFrame([(page(list(reviews)),)], "raw_data string")
        write_batch(flag_reviews(flatten_reviews(to_landing(made, NOW))), f"{root}/flagged", number)
    def take(name):
        return consume_batches(spark, f"{root}/flagged", DIMENSIONS[name], tables[name], NOW)
    assert last_batch(spark, f"{root}/flagged") == -1 and take("reviews_scd2") == -1
    put(0, review())
    assert take("reviews_scd2") == 0
    put(1, review(votes_up=5), review(recommendationid="901"))
    assert take("reviews_scd2") == 1 and take("players_scd1") == 1
    assert take("reviews_scd2") == 1
    assert tables["reviews_scd2"].read(spark).count() == 3
    assert tables["players_scd1"].read(spark).count() == 1
    rows = read_batches(spark, f"{root}/flagged", flagged_schema(spark), 0, 1)
    assert rows.count() == 2
