"""Sessions from elsewhere, and tables that several results share."""

from glob import glob

from pyspark.sql import functions as F

from medallion.catalog import bronze, dims, quality
from medallion.functions.rules import Rule, failure_reasons
from medallion.operators.flatten import type_reviews
from medallion.schemas import BRONZE_SCHEMA
from medallion.session import NO_METHOD_LIMIT, SETTINGS, scratch_folder

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_a_given_session_compiles_the_wide_projection(spark):
    before = spark.conf.get(LIMIT)
    try:
        spark.conf.set(LIMIT, NO_METHOD_LIMIT)
        type_reviews(spark.createDataFrame([], BRONZE_SCHEMA))
        assert spark.conf.get(LIMIT) == SETTINGS[LIMIT]
        spark.conf.set(LIMIT, "9000")
        type_reviews(spark.createDataFrame([], BRONZE_SCHEMA))
        assert spark.conf.get(LIMIT) == "9000"
    finally:
        spark.conf.set(LIMIT, before)


def test_reasons_of_rows_with_and_without_broken_rules(spark):
    rules = [Rule("low", F.col("id") < 1), Rule("none", F.lit(None).cast("boolean")),
             Rule("even", F.col("id") % 2 == 0)]
    found = spark.range(3).select(failure_reasons(rules)).collect()
    assert [r[0] for r in found] == [["low", "even"], [], ["even"]]


def lines(spark, folder):
    """Thirty lines of five orders, every sixth of a quantity that breaks no rule."""
    n = F.col("id")
    spark.range(30).select(
        (n % 5).alias("l_orderkey"), (n + 1).alias("l_partkey"), (n % 3).alias("l_suppkey"),
        (n % 6).cast("int").alias("l_linenumber"), (n + 10).cast("double").alias("l_quantity"),
        (n * 10.5).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"),
        F.lit(0.02).alias("l_tax"), F.lit("A").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"),
        F.timestamp_add("MONTH", n, F.lit("1997-01-01").cast("timestamp_ntz")).alias("l_shipdate"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_a_load_has_one_folder_per_application_and_day(spark, monkeypatch):
    root = scratch_folder(spark, "test")
    n = F.col("id")
    spark.range(2000).select(
        n.alias("event_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"),
        n.alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.5).alias("value"),
        F.lit("{}").alias("props")).write.parquet(f"{root}/events.parquet")
    monkeypatch.setattr(bronze, "scratch_folder", lambda spark, purpose: f"{root}/pages")
    rows = bronze.page_folders(spark, root).collect()
    assert sorted((r["steam_app_id"], r["n_pages"], r["n_reviews"]) for r in rows) == [
        (0, 10, 1000), (1, 10, 1000)]
    assert len(glob(f"{root}/pages/*/*/run=*")) == 2
    assert len(glob(f"{root}/pages/*/*/run=*/part-*")) == 20


def test_the_dimensions_share_one_flagged_table(spark, monkeypatch):
    made, folder = [], lines(spark, scratch_folder(spark, "test"))

    def counted(*given):
        made.append(given)
        return dims.flagged_table(*given)

    monkeypatch.setattr(quality, "flagged_table", counted, raising=False)
    report = quality.dq_freshness_dimensions(spark, folder)
    assert len(made) == 1
    assert {r["table_name"]: r["status"] for r in report.collect()} == {
        "reviews_scd1": "pass", "reviews_scd2": "pass", "players_scd1": "warn",
        "players_scd2": "error"}
