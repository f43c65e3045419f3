"""What must not grow faster than the rows: work outside compiled code, few tasks, many batches."""

from pyspark.sql import functions as F

from medallion.catalog import dims, flagging, streams
from medallion.catalog.feed import bronze_feed, page_feed
from medallion.functions.casts import canonical_json, reactions_json, to_boolean, to_timestamp_ntz
from medallion.operators.flatten import flag_reviews
from medallion.operators.quality import t_reactions
from medallion.schemas import BRONZE_SCHEMA
from medallion.session import scratch_folder


def plan(rows, kind="executedPlan"):
    return getattr(rows._jdf.queryExecution(), kind)().toString().splitlines()


def test_the_rules_are_not_in_the_generator(spark):
    flagged = flag_reviews(spark.createDataFrame([], BRONZE_SCHEMA))
    generators = [line for line in plan(flagged, "analyzed") if "Generate" in line]
    assert len(generators) == 1 and "review:miss_review_id" not in generators[0]


def test_pages_are_collected_behind_the_only_shuffle_of_the_events(spark):
    root, n = scratch_folder(spark, "test"), F.col("id")
    spark.range(1500).select(
        n.alias("event_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"),
        n.alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.5).alias("value"),
        F.lit("{}").alias("props")).write.parquet(f"{root}/events.parquet")
    pages = page_feed(spark, root)
    lines = plan(pages)
    shuffles = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    collecting = [i for i, line in enumerate(lines) if "collect_list" in line]
    assert len(shuffles) == 1 and collecting and max(collecting) < shuffles[0]
    sizes = pages.select("block", F.get_json_object("raw_data", "$.query_summary.num_reviews"))
    assert sorted(tuple(r) for r in sizes.collect()) == [(b, "100") for b in range(15)]


def test_a_batch_fills_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    assert streams._batch_bytes(spark) == cores * (32 << 20)


def lines(spark, root):
    n = F.col("id")
    spark.range(200).select(
        n.alias("l_orderkey"), n.alias("l_partkey"), n.alias("l_suppkey"),
        F.lit(2).alias("l_linenumber"), (n % 50 + 1).cast("double").alias("l_quantity"),
        F.lit(1.5).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"),
        F.lit(0.0).alias("l_tax"), F.lit("A").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.lit("1997-01-01").cast("timestamp_ntz").alias("l_shipdate"),
    ).write.parquet(f"{root}/lineitem.parquet")


def test_a_grain_does_not_pay_for_the_other(spark):
    root = scratch_folder(spark, "test")
    lines(spark, root)
    typed = "\n".join(plan(flagging.dlq_review(spark, root), "optimizedPlan"))
    assert "author_playtime_at_review" not in typed and "author:" not in typed
    assert flagging.dlq_review(spark, root).count() == 19 * 4
    assert flagging.dlq_player(spark, root).count() == 8 * 4
    written = dims.flagged_table(spark, root, "reviews_scd2")
    assert written.count() == 200 and not [c for c in written.columns if c.endswith("_raw")]
    every = dims.flagged_table(spark, root)
    assert {c for dim in dims.DIMENSIONS.values() for c in dim.reads} == set(every.columns)


def test_bronze_rows_are_dealt_out_unsorted(spark):
    root = scratch_folder(spark, "test")
    lines(spark, root)
    assert not [line for line in plan(bronze_feed(spark, root)) if "RoundRobin" in line]


def test_usual_reactions_need_no_parser(spark):
    texts = [
        '[{"reaction_type": 31, "count": 5}]', '[{"reaction_type":1,"count":0},\t{"reaction_type" '
        ':2 ,"count":999999999999999999}\n]', ' [{"reaction_type":1,"count":2}]',
        '[{"reaction_type":1,"count":2}] x', '[{"reaction_type":1,"count":2}]\u2028',
        '[{"reaction_type":01,"count":2}]', '[{"reaction_type":1,"count":-0}]', "[]", "[bad", None,
        '[{"reaction_type":1,"count":9999999999999999999999}]', '[{"reaction_type":1,"count":1.50}]',
        '[{"reaction_type":1,"count":"x"}]', '[{"count":1,"reaction_type":2}]', "null",
        '[{"reaction_type":1,"count":2},]', '[{"reaction_type":1,"count":2,"count":3}]',
        "[" + ",".join(['{"reaction_type":1,"count":2}'] * 40) + "]",
        "[" + ",".join(['{"reaction_type":1,"count":2}'] * 32) + "]",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    bad = t_reactions("r").violation
    found = rows.select(canonical_json(F.col("t")).alias("c"), reactions_json(F.col("t")).alias("r"))
    assert [r.r for r in found.collect()] == [r.c for r in found.collect()]
    failures = [r[0] for r in found.select(bad).collect()]
    assert failures[0] == failures[1] == failures[-1] == 0 and failures[12] == 1
    casts = plan(rows.select(reactions_json(F.col("t"))), "optimizedPlan")
    assert "RLIKE" in casts[0].upper()


def test_words_in_any_case_and_times(spark):
    texts = ["TrUe", "T", "yEs", "oN", " 1 ", "FALSE", "oFF", "N", "0", "maybe", "", None, "truE ",
             "tru\u00e9"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    word = F.lower(F.trim("t"))
    known = F.when(word.isin(["true", "t", "yes", "y", "on", "1"]), True).when(
        word.isin(["false", "f", "no", "n", "off", "0"]), False)
    assert [r[0] for r in rows.select(to_boolean(F.col("t"))).collect()] == [
        r[0] for r in rows.select(known).collect()]
    times = ["not-a-time", "T10:00:00", "2026-01-02", "\t2026-01-02 03:04:05", "+2026-01-02",
             "\x7f2026-01-02", "\u00e9", "-1-01-01", None, ""]
    rows = spark.createDataFrame([(t,) for t in times], "t string")
    text = to_timestamp_ntz(F.col("t")).cast("string")
    assert [r[0] for r in rows.select(text).collect()] == [
        r[0] for r in rows.select(F.trim("t").try_cast("timestamp_ntz").cast("string")).collect()]
