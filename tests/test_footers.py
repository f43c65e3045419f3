"""End points and freshness without a scan of the table."""

from __future__ import annotations

import datetime as dt
import re

from medallion.operators.quality import freshness
from medallion.operators.selection import end_point
from medallion.sources.layout import newest_day, read_footers, write_by_day


def plan(rows) -> str:
    return rows._jdf.queryExecution().explainString(
        rows.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_end_point_comes_from_footers(spark, tmp_path):
    folder = str(tmp_path / "keys")
    spark.range(1_000).repartition(7).write.parquet(folder)
    found = end_point(read_footers(spark, folder), "id")
    assert found.first()["end_id"] == 999
    assert "PushedAggregation: [MAX(id)]" in plan(found)
    # The session that asked keeps its reader.
    assert "PushedAggregation" not in plan(end_point(spark.read.parquet(folder), "id"))
    empty = str(tmp_path / "none")
    spark.range(0).write.parquet(empty)
    assert end_point(read_footers(spark, empty), "id").first()["end_id"] == -1


def loads(spark, folder, times):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id long, at timestamp_ntz")
    write_by_day(rows, folder, "at", ["id"])


def test_freshness_reads_the_newest_day_alone(spark, tmp_path):
    folder = str(tmp_path / "loads")
    times = [dt.datetime(2026, 3, d, h) for d in (1, 2, 3) for h in (1, 9, 5)] + [None]
    loads(spark, folder, times)
    rows = newest_day(spark, folder)
    assert rows.count() == 3
    assert re.search(r"PartitionFilters: .*day#\d+ = 2026-03-03", plan(rows))
    now = dt.datetime(2026, 3, 3, 11)
    assert freshness(rows, "at", now).collect() == freshness(
        spark.read.parquet(folder), "at", now).collect()
    assert freshness(rows, "at", now).first()["status"] == "warn"


def test_no_day_at_all_is_an_error(spark, tmp_path):
    folder = str(tmp_path / "undated")
    loads(spark, folder, [None, None])
    found = freshness(newest_day(spark, folder), "at", dt.datetime(2026, 1, 1)).first()
    assert (found["max_loaded_at"], found["status"]) == (None, "error")
