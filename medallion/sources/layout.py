"""Writing lake tables: day partitions, clustering, views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException


def write_by_day(
    rows: DataFrame, path: str, at: str, cluster_by: Sequence[str], day: str = "day",
    mode: str = "append",
) -> None:
    """Parquet by day, sorted by the cluster columns inside each file.

    ``rebalance`` brings a day together and lets adaptive execution cut a day that is too large
    into several files, so one heavy day is not one task.
    """
    (
        rows.withColumn(day, F.to_date(at))
        .hint("rebalance", day)
        .sortWithinPartitions(day, *cluster_by)
        .write.mode(mode).partitionBy(day).parquet(path)
    )


def write_bucketed(
    rows: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int,
) -> None:
    """Catalogue table bucketed and sorted by its keys: joins on them need no shuffle of it."""
    (
        rows.repartition(buckets, *keys).write.mode("overwrite")
        .bucketBy(buckets, *keys).sortBy(*keys)
        .option("path", path).saveAsTable(name)
    )


def as_view(rows: DataFrame, name: str) -> DataFrame:
    rows.createOrReplaceTempView(name)
    return rows.sparkSession.table(name)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table written out in the model itself."""
    return spark.createDataFrame(list(rows), schema)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet table, or no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def clear(spark: SparkSession, path: str) -> None:
    """Leave a table that was written on the way, and has been read, without rows."""
    spark.range(0).write.mode("overwrite").parquet(path)


def read_footers(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table whose count, minima and maxima over all rows come from the file footers.

    Spark answers such aggregates from footers only through its newer parquet reader and with a
    setting that the whole session shares, hence a session of its own on the same cluster. Columns
    must be numbers, dates or booleans, or the partition column; text and timestamps are scanned.
    """
    session = spark.newSession()
    readers = session.conf.get("spark.sql.sources.useV1SourceList").split(",")
    session.conf.set("spark.sql.sources.useV1SourceList",
                     ",".join(name for name in readers if name.strip().lower() != "parquet"))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path)


def newest_day(spark: SparkSession, path: str, day: str = "day") -> DataFrame:
    """The rows of the newest day of a table written by day; no other folder is read.

    Rows without a day belong to none. Where there is no day at all the result is empty.
    """
    last = read_footers(spark, path).agg(F.max(day).alias("last")).first()["last"]
    rows = spark.read.parquet(path)
    return rows.where(F.lit(False) if last is None else F.col(day) == F.lit(last))
