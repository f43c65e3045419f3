"""Incremental runs of the page pipeline.

``land -> flag -> quarantine`` are append-only file streams without state. Each dimension is its
own consumer with its own checkpoint, as a stream (``start_consumer``) or as a scheduled batch
over numbered batches of flagged rows (``consume_batches``); both end in the same merge. A stream
with ``trigger=None`` takes what is there and stops, with a lag like ``"1 minute"`` it keeps on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from medallion.operators.flatten import (
    flag_reviews, flatten_reviews, gated_pages, unreadable_pages,
)
from medallion.operators.quarantine import player_quarantine, review_quarantine
from medallion.plans.dims import Dimension
from medallion.schemas import BRONZE_SCHEMA, LANDING_SCHEMA
from medallion.sources.pages import stream_packed, stream_pages, to_landing
from medallion.sources.snapshots import NOTHING, SnapshotTable

# How far each table may lag behind.
BRONZE_LAG, FLAGGED_LAG, QUARANTINE_LAG, MERGE_PERIOD = (
    "1 minute", "5 minutes", "1 hour", "10 minutes",
)


def _triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    if trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def _append(rows: DataFrame, path: str, checkpoint: str, trigger: str | None) -> StreamingQuery:
    writer = (
        rows.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, trigger).start()


def flagged_schema(spark: SparkSession) -> T.StructType:
    return flag_reviews(spark.createDataFrame([], BRONZE_SCHEMA)).schema


def start_landing(
    spark: SparkSession, pages: str, landing: str, checkpoint: str, trigger: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Page files to landing rows, each file once."""
    return _append(to_landing(stream_pages(spark, pages, max_files)), landing, checkpoint, trigger)


def start_packed_landing(
    spark: SparkSession, pages: str, landing: str, checkpoint: str, trigger: str | None = None,
    max_bytes: int | None = None, archive: str | None = None,
) -> StreamingQuery:
    """Packed page files to landing rows, each file once, batches bounded by bytes."""
    rows = to_landing(stream_packed(spark, pages, max_bytes, archive))
    return _append(rows, landing, checkpoint, trigger)


def start_page_gate(
    spark: SparkSession, landing: str, target: str, checkpoint: str, trigger: str | None = None,
) -> StreamingQuery:
    """Landing rows into ``<target>/batch_id=N/outcome=accepted|rejected|unreadable``.

    A page is parsed once, and one write fills all three; a batch that is repeated writes its own
    folder again. ``gated`` reads one outcome.
    """
    def gate(batch: DataFrame, batch_id: int) -> None:
        gated_pages(batch).write.mode("overwrite").partitionBy("outcome").parquet(
            f"{target}/batch_id={batch_id}")

    rows = spark.readStream.schema(LANDING_SCHEMA).parquet(landing)
    return _triggered(rows.writeStream.foreachBatch(gate).option(
        "checkpointLocation", checkpoint), trigger).start()


def gated(target: str, outcome: str = "accepted") -> str:
    """Path of one outcome of the page gate, for a reader or the next stream."""
    return f"{target}/*/outcome={outcome}"


def start_bronze(
    spark: SparkSession, landing: str, bronze: str, checkpoint: str, trigger: str | None = None,
) -> StreamingQuery:
    rows = spark.readStream.schema(LANDING_SCHEMA).parquet(landing)
    return _append(flatten_reviews(rows), bronze, checkpoint, trigger)


def start_page_quarantine(
    spark: SparkSession, landing: str, target: str, checkpoint: str, trigger: str | None = None,
) -> StreamingQuery:
    """Landing rows that ``start_bronze`` can make no rows of, with the reason."""
    rows = spark.readStream.schema(LANDING_SCHEMA).parquet(landing)
    return _append(unreadable_pages(rows), target, checkpoint, trigger)


def start_flagged(
    spark: SparkSession, bronze: str, flagged: str, checkpoint: str, trigger: str | None = None,
) -> StreamingQuery:
    rows = spark.readStream.schema(BRONZE_SCHEMA).parquet(bronze)
    return _append(flag_reviews(rows), flagged, checkpoint, trigger)


def start_quarantine(
    spark: SparkSession, flagged: str, target: str, checkpoint: str, grain: str = "review",
    trigger: str | None = None,
) -> StreamingQuery:
    pick = {"review": review_quarantine, "player": player_quarantine}[grain]
    rows = spark.readStream.schema(flagged_schema(spark)).parquet(flagged)
    return _append(pick(rows), target, checkpoint, trigger)


def start_consumer(
    spark: SparkSession, flagged: str, dimension: Dimension, table: SnapshotTable,
    checkpoint: str, trigger: str | None = None, late_policy: str = "last_batch",
    now: str | None = None, max_files: int | None = None,
) -> StreamingQuery:
    """Merge new flagged rows into a dimension.

    A batch that is repeated after a failure has the same number and is not merged twice. Numbers
    count per checkpoint, whose id is the origin of the batch: a new checkpoint on an old table
    starts over without being taken for what is there already.
    """
    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        at = F.localtimestamp() if now is None else now
        origin = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        dimension.run(batch.sparkSession, table, batch_id, batch, at, late_policy, origin=origin)

    reader = spark.readStream.schema(flagged_schema(spark))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    writer = (
        reader.parquet(flagged).writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, trigger).start()


# --- scheduled batches ----------------------------------------------------------------------


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """One numbered batch; its marker is written last, so readers see whole batches only."""
    rows.write.mode("overwrite").parquet(f"{path}/data/ingest_batch={batch_id}")
    marker = rows.sparkSession.createDataFrame([(batch_id,)], "ingest_batch bigint")
    marker.coalesce(1).write.mode("overwrite").json(f"{path}/markers/{batch_id}")


def last_batch(spark: SparkSession, path: str) -> int:
    try:
        markers = spark.read.schema("ingest_batch bigint").json(f"{path}/markers/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return NOTHING
    return markers.agg(F.max("ingest_batch").alias("last")).first()["last"]


def finished_upto(spark: SparkSession, path: str, after: int, first: int = 0) -> int:
    """Last batch of the unbroken run of finished batches that follows ``after``.

    ``first`` is the number of the first batch the source ever writes.
    """
    try:
        markers = spark.read.schema("ingest_batch bigint").json(f"{path}/markers/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return after
    start = max(after + 1, first)
    later = markers.where(F.col("ingest_batch") >= start).select("ingest_batch").distinct()
    # A batch ends the run when the one behind it has no marker.
    behind = later.select((F.col("ingest_batch") - 1).alias("ingest_batch"))
    found = later.join(behind, "ingest_batch", "left_anti").agg(
        F.min("ingest_batch").alias("last")).crossJoin(
        later.agg(F.min("ingest_batch").alias("low"))).first()
    return found["last"] if found["low"] == start else after


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, after: int, upto: int,
) -> DataFrame:
    """Rows of the batches ``after < n <= upto``; the other folders are not read."""
    batched = T.StructType([*schema.fields, T.StructField("ingest_batch", T.LongType())])
    return (
        spark.read.schema(batched).parquet(f"{path}/data")
        .where((F.col("ingest_batch") > after) & (F.col("ingest_batch") <= upto))
        .drop("ingest_batch")
    )


def consume_batches(
    spark: SparkSession, flagged: str, dimension: Dimension, table: SnapshotTable, now: str,
    late_policy: str = "last_batch", first: int = 0,
) -> int:
    """Merge all batches a dimension has not seen; gives the number of the last one merged.

    The position is part of the commit of the dimension, so data and position move together. It
    stops before a batch that has no marker yet, so one that finishes late is not passed over.
    """
    after = table.consumed_upto(spark)
    upto = finished_upto(spark, flagged, after, first)
    if upto > after:
        rows = read_batches(spark, flagged, flagged_schema(spark), after, upto)
        dimension.run(spark, table, upto, rows, now, late_policy, consumed_upto=upto)
    return max(after, upto)
