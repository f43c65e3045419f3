"""Dimension tables on plain parquet whose batches are atomic and repeatable.

A batch appends what it changes and nothing else: ``data/batch_id=N/is_current=true`` holds the new
rows of its keys and, for a history table, ``is_current=false`` the versions it closed. Reading
merges the newest change of each key into the last base, and after ``compact_every`` batches the
current rows are written as a new base, by bucket. So the bytes written follow the batch, not the
table; a batch of few keys also reads only their buckets of the base. The commit of a batch is one
small file written last: a reader sees the table before or after a batch and never between.

The table numbers its batches itself. A commit names the source it came from and the batch's number
there: a batch that already has its commit is not run again, one that is older than the last
of its source is refused, and batches of different sources never meet. Files of a batch without a
commit are replaced by the next one, which takes the same number.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from medallion.functions.predicates import all_of
from medallion.operators.versions import latest_per_key

COMMIT_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("source_batch", T.LongType()),
    T.StructField("buckets", T.IntegerType()),
    T.StructField("consumed_upto", T.LongType()),
    T.StructField("bucket", T.IntegerType()),
])

NOTHING = -1
BASE, CHANGES, EMPTY = "base", "changes", "empty"
COMPACTION = "(compaction)"


@dataclass(frozen=True)
class SnapshotTable:
    """``schema`` is the row; with ``is_current`` in it the table keeps closed versions."""

    path: str
    schema: T.StructType
    keys: Sequence[str]
    buckets: int = 64
    compact_every: int = 16

    @property
    def has_history(self) -> bool:
        return "is_current" in self.schema.fieldNames()

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def commits(self, spark: SparkSession) -> DataFrame:
        """Committed batches, one row per touched bucket (bucket -1 for an empty batch)."""
        try:
            return spark.read.schema(COMMIT_SCHEMA).json(f"{self.path}/commits/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], COMMIT_SCHEMA)

    def consumed_upto(self, spark: SparkSession) -> int:
        """Last source batch in the table: the checkpoint of its consumer."""
        last = self.commits(spark).agg(F.max("consumed_upto").alias("upto")).first()["upto"]
        return NOTHING if last is None else last

    def is_committed(self, spark: SparkSession, batch_id: int, source: str = "") -> bool:
        """Whether the batch of this number of a source is in the table.

        A batch that comes after a later one of its source is an error: it would undo that.
        """
        known = self.commits(spark).where(F.col("source") == source)
        found = known.agg(F.max(F.col("source_batch") == batch_id).alias("there"),
                          F.max("source_batch").alias("last")).first()
        if found["last"] is not None and batch_id < found["last"] and not found["there"]:
            raise ValueError(
                f"batch {batch_id} of {source!r} comes after batch {found['last']} in {self.path}")
        return bool(found["there"])

    def _next_batch(self, spark: SparkSession) -> int:
        last = self.commits(spark).agg(F.max("batch_id").alias("last")).first()["last"]
        return 0 if last is None else last + 1

    def _layers(self, spark: SparkSession) -> tuple[int | None, list[int]]:
        """Batch of the last compaction, and the batches of changes after it, oldest first.

        There are never more of those than ``compact_every``.
        """
        wrote = self.commits(spark).where(F.col("kind").isin(BASE, CHANGES))
        base = F.max(F.when(F.col("kind") == BASE, F.col("batch_id")))
        last = wrote.agg(base.alias("base"), F.min("buckets").alias("low"),
                         F.max("buckets").alias("high")).first()
        if last["low"] is not None and {last["low"], last["high"]} != {self.buckets}:
            raise ValueError(f"{self.path} was written with another number of buckets than "
                             f"{self.buckets}")
        after = NOTHING if last["base"] is None else last["base"]
        later = wrote.where(F.col("batch_id") > after).select("batch_id").distinct().collect()
        return last["base"], sorted(row["batch_id"] for row in later)

    def _read_base(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).option("basePath", f"{self.path}/base").parquet(
            *paths).select(*self.schema.fieldNames())

    def current(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame:
        """Current rows, of all buckets or of the given ones.

        The newest change of a key stands for its row of the base. Rows with a NULL key part are
        never changed, only added, so all of them count.
        """
        base, changed = self._layers(spark)
        columns = self.schema.fieldNames()
        chosen = range(self.buckets) if buckets is None else buckets
        rows = self._read_base(spark, self._base_paths(spark, base, chosen))
        if not changed:
            return rows
        schema = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType()),
                               T.StructField("bucket", T.IntegerType())])
        changes = spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(
            *[f"{self.path}/data/batch_id={n}/is_current=true" for n in changed])
        if buckets is not None:
            changes = changes.where(F.col("bucket").isin(list(buckets)))
        known = all_of(F.col(k).isNotNull() for k in self.keys)
        newest = latest_per_key(changes.where(known), self.keys, [F.col("batch_id").desc()])
        kept = rows.join(newest.select(*self.keys), list(self.keys), "left_anti")
        return (
            kept.select(*columns).unionByName(newest.select(*columns))
            .unionByName(changes.where(~known).select(*columns))
        )

    def _base_paths(self, spark: SparkSession, base: int | None, buckets) -> list[str]:
        if base is None:
            return []
        filled = self.commits(spark).where(
            (F.col("batch_id") == base) & (F.col("bucket") >= 0)).select("bucket").collect()
        there = {row["bucket"] for row in filled}
        return [f"{self.path}/base/batch_id={base}/bucket={b}" for b in buckets if b in there]

    def history(self, spark: SparkSession) -> DataFrame:
        """Closed versions of all committed batches."""
        batches = self.commits(spark).select("batch_id").distinct()
        try:
            closed = (
                spark.read.schema(T.StructType([*self.schema.fields,
                                                T.StructField("batch_id", T.LongType())]))
                .option("basePath", f"{self.path}/data")
                .parquet(f"{self.path}/data/batch_id=*/is_current=false")
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], self.schema)
        return closed.join(batches, "batch_id", "left_semi").select(*self.schema.fieldNames())

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows: current ones and, for a history table, the closed versions."""
        if not self.has_history:
            return self.current(spark)
        return self.current(spark).unionByName(self.history(spark))

    def apply(
        self, spark: SparkSession, batch_id: int, source: DataFrame,
        merge: Callable[[DataFrame, DataFrame], DataFrame], consumed_upto: int | None = None,
        origin: str = "",
    ) -> bool:
        """Merge one batch; gives False when the batch is in the table already.

        ``source`` has one row per key; two rows of a key are an error, as a merge would double the
        target row. It is written first: its keys name the buckets and the merge then reads the
        written rows, so neither is computed twice. ``batch_id`` is the number ``origin`` gave it.
        """
        if self.is_committed(spark, batch_id, origin):
            return False
        number = self._next_batch(spark)
        staged_path = f"{self.path}/staged/batch_id={number}"
        source.withColumn("_bucket", self.bucket_of()).write.mode("overwrite").parquet(staged_path)
        staged = spark.read.parquet(staged_path)
        keys = staged.groupBy("_bucket", *self.keys).agg(F.count("*").alias("rows"))
        seen = keys.groupBy("_bucket").agg(F.max("rows").alias("rows")).collect()
        if any(row["rows"] > 1 for row in seen):
            raise ValueError(f"batch {batch_id} has two rows of one key for {self.path}")
        touched = [row["_bucket"] for row in seen]
        if touched:
            staged = staged.drop("_bucket")
            # Only the rows of the batch's keys take part: what is written follows the batch.
            affected = self.current(spark, touched).join(
                staged.select(*self.keys), list(self.keys), "left_semi")
            self._write(merge(affected, staged), number)
        self._commit(spark, number, CHANGES if touched else EMPTY, origin, batch_id, touched,
                     batch_id if consumed_upto is None else consumed_upto)
        if len(self._layers(spark)[1]) >= self.compact_every:
            self.compact(spark)
        return True

    def compact(self, spark: SparkSession) -> None:
        """Write the current rows as one base, by bucket; readers go on with the old layers until
        its commit is there."""
        number = self._next_batch(spark)
        rows = self.current(spark)
        if self.has_history:
            rows = rows.where("is_current")
        folder = f"{self.path}/base/batch_id={number}"
        rows.withColumn("bucket", self.bucket_of()).hint("rebalance", "bucket").write.mode(
            "overwrite").partitionBy("bucket").parquet(folder)
        schema = T.StructType([T.StructField("bucket", T.IntegerType())])
        filled = spark.read.schema(schema).parquet(folder).select("bucket").distinct().collect()
        self._commit(spark, number, BASE, COMPACTION, number, [r["bucket"] for r in filled], None)

    def _write(self, merged: DataFrame, batch_id: int) -> None:
        flag = F.col("is_current") if self.has_history else F.lit(True)
        (
            merged.select(*[F.col(c) for c in self.schema.fieldNames() if c != "is_current"],
                          flag.alias("is_current"), self.bucket_of().alias("bucket"))
            .hint("rebalance", "is_current")
            .write.mode("overwrite").partitionBy("is_current")
            .parquet(f"{self.path}/data/batch_id={batch_id}")
        )

    def _commit(
        self, spark: SparkSession, batch_id: int, kind: str, origin: str, source_batch: int,
        touched: list[int], upto: int | None,
    ) -> None:
        rows = [(batch_id, kind, origin, source_batch, self.buckets, upto, bucket)
                for bucket in touched or [NOTHING]]
        (
            spark.createDataFrame(rows, COMMIT_SCHEMA).coalesce(1)
            .write.mode("overwrite").json(f"{self.path}/commits/{batch_id}")
        )
