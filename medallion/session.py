"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution sizes the shuffles, turns joins with a small measured side into
    # broadcasts and splits skewed join and rebalance partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # A projection of some fifty casts and rules makes one method too large for the JIT. Beyond
    # its limit let Spark generate the projection in small methods instead of one stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Spark's default: the largest method Java takes.
NO_METHOD_LIMIT = "65535"


def build_session(app_name: str = "medallion", master: str | None = None,
                  **settings: str) -> SparkSession:
    """A session with the library's settings; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def with_small_methods(rows: DataFrame) -> DataFrame:
    """The rows, in a session that leaves no projection to the interpreter.

    The limit must hold when the rows are computed, so it is set for good. Sessions that come from
    elsewhere have Spark's default, beyond which no method can be anyway; another value stays.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    if rows.sparkSession.conf.get(limit) == NO_METHOD_LIMIT:
        rows.sparkSession.conf.set(limit, SETTINGS[limit])
    return rows


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written intermediate tables.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``. Where that is unset a
    temporary folder of this machine is taken if driver and executors are one process; on a cluster
    each executor would write to its own disk, so that is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder; the master is {master}")
        shared = tempfile.mkdtemp(prefix="medallion-")
    return f"{shared.rstrip('/')}/medallion/{purpose}-{uuid.uuid4().hex}"
