"""Registered queries with their SQL counterparts, one module per area."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from medallion.session import with_small_methods


@dataclass(frozen=True)
class Query:
    """A Spark query over one data folder and the SQL giving the same rows."""

    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return with_small_methods(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def all_queries() -> dict[str, Query]:
    from medallion.catalog import (
        bronze, control, dims, flagging, integrity, merges, quality, streams, versions,
    )

    registered: dict[str, Query] = {}
    for area in (bronze, flagging, versions, merges, dims, integrity, control, quality, streams):
        for name, query in area.QUERIES.items():
            if name in registered:
                raise ValueError(f"query registered twice: {name}")
            registered[name] = query
    return registered
