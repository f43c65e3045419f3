"""Key checks between tables: new keys, orphans, deletes that follow or stop at children.

A foreign key may be held by a large share of the child rows. The checks therefore work on the
distinct keys, which are combined on the map side, and go back to the rows only with the keys that
were found; adaptive execution turns that second join into a broadcast when those are few and
splits a skewed partition when they are not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from medallion.functions.predicates import all_of


def new_keys(source: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key has no current version (``is_current`` is part of the join)."""
    return source.join(
        current.where("is_current").select(*keys), list(keys), "left_anti"
    )


def _as_child_keys(parents: DataFrame, pairs: dict[str, str]) -> DataFrame:
    return parents.select(*[F.col(parent).alias(child) for child, parent in pairs.items()])


def orphan_keys(child: DataFrame, parent: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Known foreign keys without a parent; ``pairs`` maps child columns to parent columns."""
    keys = list(pairs)
    known = child.where(all_of(F.col(k).isNotNull() for k in keys)).select(*keys).distinct()
    return known.join(_as_child_keys(parent, pairs), keys, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Child rows without a parent; a NULL foreign key is no orphan."""
    return child.join(orphan_keys(child, parent, pairs), list(pairs), "left_semi")


def _known(pairs: dict[str, str]) -> Column:
    return all_of(F.col(k).isNotNull() for k in pairs)


def restricting_children(
    child: DataFrame, deleted: DataFrame, pairs: dict[str, str],
) -> DataFrame:
    """Children that forbid the delete (rows per deleted parent key); empty means it may go on."""
    keys = list(pairs)
    held = child.groupBy(*keys).agg(F.count("*").alias("n_children"))
    return held.join(_as_child_keys(deleted, pairs), keys, "left_semi")


def cascade_delete(child: DataFrame, deleted: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Children that stay when the parents in ``deleted`` go; a NULL foreign key meets no join."""
    known = _known(pairs)
    gone = _as_child_keys(deleted, pairs).distinct()
    return child.where(known).join(gone, list(pairs), "left_anti").select(*child.columns).union(
        child.where(~known))


def set_null_delete(child: DataFrame, deleted: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """All children, the foreign key of those with a deleted parent set to NULL.

    The keys that are NULL already, in the end perhaps most of them, are led around the join.
    """
    keys = list(pairs)
    gone = _as_child_keys(deleted, pairs).distinct().withColumn("_gone", F.lit(True))
    joined = child.where(_known(pairs)).join(gone, keys, "left")
    return joined.select(*[
        (F.when(F.col("_gone").isNull(), F.col(c)).alias(c) if c in keys else F.col(c))
        for c in child.columns
    ]).union(child.where(~_known(pairs)))


def missing_rows(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected keys that are not there; empty means the load is complete."""
    return expected.join(actual.select(*keys).distinct(), list(keys), "left_anti")
