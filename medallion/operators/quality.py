"""Quality tests that give the failing rows, and a runner that counts all failures of a table.

The runner puts every row-level test of a table into one aggregate, so a table is scanned once for
all of them; type checks need no job; tests of keys and of a second table are jobs of their own.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from medallion.functions import predicates as P
from medallion.functions.casts import to_number, usual_reactions

# --- failing rows ---------------------------------------------------------------------------


def failing(rows: DataFrame, violation: Column) -> DataFrame:
    return rows.where(violation)


def not_null(rows: DataFrame, column: str) -> DataFrame:
    return failing(rows, F.col(column).isNull())


def duplicate_keys(rows: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; NULL is ignored."""
    return (
        rows.where(F.col(column).isNotNull())
        .groupBy(column).agg(F.count("*").alias("n_records")).where("n_records > 1")
    )


def unaccepted_values(rows: DataFrame, column: str, allowed: Sequence[Any]) -> DataFrame:
    """Values outside the domain with their count; NULL passes."""
    return (
        rows.where(P.outside(F.col(column), allowed))
        .groupBy(column).agg(F.count("*").alias("n_records"))
    )


def not_empty_string(rows: DataFrame, column: str) -> DataFrame:
    return failing(rows, P.blank(F.col(column)))


def outside_between(rows: DataFrame, column: str, low: Any = None, high: Any = None) -> DataFrame:
    return failing(rows, P.between(F.col(column), low, high))


def outside_range(rows: DataFrame, column: str, low: Any, high: Any) -> DataFrame:
    return failing(rows, P.within_range(F.col(column), low, high))


def later_than(rows: DataFrame, first: str, second: str) -> DataFrame:
    return failing(rows, P.no_later_than(F.col(first), F.col(second)))


def app_date_before(
    rows: DataFrame, app_column: str, app_id: int, date_column: str, expected: Any,
) -> DataFrame:
    """Rows of one application dated before its launch."""
    return failing(rows, P.numeric_text_equals(F.col(app_column), app_id)
                   & P.date_not_before(F.col(date_column), expected))


def joined_date_before(
    rows: DataFrame, other: DataFrame, key: str, app_column: str, app_id: int, date_column: str,
    expected: Any,
) -> DataFrame:
    """Rows dated before the launch whose key belongs to the application in another table.

    ``n_matches`` says how many rows of the other table the row meets. Those are counted per key
    before the join, so a key with many rows on both sides is never paired out; the failures of
    the test are the sum of ``n_matches``.
    """
    partners = (
        other.where(P.numeric_text_equals(F.col(app_column), app_id))
        .groupBy(key).agg(F.count("*").alias("n_matches"))
    )
    return rows.where(P.date_not_before(F.col(date_column), expected)).join(partners, key)


def bad_reactions(rows: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Elements of a JSON array column whose count or type is missing or no number."""
    elements = rows.select(*keep, F.explode(_elements(column)).alias("element"))
    return (
        elements.where(_bad_element(F.col("element")))
        .withColumn("element", F.to_json("element"))
    )


def _elements(column: str) -> Column:
    return F.from_json(column, "array<variant>")


def _bad_element(element: Column) -> Column:
    def number(path: str) -> Column:
        return to_number(F.try_variant_get(element, path, "string"))

    return number("$.count").isNull() | number("$.reaction_type").isNull()


def freshness(
    rows: DataFrame, loaded_at: str, now: Any, warn_after: str = "1 hour",
    error_after: str = "3 hours",
) -> DataFrame:
    """One row: newest load and ``pass``, ``warn`` or ``error``; a table never loaded is an error."""
    at = (now if isinstance(now, Column) else F.lit(now)).cast("timestamp_ntz")
    newest = F.col("max_loaded_at")
    status = (
        F.when(newest.isNull() | (newest < at - F.expr(f"interval {error_after}")), "error")
        .when(newest < at - F.expr(f"interval {warn_after}"), "warn")
        .otherwise("pass")
    )
    return rows.agg(F.max(loaded_at).alias("max_loaded_at")).withColumn("status", status)


def type_name(rows: DataFrame, column: str) -> str:
    """Declared type family of a column: number, float, boolean, timestamp_ntz, ..."""
    name = rows.schema[column].dataType.typeName()
    return {
        "long": "number", "integer": "number", "short": "number", "byte": "number",
        "decimal": "number", "double": "float", "float": "float",
    }.get(name, name)


# --- declared tests -------------------------------------------------------------------------


@dataclass(frozen=True)
class RowTest:
    """``violations`` gives the number of failures of one row: a boolean, or a count."""

    name: str
    column: str
    violation: Column
    per_element: bool = False


@dataclass(frozen=True)
class TypeTest:
    column: str
    expected: str

    @property
    def name(self) -> str:
        return f"type_{self.expected}"


@dataclass(frozen=True)
class UniqueTest:
    column: str
    name: str = "unique"


@dataclass(frozen=True)
class JoinTest:
    """``joined_date_before`` against another table, named in ``other``."""

    name: str
    column: str
    other: str
    key: str
    app_column: str
    app_id: int
    expected: Any


Test = RowTest | TypeTest | UniqueTest | JoinTest


def t_not_null(column: str) -> RowTest:
    return RowTest("not_null", column, F.col(column).isNull())


def t_not_empty(column: str) -> RowTest:
    return RowTest("not_empty_string", column, P.blank(F.col(column)))


def t_accepted(column: str, allowed: Sequence[Any]) -> RowTest:
    return RowTest("accepted_values", column, P.outside(F.col(column), allowed))


def t_between(column: str, low: Any = None, high: Any = None) -> RowTest:
    return RowTest("between", column, P.between(F.col(column), low, high))


def t_within(column: str, low: Any, high: Any) -> RowTest:
    return RowTest("within_range", column, P.within_range(F.col(column), low, high))


def t_no_later(name: str, first: str, second: str) -> RowTest:
    return RowTest(name, first, P.no_later_than(F.col(first), F.col(second)))


def t_app_date(name: str, app_column: str, app_id: int, date_column: str, expected: Any) -> RowTest:
    return RowTest(name, date_column, P.numeric_text_equals(F.col(app_column), app_id)
                   & P.date_not_before(F.col(date_column), expected))


def t_reactions(column: str) -> RowTest:
    bad = F.size(F.filter(_elements(column), _bad_element))
    # The usual list holds numbers only and needs no parser.
    failures = F.when(usual_reactions(F.col(column)), F.lit(0)).otherwise(F.greatest(bad, F.lit(0)))
    return RowTest("valid_reaction", column, failures, per_element=True)


def run_suite(
    table_name: str, rows: DataFrame, tests: Sequence[Test],
    others: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """``(table_name, test_name, column_name, failures, status)``, one row per declared test."""
    spark = rows.sparkSession
    parts = []
    row_tests = [t for t in tests if isinstance(t, RowTest)]
    if row_tests:
        parts.append(_row_counts(rows, row_tests))
    type_tests = [t for t in tests if isinstance(t, TypeTest)]
    if type_tests:
        parts.append(_type_counts(spark, rows, type_tests))
    for test in tests:
        if isinstance(test, UniqueTest):
            counted = duplicate_keys(rows, test.column).agg(F.count("*").alias("failures"))
            parts.append(_labelled(counted, test.name, test.column))
        elif isinstance(test, JoinTest):
            failed = joined_date_before(
                rows.select(test.key, test.column), (others or {})[test.other], test.key,
                test.app_column, test.app_id, test.column, test.expected,
            )
            counted = failed.agg(
                F.coalesce(F.sum("n_matches"), F.lit(0)).cast("bigint").alias("failures")
            )
            parts.append(_labelled(counted, test.name, test.column))
    report = reduce(DataFrame.unionByName, parts)
    return report.select(
        F.lit(table_name).alias("table_name"), "test_name", "column_name", "failures",
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"),
    )


def run_selected(
    tables: dict[str, DataFrame], suites: dict[str, Sequence[Test]], table_like: str = "*",
    test_like: str = "*", others: dict[str, DataFrame] | None = None,
) -> DataFrame | None:
    """The report of those tests, over several suites, whose table and name match the patterns."""
    parts = []
    for name in sorted(fnmatch.filter(suites, table_like)):
        chosen = [t for t in suites[name] if fnmatch.fnmatchcase(t.name, test_like)]
        if chosen:
            parts.append(run_suite(name, tables[name], chosen, {**tables, **(others or {})}))
    return reduce(DataFrame.unionByName, parts) if parts else None


def _labelled(counted: DataFrame, test_name: str, column: str) -> DataFrame:
    return counted.select(F.lit(test_name).alias("test_name"), F.lit(column).alias("column_name"),
                          "failures")


def _row_counts(rows: DataFrame, tests: Sequence[RowTest]) -> DataFrame:
    def count(test: RowTest) -> Column:
        if test.per_element:
            return F.sum(test.violation.cast("bigint"))
        return F.count_if(test.violation)

    counts = rows.agg(*[
        F.coalesce(count(test), F.lit(0)).cast("bigint").alias(f"n{i}")
        for i, test in enumerate(tests)
    ])
    lines = [
        F.struct(F.lit(test.name).alias("test_name"), F.lit(test.column).alias("column_name"),
                 F.col(f"n{i}").alias("failures"))
        for i, test in enumerate(tests)
    ]
    return counts.select(F.inline(F.array(*lines)))


def _type_counts(
    spark: SparkSession, rows: DataFrame, tests: Sequence[TypeTest],
) -> DataFrame:
    lines = [
        (test.name, test.column, int(type_name(rows, test.column) != test.expected))
        for test in tests
    ]
    return spark.createDataFrame(lines, "test_name string, column_name string, failures bigint")
