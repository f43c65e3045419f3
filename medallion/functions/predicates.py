"""Predicates shared by merges and quality tests; each is a plain Column."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, functions as F


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def distinct_from(left: Column, right: Column) -> Column:
    """Inequality that treats NULL as a value."""
    return ~left.eqNullSafe(right)


def any_distinct(left: str, right: str, columns: Sequence[str]) -> Column:
    """True when at least one of ``columns`` differs between two aliased sides."""
    return any_of(distinct_from(F.col(f"{left}.`{c}`"), F.col(f"{right}.`{c}`")) for c in columns)


def date_not_before(date: Column, expected: Any) -> Column:
    """Violation: a known date earlier than ``expected``."""
    return date.isNotNull() & (date < expected)


def no_later_than(first: Column, second: Column) -> Column:
    """Violation: both known and the first one later."""
    return first.isNotNull() & second.isNotNull() & (first > second)


def within_range(value: Column, low: Any, high: Any) -> Column:
    """Violation: below ``low`` or above ``high``."""
    return (value < low) | (value > high)


def between(value: Column, low: Any = None, high: Any = None) -> Column:
    """Violation of an inclusive range with optional ends."""
    ends = []
    if low is not None:
        ends.append(value < low)
    if high is not None:
        ends.append(value > high)
    if not ends:
        raise ValueError("give at least one end")
    return any_of(ends)


def blank(text: Column) -> Column:
    """Violation: only blanks."""
    return F.trim(text) == ""


def outside(value: Column, allowed: Sequence[Any]) -> Column:
    """Violation: not NULL and not one of the allowed values."""
    return ~value.isin(list(allowed))


def numeric_text_equals(text: Column, number: int) -> Column:
    """Equality of number text and a number; text that is no number is never equal."""
    return F.coalesce(text.try_cast("bigint") == number, F.lit(False))
