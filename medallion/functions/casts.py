"""Casts that never fail: text that does not fit gives NULL, the raw text is kept by the caller."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, functions as F

EPOCH = "1970-01-01 00:00:00"

# From these magnitudes on, integer text counts as milli-, micro-, nanoseconds.
MILLIS_FROM = 31_536_000_000
MICROS_FROM = 31_536_000_000_000
NANOS_FROM = 31_536_000_000_000_000


def _may_be_number(text: Column) -> Column:
    """First character of a number: a digit, a sign or the point.

    A failing cast costs an exception inside Spark. Comparing the text by its bytes is free and
    keeps words away from the cast.
    """
    return (text >= "+") & (text < ":")


# Words taken as truth values, in any case.
TRUE_WORDS = ["true", "t", "yes", "y", "on", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "off", "0"]
SPECIAL_DOUBLES = ["nan", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"]

# The usual list of reactions: up to 32 objects of these two whole numbers in this order. Numbers
# are of at most 18 digits, which a JSON parser writes as they are.
_GAP, _WHOLE = r"[ \t\n\r]*+", r"(?:0|[1-9][0-9]{0,17}+)"
_REACTION = (
    rf'{_GAP}\{{{_GAP}"reaction_type"{_GAP}:{_GAP}({_WHOLE}){_GAP},'
    rf'{_GAP}"count"{_GAP}:{_GAP}({_WHOLE}){_GAP}\}}{_GAP}'
)
_REACTIONS = rf"\A\[{_REACTION}(?:,{_REACTION}){{0,31}}+\]\z"
_ORDERED = rf'\{{"count":{_WHOLE},"reaction_type":{_WHOLE}\}}'
_ORDERED_REACTIONS = rf"\A\[{_ORDERED}(?:,{_ORDERED}){{0,31}}+\]\z"


def _any_case(words: Sequence[str]) -> list[str]:
    """The words in every mix of cases: looking them up is cheaper than lowering each text."""
    return sorted({
        "".join(letters) for word in words for letters in product(*((c, c.upper()) for c in word))
    })


def to_bigint(text: Column) -> Column:
    """Whole number; decimal and exponent text is rounded half away from zero."""
    word = F.trim(text)
    rounded = F.round(word.try_cast("decimal(38,10)"), 0).try_cast("bigint")
    return F.when(_may_be_number(word), F.coalesce(word.try_cast("bigint"), rounded))


def to_number(text: Column) -> Column:
    """Number of 38 digits without a fraction (the lenient check of reaction members)."""
    word = F.trim(text)
    return F.when(_may_be_number(word), word.try_cast("decimal(38,0)"))


def to_double(text: Column) -> Column:
    """Double; text Java takes but SQL does not, like ``1d`` or hexadecimal digits, is refused."""
    word = F.trim(text)
    last = F.substring(word, -1, 1)
    hexadecimal = word.contains("x") | word.contains("X")
    number = _may_be_number(word) & (last >= ".") & (last < ":") & ~hexadecimal
    return F.when(number | F.lower(word).isin(SPECIAL_DOUBLES), word.try_cast("double"))


def to_boolean(text: Column) -> Column:
    """true/t/yes/y/on/1 and false/f/no/n/off/0 in any case."""
    word = F.trim(text)
    return F.when(word.isin(_any_case(TRUE_WORDS)), F.lit(True)).when(
        word.isin(_any_case(FALSE_WORDS)), F.lit(False))


def to_timestamp_ntz(text: Column) -> Column:
    """Timestamp without zone from ISO text or from integer epoch text.

    Works on micros since the epoch, so the session time zone has no say in it.
    """
    word = F.trim(text)
    # A dash after the first place is a date.
    whole = F.when(_may_be_number(word) & (F.instr(word, "-") <= 1), word.try_cast("bigint"))
    micros = (
        F.when(whole < MILLIS_FROM, F.try_multiply(whole, F.lit(1_000_000)))
        .when(whole < MICROS_FROM, whole * 1_000)
        .when(whole < NANOS_FROM, whole)
        .otherwise(F.call_function("div", whole, F.lit(1_000)))
    )
    stamped = F.timestamp_add("MICROSECOND", micros, F.lit(EPOCH).cast("timestamp_ntz"))
    # What starts with a letter is no time: no failing cast for words.
    letter = (word >= ":") & (word < "\x7f")
    return F.coalesce(stamped, F.when(~letter, word.try_cast("timestamp_ntz")))


def epoch_utc(seconds: Column) -> Column:
    """Epoch seconds to an instant (the zone-aware type of the V1 tables)."""
    return F.timestamp_seconds(seconds)


def canonical_json(text: Column) -> Column:
    """JSON text with sorted keys and no blanks, NULL where the text is no JSON.

    Two documents are equal exactly when their canonical texts are; key order and blanks do not
    count. Comparable and hashable, which VARIANT is not.
    """
    return F.to_json(F.try_parse_json(text))


def reactions_json(text: Column) -> Column:
    """``canonical_json``; the usual list of reactions is put in order without a parser."""
    ordered = F.regexp_replace(text, _REACTION, r'{"count":$2,"reaction_type":$1}')
    return F.when(text.rlike(_REACTIONS), ordered).otherwise(canonical_json(text))


def content_hash(text: Column) -> Column:
    """SHA-256 of the canonical JSON, in hex."""
    return F.sha2(canonical_json(text), 256)


def usual_reactions(canonical: Column) -> Column:
    """True for what ``reactions_json`` makes of the usual list: all members are whole numbers."""
    return canonical.rlike(_ORDERED_REACTIONS)


CASTS = {
    "bigint": to_bigint,
    "double": to_double,
    "boolean": to_boolean,
    "timestamp": to_timestamp_ntz,
    "json": reactions_json,
}
