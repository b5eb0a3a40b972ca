"""Cleaning rules as column expressions. All are built-ins, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.specs import COUNT, MOMENT, MONEY, TEXT, TableSpec

# Every character Unicode counts as white space, plus the four ASCII separators. A plain trim() only
# removes the ordinary blank.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# White space around a value is part of its pattern, so reading takes one pass over the text.
_PAD = f"[{WHITESPACE}]*"
_NUMBER = rf"^{_PAD}([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?){_PAD}$"
# A day: year first with -, / or . between or nothing at all, or day first with any of them.
_YEAR_FIRST = rf"^{_PAD}(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})(?!\d)"
_COMPACT = rf"^{_PAD}(\d{{4}})(\d{{2}})(\d{{2}})(?=$|[ T{WHITESPACE}])"
_DAY_FIRST = rf"^{_PAD}(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}})(?!\d)"
# A second number beyond 12 can only be a day.
_MONTH_FIRST = rf"^{_PAD}(0?[1-9]|1[0-2])[-/.](1[3-9]|2\d|3[01])[-/.](\d{{4}})(?!\d)"
_DAY_NAMED = rf"(?i)^{_PAD}(\d{{1,2}})[ -]([a-z]{{3}})[a-z]{{0,6}}\.?,?[ -](\d{{4}})(?!\d)"
_NAMED_DAY = rf"(?i)^{_PAD}([a-z]{{3}})[a-z]{{0,6}}\.? (\d{{1,2}}),? (\d{{4}})(?!\d)"
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
# After the day: hour and minute, seconds with a fraction if given, half of the day, and a zone or offset.
_TIME = r"\d{1,2}:\d{2}(?!\d)(?::\d{2}(?!\d)(?:\.\d{1,6})?)?"
_MOMENT = (
    # An offset belongs to a time.
    rf"(?i)^(?!{_PAD}\d{{4}}-\d{{1,2}}-\d{{1,2}}{_PAD}[+-](?!00:?00))"
    rf"{_PAD}(\d{{4}}-\d{{1,2}}-\d{{1,2}}(?!\d)(?:[ T]{_TIME})?)\d*"
    rf"(?:(?<=:\d\d) ?[ap]m)?{_PAD}(?:Z|(?<=\d|m| )[+-]\d{{2}}:?(?:\d{{2}})?)?{_PAD}$"
)
_AFTERNOON = r"(?i)[ T](?:0?[1-9]|1[01]):\d{2}(?::\d{2})? ?pm"
_MIDNIGHT = r"(?i)[ T]12:\d{2}(?::\d{2})? ?am"
_OFFSET = rf"(?i):\d{{2}}(?:\.\d+)?(?: ?[ap]m)? ?([+-]\d{{2}}):?(\d{{2}})?{_PAD}$"
# The usual spelling, which a cast reads as it is.
_USUAL = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$"
# Spellings that need no rearranging, over stripped text.
ISO_SPELLING = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]00:?00)?)?$"


def stripped(col: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def clean_text(col: Column) -> Column:
    """Stripped text; blank becomes NULL."""
    return F.nullif(stripped(col), F.lit(""))


def parse_number(col: Column) -> Column:
    """Text to double. Commas read as decimal points; anything that is not a plain number is NULL.

    The pattern keeps out spellings a cast would accept, such as 'nan', 'inf' or '2.5d'. The text is used
    once, each step inside the next: an expression mentioned twice would be computed twice.
    """
    return F.regexp_extract(F.translate(col, ",", "."), _NUMBER, 1).try_cast("double")


def non_negative(col: Column) -> Column:
    """Negative measures become NULL; zero stays."""
    return F.when(col >= 0, col)


def within(col: Column, low, high) -> Column:
    """Values outside the closed interval become NULL."""
    return F.when(col.between(low, high), col)


def to_money(col: Column) -> Column:
    """Decimal with four digits, rounded half up; NULL when it does not fit."""
    return col.try_cast("decimal(18,4)")


def to_count(col: Column) -> Column:
    """Whole number, rounded half to even; NULL when it does not fit."""
    return F.rint(col).try_cast("bigint")


def _year_first(col: Column) -> Column:
    """The text with its day as year-month-day, whatever order and spelling it had."""
    named = F.regexp_replace(F.regexp_replace(col, _NAMED_DAY, "$3-$1-$2"), _DAY_NAMED, "$3-$2-$1")
    named = F.regexp_replace(named, r"(?i)^(\d{4}-)([a-z]{3})(-\d)", "$1@$2$3")
    for number, month in enumerate(_MONTHS, 1):
        named = F.regexp_replace(named, f"(?i)@{month}", f"{number:02d}")
    iso = F.regexp_replace(F.when(col.rlike("[A-Za-z]{3}"), named).otherwise(col), _MONTH_FIRST, "$3-$1-$2")
    iso = F.regexp_replace(iso, _DAY_FIRST, "$3-$2-$1")
    iso = F.regexp_replace(iso, _COMPACT, "$1-$2-$3")
    return F.regexp_replace(iso, _YEAR_FIRST, "$1-$2-$3")


def parse_moment(col: Column) -> Column:
    """A date, year first or day first, with or without time, to a timestamp without zone; else NULL.

    Read are 2026-07-08, 2026/7/8, 20260708, 08/07/2026, 8-7-2026, 8 Jul 2026, July 8, 2026, and 7/13/2026, whose second
    number can be no month; each alone or with 13:25, 13:25:10.5 or 1:25 PM behind a blank or T, and a final Z or offset,
    which is applied: the moment is that of UTC. The usual spelling is cast as it is; others are rearranged to it first, so
    no parser exception is raised.
    """
    iso = _year_first(col)
    read = F.regexp_extract(iso, _MOMENT, 1).try_cast("timestamp_ntz")
    # Hours that the half of the day and the offset add.
    half = F.when(iso.rlike(_AFTERNOON), 12).when(iso.rlike(_MIDNIGHT), -12).otherwise(0)
    hours = F.coalesce(F.regexp_extract(iso, _OFFSET, 1).try_cast("int"), F.lit(0))
    minutes = F.coalesce(F.regexp_extract(iso, _OFFSET, 2).try_cast("int"), F.lit(0))
    minutes = F.when(F.regexp_extract(iso, _OFFSET, 1).startswith("-"), -minutes).otherwise(minutes)
    moved = read + F.make_dt_interval(F.lit(0), half - hours, -minutes)
    exact = F.when(iso.rlike(r"(?i)m|[+-]\d{2}:?\d{0,2}$"), moved).otherwise(read)
    return F.when(col.rlike(_USUAL), col.try_cast("timestamp_ntz")).otherwise(exact)


def parsed(spec: TableSpec, name: str) -> Column:
    """First step of cleaning a column: its text read as the column's kind."""
    parse = {TEXT: clean_text, MOMENT: parse_moment, MONEY: parse_number, COUNT: parse_number}
    return parse[spec.columns[name]](F.col(name)).alias(name)


def checked(spec: TableSpec, name: str) -> Column:
    """Second step: value rules and final type of a parsed column."""
    value, kind = F.col(name), spec.columns[name]
    if kind not in (MONEY, COUNT):
        return value
    value = non_negative(value)
    if name in spec.bounds:
        value = within(value, *spec.bounds[name])
    return {MONEY: to_money, COUNT: to_count}[kind](value).alias(name)


def clean_columns(rows: DataFrame, spec: TableSpec, *others: str) -> DataFrame:
    """The table's columns cleaned, next to ``others`` as they are.

    The value rules mention a number several times, so it is parsed in a projection of its own.
    """
    texts = rows.select(*[parsed(spec, name) for name in spec.names], *others)
    return texts.select(*[checked(spec, name) for name in spec.names], *others)
