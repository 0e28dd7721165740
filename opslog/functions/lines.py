"""Reading a raw log line with one regex test and plain string functions.

A line that passes ``is_log_line`` has single spaces between its first nine fields, so the
fields can be cut out with ``split`` instead of running the ten-group regex once per field.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from opslog.fixed import (
    EVENT_TS_LENGTH,
    EVENT_TS_PATTERN,
    LINE_FIELDS,
    LINE_PATTERN,
    LINE_START_PATTERN,
)

_LINE_TERMINATORS = ("\n", "\r", "\u0085", "\u2028", "\u2029")
# The same test without capturing groups, which the regex engine would fill for every line.
_LINE_TEST = LINE_PATTERN.replace("(", "(?:")
_OTHER_SPACES = ("\t", "\n", "\x0b", "\f", "\r")
_REBUILT_LINE = " ".join(f"${group}" for group in range(1, len(LINE_FIELDS) + 1))


def is_log_line(value: Column) -> Column:
    return value.rlike(_LINE_TEST)


def leading_field(value: Column, name: str) -> Column:
    """One of the first eight fields of a log line, without building the whole field array."""
    ends = LINE_FIELDS.index(name) + 1
    return F.substring_index(F.substring_index(value, " ", ends), " ", -1)


def event_time(text: Column) -> Column:
    """'2005-06-03-15.42.50.675872' -> timestamp without zone; null for an impossible time.

    ``overlay`` keeps the text a single operand: a filter that Catalyst pushes down evaluates
    it once per use.
    """
    iso = text
    for position, mark in ((11, " "), (14, ":"), (17, ":")):
        iso = F.overlay(iso, F.lit(mark), position)
    return iso.try_cast("timestamp_ntz")


def field_array(value: Column) -> Column:
    """The fields of a log line as an array of 9 or 10 strings.

    Two kinds of line would be cut differently by ``split`` than by the regex: other white
    space right after the level, and a line terminator as the last character. Those few are
    rebuilt with the regex first.
    """
    level_piece = F.substring_index(F.substring_index(value, " ", 9), " ", -1)
    odd = reduce(or_, (
        *(level_piece.contains(space) for space in _OTHER_SPACES),
        *(value.endswith(terminator) for terminator in _LINE_TERMINATORS),
    ))
    rebuilt = F.regexp_replace(value, LINE_PATTERN + r"[\s\S]*", _REBUILT_LINE)
    return F.split(F.when(odd, rebuilt).otherwise(value), " ", len(LINE_FIELDS))


def field(parts: Column, name: str) -> Column:
    return F.coalesce(F.get(parts, F.lit(LINE_FIELDS.index(name))), F.lit(""))


def starts_like_log_line(value: Column) -> Column:
    return value.rlike(LINE_START_PATTERN)


def dated_month(value: Column) -> Column:
    """'YYYY-MM' from the log date; null when the line does not start like a log line."""
    date = F.substring_index(F.substring_index(value, " ", 3), " ", -1)
    return F.when(
        starts_like_log_line(value),
        F.concat(F.substring(date, 1, 4), F.lit("-"), F.substring(date, 6, 2)),
    )


def around_microseconds(value: Column) -> tuple[Column, Column, Column]:
    """(text before, microseconds, text after) of the first event timestamp in the line.

    Without a timestamp the whole line comes first and the rest is null.
    """
    start = F.regexp_instr(value, F.lit(EVENT_TS_PATTERN))
    micro_at = start + F.lit(EVENT_TS_LENGTH - 6)
    found = start > 0
    before = F.when(found, F.substring(value, F.lit(1), micro_at - F.lit(1))).otherwise(value)
    micro = F.when(found, F.substring(value, micro_at, F.lit(6)).cast("int"))
    after = F.when(found, F.substring(value, micro_at + F.lit(6), F.length(value)))
    return before, micro, after


def shifted_line(before: Column, micro: Column, after: Column, shift: Column) -> Column:
    """The line with ``shift`` added to its microseconds, wrapping at one second."""
    moved = F.lpad(((micro + shift) % F.lit(1_000_000)).cast("string"), 6, "0")
    return F.when(micro.isNull(), before).otherwise(F.concat(before, moved, after))
