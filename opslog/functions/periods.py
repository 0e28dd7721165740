"""Months ("2005-06") and quarters ("2005Q3"), as columns and as driver-side arguments."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from opslog.fixed import LANDING_NAME, MONTH_PATTERN, QUARTER_PATTERN

_MONTH_NAME = LANDING_NAME.split("%s")


# ---- columns ------------------------------------------------------------

def is_month(text: Column) -> Column:
    return text.rlike(rf"\A(?:{MONTH_PATTERN})\z")


def is_quarter(text: Column) -> Column:
    return text.rlike(rf"\A(?:{QUARTER_PATTERN})\z")


def quarter_of(month: Column) -> Column:
    """'2005-08' -> '2005Q3'; null when the text is no month."""
    number = F.ceil(F.substring(month, 6, 2).try_cast("int") / F.lit(3)).cast("string")
    return F.when(is_month(month), F.concat(F.substring(month, 1, 4), F.lit("Q"), number))


def quarter_of_time(time: Column) -> Column:
    year = F.lpad(F.year(time).cast("string"), 4, "0")
    return F.concat(year, F.lit("Q"), F.quarter(time).cast("string"))


def months_of_quarter(quarter: Column) -> Column:
    """'2005Q3' -> ['2005-07', '2005-08', '2005-09']; null when the text is no quarter."""
    last = F.substring(quarter, 6, 1).try_cast("int") * F.lit(3)
    year = F.substring(quarter, 1, 4)
    months = F.transform(
        F.sequence(last - F.lit(2), last),
        lambda number: F.concat(year, F.lit("-"), F.lpad(number.cast("string"), 2, "0")),
    )
    return F.when(is_quarter(quarter), months)


def is_quarter_end(month: Column) -> Column:
    return F.when(is_month(month), F.substring(month, 6, 2).isin("03", "06", "09", "12"))


def ready_quarter(month: Column, last_month: Column) -> Column:
    """The quarter that can be built once this month is clean, else null."""
    return F.when(is_quarter_end(month) | (month == last_month), quarter_of(month))


def landing_name(month: Column) -> Column:
    return F.concat(F.lit(_MONTH_NAME[0]), month, F.lit(_MONTH_NAME[1]))


def month_of_landing_name(file_name: Column) -> Column:
    return F.substring(file_name, len(_MONTH_NAME[0]) + 1, 7)


# ---- driver-side arguments ---------------------------------------------

def require_month(month: str) -> str:
    if not re.fullmatch(MONTH_PATTERN, month, re.ASCII):
        raise ValueError(f"expected a month such as 2005-06, not {month!r}")
    return month


def require_quarter(quarter: str) -> str:
    if not re.fullmatch(QUARTER_PATTERN, quarter, re.ASCII):
        raise ValueError(f"expected a quarter such as 2005Q3, not {quarter!r}")
    return quarter


def quarter_name(month: str) -> str:
    year, number = map(int, require_month(month).split("-"))
    return f"{year:04d}Q{-(-number // 3)}"


def month_names(quarter: str) -> list[str]:
    """Literal months, so that a filter on them prunes partition folders."""
    year, last = require_quarter(quarter)[:4], int(quarter[5]) * 3
    return [f"{year}-{number:02d}" for number in (last - 2, last - 1, last)]


def closes_quarter(month: str) -> bool:
    return month_names(quarter_name(month))[-1] == month
