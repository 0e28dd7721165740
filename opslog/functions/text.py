"""Locations, masking and message templates.

Every replacement is guarded by a plain substring test that its pattern implies, so the regex
engine only sees texts that can contain a match.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opslog.fixed import (
    EMAIL_MASK,
    HEX_MASK,
    HEX_PATTERN,
    IP_MASK,
    IP_PATTERN,
    MIDPLANE_PATTERN,
    NUMBER_MASK,
    NUMBER_PATTERN,
    RACK_PATTERN,
    UNKNOWN_LOCATION,
)


# Finds exactly what ``EMAIL_PATTERN`` finds, but tries only the first position of a run of address
# characters (or where the last match ended) and never backtracks: a later position in the same
# run can only match when the first one does.
_EMAIL_SEARCH = r"(?:(?<![\w.+-])|\G)[\w.+-]++@[\w-]++\.[\w.]++"


def _replace(text: Column, needle: str, pattern: str, mask: str) -> Column:
    return F.when(text.contains(needle), F.regexp_replace(text, pattern, mask)).otherwise(text)


def _known_prefix(node: Column, pattern: str, length: int) -> Column:
    return F.when(node.rlike(pattern), F.substring(node, 1, length)).otherwise(UNKNOWN_LOCATION)


def rack(node: Column) -> Column:
    return _known_prefix(node, RACK_PATTERN, len("R00"))


def midplane(node: Column) -> Column:
    return _known_prefix(node, MIDPLANE_PATTERN, len("R00-M0"))


def mask_email(text: Column) -> Column:
    return _replace(text, "@", _EMAIL_SEARCH, EMAIL_MASK)


def mask_ip(text: Column) -> Column:
    return _replace(text, ".", IP_PATTERN.replace("(", "(?:"), IP_MASK)


def mask_hex(text: Column) -> Column:
    return _replace(text, "0x", HEX_PATTERN, HEX_MASK)


def mask_numbers(text: Column) -> Column:
    return F.regexp_replace(text, NUMBER_PATTERN, NUMBER_MASK)
