"""Duration text: a positive whole number followed by s, m or h."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_UNIT_MS = {"s": 1_000, "m": 60_000, "h": 3_600_000}


def parse_millis(text: str) -> int:
    match = re.fullmatch(r"([1-9][0-9]*)([smh])", text or "")
    if not match:
        raise ValueError(f"duration {text!r} is not a positive <n>s, <n>m or <n>h")
    return int(match[1]) * _UNIT_MS[match[2]]


def utc_text(instant: Column, pattern: str) -> Column:
    """An instant written in UTC, whatever the session's time zone."""
    return F.date_format(F.to_utc_timestamp(instant, F.current_timezone()), pattern)
