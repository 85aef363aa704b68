"""Column expressions for symbols, partition names and table names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tickloom.functions.durations import parse_millis
from tickloom.schemas import INSTRUMENT, PARTITION


def symbol() -> Column:
    return F.concat("base_asset", "quote_asset")


def partition_string() -> Column:
    return F.format_string(
        "Event{exchange=%s, eventType=%s, quoteAsset=%s, baseAsset=%s}",
        "exchange", "event_type", "quote_asset", "base_asset",
    )


def partition_file() -> Column:
    return F.concat_ws("_", *PARTITION)


def partition_dir() -> Column:
    return F.concat_ws("/", *PARTITION)


def _period(duration: str) -> str:
    millis = parse_millis(duration)
    return f"PT{millis // 1000}" + (f".{millis % 1000:03d}" if millis % 1000 else "") + "S"


def feature_table_name(exchange: str, quote_asset: str, base_asset: str, duration: str) -> str:
    return f"{exchange}_{quote_asset}_{base_asset}_{_period(duration)}"


def feature_table(duration: str) -> Column:
    """`feature_table_name` of a row's instrument."""
    return F.concat_ws("_", *INSTRUMENT, F.lit(_period(duration)))


def event_id(parts: str = "event_id") -> Column:
    """Identifier of a raw message: its id array joined with underscores."""
    return F.array_join(parts, "_")
