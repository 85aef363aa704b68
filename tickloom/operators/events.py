"""Filters, union and deduplication of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tickloom.schemas import EVENT_COLUMNS, LEVEL_UPDATE, TRADE


def of_type(events: DataFrame, event_type: str) -> DataFrame:
    return events.where(F.col("event_type") == event_type)


def known_types(events: DataFrame) -> DataFrame:
    """Trades and level updates; anything else is dropped."""
    return events.where(F.col("event_type").isin(TRADE, LEVEL_UPDATE))


def of_side(events: DataFrame, side: str) -> DataFrame:
    return events.where(F.col("side") == side)


def split_sides(levels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(asks, bids)"""
    return of_side(levels, "ask"), of_side(levels, "bid")


def of_partition(events: DataFrame, exchange: str, event_type: str, quote_asset: str, base_asset: str) -> DataFrame:
    """One partition, by its key columns rather than a composed string, so that scans prune."""
    return events.where(
        (F.col("exchange") == exchange) & (F.col("event_type") == event_type)
        & (F.col("quote_asset") == quote_asset) & (F.col("base_asset") == base_asset)
    )


def of_symbol(events: DataFrame, exchange: str, symbol: str) -> DataFrame:
    return events.where((F.col("exchange") == exchange) & (F.concat("base_asset", "quote_asset") == symbol))


def extract_trades(events: DataFrame, exchange: str, symbol: str) -> DataFrame:
    return of_symbol(of_type(events, TRADE), exchange, symbol).select("time", "side", "quantity", "price")


def flatten(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Bag union: duplicates stay."""
    for other in others:
        first = first.unionByName(other)
    return first


def distinct_events(events: DataFrame) -> DataFrame:
    """One row per distinct event, with the earliest ``seq`` of its copies.

    ``time`` is part of the record, so equal events share any window and a window adds nothing
    here; streams use it to bound their state. Copies are combined before the shuffle where ``seq`` is a number; the least
    record would take a sort of all that a task reads, so with records equal events are brought together first.
    """
    if "seq" in events.columns:
        if isinstance(events.schema["seq"].dataType, T.StructType):
            fraction = F.pmod(F.xxhash64(*[c for c in EVENT_COLUMNS if c != "time"]), F.lit(4096))
            placed = events.withColumn("_fraction", fraction).repartition("time", "_fraction")
            return placed.groupBy(*EVENT_COLUMNS, "_fraction").agg(F.min("seq").alias("seq")).drop("_fraction")
        return events.groupBy(*EVENT_COLUMNS).agg(F.min("seq").alias("seq"))
    return events.dropDuplicates(list(EVENT_COLUMNS))


def signed_quantity(trades: DataFrame) -> DataFrame:
    """Quantities of sells turned negative."""
    return trades.withColumn(
        "quantity", F.when(F.col("side") == "sell", -F.col("quantity")).otherwise(F.col("quantity"))
    )
