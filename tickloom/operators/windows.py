"""Event time, tumbling windows and time grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.functions.durations import parse_millis
from tickloom.operators.ordered import ordered, plain
from tickloom.schemas import EVENT_ORDER, PARTITION


def assign_event_time(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", F.timestamp_millis("time"))


def tumbling(df: DataFrame, duration: str = "5m") -> DataFrame:
    """Epoch-aligned [start, end) windows; ``window_end`` is the last millisecond inside.

    Integer arithmetic on the millisecond column, so it stays exact and needs no timestamp.
    """
    millis = parse_millis(duration)
    start = F.col("time") - F.pmod(F.col("time"), F.lit(millis).cast("bigint"))
    return df.withColumn("window_start", start).withColumn(
        "window_end", start + F.lit(millis - 1).cast("bigint")
    )


def time_grid(df: DataFrame, step: str, keys: Sequence[str] = ()) -> DataFrame:
    """Regular instants (milliseconds) from ``start`` to ``end``, both ends included.

    Built in two steps of at most 10,000 instants, so that no array grows with the time range.
    """
    millis = parse_millis(step)
    stride = millis * 10_000
    strides = df.select(*keys, "end", F.explode(F.expr(f"sequence(start, end, {stride}L)")).alias("_from"))
    return strides.select(
        *keys, F.explode(F.expr(f"sequence(_from, least(end, _from + {stride - millis}L), {millis}L)")).alias("time")
    )


def window_markers(df: DataFrame, duration: str = "5m", keys: Sequence[str] = PARTITION) -> DataFrame:
    """One 0.0 per (key, window) that has any event."""
    return tumbling(df, duration).groupBy(*keys, "window_end").agg(F.lit(0.0).alias("marker"))


def window_counts(df: DataFrame, duration: str = "5m", keys: Sequence[str] = PARTITION) -> DataFrame:
    return tumbling(df, duration).groupBy(*keys, "window_end").agg(F.count("*").alias("count"))


def ordered_event_pages(
    df: DataFrame,
    duration: str = "5m",
    keys: Sequence[str] = PARTITION,
    order: Sequence[str] = EVENT_ORDER,
    page: int = 10_000,
    fields: Sequence[str] = ("time", "quantity", "price", "side"),
) -> DataFrame:
    """The time-ordered event list of each (key, window), in pages of at most ``page`` events.

    Concatenating the pages of a window by ``page`` gives the whole list; no array grows with
    the traffic of one window.
    """
    o = ordered(tumbling(df, duration), [*keys, "window_end"], order)
    paged = o.df.withColumn("page", F.expr(f"(_pos - 1) div {page}"))
    return (
        paged.groupBy(*keys, "window_end", "page")
        .agg(F.sort_array(F.collect_list(F.struct("_pos", *fields))).alias("events"))
        .withColumn("events", F.transform("events", lambda e: F.struct(*[e[f].alias(f) for f in fields])))
    )


def count_batches(df: DataFrame, size: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Number the rows of each key into batches of ``size``; a partial last batch is withheld."""
    o = ordered(df, keys, order)
    numbered = o.df.withColumn("batch", F.expr(f"(_pos - 1) div {size}"))
    filled = F.count("*").over(Window.partitionBy(*keys, "batch"))
    full = numbered.withColumn("_n", filled).where(F.col("_n") == size)
    return plain(full.withColumn("row_in_batch", F.expr(f"(_pos - 1) % {size} + 1").cast("int")).drop("_n"))
