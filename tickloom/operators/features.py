"""Feature rows: one wide row per instrument and window."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from tickloom.functions.blocks import alternative_block, stat_block
from tickloom.functions.durations import parse_millis
from tickloom.operators.book import book_snapshots
from tickloom.operators.order_key import single_order
from tickloom.operators.ordered import PAGE_ROWS, has_large_keys, hot_groups, null_safe_join, ordered, with_group_value
from tickloom.operators.windows import tumbling
from tickloom.schemas import (
    DEFAULT_LEVELS, EVENT_ORDER, EXTENDED_MEASURES, INSTRUMENT, LEVEL_UPDATE, MEASURES, TRADE, book_labels,
    extended_columns, feature_schema,
)

WINDOW_KEYS = (*INSTRUMENT, "window_end")


def trade_features(
    events: DataFrame,
    duration: str = "5m",
    keys: Sequence[str] = INSTRUMENT,
    order: Sequence[str] = EVENT_ORDER,
    compat: bool = False,
    exact: bool = False,
) -> DataFrame:
    """Blocks ``all``, ``buy`` and ``sell`` of the trades of each (key, window), in one pass.

    ``exact``: sums that do not depend on how the rows lie, as in `stat_block`.
    ``compat`` reproduces the original output, where all three blocks describe all trades.
    """
    trades = tumbling(events.where(F.col("event_type") == TRADE), duration)
    trades, order = single_order(trades, order)
    aggregates = stat_block("all", order=order, exact=exact)
    if not compat:
        for label in ("buy", "sell"):
            aggregates += stat_block(label, F.col("side") == label, order, exact)
    rows = trades.groupBy(*keys, "window_end").agg(*aggregates)
    if compat:
        copies = [F.col(f"all_{m}").alias(f"{label}_{m}") for label in ("buy", "sell") for m in MEASURES]
        rows = rows.select("*", *copies)
    return rows


def window_snapshots(
    events: DataFrame,
    duration: str = "5m",
    levels: int = DEFAULT_LEVELS,
    keys: Sequence[str] = INSTRUMENT,
    order: Sequence[str] = EVENT_ORDER,
    scope: str = "window",
    page_rows: int | None = None,
) -> DataFrame:
    """Book snapshots with ``window_end``. The book starts empty in each window; with
    ``scope="instrument"`` it is carried on from window to window."""
    updates = events.where(F.col("event_type") == LEVEL_UPDATE)
    if scope == "window":
        return book_snapshots(tumbling(updates, duration), [*keys, "window_end"], levels, order, page_rows)
    if scope != "instrument":
        raise ValueError(f"scope {scope!r} is neither 'window' nor 'instrument'")
    return tumbling(book_snapshots(updates, keys, levels, order, page_rows), duration).drop("window_start")


def book_level_stats(snapshots: DataFrame, keys: Sequence[str] = WINDOW_KEYS) -> DataFrame:
    """The 15 measures of each (window, side, level) over all its snapshots."""
    # `pos` is one unique number per window: a flat buffer, so this is a hash aggregate.
    measures = [F.col(f"x_{m}").alias(m) for m in MEASURES]
    return (
        snapshots.groupBy(*keys, "side", "level").agg(*stat_block("x", order=["pos"])).select(*keys, "side", "level", *measures)
    )


def widen(
    stats: DataFrame, labels: Sequence[str], keys: Sequence[str] = WINDOW_KEYS,
    measures: Sequence[str] = MEASURES, name: Callable[[str, str], str] = "{}_{}".format,
) -> DataFrame:
    """Long rows (keys, label, measures) -> one row per keys, columns named from label and measure."""
    block = F.struct(*measures)
    picked = [F.first(F.when(F.col("label") == label, block), ignorenulls=True).alias(label) for label in labels]
    rows = stats.groupBy(*keys).agg(*picked)
    return rows.selectExpr(*keys, *[f"{label}.{m} AS {name(label, m)}" for label in labels for m in measures])


def book_features(
    events: DataFrame,
    duration: str = "5m",
    levels: int = DEFAULT_LEVELS,
    keys: Sequence[str] = INSTRUMENT,
    order: Sequence[str] = EVENT_ORDER,
    scope: str = "window",
    page_rows: int | None = None,
) -> DataFrame:
    """Blocks ``ask_0`` .. ``bid_<n-1>`` of each (key, window)."""
    snapshots = window_snapshots(events, duration, levels, keys, order, scope, page_rows)
    by_level = book_level_stats(snapshots, [*keys, "window_end"])
    labelled = by_level.withColumn("label", F.concat_ws("_", "side", "level"))
    return widen(labelled, book_labels(levels), [*keys, "window_end"])


def to_feature_rows(rows: DataFrame, duration: str, levels: int = DEFAULT_LEVELS) -> DataFrame:
    """The output contract: control columns and every label, absent columns as NULL."""
    present = set(rows.columns) | {"interval"}
    rows = rows.withColumn("interval", F.lit(parse_millis(duration) // 1000).cast("bigint"))
    return rows.selectExpr(*[
        f"CAST({f.name if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in feature_schema(levels)
    ])


def window_features(
    events: DataFrame,
    duration: str = "5m",
    levels: int = DEFAULT_LEVELS,
    order: Sequence[str] = EVENT_ORDER,
    compat: bool = False,
    joined: bool = True,
    scope: str = "window",
) -> DataFrame:
    """The full feature row of each (instrument, window).

    ``joined=False`` keeps the original shape: one row for the trades of a window and another
    for its book, each with the other's columns NULL.
    """
    trades = trade_features(events, duration, order=order, compat=compat)
    book = book_features(events, duration, levels, order=order, scope=scope)
    if joined:
        return to_feature_rows(join_features(trades, book), duration, levels)
    return to_feature_rows(trades, duration, levels).unionByName(to_feature_rows(book, duration, levels))


def join_features(trades: DataFrame, book: DataFrame, keys: Sequence[str] = WINDOW_KEYS) -> DataFrame:
    """Trade and book blocks of the same window side by side; either may be missing."""
    return trades.join(book, [*keys], "full_outer")


def with_control_columns(rows: DataFrame, exchange: str, quote_asset: str, base_asset: str) -> DataFrame:
    """Name the instrument from parameters, for inputs that hold one instrument and not its name."""
    return rows.withColumns({
        "exchange": F.lit(exchange), "quote_asset": F.lit(quote_asset), "base_asset": F.lit(base_asset),
    })


def with_spread(features: DataFrame) -> DataFrame:
    """Best ask minus best bid at the close of the window."""
    return features.withColumn("spread", F.col("ask_0_close_price") - F.col("bid_0_close_price"))


def trade_block_alternative(
    trades: DataFrame, duration: str = "5m", keys: Sequence[str] = INSTRUMENT, order: Sequence[str] = EVENT_ORDER
) -> DataFrame:
    """Notebook trade block on raw (not notional) quantities."""
    rows, order = single_order(tumbling(trades, duration), order)
    return rows.groupBy(*keys, "window_end").agg(*alternative_block(order))


def extended_stats(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], page_rows: int | None = None, large: bool | None = None
) -> DataFrame:
    """The 20 extended measures per key: count, sum, and nine statistics of price and quantity.

    ``mad`` is the mean absolute deviation, so every row gets its group's means first. An exact
    median holds the distinct values of its group; groups beyond ``page_rows`` rows get theirs by
    position. ``large`` says whether there are such groups, if the caller knows.
    """
    if large is None:
        large = has_large_keys(rows, keys, page_rows)
    if large:
        # Only the groups that need it take the long way.
        _, hot_rows, listed = hot_groups(rows, keys, page_rows or PAGE_ROWS)
        listed = listed.drop("_n")
        small = null_safe_join(rows, listed, keys, "left_anti")
        small = _extended_stats(small, keys, order, page_rows, large=False)
        if not hot_rows:
            return small
        hot = null_safe_join(rows, listed, keys, "left_semi")
        return small.unionByName(_extended_stats(hot, keys, order, page_rows, large=True))
    return _extended_stats(rows, keys, order, page_rows, large=False)


def _extended_stats(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], page_rows: int | None, large: bool
) -> DataFrame:
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order, *_FIELDS)
    aggregates = [F.count("price").alias("count_price"), F.sum("quantity").alias("sum_quantity")]
    for f in _FIELDS:
        aggregates += [
            F.avg(f).alias(f"mean_{f}"),
            F.skewness(f).alias(f"skew_{f}"),
            F.stddev_samp(f).alias(f"std_{f}"),
            F.min(f).alias(f"min_{f}"),
            F.max(f).alias(f"max_{f}"),
            F.avg(F.abs(F.col(f) - F.col(f"_mean_{f}"))).alias(f"mad_{f}"),
            F.min_by(f, at).alias(f"first_{f}"),
            F.max_by(f, at).alias(f"last_{f}"),
        ]
        if not large:
            aggregates.append(F.median(f).alias(f"median_{f}"))
    needed = rows.select(*keys, *[c for c in order if c not in keys], *_FIELDS)
    centred = with_group_value(needed, keys, {f"_mean_{f}": F.avg(f) for f in _FIELDS}, large, page_rows)
    stats = centred.groupBy(*keys).agg(*aggregates)
    if large:
        for f in _FIELDS:
            stats = null_safe_join(stats, _median_by_position(needed, keys, f, order, page_rows), keys, "left")
    return stats.select(*keys, *EXTENDED_MEASURES)


_FIELDS = ("price", "quantity")


def _median_by_position(
    rows: DataFrame, keys: Sequence[str], field: str, order: Sequence[str], page_rows: int | None
) -> DataFrame:
    values = rows.where(F.col(field).isNotNull())
    sizes = values.groupBy(*keys).agg(F.count("*").alias("_n"))
    middle = null_safe_join(
        ordered(values, keys, [field, *order], page_rows).df,  # one price may hold most rows; the order splits it
        sizes.select(*keys, F.explode(F.expr("array_distinct(array((_n + 1) div 2, (_n + 2) div 2))")).alias("_pos")),
        [*keys, "_pos"],
    )
    return middle.groupBy(*keys).agg(F.avg(field).alias(f"median_{field}"))


def extended_features(
    events: DataFrame, duration: str = "5m", levels: int = 10, keys: Sequence[str] = INSTRUMENT,
    order: Sequence[str] = EVENT_ORDER, page_rows: int | None = None,
) -> DataFrame:
    """The extended block of both trade sides and of every book level, close price and spread."""
    window = [*keys, "window_end"]
    # No group below has more rows than its window has events.
    large = has_large_keys(tumbling(events, duration), window, page_rows)
    trades = tumbling(events.where(F.col("event_type") == TRADE), duration)
    by_side = extended_stats(trades.where(F.col("side").isin("buy", "sell")), [*window, "side"], order,
                             page_rows, large)
    close = trades.groupBy(*window).agg(F.max_by("price", F.struct(*order, "price", "quantity")).alias("close_price"))
    by_level = extended_stats(
        window_snapshots(events, duration, levels, keys, order, page_rows=page_rows), [*window, "side", "level"],
        ["pos"], page_rows, large,
    )
    trade_part = widen(by_side.withColumnRenamed("side", "label"), ("buy", "sell"), window, EXTENDED_MEASURES,
                       lambda label, m: f"{m}_{label}")

    def level_name(label: str, measure: str) -> str:
        side, level = label.split("_")
        return f"{side}_{measure}_{level}"

    book_part = widen(by_level.withColumn("label", F.concat_ws("_", "side", "level")), book_labels(levels), window,
                      EXTENDED_MEASURES, level_name)
    rows = close.join(trade_part, window, "left").join(book_part, window, "full_outer")
    spread = F.col("ask_last_price_0") - F.col("bid_last_price_0")
    return rows.withColumn("spread", spread).select(*window, *extended_columns(levels))


def mean_by_level(levels: DataFrame, keys: Sequence[str] = ("type", "side", "level")) -> DataFrame:
    return levels.groupBy(*keys).agg(F.avg("price").alias("price"), F.avg("quantity").alias("quantity"))
