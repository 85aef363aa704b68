"""Statistic blocks as lists of aggregate columns.

Every aggregate here is mergeable, so Spark combines on the map side and a hot group costs
one partial row per task, whatever its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from tickloom.functions.exact import exact_sum
from tickloom.schemas import EVENT_ORDER


def _order(order: Sequence[str]) -> Column:
    # One column keeps the aggregation buffer flat (hash aggregate); several need a struct, which ends
    # in the picked values, so that rows of one place in the order give the same result however they lie.
    return F.col(order[0]) if len(order) == 1 else F.struct(*order, "price", "quantity")


def stat_block(
    label: str, where: Column | None = None, order: Sequence[str] = EVENT_ORDER, exact: bool = False
) -> list[Column]:
    """The 15 measures of the rows that satisfy ``where``, named ``<label>_<measure>``.

    No matching row makes the whole label NULL; one row makes the deviations NULL. ``exact``: volume, means and
    vwap come from `exact_sum`, the same to the last bit however the rows lie, for about twice the time.
    """
    total = exact_sum if exact else F.sum

    def mean(column: Column) -> Column:
        return exact_sum(column) / F.nullif(F.count(column), F.lit(0)) if exact else F.avg(column)

    def pick(column: Column) -> Column:
        return column if where is None else F.when(where, column)

    price, quantity, at = pick(F.col("price")), pick(F.col("quantity")), pick(_order(order))
    notional = pick(F.col("price") * F.col("quantity"))
    count = F.count("*") if where is None else F.nullif(F.count(F.when(where, 1)), F.lit(0))
    measures = {"count": count, "volume": total(quantity)}
    if len(order) == 1:
        opened, closed = ({f: pick_by(f, at) for f in ("price", "quantity")} for pick_by in (F.min_by, F.max_by))
    else:
        # The wide order value is buffered once for both fields of the row it picks.
        row = F.struct("price", "quantity")
        first, last = F.min_by(row, at), F.max_by(row, at)
        opened, closed = ({f: picked[f] for f in ("price", "quantity")} for picked in (first, last))
    for name, value in (("quantity", quantity), ("price", price)):
        measures |= {
            f"open_{name}": opened[name],
            f"close_{name}": closed[name],
            f"high_{name}": F.max(value),
            f"low_{name}": F.min(value),
            f"mean_{name}": mean(value),
            f"std_{name}": F.stddev_samp(value),
        }
    measures["vwap"] = total(notional) / F.nullif(total(quantity), F.lit(0.0))
    return [column.alias(f"{label}_{name}") for name, column in measures.items()]


def alternative_block(order: Sequence[str] = EVENT_ORDER) -> list[Column]:
    """Notebook variant: raw quantities in, population deviation, typical price times volume."""
    notional = F.col("price") * F.col("quantity")
    close = F.max_by("price", _order(order))
    low, high, volume = F.min("price"), F.max("price"), F.sum(notional)
    return [
        close.alias("close_price"),
        high.alias("high_price"),
        low.alias("low_price"),
        F.avg("price").alias("mean_price"),
        F.stddev_pop("price").alias("std_price"),
        F.max_by(notional, _order(order)).alias("close_qty"),
        F.max(notional).alias("max_qty"),
        F.min(notional).alias("min_qty"),
        F.avg(notional).alias("mean_qty"),
        F.stddev_pop(notional).alias("std_qty"),
        F.count("*").alias("count"),
        (((close + low + high) / 3) * volume).alias("vwap"),
        volume.alias("volume"),
    ]
