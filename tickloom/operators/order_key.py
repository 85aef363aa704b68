"""One number instead of two order columns.

`min_by` over a struct cannot keep its buffer in place, so Spark sorts the whole input by group on
the map side before aggregating. Over a number it is a hash aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_KEY = "DECIMAL(35, 0)"


def single_order(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, Sequence[str]]:
    """(rows with one order column, its name) for windowed rows ordered by time and one whole number.

    The choice depends on the columns' types alone. The time within the window stands above 64 bits
    for the number, which a decimal of 35 digits holds for any window below 300 years. NULL sorts
    first, as it does in a struct; rows without a time have a window of their own.
    """
    if len(order) != 2 or order[0] != "time" or not isinstance(rows.schema[order[1]].dataType, _WHOLE):
        return rows, order
    within = f"CAST(coalesce(time - window_start, 0L) AS DECIMAL(13, 0)) * CAST({2**64 + 1} AS DECIMAL(20, 0))"
    arrival = f"coalesce(CAST({order[1]} AS DECIMAL(19, 0)) + CAST({2**63 + 1} AS DECIMAL(19, 0)), 0)"
    return rows.withColumn("_order", F.expr(f"CAST({within} + {arrival} AS {_KEY})")), ("_order",)
