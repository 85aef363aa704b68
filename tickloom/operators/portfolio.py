"""Scoring of portfolio weights: drift, turnover cost, step returns, run summaries.

Input rows: one per (run, step, asset) with ``weight`` (the action), ``current_price`` and
``next_price``; ``asset`` is its 0-based number. Steps are consecutive whole numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.operators.ordered import has_large_keys, offsets, ordered, plain, running_product, with_group_value
from tickloom.session import stage

# Fixed values of the training setup.
COMMISSION = 0.0015
DECAY = 3.47222222e-7

STEP = ("run", "step")


def normalise_weights(
    rows: DataFrame, weight: str = "weight", step: Sequence[str] = STEP, large: bool | None = None
) -> DataFrame:
    """Weights of each step scaled to sum to 1. ``large``: whether a step outgrows one task."""
    if large is None:
        large = has_large_keys(rows, step)
    scaled = F.col(weight) / F.nullif(F.col("_total"), F.lit(0.0))
    return with_group_value(rows, step, {"_total": F.sum(weight)}, large).withColumn(weight, scaled).drop("_total")


def signed_weights(rows: DataFrame, weight: str = "weight") -> DataFrame:
    """Weights of kind ``short`` turned negative."""
    return rows.withColumn(weight, F.when(F.col("kind") == "short", -F.col(weight)).otherwise(F.col(weight)))


def profit(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum(F.col("weight") * F.col("delta")).alias("pnl"))


def drifted_weights(rows: DataFrame, large: bool | None = None) -> DataFrame:
    """Weights after the step's price move: next price times weight, scaled to sum to 1."""
    moved = rows.withColumn("drifted", F.col("next_price") * F.col("weight"))
    return normalise_weights(moved, "drifted", large=large)


def _scored_steps(
    rows: DataFrame, commission: float, decay: float, page_rows: int | None, large: bool | None
) -> DataFrame:
    o = ordered(drifted_weights(rows, large), ["run", "asset"], ["step"], page_rows, large)
    traded = offsets(o, {"_held": ("drifted", -1)})
    gain = F.col("weight") * (F.col("next_price") - F.col("current_price"))
    moved = F.when(F.col("asset") > 0, F.abs(F.col("weight") - F.col("_held"))).otherwise(F.lit(0.0))
    steps = traded.groupBy(*STEP).agg(
        (F.sum(gain) + 1).alias("free_return"), F.sum(moved).alias("_moved"), F.min("_pos").alias("_pos")
    )
    cost = F.coalesce("_moved", F.lit(0.0)) * commission + decay
    return steps.withColumn("mu", F.when(F.col("_pos") == 1, F.lit(1.0)).otherwise(1 - cost))


def turnover(rows: DataFrame, commission: float = COMMISSION, decay: float = DECAY,
             page_rows: int | None = None, large: bool | None = None) -> DataFrame:
    """Cost factor ``mu`` of each step: trading from the drifted to the new weights, plus decay.

    The first step of a run costs nothing. Asset 0 is free of commission.
    """
    return _scored_steps(rows, commission, decay, page_rows, large).select(*STEP, "mu")


def step_returns(rows: DataFrame, commission: float = COMMISSION, decay: float = DECAY,
                 page_rows: int | None = None, large: bool | None = None) -> DataFrame:
    """Per (run, step): ``free_return``, ``mu`` and ``step_return`` = free_return * mu.

    ``large``: whether a step or an asset of a run outgrows one task, if the caller knows.
    """
    steps = _scored_steps(rows, commission, decay, page_rows, large)
    return steps.select(*STEP, "free_return", "mu", (F.col("free_return") * F.col("mu")).alias("step_return"))


def run_summary(returns: DataFrame, page_rows: int | None = None, large: bool | None = None) -> DataFrame:
    """Per run: mean, log mean, mean free return, population deviation, Sharpe ratio, value, loss.
    ``large``: whether there are more than ``page_rows`` runs, if the caller knows.

    ``value`` chains: the product of the run's returns times the value of the run before.
    """
    mean, std = F.avg("step_return"), F.stddev_pop("step_return")
    log_mean = F.avg(F.ln("step_return"))
    # One row per run, written so that the chaining below does not score the steps again.
    runs = stage(returns.groupBy("run").agg(
        mean.alias("mean"), log_mean.alias("log_mean"), F.avg("free_return").alias("log_mean_free"),
        std.alias("std"), ((mean - 1) / F.nullif(std, F.lit(0.0))).alias("sharpe"),
        F.product("step_return").alias("run_value"), (-log_mean).alias("loss"),
    ))
    chained = running_product(
        ordered(runs.withColumn("_all", F.lit(0)), ["_all"], ["run"], page_rows, large), "value", F.col("run_value")
    )
    return plain(chained).drop("_all")


def portfolio_delta(target: Column, current: Column) -> Column:
    """Target minus current weights, element by element."""
    return F.zip_with(target, current, lambda t, c: t - c)
