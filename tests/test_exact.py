"""Sums that do not depend on the order of addition."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tickloom.functions.exact import exact_sum
from tickloom.operators.features import trade_features


def _sums(spark, values, parts=3):
    table = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "k int, x double").repartition(parts)
    return table.agg(exact_sum(F.col("x"))).first()[0]


def test_nothing_is_lost(spark):
    assert _sums(spark, [1e16, 1.0, -1e16]) == 1.0
    assert _sums(spark, [1e16, -1.0, 1.0, 2.0**-37, -1e16]) == 2.0**-37
    assert _sums(spark, [0.1] * 10) == float(10 * Fraction(0.1))
    assert _sums(spark, [-0.25, None, 0.0]) == -0.25
    assert _sums(spark, [None]) is None and _sums(spark, []) is None
    assert _sums(spark, [1e300, 1e300]) == 2e300 and math.isnan(_sums(spark, [float("nan"), 1.0]))
    assert _sums(spark, [float("inf"), 1.0]) == math.inf


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bit_equal_in_any_order_and_partitioning(spark, seed):
    rnd = random.Random(seed)
    values = [rnd.choice([-1, 1]) * rnd.random() * 10.0 ** rnd.randrange(-8, 17) for _ in range(2000)]
    found = set()
    for parts in (1, 3, 8):
        rnd.shuffle(values)
        found.add(_sums(spark, values, parts))
    assert len(found) == 1
    exact = float(sum(map(Fraction, values)))
    assert abs(found.pop() - exact) <= math.ulp(exact)


def test_features_do_not_depend_on_how_rows_lie(spark):
    rnd = random.Random(4)
    rows = [("trade", "e", "q", "b", i, rnd.random() * 10.0 ** rnd.randrange(-3, 9), rnd.random(), rnd.choice(["buy", "sell"]), i)
            for i in range(3000)]
    schema = "event_type string, exchange string, quote_asset string, base_asset string, time bigint, quantity double, price double, side string, seq bigint"
    picked = [f"{label}_{m}" for label in ("all", "buy", "sell") for m in ("volume", "mean_price", "mean_quantity", "vwap")]
    found = set()
    for parts in (1, 5):
        rnd.shuffle(rows)
        features = trade_features(spark.createDataFrame(rows, schema).repartition(parts), "1m", exact=True)
        found.add(tuple(features.select(picked).first()))
        assert "HashAggregate" in features._jdf.queryExecution().executedPlan().toString()
    assert len(found) == 1
