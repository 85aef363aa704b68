import pytest
from market import SCHEMA, random_updates
from pyspark.sql import functions as F

from tickloom.operators.features import trade_features, trade_block_alternative
from tickloom.operators.order_key import single_order
from tickloom.operators.windows import tumbling


def _trades(spark, n=400):
    rows = [("trade",) + r[1:7] + ("buy" if r[8] % 2 else "sell", (r[8] * 7919) % n) for r in random_updates(n, 3, span=300)]
    return spark.createDataFrame(rows, SCHEMA)  # many ties in time


def _rows(df):
    return sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())


def test_packed_equals_struct_order(spark):
    trades = _trades(spark)
    wide = trades.withColumn("seq", F.col("seq") * F.lit(2**40))
    nested = trades.withColumn("seq", F.struct((F.col("seq") / 10).cast("bigint").alias("a"), (F.col("seq") % 10).cast("int").alias("b")))
    text = trades.withColumn("seq", F.format_string("%06d", "seq"))
    for build in (trade_features, trade_block_alternative):
        want = _rows(build(wide, "1s"))
        for frame in (trades, nested, text):
            assert _rows(build(frame, "1s")) == want


@pytest.mark.parametrize("seq, packed", [("seq", True), ("seq * (1L << 40)", True), ("CAST(seq AS STRING)", False),
                                         ("nullif(seq, 5)", True), ("struct(seq)", False)])
def test_when_it_packs(spark, seq, packed):
    rows = tumbling(_trades(spark).withColumn("seq", F.expr(seq)), "1h")
    _, order = single_order(rows, ("time", "seq"))
    assert (order == ("_order",)) == packed


def test_packed_equals_struct_on_nulls_and_extremes(spark):
    rows = [("trade", "ex", "QQ", "A", t, 1.0 + i, 2.0 + i, "buy", s) for i, (t, s) in enumerate(
        [(None, 5), (None, 2), (7, None), (7, -2**63), (9, 2**63 - 1), (9, 0), (3_600_001, 4), (3_600_001, None)])]
    trades = spark.createDataFrame(rows, SCHEMA)
    want = _rows(trade_features(trades.withColumn("seq", F.struct("seq")), "1h"))
    assert _rows(trade_features(trades, "1h")) == want
    assert _rows(trade_features(trades.where("time IS NULL"), "1h")) == [r for r in want if ", None, 2," in r]


def test_equal_places_give_one_result(spark):
    """Trades of one instant and one arrival: whatever order they lie in, open and close are the same."""
    rows = [("trade", "ex", "QQ", "A", 7, float(q), float(p), "buy", "x") for q, p in ((1, 3), (2, 1), (3, 2), (3, 1))]
    for seed in range(3):
        frame = spark.createDataFrame(rows[seed:] + rows[:seed], SCHEMA.replace("seq bigint", "seq string")).repartition(2)
        [row] = trade_features(frame, "1h").collect()
        assert (row.all_open_price, row.all_open_quantity, row.all_close_price) == (1.0, 2.0, 3.0)


def test_packed_is_a_hash_aggregate(spark):
    plan = trade_features(_trades(spark), "1s")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
