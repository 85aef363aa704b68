import pytest
from pyspark.sql import functions as F

from tickloom.functions.durations import parse_millis
from tickloom.functions.naming import feature_table_name
from tickloom.operators import windows as wn
from tickloom.schemas import PRESET_44, PRESET_60, extended_columns, feature_columns, feature_schema, older_names


def test_durations():
    assert [parse_millis(t) for t in ("1s", "5m", "24h")] == [1000, 300_000, 86_400_000]
    for bad in ("", "0s", "-1m", "5", "5d", "1.5h", None):
        with pytest.raises(ValueError):
            parse_millis(bad)


def test_tumbling_edges(spark):
    df = spark.createDataFrame([(0,), (299_999,), (300_000,), (-1,)], "time bigint")
    got = {r.time: (r.window_start, r.window_end) for r in wn.tumbling(df, "5m").collect()}
    assert got == {0: (0, 299_999), 299_999: (0, 299_999), 300_000: (300_000, 599_999), -1: (-300_000, -1)}


def test_time_grid_over_many_strides(spark):
    df = spark.createDataFrame([("k", 0, 25_000_000)], "k string, start bigint, end bigint")
    got = [r.time for r in wn.time_grid(df, "1s", ["k"]).collect()]
    assert sorted(got) == list(range(0, 25_000_001, 1000))


def test_column_contracts():
    assert len(feature_columns()) == len(feature_schema()) == 200
    assert (len(PRESET_44), len(PRESET_60), len(extended_columns())) == (44, 60, 442)
    assert set(PRESET_44) | set(PRESET_60) <= set(feature_columns())
    assert len(set(extended_columns())) == 442
    older = older_names()
    assert len(older) == 252
    assert (older["closePrice"], older["bid_9_stdQty"], older["ask_0_vwap"]) == ("all_close_price", "bid_9_std_quantity", "ask_0_vwap")


def test_table_name():
    assert feature_table_name("north", "QQ", "ZED", "5m") == "north_QQ_ZED_PT300S"


def test_markers_and_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 70_000)], "k string, time bigint")
    assert sorted(map(tuple, wn.window_markers(df, "1m", ["k"]).collect())) == [("a", 59_999, 0.0), ("a", 119_999, 0.0)]
    assert sorted(map(tuple, wn.window_counts(df, "1m", ["k"]).collect())) == [("a", 59_999, 2), ("a", 119_999, 1)]
    assert wn.assign_event_time(df).agg(F.max("event_time")).first()[0].timestamp() == 70
