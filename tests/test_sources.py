import json

import pytest
from market import SCHEMA, random_updates, stream_rows
from pyspark.sql import functions as F, types as T

from tickloom.operators.features import window_features
from tickloom.schemas import ENVELOPE, EVENT_COLUMNS, FAILURE, feature_schema
from tickloom.session import shared_dir, stage
from tickloom.sources import readers, writers

SEQ = [T.StructField("seq", T.LongType())]


@pytest.fixture
def events(spark):
    return spark.createDataFrame(stream_rows() + random_updates(300, 5), SCHEMA)


def _same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_event_round_trip(spark, events, tmp_path):
    path = str(tmp_path / "events")
    writers.write_events(events, path)
    _same(readers.read_events(spark, path, extra=SEQ).select(events.columns), events)
    one = readers.read_events(spark, path, "north", "QQ", "ZED", extra=SEQ)
    _same(one.select(events.columns), events.where("exchange = 'north'"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(exchange" in plan
    assert (tmp_path / "events/exchange=north/quote_asset=QQ/base_asset=ZED/event_type=trade").is_dir()


def test_hot_destination_is_split(spark, tmp_path):
    """More rows than one task should write: adaptive execution adds files beyond the shards."""
    rows = spark.range(200_000).selectExpr(
        "'trade' AS event_type", "IF(id % 100 = 0, 'cold', 'hot') AS exchange", "'USDT' AS quote_asset", "'A' AS base_asset",
        "id AS time", "rand(1) AS quantity", "rand(2) AS price", "'buy' AS side", "id AS seq",
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "262144")
    try:
        writers.write_events(rows, str(tmp_path / "e"), shards=2)
    finally:
        spark.conf.unset(size)
    files = {x: len(list((tmp_path / f"e/exchange={x}").rglob("*.parquet"))) for x in ("hot", "cold")}
    assert files["hot"] > 4 and files["cold"] <= files["hot"]
    assert spark.read.parquet(str(tmp_path / "e")).count() == 200_000


def test_null_keys_go_to_the_default_partition(spark, tmp_path):
    df = spark.createDataFrame([(None, None, None, None, 1, 1.0, 1.0, "buy", 0)], SCHEMA)
    writers.write_events(df, str(tmp_path / "e"))
    assert (tmp_path / "e/exchange=None/quote_asset=None/base_asset=None/event_type=None").is_dir()


def test_windowed_output(spark, tmp_path):
    rows = spark.createDataFrame([("a", 3_599_999), ("b", 7_199_999)], "k string, window_end bigint")
    writers.write_windowed(rows, str(tmp_path / "w"))
    assert (tmp_path / "w/year=1970/month=01/day=01/hour=01").is_dir()
    assert spark.read.parquet(str(tmp_path / "w")).count() == 2
    paths = {r[0] for r in writers.window_directories(rows).select(writers.window_path("x/YYYY-MM-DD/HH")).collect()}
    assert paths == {"x/1970-01-01/01", "x/1970-01-01/02"}
    with pytest.raises(ValueError):
        writers.write_windowed(rows.drop("window_end"), str(tmp_path / "v"))


def test_feature_table_is_replaced(spark, events):
    features = window_features(events, "2m")
    for _ in range(2):
        name = writers.write_features(features, "north", "QQ", "ZED", "2m")
    assert name == "north_QQ_ZED_PT120S"
    assert spark.table(name).count() == 2


def test_feature_formats(spark, events, tmp_path):
    features = window_features(events, "2m")
    for fmt in ("parquet", "json"):
        path = str(tmp_path / fmt)
        features.write.format(fmt).save(path)
        _same(readers.read_features(spark, path, feature_schema(), fmt).select(features.columns), features)
    text = [json.loads(r.value) for r in writers.as_text(features).collect()]
    assert {t["window_end"] for t in text} >= {119_999, 239_999}


def test_level_csv_and_trade_extract(spark, tmp_path):
    (tmp_path / "d.csv").write_text("1,2.5,3.0,ask\n2,2.4,0.5,bid\n")
    assert [tuple(r) for r in readers.read_level_csv(spark, str(tmp_path / "d.csv")).collect()] == [
        (1, 2.5, 3.0, "ask"), (2, 2.4, 0.5, "bid")]
    (tmp_path / "t.json").write_text(json.dumps([{"time": 1, "side": "buy", "quantity": 2.0, "price": 3.0}] * 2))
    assert readers.read_trade_extract(spark, str(tmp_path / "t.json")).count() == 2


def test_instrument_extract(spark, events, tmp_path):
    writers.extract_instrument(events, "north", "ZEDQQ", str(tmp_path / "x"))
    rows = spark.read.json(str(tmp_path / "x"))
    assert rows.count() == 5 and set(rows.columns) == {"time", "side", "quantity", "price"}


def test_failures_by_arrival(spark, tmp_path):
    rows = [("bad_number", "m", "p", "trades", 10), ("bad_number", "m", "p", "trades", None)]
    writers.write_failures(spark.createDataFrame(rows, FAILURE), str(tmp_path / "f"))
    stored = spark.read.schema(FAILURE).json(str(tmp_path / "f"))
    assert stored.where("hour IS NOT NULL" if "hour" in stored.columns else "true").count() == 2
    assert (tmp_path / "f/year=1970/month=01/day=01/hour=01").is_dir()


def test_messages(spark, tmp_path):
    df = spark.createDataFrame([(bytearray(b"{}"), {"id": "m1"}, 7)], ENVELOPE)
    df.write.parquet(str(tmp_path / "m/trades"))
    assert readers.read_messages(spark, str(tmp_path / "m"), "trades").first().attributes == {"id": "m1"}
    bus = spark.createDataFrame([("x", {"a": "b"}, 1.5)], "payload string, attributes map<string,string>, t double")
    envelope = readers.to_envelope(bus.withColumn("t", F.timestamp_seconds("t")), "payload", "attributes", "t")
    assert envelope.schema == ENVELOPE or [f.dataType for f in envelope.schema] == [f.dataType for f in ENVELOPE]
    assert envelope.first().timestamp == 1500


def test_stage_uses_the_shared_folder(spark, events):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(events)
    assert all(shared_dir(spark) in f for f in staged.inputFiles())
    _same(staged.select(*EVENT_COLUMNS), events.select(*EVENT_COLUMNS))
