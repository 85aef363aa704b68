import json
from pathlib import Path

import pytest
from market import SCHEMA
from pyspark.sql import functions as F, types as T

from tickloom.operators.events import distinct_events, flatten
from tickloom.operators.features import window_features
from tickloom.operators.parse import parse_depths, parse_trades
from tickloom.plans.batch import append_archive, feature_table, feature_tables, partition_archive
from tickloom.schemas import ARRIVAL, ENVELOPE, EVENT_COLUMNS, FAILURE
from tickloom.sources import writers
from tickloom.sources.readers import read_events

HEAD = {"exchange": "ex", "quote_asset": "USDT"}


def _archive(spark, path):
    trades = [HEAD | {"base_asset": f"A{i % 2}", "event_time_ms": i * 20_000, "price": 5 + i % 3, "quantity": 1 + i, "side": "buy" if i % 3 else "sell"}
              for i in range(60)]
    depths = [HEAD | {"base_asset": f"A{i % 2}", "event_time_ms": i * 20_000 + 7,
                      "asks": [{"price": 6 + i % 4, "quantity": i % 5}], "bids": [{"price": 5 - i % 4, "quantity": (i + 1) % 5}, {"price": 1, "quantity": 2}]}
              for i in range(60)]
    for topic, records in (("trades", trades + trades[:5] + [{"price": 1}]), ("depths", depths)):
        rows = [(bytearray(json.dumps(r).encode()), {}, i) for i, r in enumerate(records)]
        spark.createDataFrame(rows, ENVELOPE).write.parquet(f"{path}/{topic}")


def test_partition_then_features(spark, tmp_path):
    archive, events_dir, failures_dir = (str(tmp_path / d) for d in ("archive", "events", "failures"))
    _archive(spark, archive)
    assert partition_archive(spark, archive, events_dir, failures_dir) == {"depths": 0, "trades": 1}
    assert spark.read.schema(FAILURE).json(failures_dir).count() == 1
    assert spark.read.parquet(events_dir).count() == 60 + 60 * 3

    table = feature_table(spark, events_dir, "ex", "USDT", "A1", "2m", location=str(tmp_path / "tables"))
    read = [p(spark.read.schema(ENVELOPE).parquet(f"{archive}/{t}"))[0] for t, p in (("trades", parse_trades), ("depths", parse_depths))]
    want = window_features(distinct_events(flatten(*read)), "2m").where("base_asset = 'A1'")

    def comparable(df):
        return sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.select(want.columns).collect())

    assert comparable(table) == comparable(want)
    ends = [r.window_end for r in table.select("window_end").collect()]
    assert ends == sorted(ends) and len(ends) == 10
    assert table.agg(F.sum("all_count")).first()[0] == 30


def _rows(df):
    return sorted(map(repr, df.collect()))


def _stored(spark, path):
    return read_events(spark, path, extra=[T.StructField("seq", ARRIVAL)]).select(*EVENT_COLUMNS, "seq")


def test_a_repeated_archive_job_replaces_its_output(spark, tmp_path):
    archive, events_dir, failures_dir = (str(tmp_path / d) for d in ("archive", "events", "failures"))
    _archive(spark, archive)
    partition_archive(spark, archive, events_dir, failures_dir)
    first = _rows(_stored(spark, events_dir))
    partition_archive(spark, archive, events_dir, failures_dir)
    assert _rows(_stored(spark, events_dir)) == first
    assert spark.read.schema(FAILURE).json(failures_dir).count() == 1


@pytest.mark.parametrize("order", [("a", "b", "a"), ("b", "a", "b")])
def test_slices_equal_one_run(spark, tmp_path, order):
    """Two overlapping slices, in either order, one of them twice."""
    whole = str(tmp_path / "whole")
    _archive(spark, whole)
    partition_archive(spark, whole, f"{whole}/events", f"{whole}/failures")
    for topic in ("trades", "depths"):
        messages = spark.read.schema(ENVELOPE).parquet(f"{whole}/{topic}")
        for name, part in (("a", "timestamp < 40"), ("b", "timestamp >= 25")):
            messages.where(part).write.parquet(str(tmp_path / name / topic))
    events_dir, failures_dir = str(tmp_path / "events"), str(tmp_path / "failures")
    for name in order:
        append_archive(spark, str(tmp_path / name), name, events_dir, failures_dir)
    assert _rows(_stored(spark, events_dir)) == _rows(_stored(spark, f"{whole}/events"))
    assert spark.read.schema(FAILURE).json(failures_dir).select("error_class").count() == 1


def test_only_partitions_of_earlier_arrivals_are_rewritten(spark, tmp_path):
    def event(asset, price, seq):
        return ("trade", "ex", "USDT", asset, 5, 1.0, price, "buy", seq)

    path = str(tmp_path / "e")
    seq = [T.StructField("seq", T.LongType())]

    def merge(*rows):
        new = spark.createDataFrame(list(rows), SCHEMA)
        writers.merge_events(distinct_events(new), read_events(spark, path, extra=seq, missing_ok=True), path)
        return {str(f): f.stat().st_mtime_ns for f in (tmp_path / "e").rglob("*.parquet")}

    first = merge(event("A", 1.0, 10), event("B", 1.0, 10), event("C", 1.0, 10))
    second = merge(event("A", 1.0, 12), event("A", 2.0, 11), event("B", 1.0, 3), event("B", 4.0, 5))
    for file, written in first.items():
        assert (second.get(file) == written) == ("base_asset=B" not in file)
    got = sorted((r.base_asset, r.price, r.seq) for r in read_events(spark, path, extra=seq).collect())
    assert got == [("A", 1.0, 10), ("A", 2.0, 11), ("B", 1.0, 3), ("B", 4.0, 5), ("C", 1.0, 10)]
    assert merge(event("A", 1.0, 99)).keys() == second.keys()


def test_feature_tables_of_all_instruments(spark, tmp_path):
    archive, events_dir = str(tmp_path / "archive"), str(tmp_path / "events")
    _archive(spark, archive)
    partition_archive(spark, archive, events_dir, str(tmp_path / "failures"))
    for _ in range(2):  # a repeated job replaces the tables
        names = feature_tables(spark, events_dir, str(tmp_path / "all"), "2m")
    assert names == ["ex_USDT_A0_PT120S", "ex_USDT_A1_PT120S"]
    together = {n: spark.table(f"`{n}`").collect() for n in names}
    for asset in ("A0", "A1"):
        alone = feature_table(spark, events_dir, "ex", "USDT", asset, "2m", location=str(tmp_path / "one"))
        assert sorted(map(repr, together[f"ex_USDT_{asset}_PT120S"])) == sorted(map(repr, alone.collect()))


def _operators(spark, df, name):
    return str(df._jdf.queryExecution().executedPlan()).count(name)


def test_distinct_events_are_shuffled_once_before_any_sort(spark, tmp_path):
    """One shuffle, by ranges: copies are not combined before it by a sort of all that a task reads."""
    _archive(spark, str(tmp_path))
    events = parse_depths(spark.read.schema(ENVELOPE).parquet(f"{tmp_path}/depths"))[0]
    once = writers.earliest(flatten(events, events), 360, 3, F.min("seq").alias("seq"))
    assert _operators(spark, once, "Exchange") == 1 == _operators(spark, once, "Exchange rangepartitioning")
    assert _rows(once.select(*EVENT_COLUMNS, "seq")) == _rows(distinct_events(events).select(*EVENT_COLUMNS, "seq"))


def test_a_hot_destination_is_cut_into_pieces(spark, tmp_path):
    """One instrument, all of it at one time: many files, and every event once."""
    rows = spark.range(40_000).selectExpr(
        "'trade' AS event_type", "'ex' AS exchange", "'USDT' AS quote_asset", "CAST(NULL AS STRING) AS base_asset", "5L AS time",
        "CAST(id % 20000 AS DOUBLE) AS quantity", "1D AS price", "'buy' AS side", "id AS seq")
    rows.write.parquet(str(tmp_path / "in"))
    rows = spark.read.parquet(str(tmp_path / "in"))
    writers.write_distinct_events(rows, 40_000, str(tmp_path / "e"), shards=6)
    assert len(list((tmp_path / "e").rglob("*.parquet"))) > 3
    stored = read_events(spark, str(tmp_path / "e"), extra=[T.StructField("seq", T.LongType())])
    assert stored.agg(F.count("*"), F.max("seq"), F.min("base_asset")).first() == (20_000, 19_999, "None")


def test_archive_topics_are_spread_without_a_sort_and_written_when_asked_for(spark, tmp_path):
    from tickloom.plans import adapters, datasets

    for name, columns in {
        "events": "id AS event_id, timestamp_ntz'2024-01-01 00:00:00' AS ts, id AS user_id, 'click' AS event_type, 1D AS value, '{\"k\": 3}' AS props",
        "lineitem": "id AS l_orderkey, id AS l_partkey, id AS l_suppkey, 1 AS l_linenumber, 3D AS l_quantity, 'F' AS l_linestatus, "
                    "date'1995-01-01' AS l_shipdate",
    }.items():
        spark.range(50).selectExpr(*columns.split(", ")).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    for made in (adapters.trade_messages, adapters.depth_messages):
        rows = made(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
        assert "hashpartitioning" in str(rows._jdf.queryExecution().executedPlan()).lower()
    assert datasets.messages(spark, str(tmp_path), "trades").count() == 50
    assert not [k for k in datasets._WRITTEN if k[2:] == (str(tmp_path), "archive/depths")]
    root = datasets.archive(spark, str(tmp_path))
    assert spark.read.parquet(f"{root}/depths").count() == 50


def test_dead_letters_are_compressed(spark, tmp_path):
    archive, failures_dir = str(tmp_path / "archive"), tmp_path / "failures"
    _archive(spark, archive)
    partition_archive(spark, archive, str(tmp_path / "events"), str(failures_dir))
    assert [f.name for f in failures_dir.rglob("part-*")] and all(f.name.endswith(".json.gz") for f in failures_dir.rglob("part-*"))


def test_records_are_not_combined_before_the_shuffle(spark, tmp_path):
    _archive(spark, str(tmp_path))
    events = parse_depths(spark.read.schema(ENVELOPE).parquet(f"{tmp_path}/depths"))[0]
    once = distinct_events(flatten(events, events))
    assert "SortAggregate" not in str(once._jdf.queryExecution().executedPlan()).split("Exchange", 1)[1]
    assert once.count() == 180


def test_a_slice_leaves_no_staged_copies_and_shuffles_its_events_once(spark, tmp_path):
    """What a job staged is deleted, its shuffle files go, and merged events are written as they lie: one piece, one file."""
    from tickloom.session import shared_dir

    def staged():
        return {str(p) for p in Path(shared_dir(spark)).glob("stage-*")}

    def shuffles():
        tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
        return tracker.shuffleStatuses().size()

    archive, events_dir, failures_dir = (str(tmp_path / d) for d in ("archive", "events", "failures"))
    _archive(spark, archive)
    before = staged(), shuffles()
    append_archive(spark, archive, "all", events_dir, failures_dir, shards=1)
    assert staged() == before[0] and shuffles() <= before[1]
    folders = [[f.name for f in d.glob("*.parquet")] for d in Path(events_dir).rglob("event_type=*")]
    assert len(folders) == 4 and all(len(files) == 1 for files in folders)
    partition_archive(spark, archive, str(tmp_path / "whole"), failures_dir)
    assert staged() == before[0] and shuffles() <= before[1]
    assert _rows(_stored(spark, events_dir)) == _rows(_stored(spark, str(tmp_path / "whole")))
