import json
import time

import pytest
from market import SCHEMA, random_updates, stream_rows
from pyspark.sql import functions as F, types as T

from tickloom.operators.events import distinct_events
from tickloom.operators.features import trade_features, window_features
from tickloom.schemas import ENVELOPE, FAILURE
from tickloom.streaming import jobs

FAR = 10**12  # a far-future event: the watermark passes every window before it
ORDER = ["time", "seq"]


def _sentinel(kind="trade", side="buy", seq=10**6):
    return (kind, "ex", "USDT", "A0", FAR, 1.0, 1.0, side, seq)


def _write(spark, rows, path, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/{name}")


def _stream(spark, path):
    # One file per micro-batch, in the order of writing.
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def _same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_trade_stream_equals_batch(spark, tmp_path):
    rows = [r for r in stream_rows() if r[0] == "trade"]
    _write(spark, rows, tmp_path, "a")
    _write(spark, [_sentinel()], tmp_path, "b")
    out = jobs.trade_feature_stream(_stream(spark, tmp_path), "2m", order=ORDER)
    query = out.writeStream.outputMode("append").format("memory").queryName("trades_out").trigger(availableNow=True).start()
    query.awaitTermination()
    batch = trade_features(spark.createDataFrame(rows, SCHEMA), "2m", order=ORDER)
    _same(spark.table("trades_out").select(batch.columns), batch)


def test_late_rows_are_dropped(spark, tmp_path):
    early, late = ("trade", "ex", "USDT", "A0", 1_000, 1.0, 1.0, "buy", 0), ("trade", "ex", "USDT", "A0", 2_000, 9.0, 9.0, "buy", 2)
    ahead = ("trade", "ex", "USDT", "A0", 500_000, 1.0, 1.0, "buy", 1)
    # Spark judges lateness by the watermark of the batch before, hence a filler in between.
    filler = ("trade", "ex", "USDT", "A0", 500_001, 1.0, 1.0, "buy", 3)
    for i, row in enumerate((early, ahead, filler, late, _sentinel())):
        _write(spark, [row], tmp_path, f"f{i}")
    counts = {}
    for lateness in ("0s", "1h"):
        out = jobs.trade_feature_stream(_stream(spark, tmp_path), "2m", lateness, order=ORDER)
        name = f"late_{lateness}"
        out.writeStream.outputMode("append").format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
        counts[lateness] = {r.window_end: r.all_count for r in spark.table(name).collect()}
    assert counts["0s"][119_999] == 1
    assert counts["1h"][119_999] == 2


def test_ingest_and_feature_job_equal_batch(spark, tmp_path):
    rows = random_updates(300, 8, span=400_000) + [r[:8] + (r[8] + 1000,) for r in stream_rows()]
    first, second = [r for r in rows if r[4] < 200_000], [r for r in rows if r[4] >= 200_000]
    source = tmp_path / "in"
    # Some events twice, the later copy first, within and across micro-batches.
    _write(spark, [r[:8] + (r[8] + 5000,) for r in first[:20]] + first + [r[:8] + (r[8] + 7000,) for r in first[20:40]], source, "a")
    _write(spark, second + [_sentinel("levelUpdate", "ask")], source, "b")
    stored, out = str(tmp_path / "stored"), str(tmp_path / "out")
    jobs.ingest(_stream(spark, source), stored, str(tmp_path / "c1")).awaitTermination()
    # The far-future event itself waits for the watermark to pass it.
    assert spark.read.parquet(stored).count() == len(set(r[:8] for r in rows))
    _write(spark, [_sentinel("levelUpdate", "bid")[:4] + (2 * FAR,) + _sentinel()[5:]], source, "c")
    jobs.ingest(_stream(spark, source), stored, str(tmp_path / "c1")).awaitTermination()
    jobs.feature_job(
        spark, stored, out, str(tmp_path / "c2"), "2m", order=ORDER, seq=T.LongType(), maxFilesPerTrigger="1"
    ).awaitTermination()
    batch = window_features(distinct_events(spark.createDataFrame(rows, SCHEMA)), "2m", order=ORDER)
    got = spark.read.parquet(out).select(batch.columns).where(F.col("window_end") < FAR)

    def comparable(df):
        return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])

    _same(comparable(got), comparable(batch))


def test_events_after_closing_stay_out(spark, tmp_path):
    stored = spark.createDataFrame(
        [("trade", "ex", "USDT", "A0", 10, 1.0, 1.0, "buy", 0, 0, "1970-01-01"),
         ("trade", "ex", "USDT", "A0", 20, 1.0, 1.0, "buy", 1, 5, "1970-01-01")],
        SCHEMA + ", ingest_batch bigint, event_day string",
    )
    stored.write.partitionBy("ingest_batch", "event_day").parquet(str(tmp_path / "s"))
    closed = spark.createDataFrame(
        [("ex", "USDT", "A0", [(0, "1970-01-01"), (5, "1970-01-01")], 3, 0, 119_999)],
        "exchange string, quote_asset string, base_asset string, parts array<struct<ingest_batch: bigint, event_day: string>>, "
        "last_batch bigint, window_start bigint, window_end bigint",
    )
    rows = jobs.events_of(spark, str(tmp_path / "s"), closed, "2m", T.LongType())
    assert [r.seq for r in rows.collect()] == [0]


def test_raw_messages_to_events(spark, tmp_path):
    trade = {"exchange": "ex", "quote_asset": "USDT", "base_asset": "A0", "event_time_ms": 5, "price": 2, "quantity": "3", "side": "buy"}
    depth = {k: trade[k] for k in ("exchange", "quote_asset", "base_asset", "event_time_ms")} | {
        "asks": [{"price": 2, "quantity": 1}], "bids": [{"price": 1, "quantity": 0}]}
    late = {"event_time_ms": 10**9}  # moves the watermark past the others
    for topic, payloads in (("trades", [trade, trade, {"bad": 1}, trade | late]), ("depths", [depth])):
        rows = [(bytearray(json.dumps(p).encode()), {}, i) for i, p in enumerate(payloads)]
        spark.createDataFrame(rows, ENVELOPE).write.parquet(str(tmp_path / "in" / topic))
    source = str(tmp_path / "in")
    jobs.ingest(jobs.event_stream(spark, source), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.event_type, r.side, r.quantity) for r in rows.collect()) == [
        ("levelUpdate", "ask", 2.0), ("levelUpdate", "bid", 0.0), ("trade", "buy", 6.0)]
    assert min(r.seq.timestamp for r in rows.where("event_type = 'trade'").collect()) == 0
    failed = jobs.failure_stream(spark, source)
    for _ in range(2):  # a repeated run adds nothing
        jobs.ingest_failures(failed, str(tmp_path / "bad"), str(tmp_path / "c3")).awaitTermination()
    assert [r.error_class for r in spark.read.schema(FAILURE).json(str(tmp_path / "bad")).collect()] == ["missing_field"]
    with pytest.raises(Exception):
        jobs.event_stream(spark, source, fmt="no-such-format")


def test_earliest_copy_stays_whatever_the_batches(spark, tmp_path):
    copies = [("trade", "ex", "QQ", "A", 5, 1.0, 1.0, "buy", s) for s in (9, 3, 6)]
    other = ("trade", "ex", "QQ", "A", 5, 1.0, 2.0, "buy", 4)
    for i, row in enumerate([*copies, other, _sentinel()]):
        _write(spark, [row], tmp_path / "in", f"f{i}")
    jobs.ingest(_stream(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = sorted((r.price, r.seq) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = sorted((r.price, r.seq) for r in distinct_events(spark.createDataFrame([*copies, other], SCHEMA)).collect())
    assert got == want == [(1.0, 3), (2.0, 4)]


def test_processing_time_trigger(spark, tmp_path):
    """A continuous job goes on when new files come."""
    _write(spark, [("trade", "ex", "QQ", "A", 5, 1.0, 1.0, "buy", 0), _sentinel()], tmp_path / "in", "a")
    query = jobs.ingest(_stream(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c"),
                        trigger={"processingTime": "200 milliseconds"})
    try:
        query.processAllAvailable()
        _write(spark, [_sentinel(seq=7)[:4] + (2 * FAR,) + _sentinel()[5:]], tmp_path / "in", "b")
        query.processAllAvailable()
        deadline = time.time() + 60
        while time.time() < deadline and spark.read.parquet(str(tmp_path / "out")).count() < 2:
            time.sleep(0.3)
        assert query.isActive and sorted(r.time for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [5, FAR]
    finally:
        query.stop()


def test_a_day_is_stored_in_few_files_whatever_the_tasks(spark, tmp_path):
    rows = spark.range(3000).selectExpr(
        "'trade' AS event_type", "'ex' AS exchange", "'USDT' AS quote_asset", "'A' AS base_asset", "id + 1 AS time",
        "1D AS quantity", "CAST(id AS DOUBLE) AS price", "'buy' AS side", "id AS seq")
    rows.union(rows.limit(1).selectExpr("event_type", "exchange", "quote_asset", "base_asset", "9000000L", "quantity", "price", "side", "seq")
               ).coalesce(1).write.parquet(str(tmp_path / "in"))
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        events = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        jobs.ingest(events, str(tmp_path / "e"), str(tmp_path / "check")).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
    files = list((tmp_path / "e").rglob("event_day=*/*.parquet"))
    assert 0 < len(files) <= jobs.DAY_PIECES
    assert spark.read.parquet(*{str(f.parent) for f in files}).count() == 3000
