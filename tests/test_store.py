"""The stream from messages to stored events: intake, late events, the end of a feed, named parts, compaction."""

import json
import os

import pytest
from market import SCHEMA, random_updates
from pyspark.sql import functions as F, types as T

from tickloom.operators.events import distinct_events
from tickloom.operators.features import window_features, window_snapshots
from tickloom.schemas import ENVELOPE
from tickloom.streaming import intake, jobs, store

ORDER = ["time", "seq"]
TRADE = {"exchange": "ex", "quote_asset": "USDT", "base_asset": "A0", "price": 2, "quantity": "3", "side": "buy"}
LONG = T.LongType()


def _messages(spark, path, topic, payloads):
    rows = [(bytearray(json.dumps(p).encode()), {"id": str(i)}, i) for i, p in enumerate(payloads)]
    spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.mode("append").parquet(f"{path}/in/{topic}")


def _intake(spark, path, lateness="1s"):
    query = intake.intake(spark, f"{path}/in", f"{path}/taken", f"{path}/c-intake", lateness)
    query.awaitTermination()
    return query


def _times(spark, path):
    records = spark.read.schema(intake.RECORDS).parquet(f"{path}/taken/records/*")
    return sorted(r.time for r in intake.events_of_records(records).collect())


def _compared(df):
    return sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())


def test_messages_to_records_dead_letters_and_late_events(spark, tmp_path):
    path = str(tmp_path)
    depth = {k: TRADE[k] for k in ("exchange", "quote_asset", "base_asset")} | {
        "event_time_ms": 9_000, "asks": [{"price": 2, "quantity": 1}], "bids": [{"price": 1, "quantity": 0}]}
    _messages(spark, path, "trades", [TRADE | {"event_time_ms": t} for t in (5_000, 10_000)] + [{"bad": 1}])
    _messages(spark, path, "depths", [depth])
    _intake(spark, path)
    assert _times(spark, path) == [5_000, 9_000, 9_000, 10_000]  # the first batch has no bound
    _messages(spark, path, "trades", [TRADE | {"event_time_ms": t} for t in (9_000, 9_001, 8_999)])
    _intake(spark, path)
    assert _times(spark, path) == [5_000, 9_000, 9_000, 9_001, 10_000]
    failures = intake.read_failures(spark, f"{path}/taken")
    assert sorted((r.error_class, r.source) for r in failures.collect()) == [
        ("late_event", "trades"), ("late_event", "trades"), ("missing_field", "trades")]
    late = [json.loads(r.payload)["time"] for r in failures.where("error_class = 'late_event'").collect()]
    assert sorted(late) == [8_999, 9_000]
    assert intake.clock(spark, f"{path}/taken", 2) == 10_000


def test_a_repeated_batch_gives_the_same(spark, tmp_path):
    """The last commit is lost, so the batch runs once more, although later messages are there."""
    path = str(tmp_path)
    for topic in ("trades", "depths"):
        _messages(spark, path, topic, [TRADE | {"event_time_ms": 5_000, "asks": [], "bids": []}])
    _intake(spark, path)
    _messages(spark, path, "trades", [TRADE | {"event_time_ms": 3_000}, TRADE | {"event_time_ms": 60_000}])
    _intake(spark, path)
    before = _times(spark, path), intake.read_failures(spark, f"{path}/taken").count()
    for name in ("1", ".1.crc"):
        os.remove(f"{path}/c-intake/commits/{name}")
    _intake(spark, path)
    assert (_times(spark, path), intake.read_failures(spark, f"{path}/taken").count()) == before == ([5_000, 60_000], 1)


def test_intake_parses_once(spark):
    messages = spark.createDataFrame([(bytearray(b"{}"), {}, 1, "depths")], T.StructType([*ENVELOPE.fields, T.StructField("topic", T.StringType())]))
    plan = intake.parsed(messages, F.lit(5))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 4  # for each topic the parse, and the map check of unreadable payloads


def test_the_end_of_a_feed_lets_the_last_events_go(spark, tmp_path):
    path = str(tmp_path)
    _messages(spark, path, "trades", [TRADE | {"event_time_ms": t} for t in (1_000, 2_000, 2_000, 400_000)])
    _messages(spark, path, "depths", [{"asks": [], "bids": []}])
    query = _intake(spark, path, "5m")

    def ingest():
        jobs.ingest(intake.record_stream(spark, f"{path}/taken"), f"{path}/events", f"{path}/c-ingest").awaitTermination()
        return sorted(r.time for r in store.read_store(spark, f"{path}/events").collect())

    assert ingest() == [1_000, 2_000]
    intake.end_feed(spark, f"{path}/taken", query.lastProgress["batchId"], 700_000)
    assert ingest() == [1_000, 2_000, 400_000]
    # The feed goes on: what the end has overtaken is late, and counted.
    _messages(spark, path, "trades", [TRADE | {"event_time_ms": t} for t in (399_000, 800_000)])
    _intake(spark, path, "5m")
    late = intake.read_failures(spark, f"{path}/taken").where("error_class = 'late_event'")
    assert [json.loads(r.payload)["time"] for r in late.collect()] == [399_000]


def _stored(spark, path, rows, schema=SCHEMA):
    """Ingest ``rows`` in the given groups, one run for each, then end the feed."""
    for group in rows:
        spark.createDataFrame(group, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{path}/in")
        jobs.ingest(stream, f"{path}/events", f"{path}/c-ingest").awaitTermination()
    last = max(r[4] for group in rows for r in group)
    store.heartbeat(spark, f"{path}/in", last + 300_000, spark.createDataFrame([], schema).schema)
    jobs.ingest(spark.readStream.schema(schema).parquet(f"{path}/in"), f"{path}/events", f"{path}/c-ingest").awaitTermination()
    return last


def _features(spark, path, **options):
    jobs.feature_job(spark, f"{path}/events", f"{path}/rows", f"{path}/c-features", "2m", order=ORDER, seq=LONG, **options).awaitTermination()


def test_features_open_named_parts_only(spark, tmp_path):
    """Parts that no closing names may be anything; announcements do not pile up; the end closes the last window."""
    path = str(tmp_path)
    rows = random_updates(400, 8, span=900_000)
    groups = [[r for r in rows if i * 300_000 <= r[4] < (i + 1) * 300_000] for i in range(3)]
    last = _stored(spark, path, groups)
    for other in ("ingest_batch=77/event_day=1970-01-01", "ingest_batch=78/event_day=1970-01-02"):
        os.makedirs(f"{path}/events/{other}")
        with open(f"{path}/events/{other}/part-0.parquet", "w") as file:
            file.write("not a parquet file")
    _features(spark, path)
    jobs.end_windows(spark, f"{path}/events", last + 120_000)
    _features(spark, path)
    batch = window_features(distinct_events(spark.createDataFrame(rows, SCHEMA)), "2m", order=ORDER)
    assert _compared(spark.read.parquet(f"{path}/rows").select(batch.columns)) == _compared(batch)
    for i in range(3):  # what is left in the folder is what came last, however often the job runs
        jobs.end_windows(spark, f"{path}/events", last + 10**6 * (i + 1))
        _features(spark, path)
    left = [f for f in os.listdir(f"{path}/events-announced") if f.endswith(".parquet")]
    assert len(left) <= 2


def test_parts_of_a_closing_bound_what_is_opened(spark, tmp_path):
    """The files that are opened are those of the window's batches, however many batches there are."""
    path, opened = str(tmp_path / "s"), {}
    closed = spark.createDataFrame(
        [("ex", "USDT", "A0", [(0, "1970-01-01")], 0, 0, 119_999)],
        "exchange string, quote_asset string, base_asset string, parts array<struct<ingest_batch: bigint, event_day: string>>, "
        "last_batch bigint, window_start bigint, window_end bigint")
    for n in (2, 30):
        rows = [("trade", "ex", "USDT", "A0", 10, 1.0, 1.0, "buy", i, i, "1970-01-01") for i in range(n)]
        spark.createDataFrame(rows, SCHEMA + ", ingest_batch bigint, event_day string").coalesce(1).write.mode(
            "overwrite").partitionBy("ingest_batch", "event_day").parquet(path)
        found = jobs.events_of(spark, path, closed, "2m", LONG)
        assert [r.seq for r in found.collect()] == [0]
        opened[n] = len(found.inputFiles())
    assert opened[2] == opened[30] == 1


def test_compaction_keeps_every_event_once(spark, tmp_path):
    path = str(tmp_path)
    day = 86_400_000
    rows = [("trade", "ex", "USDT", "A0", d * day + 1 + i * 60_000, 1.0, float(i), "buy", 100 * d + i) for d in range(3) for i in range(50)]
    _stored(spark, path, [rows[:30], rows[30:90], rows[90:]])
    events = f"{path}/events"

    def seqs():
        return sorted(r.seq for r in store.read_store(spark, events, LONG).collect())

    everything = sorted(r[8] for r in rows)
    assert seqs() == everything
    parts = [p for p in store.stored_parts(spark, events) if p[1] < "1970-01-02"]
    kept = store.read_parts(spark, events, parts, LONG).collect()
    assert len(parts) > 1 and store.compact(spark, events, "1970-01-02", LONG) == ["1970-01-01"]
    assert seqs() == everything and not [p for p in store.stored_parts(spark, events) if p[1] < "1970-01-02"]
    # A follower that still names the parts finds them in the compaction.
    assert sorted(store.read_parts(spark, events, parts, LONG).collect()) == sorted(kept)
    # A batch that is repeated after the compaction, and a job that stopped before it deleted, double nothing.
    again = spark.createDataFrame([r for r in rows[:10]], SCHEMA)
    again.write.parquet(f"{events}/ingest_batch={parts[0][0]}/event_day=1970-01-01")
    assert seqs() == everything
    assert store.compact(spark, events, "1970-01-04", LONG) == ["1970-01-02", "1970-01-03"]
    assert seqs() == everything and store.stored_parts(spark, events) == []
    # A late batch of a compacted day is added to it.
    spark.createDataFrame([rows[0][:8] + (999,)], SCHEMA).write.parquet(f"{events}/ingest_batch=50/event_day=1970-01-01")
    assert store.compact(spark, events, "1970-01-04", LONG) == ["1970-01-01"]
    assert seqs() == sorted([*everything, 999])


def test_empty_store(spark, tmp_path):
    assert store.read_store(spark, str(tmp_path / "none")).count() == 0
    assert store.compact(spark, str(tmp_path / "none"), "2030-01-01") == []


@pytest.mark.parametrize("field", ["event_type", "time"])
def test_heartbeat_row(spark, tmp_path, field):
    store.heartbeat(spark, str(tmp_path / "h"), 7, store.ANNOUNCED if field == "time" else store.stored_schema())
    row = spark.read.parquet(str(tmp_path / "h")).first().asDict()
    assert row["time"] == 7 and row.get("event_type", store.HEARTBEAT) == store.HEARTBEAT and row["ingest_batch"] is None


def test_books_carried_over_closings_equal_the_batch(spark, tmp_path):
    """Three closings; the last one runs twice, as after a crash before its commit."""
    path = str(tmp_path)
    rows = [r for r in random_updates(300, 9, span=900_000) if r[0] == "levelUpdate"]
    groups = [[r for r in rows if i * 450_000 <= r[4] < (i + 1) * 450_000] for i in range(2)]

    def books():
        jobs.carried_books(spark, f"{path}/events", f"{path}/books", f"{path}/c-books", "2m", 3, order=ORDER, seq=LONG).awaitTermination()

    for group in groups:
        last = _stored(spark, path, [group])
        books()
    jobs.end_windows(spark, f"{path}/events", last + 240_000)
    books()
    commits = sorted(int(f) for f in os.listdir(f"{path}/c-books/commits") if f.isdigit())
    assert len(commits) >= 3
    for name in (f"{commits[-1]}", f".{commits[-1]}.crc"):
        os.remove(f"{path}/c-books/commits/{name}")
    books()
    want = window_snapshots(distinct_events(spark.createDataFrame(rows, SCHEMA)), "2m", 3, order=ORDER, scope="instrument")
    assert _compared(spark.read.parquet(f"{path}/books/rows").select(want.columns)) == _compared(want)


def test_ingest_keeps_what_waits_beside_its_checkpoint(spark, tmp_path):
    """No keyed state: a batch stores what the watermark has passed, and writes the few events that wait, once each."""
    path, checkpoint = str(tmp_path), tmp_path / "c"
    minute = 60_000

    def event(time, seq, price=1.0):
        return ("trade", "ex", "USDT", "A0", time, 1.0, price, "buy", seq)

    def ingest(*rows):
        if rows:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in")
        jobs.ingest(spark.readStream.schema(SCHEMA).parquet(f"{path}/in"), f"{path}/events", str(checkpoint)).awaitTermination()
        stored = sorted((r.time, r.seq) for r in store.read_store(spark, f"{path}/events", LONG).collect())
        last = max(int(f.split("=")[1]) for f in os.listdir(checkpoint / "pending") if f.startswith("batch="))
        return stored, sorted((r.time or 0, r.seq) for r in spark.read.parquet(f"{checkpoint}/pending/batch={last}").collect())

    unknown = ("trade", "ex", "USDT", "A0", None, 1.0, 1.0, "buy", 8)
    stored, waiting = ingest(event(minute, 9), event(minute, 3), event(9 * minute, 5), event(10 * minute, 4), event(10 * minute, 6), unknown, unknown)
    assert stored == [(minute, 3)] and waiting == [(0, 8), (9 * minute, 5), (10 * minute, 4)]
    assert not (checkpoint / "state").exists()
    # An earlier copy of what waits, one of what was stored (late), and the watermark goes on.
    again = ingest(event(10 * minute, 2), event(minute, 1), event(4 * minute, 7), event(15 * minute, 11))
    assert again[0] == [(minute, 3), (9 * minute, 5), (10 * minute, 2)] and (15 * minute, 11) in again[1]
    for name in ("1", ".1.crc"):  # the last commit is lost: the batch runs once more
        os.remove(checkpoint / "commits" / name)
    assert ingest() == again
    for _ in range(3):
        ingest(event(15 * minute, 12))
    assert len([f for f in os.listdir(checkpoint / "pending") if f.startswith("batch=")]) == 2
