"""From the messages of the bus to parsed records, dead letters and late events: one parse, one stream.

Each micro-batch writes ``records/batch=N`` (what each message gave, and the batch's time bound), and from
there its dead letters. Both replace what an earlier try of the batch left. The bound of a batch is the
latest event time of the batches before it, less the lateness; it is kept in ``clock``, so a repeated
batch finds the same bound. Events at or behind it are late: they go to the dead letters and are counted, and no
later stream drops anything silently, as its own watermark is never ahead of this one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.durations import parse_millis
from tickloom.operators import parse
from tickloom.operators.events import flatten
from tickloom.schemas import ARRIVAL, EVENT, FAILURE
from tickloom.session import exists
from tickloom.sources.readers import TOPICS, stream_messages
from tickloom.sources.writers import write_failures
from tickloom.streaming.store import HEARTBEAT

LATE = "late_event"
_READERS = {"depths": parse.read_depths, "trades": parse.read_trades}
_EVENTS = T.ArrayType(T.StructType([*EVENT.fields, T.StructField("seq", ARRIVAL)]))
RECORDS = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("events", _EVENTS),
    T.StructField("failure", T.ArrayType(FAILURE)), T.StructField("bound", T.LongType()),
])
CLOCK = T.StructType([T.StructField(c, T.LongType()) for c in ("latest", "messages", "parse_errors")])


def message_stream(spark: SparkSession, source: str, topics: Sequence[str] = TOPICS, fmt: str = "parquet", **options: str) -> DataFrame:
    """Envelopes of several topics as one stream, with their ``topic``."""
    return flatten(*[
        stream_messages(spark, source, topic, fmt, **options).withColumn("topic", F.lit(topic)) for topic in topics
    ])


def parsed(messages: DataFrame, bound: Column) -> DataFrame:
    """`RECORDS` of messages with a ``topic``: every message is parsed once, by its topic's parser."""
    parts = []
    for topic, read in _READERS.items():
        rows = parse.records(read(messages.where(F.col("topic") == topic)), topic)
        parts.append(rows.select(
            F.lit(topic).alias("topic"), F.col("events").cast(_EVENTS), F.col("failure").cast(T.ArrayType(FAILURE)),
            bound.cast("bigint").alias("bound")))
    return flatten(*parts)


def events_of_records(records: DataFrame) -> DataFrame:
    """Events that were in time, and heartbeats."""
    return records.select("bound", F.inline("events")).where("bound IS NULL OR time > bound").drop("bound")


def late_events(records: DataFrame) -> DataFrame:
    """Events at or behind the bound of their batch, as dead letters."""
    late = records.select("topic", "bound", F.inline("events")).where("time <= bound")
    message = F.format_string("%s: time %d is not after %d", "topic", "time", "bound")
    return late.select(
        F.lit(LATE).alias("error_class"), message.alias("error_message"),
        F.to_json(F.struct(*EVENT.names)).alias("payload"), F.col("topic").alias("source"),
        F.col("seq.timestamp").alias("timestamp"))


def clock(spark: SparkSession, directory: str, batch_id: int) -> int | None:
    """Latest event time before a batch, heartbeats included."""
    times = []
    for name in (f"batch={batch_id - 1}", f"after={batch_id - 1}"):
        path = f"{directory}/clock/{name}"
        if exists(spark, path):
            times.append(spark.read.schema(CLOCK).json(path).first().latest)
    return max((t for t in times if t is not None), default=None)


def _write_clock(spark: SparkSession, path: str, *values: int | None) -> None:
    spark.createDataFrame([values], CLOCK).coalesce(1).write.mode("overwrite").json(path)


def intake(
    spark: SparkSession, source: str, directory: str, checkpoint: str, lateness: str = "5m", topics: Sequence[str] = TOPICS,
    fmt: str = "parquet", trigger: dict | None = None, **options: str
) -> StreamingQuery:
    """Parse the messages under ``source`` into ``directory``: ``records``, ``failures`` and ``clock``."""

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = clock(spark, directory, batch_id)
        bound = None if before is None else before - parse_millis(lateness)
        seen = Observation(f"intake-{batch_id}")
        rows = parsed(batch, F.lit(bound)).observe(
            seen, F.max(F.array_max(F.transform("events", lambda e: e["time"]))).alias("latest"),
            F.count(F.lit(1)).alias("messages"), F.count("failure").alias("parse_errors"))
        path = f"{directory}/records/batch={batch_id}"
        rows.write.mode("overwrite").parquet(path)
        stored = spark.read.schema(RECORDS).parquet(path)
        failures = flatten(stored.select(F.inline("failure")), late_events(stored))
        write_failures(failures, f"{directory}/failures/batch={batch_id}", mode="overwrite")
        counts = seen.get
        latest = max((t for t in (before, counts["latest"]) if t is not None), default=None)
        _write_clock(spark, f"{directory}/clock/batch={batch_id}", latest, counts["messages"], counts["parse_errors"])

    return (
        message_stream(spark, source, topics, fmt, **options).writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(**trigger or {"availableNow": True}).start()
    )


def record_stream(spark: SparkSession, directory: str, **options: str) -> DataFrame:
    """The events that an intake has taken in, as a stream: what `ingest` deduplicates and stores.

    ``cleanSource="delete"`` (or "archive") among the options keeps the folder, and so its listing, small.
    """
    return events_of_records(spark.readStream.schema(RECORDS).options(**options).parquet(f"{directory}/records/*"))


def read_failures(spark: SparkSession, directory: str) -> DataFrame:
    """Dead letters of all batches: failed messages and late events."""
    return spark.read.schema(FAILURE).json(f"{directory}/failures").select(*FAILURE.names)


def end_feed(spark: SparkSession, directory: str, batch_id: int, at: int) -> None:
    """Say that the feed has come to ``at`` (milliseconds) with the batch ``batch_id``, its last one so far.

    Later streams give out what waits for the watermark. Should the feed go on, events at or before ``at`` less the
    lateness are late. ``StreamingQuery.lastProgress["batchId"]`` has the number.
    """
    _write_clock(spark, f"{directory}/clock/after={batch_id}", at, 0, 0)
    event = F.struct(*[
        F.lit({"time": at, "event_type": HEARTBEAT}.get(f.name)).cast(f.dataType).alias(f.name) for f in _EVENTS.elementType
    ])
    row = spark.range(1).select(
        F.lit(None).cast("string").alias("topic"), F.array(event).cast(_EVENTS).alias("events"),
        F.lit(None).cast(T.ArrayType(FAILURE)).alias("failure"), F.lit(None).cast("bigint").alias("bound"))
    # Beside the batch's own records, under its number: a second call replaces the first.
    row.write.mode("overwrite").parquet(f"{directory}/records/after={batch_id}")
