"""Streaming ingest and streaming features.

Ingest deduplicates and stores events, each micro-batch in its own ``ingest_batch`` directory, so a
repeated batch replaces itself (`store`; messages are parsed by `intake` before); what waits for the watermark lies beside its
checkpoint. Trade features are an
ordinary windowed stream aggregation. Features that need the order of a whole window (the book) keep no
events in stream state: a second stream gathers, per (instrument, window), which parts of the store hold its
events, and when the watermark closes a window these parts are opened by name and go through the batch
operators.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.blocks import stat_block
from tickloom.functions.durations import parse_millis, utc_text
from tickloom.operators.book import book_snapshots
from tickloom.operators.events import flatten
from tickloom.operators.features import window_features
from tickloom.operators.parse import parse_depths, parse_trades
from tickloom.operators.ordered import null_safe_join
from tickloom.operators.replay import EMPTY_QUANTITY
from tickloom.operators.windows import assign_event_time, tumbling
from tickloom.schemas import ARRIVAL, DEFAULT_LEVELS, EVENT_COLUMNS, EVENT_ORDER, INSTRUMENT, LEVEL_UPDATE, TRADE
from tickloom.sources.readers import TOPICS, stream_messages
from tickloom.session import exists, file_system, freed_shuffles, hadoop_path, stage
from tickloom.sources.writers import as_text, named_partitions, write_failures
from tickloom.streaming import store as st
from tickloom.streaming.store import stored_schema

DEDUPE_WINDOW = "5m"
DAY_PIECES = 16
#: What a job runs on without another word: all that is there now, then stop.
AVAILABLE = {"availableNow": True}


def _interval(duration: str) -> str:
    return f"{parse_millis(duration)} milliseconds"


def event_stream(spark: SparkSession, source: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Events of both topics as one stream."""
    depths, trades = (stream_messages(spark, source, topic, fmt, **options) for topic in TOPICS)
    return flatten(parse_depths(depths)[0], parse_trades(trades)[0])


def failure_stream(spark: SparkSession, source: str, fmt: str = "parquet", **options: str) -> DataFrame:
    depths, trades = (stream_messages(spark, source, topic, fmt, **options) for topic in TOPICS)
    return flatten(parse_depths(depths)[1], parse_trades(trades)[1])


PENDING = T.StructType([T.StructField(c, T.LongType()) for c in ("latest", "bound")])


def _distinct_of(events: DataFrame, condition: Column, period: str) -> DataFrame:
    """Each distinct event that meets ``condition`` on the time, with the earliest ``seq`` of its copies and its ``event_day``.

    Copies have one time, so such a condition takes all of them or none. One shuffle, by day and piece, serves the aggregation and a
    write that is partitioned by day: at most `DAY_PIECES` files a day. A hash comes first in the sort of the aggregation: it tells
    nearly all events apart by one number.
    """
    day = utc_text(F.timestamp_millis("time"), period)
    placed = events.where(condition).withColumns({"event_day": day, "_key": F.xxhash64(*EVENT_COLUMNS)})
    placed = placed.withColumn("_piece", F.pmod("_key", F.lit(DAY_PIECES)).cast("int")).repartition("event_day", "_piece")
    once = placed.groupBy("_key", "event_day", "_piece", *EVENT_COLUMNS).agg(F.min("seq").alias("seq"))
    return once.select(*EVENT_COLUMNS, "seq", "event_day")


def ingest(
    events: DataFrame, directory: str, checkpoint: str, lateness: str = DEDUPE_WINDOW, trigger: dict | None = None,
    announce: Sequence[str] | None = None, period: str = "yyyy-MM-dd",
) -> StreamingQuery:
    """Deduplicate and store events by ingest batch and day: full-record deduplication with the earliest ``seq``, as in the batch.

    An event is stored, once, when the watermark (the latest event time less the lateness) passes its time; copies at or behind
    the watermark that an earlier batch has reached are late, and dropped. What waits is written anew by each batch, as
    ``pending`` in the checkpoint: it is bounded by the lateness, and a batch that brings years goes by it in one shuffle, without a
    keyed state that takes every event by itself. A repeated batch starts from what the one before it left.
    A batch stores a day in at most `DAY_PIECES` files, not one for each task of the aggregation and day. A feed that
    brings years at once is better stored by a longer ``period``, say "yyyy-MM".
    ``trigger``: arguments of ``DataStreamWriter.trigger``. ``announce``: a folder for every job that follows the store
    (each deletes what it has used), by default the one of a single `feature_job`. Heartbeats move the watermark and
    are not stored.
    """
    targets = [st.announced_dir(directory)] if announce is None else announce

    waiting = f"{checkpoint}/pending"

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.select(*EVENT_COLUMNS, "seq")
        schema = batch.schema
        before = latest = None
        if batch_id:
            kept = f"{waiting}/clock={batch_id - 1}"
            if not exists(spark, kept):
                raise ValueError(f"{kept} is missing: the checkpoint is of another job or an earlier form of this one")
            latest, before = spark.read.schema(PENDING).json(kept).first()
        latest = max((t for t in (latest, batch.agg(F.max("time")).first()[0]) if t is not None), default=None)
        bound = None if latest is None else latest - parse_millis(lateness)
        rows = batch.where(~F.col("event_type").eqNullSafe(st.HEARTBEAT))
        if before is not None:
            rows = rows.where((F.col("time") > before) | F.col("time").isNull())
        if batch_id:
            rows = rows.unionByName(spark.read.schema(schema).parquet(f"{waiting}/batch={batch_id - 1}"))
        passed = F.coalesce(F.col("time") <= F.lit(bound).cast("bigint"), F.lit(False))
        path = f"{directory}/ingest_batch={batch_id}"
        with freed_shuffles(spark):
            due = named_partitions(_distinct_of(rows, passed, period))
            due.write.mode("overwrite").partitionBy("event_day").parquet(path)
            left = _distinct_of(rows, ~passed, period).select(*schema.names)
            left.write.mode("overwrite").parquet(f"{waiting}/batch={batch_id}")
            # The schema is that of the store, but for the batch, which names the folder.
            stored = spark.read.schema(due.schema).parquet(path)
            st.announce(stored.withColumn("ingest_batch", F.lit(batch_id).cast("bigint")), targets)
        spark.createDataFrame([(latest, bound)], PENDING).coalesce(1).write.mode("overwrite").json(f"{waiting}/clock={batch_id}")
        for name in ("batch", "clock"):  # the one before is needed if this batch is repeated
            file_system(spark, waiting).delete(hadoop_path(spark, f"{waiting}/{name}={batch_id - 2}"), True)

    return (
        events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(**trigger or AVAILABLE).start()
    )


def ingest_failures(failed: DataFrame, directory: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Store the dead letters of a stream in windows of their arrival, each micro-batch in its own directory."""

    def store(batch: DataFrame, batch_id: int) -> None:
        write_failures(batch, f"{directory}/ingest_batch={batch_id}", mode="overwrite")

    return (
        failed.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(**trigger or AVAILABLE).start()
    )


def trade_feature_stream(
    events: DataFrame, duration: str = "5m", lateness: str = "0s", keys: Sequence[str] = INSTRUMENT,
    order: Sequence[str] = EVENT_ORDER,
) -> DataFrame:
    """Trade blocks per (key, window), once, when the watermark passes the window's end."""
    timed = assign_event_time(events.where(F.col("event_type") == TRADE)).withWatermark("event_time", _lateness(lateness))
    aggregates = stat_block("all", order=order)
    for label in ("buy", "sell"):
        aggregates += stat_block(label, F.col("side") == label, order)
    rows = timed.groupBy(*keys, F.window("event_time", _interval(duration)).alias("_window")).agg(*aggregates)
    return rows.withColumn("window_end", F.unix_millis("_window.end") - 1).drop("_window")


def _lateness(duration: str) -> str:
    return "0 milliseconds" if duration == "0s" else _interval(duration)


def closed_windows(announced: DataFrame, duration: str, lateness: str) -> DataFrame:
    """One small row per closed (instrument, window): the parts of the store that hold it, and its last ingest batch."""
    timed = assign_event_time(announced).withWatermark("event_time", _lateness(lateness))
    return (
        timed.groupBy(*INSTRUMENT, F.window("event_time", _interval(duration)).alias("_window"))
        .agg(F.collect_set(F.struct("ingest_batch", "event_day")).alias("parts"), F.max("ingest_batch").alias("last_batch"))
        .select(
            *INSTRUMENT, "parts", "last_batch",
            F.unix_millis("_window.start").alias("window_start"), (F.unix_millis("_window.end") - 1).alias("window_end"),
        )
    )


def events_of(spark: SparkSession, directory: str, closed: DataFrame, duration: str, seq: T.DataType = ARRIVAL) -> DataFrame:
    """Stored events of the closed windows, from the parts of the store that they name.

    What arrived after a window closed sits in a later ingest batch than ``last_batch`` and stays
    out, as a late event should. The parts of a window are as many as the batches it was open in.
    """
    named = closed.select(F.explode("parts").alias("part")).select("part.*").where("ingest_batch IS NOT NULL").distinct()
    stored = st.read_parts(spark, directory, [(r.ingest_batch, r.event_day) for r in named.collect()], seq)
    millis = F.lit(parse_millis(duration)).cast("bigint")
    windowed = stored.withColumn("window_start", F.col("time") - F.pmod(F.col("time"), millis))
    wanted = closed.select(*INSTRUMENT, "window_start", F.col("last_batch").alias("_last"))
    return (
        windowed.join(wanted, [*INSTRUMENT, "window_start"])
        .where("ingest_batch <= _last").drop("window_start", "_last", "ingest_batch", "event_day")
    )


def feature_job(
    spark: SparkSession,
    directory: str,
    output: str,
    checkpoint: str,
    duration: str = "5m",
    levels: int = DEFAULT_LEVELS,
    lateness: str = "0s",
    order: Sequence[str] = EVENT_ORDER,
    seq: T.DataType = ARRIVAL,
    build: Callable[..., DataFrame] = window_features,
    trigger: dict | None = None,
    announced: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Feature rows of every closed window of the events stored by `ingest`, once each.

    Follows the announcements of the store, which come after a batch is stored whole; used ones are deleted, so
    neither the store nor its past is listed. ``announced``: this job's folder, if it isn't the only one.
    """
    source = announced or st.announced_dir(directory)
    followed = (
        spark.readStream.schema(st.ANNOUNCED).option("cleanSource", "delete").options(**options).parquet(source)
    )

    def compute(closed: DataFrame, batch_id: int) -> None:
        # Both are used several times: neither the stream's plan nor the join should run again.
        closed = stage(closed)
        events = stage(events_of(closed.sparkSession, directory, closed, duration, seq))
        rows = build(events, duration, levels, order=order)
        rows.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    return (
        closed_windows(followed, duration, lateness).writeStream.outputMode("append").foreachBatch(compute)
        .option("checkpointLocation", checkpoint).trigger(**trigger or AVAILABLE).start()
    )


def carried_books(
    spark: SparkSession, directory: str, output: str, checkpoint: str, duration: str = "5m", levels: int = DEFAULT_LEVELS,
    lateness: str = "0s", order: Sequence[str] = EVENT_ORDER, seq: T.DataType = ARRIVAL, trigger: dict | None = None,
    announced: str | None = None, **options: str,
) -> StreamingQuery:
    """Snapshots of closed windows of books that go on from window to window, as ``scope="instrument"`` has them.

    Beside ``rows/batch=N`` each closing writes the books it ends with, ``levels/batch=N``, and how many updates each
    instrument has had, ``counts/batch=N``; the next closing opens with them. Their size is that of the live books. A
    repeated closing reads what the one before it left and replaces its own. Windows close in the order of
    their ends, so a book's updates come in order.
    """
    followed = (
        spark.readStream.schema(st.ANNOUNCED).option("cleanSource", "delete").options(**options)
        .parquet(announced or st.announced_dir(directory))
    )
    keys = list(INSTRUMENT)

    def before(session: SparkSession, kind: str, batch_id: int, schema: str) -> DataFrame:
        path = f"{output}/{kind}/batch={batch_id - 1}"
        return session.read.schema(schema).parquet(path) if exists(session, path) else session.createDataFrame([], schema)

    def compute(closed: DataFrame, batch_id: int) -> None:
        closed = stage(closed)
        session = closed.sparkSession
        names = ", ".join(f"{k} STRING" for k in keys)
        events = events_of(session, directory, closed, duration, seq).where(F.col("event_type") == LEVEL_UPDATE)
        opening = before(session, "levels", batch_id, f"{names}, side STRING, price DOUBLE, quantity DOUBLE")
        had = before(session, "counts", batch_id, f"{names}, updates BIGINT")
        # Levels that are there already come first: no event has their time.
        opening = opening.withColumns({"time": F.lit(None).cast("bigint"), "seq": F.lit(None).cast(seq)})
        rows = stage(events.select(*opening.columns).unionByName(opening))
        known = (
            rows.groupBy(*keys).agg(F.count_if(F.col("time").isNull()).alias("_open"), F.count("time").alias("_new"))
            .join(had, keys, "full_outer").na.fill(0, ["_open", "_new", "updates"])
        )
        known = stage(known)
        snapshots = null_safe_join(book_snapshots(rows, keys, levels, order), known, keys).where("pos > _open")
        snapshots = snapshots.withColumn("pos", F.col("pos") - F.col("_open") + F.col("updates")).drop("_open", "_new", "updates")
        tumbling(snapshots, duration).drop("window_start").write.mode("overwrite").parquet(f"{output}/rows/batch={batch_id}")
        last = F.max_by("quantity", F.struct(*order, "quantity")).alias("quantity")
        live = rows.where(F.col("side").isin("ask", "bid") & F.col("price").isNotNull() & ~F.isnan("price"))
        live = live.groupBy(*keys, "side", "price").agg(last).where(F.col("quantity") >= EMPTY_QUANTITY)
        live.write.mode("overwrite").parquet(f"{output}/levels/batch={batch_id}")
        counts = known.select(*keys, (F.col("updates") + F.col("_new")).alias("updates"))
        counts.write.mode("overwrite").parquet(f"{output}/counts/batch={batch_id}")

    return (
        closed_windows(followed, duration, lateness).writeStream.outputMode("append").foreachBatch(compute)
        .option("checkpointLocation", checkpoint).trigger(**trigger or AVAILABLE).start()
    )


def end_windows(spark: SparkSession, directory: str, at: int, announced: str | None = None) -> None:
    """Tell the `feature_job` that its feed has come to ``at``: windows that end by then are closed."""
    st.heartbeat(spark, announced or st.announced_dir(directory), at, st.ANNOUNCED)


def publish(
    rows: DataFrame, target: str, checkpoint: str, fmt: str = "text", trigger: dict | None = None, **options: str
) -> StreamingQuery:
    """Rows as JSON strings to a text directory, or to another sink with a ``value`` column (Kafka:
    ``fmt="kafka"``, ``target`` the topic, ``kafka.bootstrap.servers`` among the options)."""
    writer = as_text(rows).writeStream.format(fmt).outputMode("append").options(**options)
    writer = writer.option("checkpointLocation", checkpoint).trigger(**trigger or AVAILABLE)
    return writer.option("topic", target).start() if fmt == "kafka" else writer.start(target)
