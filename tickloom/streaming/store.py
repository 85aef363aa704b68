"""The event store of the streams: ingest batches by day, closed days compacted, and what is announced of them.

* ``<directory>/ingest_batch=N/event_day=D``: what one micro-batch stored, replaced if it is repeated.
* ``<directory>-compacted/through=N/event_day=D``: the batches up to N of a closed day, together. A batch that
  lies under a day's compaction is not read from its own directory any more, deleted or not, so a job
  that stops between writing and deleting loses and doubles nothing.
* ``<directory>-announced``: one row for each instrument, second and batch. A job that follows the store reads these and then
  opens the directories they name; it never lists the store. Announcements are deleted once they are used.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tickloom.schemas import ARRIVAL, EVENT, INSTRUMENT
from tickloom.session import file_system, hadoop_path

#: Type of a row that is no event: its time says how far the feed has come.
HEARTBEAT = "_heartbeat"
SLOT_MS = 1000  # every window starts and ends at a whole second

Part = tuple[int, str]  # ingest batch, day

ANNOUNCED = T.StructType([
    *[T.StructField(c, T.StringType()) for c in INSTRUMENT],
    T.StructField("time", T.LongType()),
    T.StructField("ingest_batch", T.LongType()), T.StructField("event_day", T.StringType()),
])


def stored_schema(seq: T.DataType = ARRIVAL) -> T.StructType:
    return T.StructType([
        *EVENT.fields, T.StructField("seq", seq),
        T.StructField("ingest_batch", T.LongType()), T.StructField("event_day", T.StringType()),
    ])


def announced_dir(directory: str) -> str:
    return f"{directory}-announced"


def compacted_dir(directory: str) -> str:
    return f"{directory}-compacted"


def _matches(spark: SparkSession, pattern: str) -> list[str]:
    return [str(s.getPath().toString()) for s in file_system(spark, pattern).globStatus(hadoop_path(spark, pattern)) or []]


def _value(part: str) -> str:
    return part.split("=", 1)[1]


def compactions(spark: SparkSession, directory: str, days: Iterable[str]) -> dict[str, list[int]]:
    """The compactions of each day, by their last batch, ascending."""
    found = {}
    for day in sorted(set(days)):
        paths = _matches(spark, f"{compacted_dir(directory)}/through=*/event_day={day}")
        found[day] = sorted(int(_value(p.split("/")[-2])) for p in paths)
    return found


def part_paths(spark: SparkSession, directory: str, parts: Iterable[Part]) -> tuple[list[str], list[str]]:
    """(ingest directories, compacted directories) that hold the given parts."""
    parts = sorted(set(parts))
    compacted = compactions(spark, directory, (day for _, day in parts))
    own, together = [], set()
    for batch, day in parts:
        later = [n for n in compacted[day] if n >= batch]
        if later:
            together.add(f"{compacted_dir(directory)}/through={later[0]}/event_day={day}")
        else:
            own.append(f"{directory}/ingest_batch={batch}/event_day={day}")
    return own, sorted(together)


def read_parts(spark: SparkSession, directory: str, parts: Iterable[Part], seq: T.DataType = ARRIVAL) -> DataFrame:
    """Events of the named parts alone. A compacted directory brings the other batches of its day along."""
    schema = stored_schema(seq)
    out = spark.createDataFrame([], schema)
    for base, paths in zip((directory, compacted_dir(directory)), part_paths(spark, directory, parts)):
        if paths:
            rows = spark.read.schema(schema).option("basePath", base).parquet(*paths)
            out = out.unionByName(rows.select(*schema.names))
    return out


def stored_parts(spark: SparkSession, directory: str) -> list[Part]:
    """Parts that still lie in their ingest directories, by a listing of the store."""
    found = (p.split("/")[-2:] for p in _matches(spark, f"{directory}/ingest_batch=*/event_day=*"))
    return sorted((int(_value(batch)), _value(day)) for batch, day in found)


def read_store(spark: SparkSession, directory: str, seq: T.DataType = ARRIVAL) -> DataFrame:
    """All stored events, compacted or not."""
    parts = stored_parts(spark, directory)
    days = {_value(p.split("/")[-1]) for p in _matches(spark, f"{compacted_dir(directory)}/through=*/event_day=*")}
    together = [(n, day) for day, through in compactions(spark, directory, days).items() for n in through]
    return read_parts(spark, directory, [*parts, *together], seq)


def compact(spark: SparkSession, directory: str, before: str, seq: T.DataType = ARRIVAL) -> list[str]:
    """Rewrite the days before ``before`` (yyyy-MM-dd), all their batches together; returns these days.

    For days that get no more events. If one does, later, its next compaction adds to it. Large days are split
    by adaptive execution, small ones packed.
    """
    parts = [p for p in stored_parts(spark, directory) if p[1] < before]
    known = compactions(spark, directory, (day for _, day in parts))
    live = [(batch, day) for batch, day in parts if not any(n >= batch for n in known[day])]
    if live:
        rows = read_parts(spark, directory, live, seq).hint("rebalance", F.col("event_day"), *map(F.col, INSTRUMENT))
        target = f"{compacted_dir(directory)}/through={max(batch for batch, _ in live)}"
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_day").parquet(target)
    for batch, day in parts:
        file_system(spark, directory).delete(hadoop_path(spark, f"{directory}/ingest_batch={batch}/event_day={day}"), True)
    for batch in {batch for batch, _ in parts} - {batch for batch, _ in stored_parts(spark, directory)}:
        file_system(spark, directory).delete(hadoop_path(spark, f"{directory}/ingest_batch={batch}"), True)
    return sorted({day for _, day in live})


def announce(stored: DataFrame, targets: Sequence[str]) -> None:
    """Tell the followers what a batch has brought: (instrument, last time in a second, batch, day).

    A repeated batch announces the same again, which changes nothing: followers keep sets. A batch is announced in one
    file, which appears at once: in several, the watermark of a follower that takes them one by one could pass a
    window before all of the batch is known. A backfill is best taken in by bounded batches.
    """
    slot = F.expr(f"time div {SLOT_MS}").alias("slot")
    rows = stored.groupBy(*INSTRUMENT, slot, "ingest_batch", "event_day").agg(F.max("time").alias("time"))
    for target in targets:
        rows.select(*ANNOUNCED.names).repartition(1).write.mode("append").parquet(target)


def heartbeat(spark: SparkSession, directory: str, at: int, schema: T.StructType) -> None:
    """A row into a stream's folder that only says that its feed has come to ``at`` (milliseconds).

    Written when a feed ends or pauses: the watermark passes what still waits. Of the other fields, an event
    type is `HEARTBEAT` and the rest NULL.
    """
    known = {"time": at, "event_type": HEARTBEAT}
    row = spark.range(1).select(*[F.lit(known.get(f.name)).cast(f.dataType).alias(f.name) for f in schema])
    row.write.mode("append").parquet(directory)
