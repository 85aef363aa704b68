"""Sinks: partitioned events, windowed directories, feature tables, dead letters."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.durations import parse_millis, utc_text
from tickloom.functions.naming import feature_table, feature_table_name
from tickloom.operators.events import extract_trades
from tickloom.schemas import EVENT_COLUMNS, PARTITION
from tickloom.session import stage

SHARDS = 10
_MAX_RECORDS = 5_000_000
_PIECE_ROWS = 1_000_000  # events sorted by one task
_DIRECTORY_PARTS = ("year", "month", "day", "hour")


def named_partitions(df: DataFrame, keys: Sequence[str] = PARTITION) -> DataFrame:
    """Key columns with NULL as the literal ``None``, the default destination."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("None")) for c in keys})


def balanced(df: DataFrame, keys: Sequence[str], shards: int = SHARDS) -> DataFrame:
    """Rows brought together by destination and shard, split again where that is too much.

    The rebalance hint lets adaptive execution cut a hot destination into pieces of the advisory
    size (beyond ``shards`` if need be) and pack small ones into one task.
    """
    salted = df.withColumn("_shard", F.pmod(F.xxhash64(*df.columns), F.lit(shards)))
    return salted.hint("rebalance", *[F.col(c) for c in (*keys, "_shard")]).drop("_shard")


def write_events(df: DataFrame, directory: str, shards: int = SHARDS, mode: str = "overwrite") -> None:
    """Events under ``exchange=/quote_asset=/base_asset=/event_type=`` directories."""
    rows = balanced(named_partitions(df), PARTITION, shards)
    rows.write.mode(mode).option("maxRecordsPerFile", _MAX_RECORDS).partitionBy(*PARTITION).parquet(directory)


def earliest(events: DataFrame, rows: int, least: int, *aggregates: Column) -> DataFrame:
    """Each distinct event of ``rows`` events and its ``aggregates``, destinations named and side by side.

    One shuffle by ranges of (destination, time) cuts any destination into pieces of about `_PIECE_ROWS` events, at
    ``least`` so many in all, and serves the aggregation and a partitioned write. Combining copies before the shuffle would
    sort all that a task reads, and spill it.
    """
    # The fraction of a time: prices and quantities themselves are normalised by the grouping and can't place a row.
    fraction = F.pmod(F.xxhash64("price", "quantity", "side"), F.lit(256)).cast("int")
    place = [*PARTITION, "time", "_fraction"]
    rest = [c for c in EVENT_COLUMNS if c not in place]
    placed = named_partitions(events).withColumn("_fraction", fraction)
    pieces = placed.repartitionByRange(max(least, ceil(rows / _PIECE_ROWS)), *place)
    return pieces.groupBy(*place, *rest).agg(*aggregates).drop("_fraction")


def write_distinct_events(events: DataFrame, rows: int, directory: str, shards: int = SHARDS) -> None:
    """What `write_events` makes of the distinct events, each with its earliest ``seq``, in one shuffle; replaces the folder."""
    once = earliest(events, rows, shards, F.min("seq").alias("seq")).select(*EVENT_COLUMNS, "seq")
    once.write.mode("overwrite").option("maxRecordsPerFile", _MAX_RECORDS).partitionBy(*PARTITION).parquet(directory)


def merge_events(new: DataFrame, stored: DataFrame, directory: str, shards: int = SHARDS) -> None:
    """Add events to the partitions of ``directory`` so that each is there once, with its earliest ``seq``.

    ``new``: events with ``seq``, repeated or not, and cheap to read again; ``stored``: what `read_events` gives for the directory.
    Equal events have equal times, so only stored events of the new ones' partitions and time ranges are looked at. Events
    that are new are appended. Where a stored event turns out to have come earlier than was known, which an archive
    read in order never shows, its partition is written anew, and no other. A repeated run changes nothing. What is merged lies by
    ranges of (destination, time) and is written from there as it lies, without another shuffle.
    """
    new = named_partitions(new)
    # One row for each partition of the slice: the scan opens no other directory.
    ranges = stage(new.groupBy(*PARTITION).agg(
        F.min("time").alias("_first"), F.max("time").alias("_last"), F.count("*").alias("_n")))
    inside = F.coalesce(F.col("time").between(F.col("_first"), F.col("_last")), F.col("time").isNull())
    columns = [*EVENT_COLUMNS, "seq"]
    near = stored.join(ranges.drop("_n"), list(PARTITION)).where(inside)
    rows = (ranges.agg(F.sum("_n")).first()[0] or 0) + near.count()
    both = near.select(*columns, F.lit(False).alias("_new")).unionByName(new.select(*columns, F.lit(True).alias("_new")))
    # Of equal arrivals the stored one comes first.
    merged = earliest(both, rows, shards, F.min(F.struct("seq", "_new")).alias("_came"), F.min("_new").alias("_fresh"))
    merged = stage(merged.select(*EVENT_COLUMNS, "_came.seq", "_fresh", (F.col("_came._new") & ~F.col("_fresh")).alias("_moved")))
    moved = stage(merged.where("_moved").select(*PARTITION).distinct())
    some = F.broadcast(moved)  # a row for each destination at most

    def write(rows: DataFrame, mode: str) -> None:
        writer = rows.select(*columns).write.mode(mode).option("partitionOverwriteMode", "dynamic")
        writer.option("maxRecordsPerFile", _MAX_RECORDS).partitionBy(*PARTITION).parquet(directory)

    write(merged.where("_fresh").join(some, list(PARTITION), "left_anti"), "append")
    if moved.limit(1).count():
        apart = stored.join(ranges.drop("_n"), list(PARTITION)).where(~inside).select(*columns)
        write(merged.select(*columns).unionByName(apart).join(some, list(PARTITION), "left_semi"), "overwrite")


def window_directories(df: DataFrame) -> DataFrame:
    """Add ``year, month, day, hour`` of the window's end (exclusive), in UTC."""
    if "window_end" not in df.columns:
        raise ValueError("windowed output needs a window_end column; these rows are not windowed")
    end = F.timestamp_millis(F.col("window_end") + 1)
    formats = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return df.withColumns({name: utc_text(end, pattern) for name, pattern in formats.items()})


def write_windowed(df: DataFrame, directory: str, shards: int = 1, mode: str = "overwrite", fmt: str = "parquet", **options: str) -> None:
    rows = balanced(window_directories(df), _DIRECTORY_PARTS, shards)
    rows.write.mode(mode).options(maxRecordsPerFile=_MAX_RECORDS, **options).partitionBy(*_DIRECTORY_PARTS).format(fmt).save(
        directory
    )


def write_features(
    features: DataFrame, exchange: str, quote_asset: str, base_asset: str, duration: str, location: str | None = None
) -> str:
    """One instrument's feature rows as a table named after it; earlier content is replaced.

    ``location`` is the folder that holds the tables, where it is not the warehouse.
    """
    name = feature_table_name(exchange, quote_asset, base_asset, duration)
    rows = features.where(
        (F.col("exchange") == exchange) & (F.col("quote_asset") == quote_asset) & (F.col("base_asset") == base_asset)
    )
    writer = rows.write.mode("overwrite").format("parquet")
    if location:
        writer = writer.option("path", f"{location}/{name}")
    writer.saveAsTable(f"`{name}`")
    return name


def write_feature_tables(features: DataFrame, duration: str, location: str) -> list[str]:
    """Feature rows of all instruments, each a table named after it: written in one job, replaced as a whole.

    ``location``: the folder of this set of tables. The names, one for each instrument, are all that reaches the driver.
    """
    rows = features.withColumn("_table", feature_table(duration))
    balanced(rows, ["_table"], 1).write.mode("overwrite").partitionBy("_table").parquet(location)
    spark = features.sparkSession
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in features.schema)
    stored = spark.read.schema(f"{schema}, _table STRING").parquet(location)
    names = sorted(r[0] for r in stored.select("_table").distinct().collect())
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        spark.sql(f"CREATE TABLE `{name}` ({schema}) USING parquet LOCATION '{location}/_table={name}'")
    return names


def write_failures(failures: DataFrame, directory: str, duration: str = "1h", mode: str = "overwrite") -> None:
    """Dead letters in windows of their arrival time, as gzipped JSON lines: payloads are long and much alike."""
    millis = parse_millis(duration)
    arrived = F.coalesce(F.col("timestamp"), F.lit(0).cast("bigint"))
    end = arrived - F.pmod(arrived, F.lit(millis).cast("bigint")) + F.lit(millis - 1)
    write_windowed(failures.withColumn("window_end", end), directory, mode=mode, fmt="json", compression="gzip")


def as_text(df: DataFrame) -> DataFrame:
    """Each row as one JSON string in ``value``: the shape of a message bus sink."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def extract_instrument(events: DataFrame, exchange: str, symbol: str, path: str) -> None:
    """Trades of one instrument as JSON lines of (time, side, quantity, price)."""
    extract_trades(events, exchange, symbol).write.mode("overwrite").json(path)


def window_path(directory: str) -> Column:
    """``directory`` with YYYY, MM, DD and HH replaced from the columns of `window_directories`."""
    path = F.lit(directory)
    for token, column in (("YYYY", "year"), ("MM", "month"), ("DD", "day"), ("HH", "hour")):
        path = F.replace(path, F.lit(token), F.col(column))
    return path
