"""Readers of archived messages, partitioned events and stored features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tickloom.schemas import ENVELOPE, EVENT, LEVEL_CSV, TRADE_EXTRACT
from tickloom.session import exists

TOPICS = ("depths", "trades")


def read_messages(spark: SparkSession, directory: str, topic: str, fmt: str = "parquet") -> DataFrame:
    """All archived envelopes of a topic, ``<directory>/<topic>/*``. ``fmt="avro"`` needs Spark's
    Avro package on the class path."""
    return spark.read.format(fmt).schema(ENVELOPE).load(f"{directory}/{topic}")


def to_envelope(df: DataFrame, payload: str | Column, attributes: str | Column, arrived: str | Column) -> DataFrame:
    """Payload, attributes and arrival timestamp (milliseconds) of bus messages."""
    def column(c):
        return F.col(c) if isinstance(c, str) else c

    return df.select(
        column(payload).cast("binary").alias("message"),
        column(attributes).alias("attributes"),
        F.unix_millis(column(arrived)).alias("timestamp"),
    )


def read_events(
    spark: SparkSession,
    directory: str,
    exchange: str | None = None,
    quote_asset: str | None = None,
    base_asset: str | None = None,
    event_type: str | None = None,
    extra: Sequence[T.StructField] = (),
    missing_ok: bool = False,
) -> DataFrame:
    """Partitioned events, optionally of one instrument: conditions on partition columns, which
    Spark turns into a choice of directories. ``missing_ok``: a folder that isn't there yet holds no events."""
    schema = T.StructType([*EVENT.fields, *extra])
    if missing_ok and not exists(spark, directory):
        return spark.createDataFrame([], schema)
    events = spark.read.schema(schema).parquet(directory)
    wanted = {"exchange": exchange, "quote_asset": quote_asset, "base_asset": base_asset, "event_type": event_type}
    for name, value in wanted.items():
        if value is not None:
            events = events.where(F.col(name) == value)
    return events


def stream_messages(spark: SparkSession, source: str, topic: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Unbounded envelopes of one topic: files appearing under ``<source>/<topic>``, or Kafka
    (``fmt="kafka"``, ``source`` the bootstrap servers) where its package is on the class path."""
    if fmt == "kafka":
        raw = (
            spark.readStream.format("kafka").option("kafka.bootstrap.servers", source)
            .option("subscribe", topic).option("includeHeaders", "true").options(**options).load()
        )
        headers = F.map_from_entries(F.transform("headers", lambda h: F.struct(h["key"], h["value"].cast("string"))))
        return to_envelope(raw, "value", headers, "timestamp")
    return spark.readStream.format(fmt).schema(ENVELOPE).options(**options).load(f"{source}/{topic}")


def read_features(spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "parquet") -> DataFrame:
    """Stored feature or level records.

    ``fmt``: parquet, avro (package needed), json (one record per line), json_array (one array per
    file) or csv without a header.
    """
    reader = spark.read.schema(schema)
    if fmt == "json_array":
        return reader.option("multiLine", "true").json(path)
    if fmt == "csv":
        return reader.option("header", "false").csv(path)
    return reader.format(fmt).load(path)


def read_level_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_features(spark, path, LEVEL_CSV, "csv")


def read_trade_extract(spark: SparkSession, path: str) -> DataFrame:
    return read_features(spark, path, TRADE_EXTRACT, "json_array")
