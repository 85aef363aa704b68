"""Stored inputs derived from the driver's tables, written once per session and read back.

The jobs run on archived messages, partitioned events and stored feature rows; the queries do the
same. Everything is written under the session's shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.operators.features import trade_features, window_features
from tickloom.plans import adapters
from tickloom.session import shared_dir
from tickloom.sources.readers import TOPICS, read_messages
from tickloom.sources.writers import write_events

_WRITTEN: dict[tuple, str] = {}


def written_once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, shared_dir(spark), sf_dir, name)
    if key not in _WRITTEN:
        path = f"{shared_dir(spark)}/data-{uuid.uuid4().hex}-{name}"
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def forget(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> None:
    """Have every stored input but ``keep`` written again when it is next asked for."""
    session = (spark.sparkContext.applicationId, shared_dir(spark), sf_dir)
    for key in [k for k in _WRITTEN if k[:3] == session and k[3].split("/")[0] not in keep]:
        del _WRITTEN[key]


def archive(spark: SparkSession, sf_dir: str, topics: tuple[str, ...] = TOPICS) -> str:
    """Message archive with the directories `trades` and `depths`; a topic is written when it is first asked for."""
    root = written_once(spark, sf_dir, "archive", lambda path: None)
    for topic in topics:
        make = {"trades": adapters.trade_messages, "depths": adapters.depth_messages}[topic]
        # As zstd: the texts of messages are much alike.
        written_once(
            spark, sf_dir, f"archive/{topic}",
            lambda _: make(spark, sf_dir).write.option("compression", "zstd").parquet(f"{root}/{topic}"),
        )
    return root


def messages(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    return read_messages(spark, archive(spark, sf_dir, (topic,)), topic)


def event_store(spark: SparkSession, sf_dir: str) -> str:
    """Market events partitioned by exchange, quote asset, base asset and event type."""
    return written_once(spark, sf_dir, "events", lambda path: write_events(adapters.market_events(spark, sf_dir), path))


def event_files(spark: SparkSession, sf_dir: str) -> str:
    """Market events as plain files, the input of the streams."""
    return written_once(spark, sf_dir, "files", lambda path: adapters.market_events(spark, sf_dir).write.parquet(path))


def trade_rows(spark: SparkSession, sf_dir: str, duration: str) -> DataFrame:
    """Stored trade feature rows of the market events."""
    path = written_once(
        spark, sf_dir, f"trades-{duration}",
        lambda p: trade_features(adapters.market_events(spark, sf_dir), duration).write.parquet(p),
    )
    return spark.read.parquet(path)


def feature_rows(spark: SparkSession, sf_dir: str, duration: str) -> DataFrame:
    """Stored full feature rows of the market events."""
    path = written_once(
        spark, sf_dir, f"features-{duration}",
        lambda p: window_features(adapters.market_events(spark, sf_dir), duration).write.parquet(p),
    )
    return spark.read.parquet(path)
