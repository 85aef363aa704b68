"""The registered queries, each with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from tickloom.functions import naming
from tickloom.operators import book, events as ev, features as ft, frames as fr, ordered as od, parse as ps
from tickloom.operators import portfolio as pf, versions as vs, windows as wn
from tickloom.plans import adapters as ad, batch, datasets as ds, sqltext as q
from tickloom.schemas import (
    ARRIVAL, DEFAULT_LEVELS, EVENT_COLUMNS, EXTENDED_MEASURES, FAILURE, INSTRUMENT, LEVEL_UPDATE, MEASURES, PARTITION, PRESET_44,
    PRESET_60, TRADE, TRADE_LABELS, block_columns, book_labels, extended_columns, feature_columns,
    older_names,
)
from tickloom.session import shared_dir, stage
from tickloom.sources import readers, writers
from tickloom.streaming import intake, jobs, store

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

KEYS = q.KEYS
DAY, HOUR, MONTH = 86_400_000, 3_600_000, 30 * 86_400_000
PARTITION_SQL = ", ".join(PARTITION)
EVENT_SQL = ", ".join(EVENT_COLUMNS)


def six_places(column: Column) -> Column:
    return F.round(column + F.lit(1e-9), 6)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, as in the SQL: sums depend on the order of addition."""
    return df.select(*[
        six_places(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def query(sql: str | None = None, finish: Callable[[DataFrame], DataFrame] = rounded):
    def register(build: Query) -> Query:
        name = build.__name__
        QUERIES[name] = lambda spark, sf_dir: finish(build(spark, sf_dir))
        if sql:
            ORACLE[name] = sql
        return build

    return register


# --- sources and sinks -----------------------------------------------------------------------

_MESSAGE_TYPES = "event_type IN ('purchase', 'click', 'error')"
_DEPTH_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT))"


@query(f"""
SELECT 'trades' AS topic, event_id AS timestamp, CAST(event_id AS VARCHAR) AS id FROM events WHERE {_MESSAGE_TYPES}
UNION ALL SELECT 'depths', l_orderkey, {_DEPTH_ID} FROM lineitem""")
def message_scan(spark, sf_dir):
    scans = [
        ds.messages(spark, sf_dir, topic).select(
            F.lit(topic).alias("topic"), "timestamp", F.element_at("attributes", "id").alias("id")
        ) for topic in readers.TOPICS
    ]
    return ev.flatten(*scans)


@query("""
SELECT event_type || ':' || props AS payload, CAST(user_id AS VARCHAR) AS user_id, epoch_us(ts) // 1000 AS timestamp FROM events""")
def envelopes(spark, sf_dir):
    raw = ad.table(spark, sf_dir, "events")
    rows = readers.to_envelope(
        raw, F.concat_ws(":", "event_type", "props"), F.create_map(F.lit("user"), F.col("user_id").cast("string")),
        ad.utc_instant("ts"),
    )
    return rows.select(
        F.col("message").cast("string").alias("payload"), F.element_at("attributes", "user").alias("user_id"), "timestamp"
    )


@query(f"""WITH {q.EVENTS} SELECT {EVENT_SQL} FROM ev WHERE exchange = 'ex1' AND base_asset = 'A2' AND quote_asset = 'USDT'""")
def instrument_scan(spark, sf_dir):
    return readers.read_events(spark, ds.event_store(spark, sf_dir), "ex1", "USDT", "A2").select(*EVENT_COLUMNS)


@query(f"""WITH {q.EVENTS} SELECT {PARTITION_SQL}, count(*) AS events, {q.rnd('sum(quantity)', 'quantity')} FROM ev GROUP BY {PARTITION_SQL}""")
def written_partitions(spark, sf_dir):
    stored = readers.read_events(spark, ds.event_store(spark, sf_dir))
    return stored.groupBy(*PARTITION).agg(F.count("*").alias("events"), F.sum("quantity").alias("quantity"))


@query(f"""WITH {q.EVENTS}, {q.windowed(HOUR)}, e AS (SELECT make_timestamp((window_end + 1) * 1000) AS t FROM w)
SELECT strftime(t, '%Y') AS year, strftime(t, '%m') AS month, strftime(t, '%d') AS day, strftime(t, '%H') AS hour,
  'out/' || strftime(t, '%Y/%m/%d/%H') AS path, count(*) AS events FROM e GROUP BY t""")
def windowed_directories(spark, sf_dir):
    rows = writers.window_directories(wn.tumbling(ad.market_events(spark, sf_dir), "1h"))
    return rows.withColumn("path", writers.window_path("out/YYYY/MM/DD/HH")).groupBy(
        "year", "month", "day", "hour", "path"
    ).agg(F.count("*").alias("events"))


@query(f"""WITH {q.EVENTS}, {q.trade_rows(DAY)}
SELECT *, 86400 AS interval FROM (SELECT {KEYS}, window_end, all_count, all_close_price, all_vwap FROM tf)
WHERE exchange = 'ex0' AND base_asset = 'A1'""")
def stored_feature_table(spark, sf_dir):
    rows = ft.to_feature_rows(ds.trade_rows(spark, sf_dir, "24h"), "24h")
    location = f"{shared_dir(spark)}/tables-{spark.sparkContext.applicationId}"
    name = writers.write_features(rows, "ex0", "USDT", "A1", "24h", location)
    return spark.table(f"`{name}`").select(
        *INSTRUMENT, "window_end", "all_count", "all_close_price", "all_vwap", F.col("interval").cast("int")
    )


@query(f"""WITH {q.EVENTS}, {q.trade_rows(DAY)}
SELECT exchange, base_asset, CAST(window_end AS VARCHAR) AS window_end, CAST(all_count AS VARCHAR) AS all_count FROM tf""")
def features_as_text(spark, sf_dir):
    text = writers.as_text(ds.trade_rows(spark, sf_dir, "24h"))
    fields = ("exchange", "base_asset", "window_end", "all_count")
    return text.select(*[F.get_json_object("value", f"$.{f}").alias(f) for f in fields])


@query(f"""SELECT CASE event_id % 3 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'missing_field' ELSE 'bad_number' END AS error_class,
  'trades' AS source, count(*) AS failures FROM events WHERE event_type = 'error' GROUP BY 1""")
def written_failures(spark, sf_dir):
    _, failed = ps.parse_trades(ds.messages(spark, sf_dir, "trades"))
    path = ds.written_once(spark, sf_dir, "failures", lambda p: writers.write_failures(failed, p))
    stored = spark.read.schema(failed.schema).json(path)
    return stored.groupBy("error_class", "source").agg(F.count("*").alias("failures"))


@query(f"""WITH {q.EVENTS} SELECT time, side, quantity, price FROM ev
WHERE event_type = 'trade' AND exchange = 'ex0' AND base_asset || quote_asset = 'A0USDT'""")
def instrument_extract(spark, sf_dir):
    path = ds.written_once(
        spark, sf_dir, "extract",
        lambda p: writers.extract_instrument(ad.market_events(spark, sf_dir), "ex0", "A0USDT", p),
    )
    return readers.read_features(spark, path, readers.TRADE_EXTRACT, "json")


@query(f"""WITH {q.EVENTS} SELECT time, price, {q.rnd('quantity')}, side FROM ev WHERE event_type = 'levelUpdate'""")
def level_csv(spark, sf_dir):
    rows = ev.of_type(ad.market_events(spark, sf_dir), LEVEL_UPDATE).select("time", "price", "quantity", "side")
    return readers.read_level_csv(spark, ds.written_once(spark, sf_dir, "csv", lambda p: rows.write.csv(p)))


@query(f"""WITH {q.EVENTS} SELECT time, side, {q.rnd('quantity')}, price FROM ev WHERE event_type = 'trade'""")
def trade_arrays(spark, sf_dir):
    """Trade records in files of one JSON array each."""
    def run(path: str) -> None:
        trades = ev.of_type(ad.market_events(spark, sf_dir), TRADE)
        days = trades.groupBy(*INSTRUMENT, F.expr(f"time div {DAY}")).agg(
            F.to_json(F.collect_list(F.struct("time", "side", "quantity", "price"))).alias("value"))
        days.select("value").write.option("maxRecordsPerFile", 1).text(path)

    return readers.read_trade_extract(spark, ds.written_once(spark, sf_dir, "arrays", run))


# --- parsing -----------------------------------------------------------------------------------


@query(f"""WITH {q.EVENTS}, raw AS (SELECT *, round(value * 100) AS raw_quantity FROM events WHERE event_type IN ('purchase', 'click'))
SELECT 'trade' AS event_type, ev.exchange, ev.quote_asset, ev.base_asset, ev.time, {q.rnd('ev.price * raw_quantity', 'quantity')},
  ev.price, ev.side FROM ev JOIN raw ON raw.event_id = ev.seq""")
def parse_trades(spark, sf_dir):
    return ps.canonical(ps.parse_trades(ds.messages(spark, sf_dir, "trades"))[0])


_DEPTH_LEVELS = """d AS (
  SELECT *, l_linenumber % 3 AS n_ask, CAST(l_quantity AS BIGINT) % 3 AS n_bid, 100 + l_partkey % 400 AS base,
    l_linenumber = 6 AND l_linestatus = 'O' AS nameless, l_linenumber = 7 AS bidless,
    l_quantity = 50 AND l_linenumber % 3 = 2 AS bad_ask FROM lineitem),
lv AS (
  SELECT 'ask' AS side, i, base + i AS price, l_quantity + i AS raw, d.* FROM d, (VALUES (1), (2)) t(i)
  WHERE i <= n_ask AND NOT nameless AND NOT (bad_ask AND i = 2)
  UNION ALL
  SELECT 'bid', i, base - i, l_quantity + i, d.* FROM d, (VALUES (1), (2)) t(i)
  WHERE i <= n_bid AND NOT nameless AND NOT bad_ask AND NOT bidless)"""


@query(f"""WITH {_DEPTH_LEVELS}
SELECT 'levelUpdate' AS event_type, 'li' AS exchange, 'USD' AS quote_asset, 'C' || CAST(l_suppkey % 10 AS VARCHAR) AS base_asset,
  epoch_us(l_shipdate) // 1000 AS time, CAST(price * raw AS DOUBLE) AS quantity, CAST(price AS DOUBLE) AS price, side FROM lv""")
def parse_depths(spark, sf_dir):
    return ps.canonical(ps.parse_depths(ds.messages(spark, sf_dir, "depths"))[0])


@query(f"""WITH {_DEPTH_LEVELS}, bad AS (
  SELECT l_orderkey AS timestamp, CASE WHEN nameless AND (n_ask > 0 OR (n_bid > 0 AND NOT bidless)) THEN 'missing_field'
    WHEN bad_ask THEN 'bad_number' WHEN bidless THEN 'missing_field' END AS error_class, 'depths' AS source FROM d)
SELECT error_class, source, timestamp FROM bad WHERE error_class IS NOT NULL
UNION ALL
SELECT CASE event_id % 3 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'missing_field' ELSE 'bad_number' END, 'trades', event_id
FROM events WHERE event_type = 'error'""")
def parse_failures(spark, sf_dir):
    failed = [ps.parse_depths(ds.messages(spark, sf_dir, "depths"))[1], ps.parse_trades(ds.messages(spark, sf_dir, "trades"))[1]]
    return ev.flatten(*failed).select("error_class", "source", "timestamp")


@query(f"""SELECT count(*) AS messages, count(*) FILTER (WHERE event_type = 'error') AS parse_errors FROM events WHERE {_MESSAGE_TYPES}""")
def parse_counts(spark, sf_dir):
    counter = Observation("parse_counts")
    ps.count_errors(ps.read_trades(ds.messages(spark, sf_dir, "trades")), counter).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([counter.get], "messages bigint, parse_errors bigint")


@query("""SELECT 'north_depthUpdate_ZED_QQ_' || CAST(epoch_us(l_shipdate) // 1000 AS VARCHAR) AS event_key, epoch_us(l_shipdate) // 1000 AS event_time_ms,
  l_quantity AS ask_quantity, l_extendedprice AS ask_price, l_tax AS bid_quantity, l_discount AS bid_price FROM lineitem""")
def compact_depths(spark, sf_dir):
    li = ad.table(spark, sf_dir, "lineitem")
    pairs = li.select(
        ad._millis("l_shipdate").alias("event_time_ms"),
        F.array(F.array("l_quantity", "l_extendedprice")).alias("asks"), F.array(F.array("l_tax", "l_discount")).alias("bids"),
        F.lit("north").alias("exchange"), F.lit("depthUpdate").alias("event_type"),
        F.lit("QQ").alias("quote_asset"), F.lit("ZED").alias("base_asset"),
    )
    return ps.compact_depths(pairs).select(
        "event_key", "event_time_ms",
        *[F.col(f"{s}s")[0][c].alias(f"{s}_{c}") for s in ("ask", "bid") for c in ("quantity", "price")],
    )


@query(f"""WITH {q.EVENTS} SELECT base_asset || quote_asset AS symbol,
  'Event{{exchange=' || exchange || ', eventType=' || event_type || ', quoteAsset=' || quote_asset || ', baseAsset=' || base_asset || '}}' AS partition,
  exchange || '_' || quote_asset || '_' || base_asset || '_' || event_type AS file,
  exchange || '/' || quote_asset || '/' || base_asset || '/' || event_type AS dir, count(*) AS events
FROM ev GROUP BY ALL""")
def partition_paths(spark, sf_dir):
    named = ad.market_events(spark, sf_dir).select(
        naming.symbol().alias("symbol"), naming.partition_string().alias("partition"),
        naming.partition_file().alias("file"), naming.partition_dir().alias("dir"),
    )
    return named.groupBy("symbol", "partition", "file", "dir").agg(F.count("*").alias("events"))


@query(f"""WITH {q.EVENTS} SELECT time, side, price, CASE side WHEN 'sell' THEN -quantity ELSE quantity END AS quantity FROM ev WHERE event_type = 'trade'""")
def signed_quantity(spark, sf_dir):
    trades = ev.of_type(ad.market_events(spark, sf_dir), TRADE)
    return ev.signed_quantity(trades).select("time", "side", "price", "quantity")


# --- filters, union, dedupe --------------------------------------------------------------------


@query(f"""WITH {q.EVENTS} SELECT event_type, side, count(*) AS events FROM ev GROUP BY event_type, side""")
def known_event_types(spark, sf_dir):
    return ev.known_types(ad.all_events(spark, sf_dir)).groupBy("event_type", "side").agg(F.count("*").alias("events"))


@query(f"""WITH {q.EVENTS} SELECT time, price, quantity, side FROM ev
WHERE exchange = 'ex0' AND event_type = 'levelUpdate' AND quote_asset = 'USDT' AND base_asset = 'A1'""")
def partition_filter(spark, sf_dir):
    asks, bids = ev.split_sides(
        ev.of_partition(ad.market_events(spark, sf_dir), "ex0", LEVEL_UPDATE, "USDT", "A1").select("time", "price", "quantity", "side")
    )
    return ev.flatten(asks, bids)


@query(f"""WITH {q.EVENTS} SELECT {EVENT_SQL} FROM ev WHERE exchange = 'ex1' AND base_asset || quote_asset = 'A0USDT'""")
def symbol_filter(spark, sf_dir):
    return ev.of_symbol(ad.market_events(spark, sf_dir), "ex1", "A0USDT").select(*EVENT_COLUMNS)


_TWO_FEEDS = f"""{q.EVENTS}, feed AS (
  SELECT {EVENT_SQL}, seq FROM ev UNION ALL SELECT {EVENT_SQL}, seq FROM ev WHERE event_type = 'trade')"""


def _two_feeds(spark, sf_dir):
    """Trades arrive twice, as from two redundant feeds."""
    events = ad.market_events(spark, sf_dir)
    return ev.flatten(events, ev.of_type(events, TRADE))


@query(f"WITH {_TWO_FEEDS} SELECT {EVENT_SQL} FROM feed")
def flatten_events(spark, sf_dir):
    return _two_feeds(spark, sf_dir).select(*EVENT_COLUMNS)


@query(f"WITH {_TWO_FEEDS} SELECT {EVENT_SQL}, min(seq) AS seq FROM feed GROUP BY {EVENT_SQL}")
def distinct_events(spark, sf_dir):
    return ev.distinct_events(_two_feeds(spark, sf_dir))


_NUMBERED = f"{q.EVENTS}, nr AS (SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY time, seq) AS pos FROM ev)"


@query(f"WITH {_NUMBERED} SELECT {KEYS}, time, seq, price FROM nr WHERE pos BETWEEN 11 AND 101")
def position_slice(spark, sf_dir):
    o = od.ordered(ad.market_events(spark, sf_dir), INSTRUMENT, ["time", "seq"])
    return od.position_slice(o, 10, 100).select(*INSTRUMENT, "time", "seq", "price")


@query(f"WITH {q.EVENTS} SELECT time, seq, price, side FROM ev ORDER BY time, seq LIMIT 20")
def head_rows(spark, sf_dir):
    return od.head(ad.market_events(spark, sf_dir).select("time", "seq", "price", "side"), 20, ["time", "seq"])


# --- windows -----------------------------------------------------------------------------------


@query(f"""WITH {q.EVENTS}, {q.windowed(300000)} SELECT seq, make_timestamp(time * 1000) AS event_time, time - time % 300000 AS window_start, window_end FROM w""")
def windows(spark, sf_dir):
    timed = wn.tumbling(wn.assign_event_time(ad.market_events(spark, sf_dir)), "5m")
    utc = F.to_utc_timestamp("event_time", F.current_timezone()).cast("timestamp_ntz")
    return timed.select("seq", utc.alias("event_time"), "window_start", "window_end")


@query(f"""WITH {q.EVENTS}, b AS (SELECT {KEYS}, min(time - time % 300000) AS a, max(time - time % 300000) AS z FROM ev GROUP BY {KEYS})
SELECT {KEYS}, unnest(generate_series(a, z, 300000)) AS time FROM b""")
def time_grid(spark, sf_dir):
    w = wn.tumbling(ad.market_events(spark, sf_dir), "5m")
    bounds = w.groupBy(*INSTRUMENT).agg(F.min("window_start").alias("start"), F.max("window_start").alias("end"))
    return wn.time_grid(bounds, "5m", INSTRUMENT)


@query(f"""WITH {q.EVENTS}, {q.windowed(DAY)}, n AS (SELECT *, row_number() OVER (PARTITION BY {PARTITION_SQL}, window_end ORDER BY time, seq) - 1 AS r FROM w)
SELECT {PARTITION_SQL}, window_end, r // 8 AS page, r % 8 AS place, time, quantity, price, side FROM n""")
def ordered_event_list(spark, sf_dir):
    pages = wn.ordered_event_pages(ad.market_events(spark, sf_dir), "24h", page=8)
    return pages.select(*PARTITION, "window_end", "page", F.posexplode("events").alias("p", "e")).select(
        *PARTITION, "window_end", "page", F.col("p").cast("bigint").alias("place"), "e.*"
    )


@query(f"""WITH {q.EVENTS}, n AS (SELECT *, row_number() OVER (PARTITION BY {PARTITION_SQL} ORDER BY time, seq) - 1 AS r,
  count(*) OVER (PARTITION BY {PARTITION_SQL}) AS n FROM ev)
SELECT {PARTITION_SQL}, r // 50 AS batch, CAST(r % 50 + 1 AS INTEGER) AS row_in_batch, seq, price FROM n WHERE (r // 50 + 1) * 50 <= n""")
def count_batches(spark, sf_dir):
    rows = wn.count_batches(ad.market_events(spark, sf_dir), 50, PARTITION, ["time", "seq"])
    return rows.select(*PARTITION, "batch", "row_in_batch", "seq", "price")


@query(f"""WITH {q.EVENTS}, {q.windowed(300000)} SELECT {PARTITION_SQL}, window_end, CAST(0.0 AS DOUBLE) AS marker FROM w GROUP BY {PARTITION_SQL}, window_end""")
def window_marker(spark, sf_dir):
    return wn.window_markers(ad.market_events(spark, sf_dir), "5m")


@query(f"""WITH {q.EVENTS}, {q.windowed(HOUR)} SELECT {PARTITION_SQL}, window_end, count(*) AS count FROM w GROUP BY {PARTITION_SQL}, window_end""")
def window_counts(spark, sf_dir):
    return wn.window_counts(ad.market_events(spark, sf_dir), "1h")


# --- aggregations and the book -----------------------------------------------------------------


@query(f"WITH {q.EVENTS}, {q.trade_rows(DAY)} SELECT * FROM tf")
def trade_features(spark, sf_dir):
    return ft.trade_features(ad.market_events(spark, sf_dir), "24h")


@query(f"WITH {q.EVENTS}, {q.trade_rows(DAY)} SELECT * FROM tf")
def trade_features_exact(spark, sf_dir):
    """The same by sums that do not depend on the order of addition."""
    return ft.trade_features(ad.market_events(spark, sf_dir), "24h", exact=True)


_COMPAT = ", ".join(f"all_{m} AS {label}_{m}" for label in TRADE_LABELS for m in MEASURES)


@query(f"WITH {q.EVENTS}, {q.trade_rows(DAY)} SELECT {KEYS}, window_end, {_COMPAT} FROM tf")
def trade_features_compat(spark, sf_dir):
    return ft.trade_features(ad.market_events(spark, sf_dir), "24h", compat=True)


@query(f"WITH {q.LINEITEM_TRADES}, {q.trade_rows(MONTH)} SELECT * FROM tf")
def trade_features_lineitem(spark, sf_dir):
    return ft.trade_features(ad.lineitem_trades(spark, sf_dir), "720h")


@query(f"WITH {q.EVENTS}, {q.snapshots(DAY, 5)} SELECT {KEYS}, window_end, pos, time, side, level, price, quantity FROM snap")
def book_snapshots(spark, sf_dir):
    return ft.window_snapshots(ad.market_events(spark, sf_dir), "24h", 5)


@query(f"WITH {q.EVENTS}, {q.snapshots(None, 5)} SELECT {KEYS}, time - time % {DAY} + {DAY - 1} AS window_end, pos, time, side, level, price, quantity FROM snap")
def book_snapshots_carried(spark, sf_dir):
    return ft.window_snapshots(ad.market_events(spark, sf_dir), "24h", 5, scope="instrument")


@query(f"WITH {q.EVENTS}, {q.level_rows(DAY, 5)} SELECT * FROM bl")
def book_level_stats(spark, sf_dir):
    return ft.book_level_stats(ft.window_snapshots(ad.market_events(spark, sf_dir), "24h", 5))


@query(f"WITH {q.LINEITEM_UPDATES}, {q.level_rows(MONTH, 5)}, {q.wide_book(5)} SELECT * FROM bf")
def book_features_deep(spark, sf_dir):
    return ft.book_features(ad.lineitem_updates(spark, sf_dir), "720h", 5)


_LABELS = [*TRADE_LABELS, *book_labels(5)]
_FEATURES = f"{q.EVENTS}, {q.trade_rows(DAY)}, {q.level_rows(DAY, 5)}, {q.wide_book(5)}"
_BLOCK_SQL = ", ".join(block_columns(_LABELS))


@query(f"WITH {_FEATURES} SELECT {KEYS}, window_end, CAST(86400 AS BIGINT) AS interval, {_BLOCK_SQL} FROM tf FULL JOIN bf USING ({KEYS}, window_end)")
def window_features(spark, sf_dir):
    return ft.window_features(ad.market_events(spark, sf_dir), "24h")


@query(f"""WITH {_FEATURES}
SELECT {KEYS}, window_end, CAST(86400 AS BIGINT) AS interval, {_BLOCK_SQL} FROM (SELECT * FROM tf UNION ALL BY NAME SELECT * FROM bf)""")
def window_features_separate(spark, sf_dir):
    return ft.window_features(ad.market_events(spark, sf_dir), "24h", joined=False)


@query(f"WITH {_FEATURES} SELECT {KEYS}, window_end, all_vwap, ask_0_vwap FROM tf FULL JOIN bf USING ({KEYS}, window_end)")
def joined_features(spark, sf_dir):
    events = ad.market_events(spark, sf_dir)
    joined = ft.join_features(ft.trade_features(events, "24h"), ft.book_features(events, "24h"))
    return joined.select(*INSTRUMENT, "window_end", "all_vwap", "ask_0_vwap")


@query(f"WITH {_FEATURES} SELECT {KEYS}, window_end, {q.rnd('ask_0_close_price - bid_0_close_price', 'spread')} FROM bf")
def spread(spark, sf_dir):
    rows = ft.with_spread(ft.book_features(ad.market_events(spark, sf_dir), "24h"))
    return rows.select(*INSTRUMENT, "window_end", "spread")


@query(f"""WITH {q.EVENTS}, {q.windowed(DAY)} SELECT 'north' AS exchange, 'QQ' AS quote_asset, 'ZED' AS base_asset, window_end, count(*) AS all_count
FROM w WHERE event_type = 'trade' GROUP BY window_end""")
def named_instrument(spark, sf_dir):
    """Rows of a single unnamed instrument, named from parameters."""
    rows = ft.trade_features(ad.market_events(spark, sf_dir), "24h", keys=())
    return ft.with_control_columns(rows, "north", "QQ", "ZED").select(*INSTRUMENT, "window_end", "all_count")


_ALT = ", ".join(q.rnd(e, n) for e, n in (
    ("last(price ORDER BY time, seq)", "close_price"), ("max(price)", "high_price"), ("min(price)", "low_price"),
    ("avg(price)", "mean_price"), ("stddev_pop(price)", "std_price"), ("last(price * quantity ORDER BY time, seq)", "close_qty"),
    ("max(price * quantity)", "max_qty"), ("min(price * quantity)", "min_qty"), ("avg(price * quantity)", "mean_qty"),
    ("stddev_pop(price * quantity)", "std_qty"),
    ("(last(price ORDER BY time, seq) + min(price) + max(price)) / 3 * sum(price * quantity)", "vwap"), ("sum(price * quantity)", "volume"),
))


@query(f"""WITH {q.EVENTS}, {q.windowed(DAY)} SELECT {KEYS}, window_end, count(*) AS count, {_ALT} FROM w WHERE event_type = 'trade' GROUP BY {KEYS}, window_end""")
def trade_block_alternative(spark, sf_dir):
    return ft.trade_block_alternative(ev.of_type(ad.market_events(spark, sf_dir), TRADE), "24h")


def _extended_sql(source: str, keys: str, order: str) -> str:
    """CTEs `em` and `ext`. Skewness is the population moment, `mad` the mean absolute deviation."""
    parts = ["count(price) AS count_price", q.rnd("sum(quantity)", "sum_quantity")]
    for f in ("price", "quantity"):
        parts += [
            q.rnd(f"avg({f})", f"mean_{f}"), q.rnd(f"median({f})", f"median_{f}"),
            q.rnd(f"CASE WHEN max({f}) > min({f}) THEN avg(power({f} - m_{f}, 3)) / power(avg(power({f} - m_{f}, 2)), 1.5) END", f"skew_{f}"),
            q.rnd(f"stddev_samp({f})", f"std_{f}"), q.rnd(f"min({f})", f"min_{f}"), q.rnd(f"max({f})", f"max_{f}"),
            q.rnd(f"avg(abs({f} - m_{f}))", f"mad_{f}"),
            q.rnd(f"first({f} ORDER BY {order})", f"first_{f}"), q.rnd(f"last({f} ORDER BY {order})", f"last_{f}"),
        ]
    return f"""em AS (SELECT *, avg(price) OVER (PARTITION BY {keys}) AS m_price, avg(quantity) OVER (PARTITION BY {keys}) AS m_quantity FROM {source}),
ext AS (SELECT {keys}, {', '.join(parts)} FROM em GROUP BY {keys})"""


@query(f"""WITH {q.EVENTS}, {q.windowed(DAY)}, tr AS (SELECT * FROM w WHERE event_type = 'trade'),
{_extended_sql('tr', f'{KEYS}, window_end, side', 'time, seq')} SELECT * FROM ext""")
def extended_block(spark, sf_dir):
    trades = wn.tumbling(ev.of_type(ad.market_events(spark, sf_dir), TRADE), "24h")
    return ft.extended_stats(trades, [*INSTRUMENT, "window_end", "side"], ["time", "seq"])


def _extended_wide() -> str:
    picks = ["c.close_price"]
    for name in extended_columns()[1:-1]:
        for side in ("buy", "sell"):
            if name.endswith(f"_{side}"):
                picks.append(f"max(t.{name[: -len(side) - 1]}) FILTER (WHERE t.side = '{side}') AS {name}")
    trade_cols = ", ".join(picks[1:])
    book_cols = []
    for side in ("ask", "bid"):
        for m in EXTENDED_MEASURES:
            book_cols += [f"max({m}) FILTER (WHERE side = '{side}' AND level = {i}) AS {side}_{m}_{i}" for i in range(10)]
    names = ", ".join(extended_columns()[1:-1])
    return f"""WITH {q.EVENTS}, {q.windowed(DAY)}, tr AS (SELECT * FROM w WHERE event_type = 'trade'),
{_extended_sql('tr', f'{KEYS}, window_end, side', 'time, seq')},
{q.snapshots(DAY, 10)},
{_extended_sql('snap', f'{KEYS}, window_end, side, level', 'pos').replace('em AS', 'bm AS').replace('FROM em', 'FROM bm').replace('ext AS', 'bx AS')},
c AS (SELECT {KEYS}, window_end, last(price ORDER BY time, seq) AS close_price FROM tr GROUP BY {KEYS}, window_end),
tw AS (SELECT {KEYS}, window_end, {trade_cols} FROM ext t GROUP BY {KEYS}, window_end),
bw2 AS (SELECT {KEYS}, window_end, {', '.join(book_cols)} FROM bx GROUP BY {KEYS}, window_end)
SELECT {KEYS}, window_end, close_price, {names}, {q.rnd('ask_last_price_0 - bid_last_price_0', 'spread')}
FROM (SELECT * FROM c LEFT JOIN tw USING ({KEYS}, window_end)) FULL JOIN bw2 USING ({KEYS}, window_end)"""


@query(_extended_wide())
def extended_features(spark, sf_dir):
    return ft.extended_features(ad.market_events(spark, sf_dir), "24h")


@query(f"""WITH {q.EVENTS}, {q.snapshots(DAY, 5)} SELECT 'level' AS type, side, level, {q.rnd('avg(price)', 'price')}, {q.rnd('avg(quantity)', 'quantity')} FROM snap GROUP BY side, level""")
def mean_by_level(spark, sf_dir):
    snapshots = ft.window_snapshots(ad.market_events(spark, sf_dir), "24h", 5).withColumn("type", F.lit("level"))
    return ft.mean_by_level(snapshots)


@query(f"""WITH {q.EVENTS}, {q.snapshots(DAY, None)} SELECT {KEYS}, window_end, pos, side, price, quantity FROM snap""")
def book_state(spark, sf_dir):
    """Both sides' maps after every update."""
    updates = wn.tumbling(ev.of_type(ad.market_events(spark, sf_dir), LEVEL_UPDATE), "24h")
    states = book.running_state(updates, [*INSTRUMENT, "window_end"], ["time", "seq"])
    sides = [
        states.select(*INSTRUMENT, "window_end", "pos", F.lit(side).alias("side"), F.explode(column).alias("price", "quantity"))
        for side, column in (("ask", "asks"), ("bid", "bids"))
    ]
    return ev.flatten(*sides)


@query(f"""WITH {q.EVENTS}, {q.snapshots(DAY, None)} SELECT {KEYS}, window_end, pos, side, level, price, quantity FROM snap""")
def rebuilt_books(spark, sf_dir):
    """Stored versions of every book, and from them the book at each position."""
    keys, every = [*INSTRUMENT, "window_end"], 64

    def run(path: str) -> None:
        updates = wn.tumbling(ev.of_type(ad.market_events(spark, sf_dir), LEVEL_UPDATE), "24h")
        vs.book_versions(updates, keys, ["time", "seq"], every).write.parquet(path)

    stored = spark.read.parquet(ds.written_once(spark, sf_dir, "versions", run))
    positions = stored.where(f"at > _run * {every}").select(*keys, F.col("at").alias("pos"))
    return vs.books_at(stored, positions, keys, every)


# Parsed levels with the place of their arrival; equal messages are one message sent twice.
_PARSED_LEVELS = f"""{_DEPTH_LEVELS},
pl AS (SELECT DISTINCT 'levelUpdate' AS event_type, 'li' AS exchange, 'USD' AS quote_asset, 'C' || CAST(l_suppkey % 10 AS VARCHAR) AS base_asset,
    epoch_us(l_shipdate) // 1000 AS time, CAST(price * raw AS DOUBLE) AS quantity, CAST(price AS DOUBLE) AS price, side,
    l_orderkey AS arrived, {_DEPTH_ID} AS message, CASE side WHEN 'ask' THEN i ELSE 10 + i END AS place FROM lv),
nl AS (SELECT *, row_number() OVER (ORDER BY arrived, message, place) AS seq FROM pl)"""


@query(f"""WITH {_PARSED_LEVELS}, ev AS (SELECT {EVENT_SQL}, min(seq) AS seq FROM nl GROUP BY {EVENT_SQL}), {q.snapshots(MONTH, None)},
ml AS (SELECT u.*, n.message FROM upd u JOIN nl n USING (seq)),
last_pos AS (SELECT {KEYS}, window_end, time, message, max(pos) AS pos FROM ml GROUP BY ALL)
SELECT {KEYS}, window_end, pos, message, side, level, price, quantity FROM snap JOIN last_pos USING ({KEYS}, window_end, pos)""", finish=lambda levels: levels)
def message_books(spark, sf_dir):
    """The whole book of every instrument after every depth message. A level is rounded once, as it is written, not in every book."""
    parsed = ev.distinct_events(ps.parse_depths(ds.messages(spark, sf_dir, "depths"))[0])
    updates = wn.tumbling(stage(parsed), "720h").withColumn("message", F.col("seq.message_id"))
    return book.message_levels(updates, [*INSTRUMENT, "window_end"], ["time", "message"], ["message"], shown=six_places)


_ARCHIVED = f"""{_PARSED_LEVELS},
px AS (SELECT event_id, 'ex' || CAST(user_id % 2 AS VARCHAR) AS exchange, 'USDT' AS quote_asset, 'A' || CAST(user_id % 3 AS VARCHAR) AS base_asset,
    epoch_us(ts) // 1000 AS time, CAST(100 + CAST(json_extract_string(props, '$.k') AS INTEGER) % 20 AS DOUBLE) AS price,
    round(value * 100) AS raw, CASE event_type WHEN 'purchase' THEN 'buy' ELSE 'sell' END AS side
  FROM events WHERE event_type IN ('purchase', 'click')),
both_topics AS (SELECT {EVENT_SQL}, seq FROM nl UNION ALL
  SELECT 'trade', exchange, quote_asset, base_asset, time, price * raw, price, side, event_id FROM px),
ev AS (SELECT {EVENT_SQL}, min(seq) AS seq FROM both_topics GROUP BY {EVENT_SQL})"""


_ARRIVED = f"""{_ARCHIVED}, arrived AS (SELECT {EVENT_SQL}, arrived FROM nl UNION ALL
  SELECT 'trade', exchange, quote_asset, base_asset, time, price * raw, price, side, event_id FROM px)"""


def _archive_events(spark, sf_dir) -> str:
    """Both topics of the archive, partitioned."""
    def run(path: str) -> None:
        batch.partition_archive(spark, ds.archive(spark, sf_dir), f"{path}/events", f"{path}/failures")

    return ds.written_once(spark, sf_dir, "partitioned", run)


@query(f"""WITH {_ARCHIVED} SELECT {PARTITION_SQL}, CAST(count(*) AS BIGINT) AS events, {q.rnd('sum(quantity)', 'quantity')} FROM ev GROUP BY {PARTITION_SQL}""")
def archive_partitions(spark, sf_dir):
    stored = readers.read_events(spark, f"{_archive_events(spark, sf_dir)}/events")
    return stored.groupBy(*PARTITION).agg(F.count("*").alias("events"), F.sum("quantity").alias("quantity"))


@query(f"""SELECT error_class, source, count(*) AS failures FROM ({ORACLE['parse_failures']}) GROUP BY 1, 2""")
def archive_failures(spark, sf_dir):
    stored = spark.read.schema(FAILURE).json(f"{_archive_events(spark, sf_dir)}/failures")
    return stored.groupBy("error_class", "source").agg(F.count("*").alias("failures"))


@query(f"""WITH {_ARCHIVED}, {q.trade_rows(MONTH)}, {q.level_rows(MONTH, 5)}, {q.wide_book(5)}
SELECT {KEYS}, window_end, CAST({MONTH // 1000} AS BIGINT) AS interval, {_BLOCK_SQL} FROM tf FULL JOIN bf USING ({KEYS}, window_end)""")
def archive_features(spark, sf_dir):
    """Archive to partitioned events to the feature tables of all instruments."""
    def run(path: str) -> None:
        batch.feature_tables(spark, f"{_archive_events(spark, sf_dir)}/events", path, "720h")

    location = ds.written_once(spark, sf_dir, "tables", run)
    names = [r[0] for r in spark.read.parquet(location).select("_table").distinct().collect()]
    return ev.flatten(*[spark.table(f"`{name}`") for name in sorted(names)])


@query(f"""WITH {_ARRIVED} SELECT {EVENT_SQL}, min(arrived) AS arrived FROM arrived GROUP BY {EVENT_SQL}""")
def archive_slices(spark, sf_dir):
    """The archive in two slices that overlap in a third of the messages, the later one first."""
    def run(path: str) -> None:
        for part, name in (("> 0", "late"), ("< 2", "early")):
            for topic in readers.TOPICS:
                messages = ds.messages(spark, sf_dir, topic)
                messages.where(f"pmod(xxhash64(message), 3) {part}").write.option("compression", "zstd").parquet(f"{path}/{name}/{topic}")
            batch.append_archive(spark, f"{path}/{name}", name, f"{path}/events", f"{path}/failures")

    stored = readers.read_events(
        spark, f"{ds.written_once(spark, sf_dir, 'slices', run)}/events", extra=[T.StructField("seq", ARRIVAL)])
    return stored.select(*EVENT_COLUMNS, F.col("seq.timestamp").alias("arrived"))


@query(f"""WITH {q.EVENTS}, d AS (SELECT CASE WHEN side = 'sell' THEN 'None' ELSE exchange END AS exchange, count(*) AS events FROM ev GROUP BY 1) SELECT * FROM d""")
def default_destination(spark, sf_dir):
    """Events without an exchange are stored under the name of the default destination."""
    nameless = ad.market_events(spark, sf_dir).withColumn("exchange", F.when(F.col("side") != "sell", F.col("exchange")))
    path = ds.written_once(spark, sf_dir, "nameless", lambda p: writers.write_events(nameless, p))
    return readers.read_events(spark, path).groupBy("exchange").agg(F.count("*").alias("events"))


# --- frames and labels -------------------------------------------------------------------------

_HOURLY = f"{q.EVENTS}, {q.trade_rows(HOUR)}, t AS (SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY window_end) AS pos FROM tf)"
_FRAME = ("window_end", "all_close_price", "all_volume")


def _hourly(spark, sf_dir):
    return rounded(ds.trade_rows(spark, sf_dir, "1h"))


_FILL = ("buy_close_price", "sell_close_price")


def _fill_sql(source: str) -> str:
    return ", ".join(f"last_value({c} IGNORE NULLS) OVER (PARTITION BY {KEYS} ORDER BY window_end) AS {c}" for c in _FILL) + f" FROM {source}"


@query(f"WITH {_HOURLY} SELECT {KEYS}, window_end, {_fill_sql('t')}")
def forward_fill(spark, sf_dir):
    filled = fr.forward_fill(fr.timeline(_hourly(spark, sf_dir)), _FILL)
    return filled.select(*INSTRUMENT, "window_end", *_FILL)


@query(f"WITH {_HOURLY}, kept AS (SELECT * FROM t WHERE pos > 150) SELECT {KEYS}, window_end, {_fill_sql('kept')}")
def drop_warm_up(spark, sf_dir):
    return fr.drop_warm_up(_hourly(spark, sf_dir), _FILL).select(*INSTRUMENT, "window_end", *_FILL)


def _frame_sql(rows: int, reach: int) -> str:
    """CTE `f`: the rows of each frame whose last needed row, ``reach`` on, exists."""
    return f"""cnt AS (SELECT {KEYS}, count(*) AS n FROM t GROUP BY {KEYS}),
f AS (SELECT s.{KEYS.replace(', ', ', s.')}, s.pos AS pos, s.pos - 1 AS start, g.pos - s.pos AS place, g.window_end, g.all_close_price, g.all_volume
  FROM t s JOIN cnt USING ({KEYS}) JOIN t g ON g.exchange = s.exchange AND g.base_asset = s.base_asset AND g.pos BETWEEN s.pos AND s.pos + {rows - 1}
  WHERE s.pos + {reach} <= n)"""


def _open_frame(df: DataFrame, *columns: str) -> DataFrame:
    opened = df.select(*INSTRUMENT, "start", *columns, F.posexplode("frame").alias("p", "e"))
    return opened.select(*INSTRUMENT, "start", *columns, F.col("p").cast("bigint").alias("place"), "e.*")


@query(f"WITH {_HOURLY}, {_frame_sql(90, 89)} SELECT {KEYS}, start, start // 5 AS batch, place, window_end, all_close_price, all_volume FROM f")
def frames(spark, sf_dir):
    return _open_frame(fr.frames(fr.timeline(_hourly(spark, sf_dir)), _FRAME, batch_size=5), "batch")


@query(f"""WITH {_HOURLY}, {_frame_sql(90, 91)}, p AS (SELECT {KEYS}, pos, lead(all_close_price, 90) OVER o AS current_price,
  lead(all_close_price, 91) OVER o AS next_price FROM t WINDOW o AS (PARTITION BY {KEYS} ORDER BY pos))
SELECT {KEYS}, start, current_price, next_price, place, window_end, all_close_price, all_volume FROM f JOIN p USING ({KEYS}, pos)""")
def frame_labels(spark, sf_dir):
    return _open_frame(fr.frame_labels(fr.timeline(_hourly(spark, sf_dir)), _FRAME), "current_price", "next_price")


@query(f"""WITH {_HOURLY.replace('t AS (', 't0 AS (')}, t AS (SELECT * REPLACE (lead(all_close_price) OVER o - all_close_price AS all_close_price,
    lead(all_volume) OVER o - all_volume AS all_volume) FROM t0 WINDOW o AS (PARTITION BY {KEYS} ORDER BY pos)
    QUALIFY lead(pos) OVER o IS NOT NULL),
{_frame_sql(90, 89)} SELECT {KEYS}, start, place, {q.rnd('all_close_price')}, {q.rnd('all_volume')} FROM f""")
def differenced_frames(spark, sf_dir):
    return _open_frame(fr.differenced_frames(fr.timeline(_hourly(spark, sf_dir)), _FRAME[1:]))


_PRICES = f"""p AS (SELECT {KEYS}, window_end, pos, all_close_price, lag(all_close_price) OVER o AS before,
  lead(all_close_price, 90) OVER o AS current_price, lead(all_close_price, 91) OVER o AS next_price FROM t
  WINDOW o AS (PARTITION BY {KEYS} ORDER BY pos))"""


@query(f"WITH {_HOURLY}, {_PRICES} SELECT {KEYS}, window_end, {q.rnd('next_price / current_price', 'price_relative')} FROM p WHERE next_price IS NOT NULL")
def price_relative(spark, sf_dir):
    return fr.price_relative(fr.timeline(_hourly(spark, sf_dir))).select(*INSTRUMENT, "window_end", "price_relative")


@query(f"WITH {_HOURLY}, {_PRICES} SELECT {KEYS}, window_end, all_close_price - before AS delta FROM p WHERE before IS NOT NULL")
def delta(spark, sf_dir):
    return fr.delta(fr.timeline(_hourly(spark, sf_dir)), "all_close_price").select(*INSTRUMENT, "window_end", "delta")


@query(f"""WITH {_HOURLY}, s AS (SELECT {KEYS}, window_end, count(*) OVER o AS bars, first_value(window_end) OVER o AS oldest, sum(all_close_price) OVER o AS total
  FROM t WINDOW o AS (PARTITION BY {KEYS} ORDER BY pos ROWS 299 PRECEDING))
SELECT {KEYS}, window_end, CAST(bars AS INTEGER) AS bars, oldest, {q.rnd('total')} FROM s""")
def bounded_series(spark, sf_dir):
    rows = fr.bounded_series(fr.timeline(_hourly(spark, sf_dir)), ["window_end", "all_close_price"])
    total = F.aggregate("series", F.lit(0.0), lambda acc, x: acc + x["all_close_price"])
    return rows.select(
        *INSTRUMENT, "window_end", F.size("series").alias("bars"), F.col("series")[0]["window_end"].alias("oldest"), total.alias("total")
    )


@query(f"""WITH {_HOURLY}, {_frame_sql(90, 91)}, g AS (SELECT {KEYS}, pos - 91 AS pos, window_end AS target_end, all_close_price AS target_price FROM t)
SELECT {KEYS}, start, target_end, target_price, place, window_end, all_close_price, all_volume FROM f JOIN g USING ({KEYS}, pos)""")
def observation_pairs(spark, sf_dir):
    pairs = fr.observation_pairs(fr.timeline(_hourly(spark, sf_dir)), _FRAME)
    named = pairs.withColumns({
        "target_end": F.col("target.window_end"), "target_price": F.col("target.all_close_price")
    })
    return _open_frame(named, "target_end", "target_price")


@query(f"""WITH {_HOURLY}, {_frame_sql(90, 89).split('f AS (')[0].rstrip().rstrip(',')},
c0 AS (SELECT {KEYS}, time - time % 21600000 + 21599999 AS window_end, price, time, seq FROM ev WHERE event_type = 'trade'),
c AS (SELECT {KEYS}, window_end, last(price ORDER BY time, seq) AS price, row_number() OVER (PARTITION BY {KEYS} ORDER BY window_end) AS pos FROM c0 GROUP BY {KEYS}, window_end),
s AS (SELECT t.{KEYS.replace(', ', ', t.')}, t.window_end, (SELECT count(*) FROM c WHERE c.exchange = t.exchange AND c.base_asset = t.base_asset AND c.window_end < t.window_end) + 1 AS first_at
  FROM t JOIN cnt USING ({KEYS}) WHERE t.pos + 89 <= n)
SELECT s.{KEYS.replace(', ', ', s.')}, s.window_end AS time, CAST(90 AS INTEGER) AS fine_rows, CAST(count(c.pos) AS INTEGER) AS coarse_rows, min(c.window_end) AS coarse_start, {q.rnd('sum(c.price)', 'coarse_total')}
FROM s LEFT JOIN c ON c.exchange = s.exchange AND c.base_asset = s.base_asset AND c.pos BETWEEN first_at AND first_at + 89
GROUP BY s.{KEYS.replace(', ', ', s.')}, s.window_end""")
def multi_resolution_frames(spark, sf_dir, page_rows=None):
    fine, coarse = _hourly(spark, sf_dir), ds.trade_rows(spark, sf_dir, "6h")
    rows = fr.multi_resolution_frames(fine, coarse, ["window_end", "all_close_price"], page_rows=page_rows)
    total = F.aggregate("coarse_frame", F.lit(None).cast("double"), lambda a, x: F.coalesce(a, F.lit(0.0)) + x["all_close_price"])
    return rows.select(
        *INSTRUMENT, "time", F.size("fine_frame").alias("fine_rows"), F.size("coarse_frame").alias("coarse_rows"),
        F.get("coarse_frame", F.lit(0))["window_end"].alias("coarse_start"), total.alias("coarse_total"),
    )


@query(f"WITH {_FEATURES} SELECT {KEYS}, window_end, {', '.join(PRESET_44)} FROM tf FULL JOIN bf USING ({KEYS}, window_end)")
def preset_44(spark, sf_dir):
    return fr.select_preset(ds.feature_rows(spark, sf_dir, "24h"), PRESET_44)


@query(f"WITH {_FEATURES} SELECT {KEYS}, window_end, {', '.join(PRESET_60)} FROM tf FULL JOIN bf USING ({KEYS}, window_end)")
def preset_60(spark, sf_dir):
    return fr.select_preset(ds.feature_rows(spark, sf_dir, "24h"), PRESET_60)


@query(f"""WITH {_FEATURES} SELECT {KEYS}, window_end, {', '.join(f'{c} AS "{older}"' for older, c in older_names(5).items())}
FROM tf FULL JOIN bf USING ({KEYS}, window_end)""")
def older_record(spark, sf_dir):
    return fr.to_older_names(ds.feature_rows(spark, sf_dir, "24h"), 5)


@query(f"WITH {q.EVENTS}, {q.trade_rows(DAY)} SELECT window_end, quote_asset, exchange, all_count FROM tf")
def reindexed(spark, sf_dir):
    rows = ds.trade_rows(spark, sf_dir, "24h").select(*INSTRUMENT, "window_end", "all_count")
    return fr.reindex(rows, ["window_end", "quote_asset"], ["base_asset"])


@query(f"WITH {q.EVENTS}, {q.trade_rows(DAY)} SELECT window_end, exchange, base_asset, all_count FROM tf ORDER BY window_end, exchange, base_asset")
def sorted_features(spark, sf_dir):
    rows = ds.trade_rows(spark, sf_dir, "24h").select("window_end", "exchange", "base_asset", "all_count")
    return rows.orderBy("window_end", "exchange", "base_asset")


# --- the same, with every key cut into pages as a hot key would be --------------------------------


@query(ORACLE["book_snapshots_carried"])
def book_snapshots_paged(spark, sf_dir):
    return ft.window_snapshots(ad.market_events(spark, sf_dir), "24h", 5, scope="instrument", page_rows=60)


@query(ORACLE["forward_fill"])
def forward_fill_paged(spark, sf_dir):
    filled = fr.forward_fill(fr.timeline(_hourly(spark, sf_dir), page_rows=50), _FILL)
    return filled.select(*INSTRUMENT, "window_end", *_FILL)


@query(ORACLE["frame_labels"])
def frame_labels_paged(spark, sf_dir):
    line = fr.timeline(_hourly(spark, sf_dir), page_rows=100)
    return _open_frame(fr.frame_labels(line, _FRAME), "current_price", "next_price")


@query(ORACLE["multi_resolution_frames"])
def multi_resolution_frames_paged(spark, sf_dir):
    return multi_resolution_frames(spark, sf_dir, page_rows=70)


@query(ORACLE["extended_block"])
def extended_block_paged(spark, sf_dir):
    trades = wn.tumbling(ev.of_type(ad.market_events(spark, sf_dir), TRADE), "24h")
    return ft.extended_stats(trades, [*INSTRUMENT, "window_end", "side"], ["time", "seq"], page_rows=10)


# --- portfolio ---------------------------------------------------------------------------------

_STEPS = f"""{q.EVENTS}, {q.trade_rows(DAY)},
a AS (SELECT exchange AS run, window_end AS step, CAST(substr(base_asset, 2) AS INTEGER) AS asset, all_volume AS weight, buy_count, sell_count,
    all_close_price / 1000 AS current_price, lead(all_close_price) OVER (PARTITION BY exchange, base_asset ORDER BY window_end) / 1000 AS next_price FROM tf),
s AS (SELECT * REPLACE (weight / sum(weight) OVER (PARTITION BY run, step) AS weight) FROM a WHERE next_price IS NOT NULL)"""


def _steps(spark, sf_dir, large: bool | None) -> DataFrame:
    """Each exchange's days as steps, its instruments as assets, weighted by traded volume."""
    daily = rounded(ds.trade_rows(spark, sf_dir, "24h"))
    ahead = od.plain(od.offsets(fr.timeline(daily, large=large), {"_next": ("all_close_price", 1)})).where("_next IS NOT NULL")
    rows = ahead.select(
        F.col("exchange").alias("run"), F.col("window_end").alias("step"),
        F.substring("base_asset", 2, 10).cast("int").alias("asset"), F.col("all_volume").alias("weight"),
        "buy_count", "sell_count", (F.col("all_close_price") / 1000).alias("current_price"), (F.col("_next") / 1000).alias("next_price"),
    )
    return pf.normalise_weights(rows, large=large)


def _large(spark, sf_dir) -> bool | None:
    """False if all stored rows together fit a task, so that no key has to be looked at; else unknown."""
    return None if ds.trade_rows(spark, sf_dir, "24h").count() > od.PAGE_ROWS else False


@query(f"WITH {_STEPS} SELECT run, step, asset, {q.rnd('weight')} FROM s")
def weights(spark, sf_dir):
    return _steps(spark, sf_dir, _large(spark, sf_dir)).select("run", "step", "asset", "weight")


@query(f"""WITH {_STEPS} SELECT run, step, {q.rnd("sum(CASE WHEN coalesce(sell_count, 0) > coalesce(buy_count, 0) THEN -weight ELSE weight END * (next_price - current_price))", 'pnl')} FROM s GROUP BY run, step""")
def pnl(spark, sf_dir):
    more_sells = F.coalesce("sell_count", F.lit(0)) > F.coalesce("buy_count", F.lit(0))
    rows = _steps(spark, sf_dir, _large(spark, sf_dir)).withColumns({
        "kind": F.when(more_sells, "short").otherwise("long"), "delta": F.col("next_price") - F.col("current_price"),
    })
    return pf.profit(pf.signed_weights(rows), ["run", "step"])


@query(f"WITH {_STEPS} SELECT run, step, asset, {q.rnd('next_price * weight / sum(next_price * weight) OVER (PARTITION BY run, step)', 'drifted')} FROM s")
def drifted_weights(spark, sf_dir):
    large = _large(spark, sf_dir)
    return pf.drifted_weights(_steps(spark, sf_dir, large), large).select("run", "step", "asset", "drifted")


_RETURNS = f"""{_STEPS},
h AS (SELECT *, next_price * weight / sum(next_price * weight) OVER (PARTITION BY run, step) AS drifted FROM s),
m AS (SELECT *, lag(drifted) OVER (PARTITION BY run, asset ORDER BY step) AS held, row_number() OVER (PARTITION BY run, asset ORDER BY step) AS pos FROM h),
r AS (SELECT run, step, sum(weight * (next_price - current_price)) + 1 AS free_return,
    CASE WHEN min(pos) = 1 THEN 1 ELSE 1 - (coalesce(sum(abs(weight - held)) FILTER (WHERE asset > 0), 0) * 0.0015 + 3.47222222e-7) END AS mu FROM m GROUP BY run, step)"""


@query(f"WITH {_RETURNS} SELECT run, step, {q.rnd('mu')} FROM r")
def turnover_cost(spark, sf_dir):
    large = _large(spark, sf_dir)
    return pf.turnover(_steps(spark, sf_dir, large), large=large)


@query(f"WITH {_RETURNS} SELECT run, step, {q.rnd('free_return')}, {q.rnd('mu')}, {q.rnd('free_return * mu', 'step_return')} FROM r")
def step_returns(spark, sf_dir):
    large = _large(spark, sf_dir)
    return pf.step_returns(_steps(spark, sf_dir, large), large=large)


@query(f"""WITH {_RETURNS}, x AS (SELECT run, avg(free_return * mu) AS mean, avg(ln(free_return * mu)) AS log_mean, avg(free_return) AS log_mean_free,
    stddev_pop(free_return * mu) AS std, product(free_return * mu) AS run_value FROM r GROUP BY run)
SELECT run, {q.rnd('mean')}, {q.rnd('log_mean')}, {q.rnd('log_mean_free')}, {q.rnd('std')}, {q.rnd('(mean - 1) / std', 'sharpe')}, {q.rnd('run_value')},
  {q.rnd('-log_mean', 'loss')}, {q.rnd('exp(sum(ln(run_value)) OVER (ORDER BY run))', 'value')} FROM x""")
def run_summary(spark, sf_dir):
    large = _large(spark, sf_dir)
    return pf.run_summary(pf.step_returns(_steps(spark, sf_dir, large), large=large), large=large)


@query(f"""WITH {_STEPS}, d AS (SELECT run, step, max(weight) FILTER (WHERE asset = 0) AS w0, max(weight) FILTER (WHERE asset = 1) AS w1 FROM s GROUP BY run, step)
SELECT run, step, {q.rnd('0.75 - w0', 'd0')}, {q.rnd('0.25 - w1', 'd1')} FROM d""")
def portfolio_delta(spark, sf_dir):
    rows = _steps(spark, sf_dir, _large(spark, sf_dir)).groupBy("run", "step").agg(
        *[F.max(F.when(F.col("asset") == i, F.col("weight"))).alias(f"w{i}") for i in (0, 1)]
    )
    target = F.array(F.lit(0.75), F.lit(0.25))
    moved = rows.withColumn("d", pf.portfolio_delta(target, F.array("w0", "w1")))
    return moved.select("run", "step", F.col("d")[0].alias("d0"), F.col("d")[1].alias("d1"))


# --- streams over the same events, run to the end of their input --------------------------------

_CLOSED = "WHERE window_end < (SELECT max(time) FROM ev WHERE event_type = 'trade') - 1"


def _event_stream(spark, sf_dir):
    path = ds.event_files(spark, sf_dir)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


@query(f"""WITH {q.EVENTS}, {q.trade_rows(DAY)} SELECT exchange, base_asset, CAST(window_end AS VARCHAR) AS window_end, CAST(all_count AS VARCHAR) AS all_count
FROM tf {_CLOSED}""")
def published_features(spark, sf_dir):
    """Streamed feature rows as the strings of a message bus."""
    def run(path: str) -> None:
        rows = jobs.trade_feature_stream(_event_stream(spark, sf_dir), "24h", order=["time", "seq"])
        jobs.publish(rows, path, f"{path}-state").awaitTermination()

    fields = ("exchange", "base_asset", "window_end", "all_count")
    text = spark.read.text(ds.written_once(spark, sf_dir, "published", run))
    return text.select(*[F.get_json_object("value", f"$.{f}").alias(f) for f in fields])


@query(f"WITH {q.EVENTS}, {q.trade_rows(DAY)} SELECT * FROM tf {_CLOSED}")
def streamed_trade_features(spark, sf_dir):
    """Windows the watermark has passed; the last one stays open."""
    def run(path: str) -> None:
        rows = jobs.trade_feature_stream(_event_stream(spark, sf_dir), "24h", order=["time", "seq"])
        started = (
            rows.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{path}-state")
            .trigger(availableNow=True).start(path)
        )
        started.awaitTermination()

    return spark.read.parquet(ds.written_once(spark, sf_dir, "stream-trades", run))


def _last_time(rows) -> int:
    return rows.agg(F.max("time")).first()[0]


def _feed(spark, sf_dir, rows, path):
    """``rows`` as a stream of files under ``path``, and a call that ends it after its last event."""
    rows.write.parquet(path)
    schema = rows.schema
    lateness = 300_000  # that of `ingest`

    def end() -> None:
        store.heartbeat(spark, path, _last_time(spark.read.schema(schema).parquet(path)) + lateness, schema)

    return lambda: spark.readStream.schema(schema).parquet(path), end


@query(f"""WITH {_FEATURES} SELECT {KEYS}, window_end, CAST(86400 AS BIGINT) AS interval, {_BLOCK_SQL} FROM tf FULL JOIN bf USING ({KEYS}, window_end)""")
def streamed_window_features(spark, sf_dir):
    """Ingest with deduplication, then feature rows of all windows: the feed's end closes the last ones."""
    def run(path: str) -> None:
        stream, end = _feed(spark, sf_dir, ad.market_events(spark, sf_dir), f"{path}/in")
        options = {"order": ["time", "seq"], "seq": T.LongType()}
        for step in ("events", "end"):
            jobs.ingest(stream(), f"{path}/events", f"{path}-ingest").awaitTermination()
            if step == "end":
                jobs.end_windows(spark, f"{path}/events", _last_time(ad.market_events(spark, sf_dir)) + DAY)
            jobs.feature_job(spark, f"{path}/events", f"{path}/rows", f"{path}-features", "24h", **options).awaitTermination()
            end()

    path = ds.written_once(spark, sf_dir, "stream-features", run)
    return spark.read.parquet(f"{path}/rows").select(*feature_columns(DEFAULT_LEVELS))


@query(f"WITH {_TWO_FEEDS} SELECT {EVENT_SQL}, min(seq) AS seq FROM feed GROUP BY {EVENT_SQL}")
def streamed_distinct_events(spark, sf_dir):
    """Trades that arrive twice, the later copy first, deduplicated and stored by the ingest stream, then compacted.
    Events wait until the watermark passes them; the end of the feed lets the last ones go."""
    def run(path: str) -> None:
        late = _two_feeds(spark, sf_dir).where("event_type = 'trade'").withColumn("seq", F.col("seq") + 1_000_000_000)
        stream, end = _feed(spark, sf_dir, late.unionByName(_two_feeds(spark, sf_dir)), f"{path}/in")
        for _ in range(2):
            jobs.ingest(stream(), f"{path}/out", f"{path}-state").awaitTermination()
            end()
        store.compact(spark, f"{path}/out", "2024-01-15", T.LongType())  # one half of the days

    path = ds.written_once(spark, sf_dir, "stream-distinct", run)
    return store.read_store(spark, f"{path}/out", T.LongType()).select(*EVENT_COLUMNS, "seq")


@query(f"WITH {q.EVENTS}, {q.snapshots(None, 5)} SELECT {KEYS}, time - time % {DAY} + {DAY - 1} AS window_end, pos, time, side, level, price, quantity FROM snap")
def streamed_books_carried(spark, sf_dir):
    """Books that go on from window to window, over several closings of one stream."""
    def run(path: str) -> None:
        events = ad.market_events(spark, sf_dir)
        stream, end = _feed(spark, sf_dir, events, f"{path}/in")
        for step in ("events", "end"):
            jobs.ingest(stream(), f"{path}/events", f"{path}-ingest").awaitTermination()
            if step == "end":
                jobs.end_windows(spark, f"{path}/events", _last_time(events) + DAY)
            jobs.carried_books(
                spark, f"{path}/events", f"{path}/books", f"{path}-books", "24h", order=["time", "seq"], seq=T.LongType()
            ).awaitTermination()
            end()

    path = ds.written_once(spark, sf_dir, "stream-books", run)
    return spark.read.parquet(f"{path}/books/rows").drop("batch")


def _intake(spark, sf_dir) -> str:
    """The archive's messages as a stream: taken in, ended, deduplicated and stored."""
    def run(path: str) -> None:
        source, taken = ds.archive(spark, sf_dir), f"{path}/taken"
        query = intake.intake(spark, source, taken, f"{path}-intake")
        query.awaitTermination()
        records = intake.record_stream(spark, taken)
        jobs.ingest(records, f"{path}/events", f"{path}-ingest", period="yyyy-MM").awaitTermination()
        last = _last_time(intake.events_of_records(spark.read.schema(intake.RECORDS).parquet(f"{taken}/records/*")))
        intake.end_feed(spark, taken, query.lastProgress["batchId"], last + 300_000)
        jobs.ingest(records, f"{path}/events", f"{path}-ingest", period="yyyy-MM").awaitTermination()

    return ds.written_once(spark, sf_dir, "stream-intake", run)


@query(f"""WITH {_ARRIVED} SELECT {EVENT_SQL}, min(arrived) AS arrived FROM arrived GROUP BY {EVENT_SQL}""")
def streamed_intake(spark, sf_dir):
    """Messages of both topics through the streams to stored events, each with its earliest arrival."""
    events = store.read_store(spark, f"{_intake(spark, sf_dir)}/events")
    return events.select(*EVENT_COLUMNS, F.col("seq.timestamp").alias("arrived"))


@query(f"""SELECT error_class, source, count(*) AS failures FROM ({ORACLE['parse_failures']}) GROUP BY 1, 2""")
def streamed_dead_letters(spark, sf_dir):
    """Failures of the same stream, from the same parse."""
    failed = intake.read_failures(spark, f"{_intake(spark, sf_dir)}/taken")
    return failed.groupBy("error_class", "source").agg(F.count("*").alias("failures"))


@query(f"""WITH {_ARCHIVED}, b AS (SELECT max(time) - 604800000 AS bound FROM px WHERE event_id % 2 = 0)
SELECT CASE WHEN event_id % 2 = 1 AND time <= bound THEN 'late' ELSE 'kept' END AS outcome, side, count(*) AS events FROM px, b GROUP BY ALL""")
def streamed_late_events(spark, sf_dir):
    """Trades of odd ids come after all others: those a week or more behind the latest are late, and counted."""
    def run(path: str) -> None:
        messages = ds.messages(spark, sf_dir, "trades")
        for rest in (0, 1):
            messages.where(F.element_at("attributes", "id").cast("bigint") % 2 == rest).write.mode("append").parquet(f"{path}/in/trades")
            intake.intake(
                spark, f"{path}/in", f"{path}/taken", f"{path}-intake", lateness="168h", topics=["trades"]
            ).awaitTermination()

    taken = f"{ds.written_once(spark, sf_dir, 'stream-late', run)}/taken"
    kept = intake.events_of_records(spark.read.schema(intake.RECORDS).parquet(f"{taken}/records/*")).select(
        F.lit("kept").alias("outcome"), "side")
    late = intake.read_failures(spark, taken).where(F.col("error_class") == intake.LATE).select(
        F.lit("late").alias("outcome"), F.get_json_object("payload", "$.side").alias("side"))
    return kept.unionByName(late).groupBy("outcome", "side").agg(F.count("*").alias("events"))
