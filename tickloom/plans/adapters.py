"""Market-shaped rows derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.schemas import LEVEL_UPDATE, TRADE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows over all cores: the small tables come in one or two row groups.

    By hash and not in turns, which would sort all rows first. A table of as many pieces as cores is left as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores, *rows.columns)


def utc_instant(column: str) -> Column:
    """The tables hold wall-clock times without a zone; they are read as UTC."""
    return F.from_utc_timestamp(F.col(column).cast("timestamp"), F.current_timezone())


def _millis(column: str) -> Column:
    return F.unix_millis(utc_instant(column))


def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as trades (purchase, click), level updates (view, signup) and events of no known type (error)."""
    known = _as_events(table(spark, sf_dir, "events"))
    kind = F.when(F.col("_kind") == "error", "heartbeat").otherwise(F.col("event_type"))
    return known.withColumn("event_type", kind).withColumn("side", F.when(F.col("_kind") != "error", F.col("side"))).drop("_kind")


def market_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as trades (purchase, click) and level updates (view, signup); errors are left out."""
    return _as_events(table(spark, sf_dir, "events").where("event_type <> 'error'")).drop("_kind")


def _as_events(e: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    is_trade = kind.isin("purchase", "click")
    k = F.get_json_object("props", "$.k").cast("int")
    side = (
        F.when(kind == "purchase", "buy").when(kind == "click", "sell").when(kind == "view", "ask").otherwise("bid")
    )
    deleted = ~is_trade & (F.col("event_id") % 3 == 0)
    return e.select(
        F.when(is_trade, TRADE).otherwise(LEVEL_UPDATE).alias("event_type"),
        F.concat(F.lit("ex"), (F.col("user_id") % 2).cast("string")).alias("exchange"),
        F.lit("USDT").alias("quote_asset"),
        F.concat(F.lit("A"), (F.col("user_id") % 3).cast("string")).alias("base_asset"),
        _millis("ts").alias("time"),
        F.when(deleted, F.lit(0.0)).otherwise(F.col("value")).alias("quantity"),
        (F.lit(100) + k % 20).cast("double").alias("price"),
        side.alias("side"),
        F.col("event_id").alias("seq"), kind.alias("_kind"),
    )


def lineitem_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as trades, one instrument per supplier; flag N is a side of its own."""
    li = table(spark, sf_dir, "lineitem")
    side = F.when(F.col("l_returnflag") == "A", "buy").when(F.col("l_returnflag") == "R", "sell").otherwise("other")
    return li.select(
        F.lit(TRADE).alias("event_type"), F.lit("li").alias("exchange"), F.lit("USD").alias("quote_asset"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("base_asset"),
        _millis("l_shipdate").alias("time"),
        F.col("l_extendedprice").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        side.alias("side"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice").alias("seq"),
    )


def lineitem_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as updates of eight deep books: 400 prices per side, a tenth of them deletes."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.lit(LEVEL_UPDATE).alias("event_type"), F.lit("li").alias("exchange"), F.lit("USD").alias("quote_asset"),
        F.concat(F.lit("B"), (F.col("l_suppkey") % 8).cast("string")).alias("base_asset"),
        _millis("l_shipdate").alias("time"),
        F.when(F.col("l_quantity") <= 5, F.lit(0.0)).otherwise(F.col("l_quantity")).alias("quantity"),
        (F.lit(100) + F.col("l_partkey") % 400).cast("double").alias("price"),
        F.when(F.col("l_linenumber") % 2 == 0, "ask").otherwise("bid").alias("side"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice").alias("seq"),
    )


def trade_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of raw trade JSON made from `events`, raw (not notional) quantities.

    Errors become broken messages, by `event_id`: cut-off text, no price, a word for a price.
    Some prices are numeric strings, which are fine.
    """
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "click", "error"))
    e = spread(e.select("event_id", "ts", "user_id", "event_type", "value", "props"))
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    price = (F.lit(100) + k % 20).cast("string")
    text = F.when(
        F.col("event_type") != "error", F.when(eid % 2 == 0, price).otherwise(F.concat(F.lit('"'), price, F.lit('"')))
    ).when(eid % 3 == 1, F.lit("null")).otherwise(F.lit('"abc"'))
    message = F.concat(
        F.lit('{"exchange": "ex'), (F.col("user_id") % 2).cast("string"),
        F.lit('", "quote_asset": "USDT", "base_asset": "A'), (F.col("user_id") % 3).cast("string"),
        F.lit('", "event_type": "trade", "event_time_ms": '), _millis("ts").cast("string"),
        F.lit(', "quantity": '), F.round(F.col("value") * 100).cast("bigint").cast("string"),
        F.lit(', "price": '), text,
        F.lit(', "side": "'), F.when(F.col("event_type") == "purchase", "buy").otherwise("sell"),
        F.lit('", "__faust": {"ns": "Trade"}}'),
    )
    broken = (F.col("event_type") == "error") & (eid % 3 == 0)
    body = F.when(broken, F.lit("{bad")).otherwise(message)
    return e.select(
        F.encode(body, "UTF-8").alias("message"),
        F.create_map(F.lit("id"), eid.cast("string")).alias("attributes"),
        eid.alias("timestamp"),
    )


def depth_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of raw depth JSON, one per line item, with 0 to 2 levels per side.

    Quantity 50 makes the second ask's price a word; line 7 has no `bids` field; line 6 of
    status O has no exchange.
    """
    li = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_linestatus", "l_shipdate"))
    base = F.lit(100) + F.col("l_partkey") % 400
    quantity = F.col("l_quantity").cast("bigint")

    def side(count: Column, sign: int, bad: Column) -> Column:
        def level(i: Column) -> Column:
            price = (base + sign * i).cast("string")
            return F.concat(
                F.lit('{"price": '), F.when(bad & (i == 2), F.lit('"abc"')).otherwise(price),
                F.lit(', "quantity": "'), (quantity + i).cast("string"), F.lit('", "num_orders": 1}'),
            )

        numbers = F.filter(F.array(F.lit(1), F.lit(2)), lambda i: i <= count)
        return F.concat(F.lit("["), F.array_join(F.transform(numbers, level), ", "), F.lit("]"))

    asks = side(F.col("l_linenumber") % 3, 1, F.col("l_quantity") == 50)
    bids = side(quantity % 3, -1, F.lit(False))
    nameless = (F.col("l_linenumber") == 6) & (F.col("l_linestatus") == "O")
    message = F.concat(
        F.lit("{"), F.when(nameless, F.lit("")).otherwise(F.lit('"exchange": "li", ')),
        F.lit('"quote_asset": "USD", "base_asset": "C'), (F.col("l_suppkey") % 10).cast("string"),
        F.lit('", "event_time_ms": "'), _millis("l_shipdate").cast("string"), F.lit('", asks: '), asks,
        F.when(F.col("l_linenumber") == 7, F.lit("")).otherwise(F.concat(F.lit(', "bids": '), bids)),
        F.lit(', "checksum": 1}'),
    )
    return li.select(
        F.encode(message, "UTF-8").alias("message"),
        F.create_map(F.lit("id"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", quantity)).alias("attributes"),
        F.col("l_orderkey").alias("timestamp"),
    )
