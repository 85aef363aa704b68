"""Record layouts, label and column generators, feature presets."""

from __future__ import annotations

from pyspark.sql import types as T

TRADE = "trade"
LEVEL_UPDATE = "levelUpdate"

INSTRUMENT = ("exchange", "quote_asset", "base_asset")
PARTITION = ("exchange", "quote_asset", "base_asset", "event_type")
EVENT_COLUMNS = (
    "event_type", "exchange", "quote_asset", "base_asset", "time", "quantity", "price", "side",
)
# `time` alone leaves ties open; `seq` is the arrival order that settles them.
EVENT_ORDER = ("time", "seq")

# Arrival of a parsed event: when its message came, which message it was (its id, and a hash of its text
# for messages without one), and its place in the message.
ARRIVAL = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("message_id", T.StringType()),
    T.StructField("message_key", T.LongType()),
    T.StructField("position", T.IntegerType()),
])

ENVELOPE = T.StructType([
    T.StructField("message", T.BinaryType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    T.StructField("timestamp", T.LongType()),
])

EVENT = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("quote_asset", T.StringType()),
    T.StructField("base_asset", T.StringType()),
    T.StructField("time", T.LongType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("side", T.StringType()),
])

FAILURE = T.StructType([
    T.StructField("error_class", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

# Numbers are declared STRING: a numeric string is as good as a number, and DOUBLE would
# turn it into NULL. Fields not named here (the framework metadata among them) are dropped.
_HEADER = "exchange STRING, quote_asset STRING, base_asset STRING, event_time_ms STRING"
TRADE_JSON = f"{_HEADER}, price STRING, quantity STRING, side STRING"
LEVELS_JSON = "ARRAY<STRUCT<price: STRING, quantity: STRING>>"
DEPTH_JSON = f"{_HEADER}, asks {LEVELS_JSON}, bids {LEVELS_JSON}"

LEVEL_CSV = "time BIGINT, price DOUBLE, quantity DOUBLE, side STRING"
TRADE_EXTRACT = "time BIGINT, side STRING, quantity DOUBLE, price DOUBLE"

# The measures of one statistic block, in output order.
MEASURES = (
    "count", "volume",
    "open_quantity", "close_quantity", "high_quantity", "low_quantity", "mean_quantity", "std_quantity",
    "open_price", "close_price", "high_price", "low_price", "mean_price", "std_price",
    "vwap",
)
TRADE_LABELS = ("all", "buy", "sell")
CONTROL_COLUMNS = (*INSTRUMENT, "window_end", "interval")
DEFAULT_LEVELS = 5


def book_labels(levels: int = DEFAULT_LEVELS) -> list[str]:
    return [f"{side}_{i}" for side in ("ask", "bid") for i in range(levels)]


def block_columns(labels) -> list[str]:
    return [f"{label}_{measure}" for label in labels for measure in MEASURES]


def feature_columns(levels: int = DEFAULT_LEVELS) -> list[str]:
    return [*CONTROL_COLUMNS, *block_columns([*TRADE_LABELS, *book_labels(levels)])]


def feature_schema(levels: int = DEFAULT_LEVELS) -> T.StructType:
    fields = [T.StructField(c, T.StringType(), False) for c in INSTRUMENT]
    fields += [T.StructField(c, T.LongType(), False) for c in ("window_end", "interval")]
    for name in block_columns([*TRADE_LABELS, *book_labels(levels)]):
        kind = T.LongType() if name.endswith("_count") else T.DoubleType()
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


_BARS = ("close_price", "high_price", "mean_price", "low_price")


def _paired(levels: int) -> list[str]:
    return [f"{side}_{i}" for i in range(levels) for side in ("ask", "bid")]


# The two feature selections of the training notebooks: 44 and 60 columns.
PRESET_44 = [f"{label}_{m}" for label in ("all", "sell", "buy", *_paired(4)) for m in _BARS]
PRESET_60 = [
    f"{label}_{m}" for label in ("all", "sell", "buy")
    for m in (*_BARS, "low_quantity", "mean_quantity", "vwap", "std_price")
] + [f"{label}_{m}" for label in _paired(3) for m in (*_BARS, "vwap", "std_price")]

# The twelve measures of the older feature record, in its order.
_OLDER = ("count", *[f"{stat}_{field}" for field in ("price", "quantity") for stat in ("close", "high", "low", "mean", "std")], "vwap")
_OLDER_FIELDS = {"price": "Price", "quantity": "Qty"}


def older_names(levels: int = 10) -> dict[str, str]:
    """Names of the older feature record (252 at ten levels) and the columns they stand for."""
    names = {}
    for label in ("all", *book_labels(levels)):
        for measure in _OLDER:
            stat, _, field = measure.partition("_")
            older = stat + _OLDER_FIELDS.get(field, "")
            names[older if label == "all" else f"{label}_{older}"] = f"{label}_{measure}"
    return names


# The statistics of the extended block, applied to price and quantity.
EXTENDED_STATS = ("mean", "median", "skew", "std", "min", "max", "mad", "first", "last")
EXTENDED_MEASURES = ("count_price", "sum_quantity") + tuple(
    f"{stat}_{field}" for stat in EXTENDED_STATS for field in ("price", "quantity")
)


def extended_columns(levels: int = 10) -> list[str]:
    """The 442-name vocabulary (at ten levels): book, trade sides, close price and spread."""
    names = ["close_price"]
    for side in ("ask", "bid"):
        names += [f"{side}_{m}_{i}" for m in EXTENDED_MEASURES for i in range(levels)]
    names += [f"{m}_{side}" for m in EXTENDED_MEASURES for side in ("buy", "sell")]
    return [*names, "spread"]
