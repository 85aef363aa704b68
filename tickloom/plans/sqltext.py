"""SQL text for checking the queries against another engine: shared parts.

The statements read the same tables and state the same semantics independently: the book by live
ranges of writes, ordered picks by ordered aggregates.
"""

from __future__ import annotations

from tickloom.schemas import MEASURES, book_labels

KEYS = "exchange, quote_asset, base_asset"

EVENTS = """ev AS (
  SELECT CASE WHEN event_type IN ('purchase', 'click') THEN 'trade' ELSE 'levelUpdate' END AS event_type,
         'ex' || CAST(user_id % 2 AS VARCHAR) AS exchange, 'USDT' AS quote_asset,
         'A' || CAST(user_id % 3 AS VARCHAR) AS base_asset, epoch_us(ts) // 1000 AS time,
         CASE WHEN event_type IN ('view', 'signup') AND event_id % 3 = 0 THEN 0.0 ELSE value END AS quantity,
         CAST(100 + CAST(json_extract_string(props, '$.k') AS INTEGER) % 20 AS DOUBLE) AS price,
         CASE event_type WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'sell' WHEN 'view' THEN 'ask' ELSE 'bid' END AS side,
         event_id AS seq
  FROM events WHERE event_type <> 'error')"""

LINEITEM_TRADES = """ev AS (
  SELECT 'trade' AS event_type, 'li' AS exchange, 'USD' AS quote_asset, 'S' || CAST(l_suppkey AS VARCHAR) AS base_asset,
         epoch_us(l_shipdate) // 1000 AS time, l_extendedprice AS quantity, l_extendedprice / l_quantity AS price,
         CASE l_returnflag WHEN 'A' THEN 'buy' WHEN 'R' THEN 'sell' ELSE 'other' END AS side,
         ROW(l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) AS seq
  FROM lineitem)"""

LINEITEM_UPDATES = """ev AS (
  SELECT 'levelUpdate' AS event_type, 'li' AS exchange, 'USD' AS quote_asset, 'B' || CAST(l_suppkey % 8 AS VARCHAR) AS base_asset,
         epoch_us(l_shipdate) // 1000 AS time, CASE WHEN l_quantity <= 5 THEN 0.0 ELSE l_quantity END AS quantity,
         CAST(100 + l_partkey % 400 AS DOUBLE) AS price, CASE WHEN l_linenumber % 2 = 0 THEN 'ask' ELSE 'bid' END AS side,
         ROW(l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) AS seq
  FROM lineitem)"""


def rnd(expression: str, name: str | None = None) -> str:
    """Six places; the shift keeps exact halves (means of 32 two-place values) off the last bit."""
    return f"round({expression} + 1e-9, 6) AS {name or expression}"


def block(label: str, where: str | None = None, order: str = "time, seq") -> str:
    f = f" FILTER (WHERE {where})" if where else ""
    parts = [f"nullif(count(*){f}, 0) AS {label}_count", rnd(f"sum(quantity){f}", f"{label}_volume")]
    for c in ("quantity", "price"):
        for name, expression in (
            ("open", f"first({c} ORDER BY {order}){f}"), ("close", f"last({c} ORDER BY {order}){f}"),
            ("high", f"max({c}){f}"), ("low", f"min({c}){f}"), ("mean", f"avg({c}){f}"), ("std", f"stddev_samp({c}){f}"),
        ):
            parts.append(rnd(expression, f"{label}_{name}_{c}"))
    parts.append(rnd(f"sum(price * quantity){f} / nullif(sum(quantity){f}, 0)", f"{label}_vwap"))
    return ",\n  ".join(parts)


def windowed(millis: int, name: str = "w", source: str = "ev") -> str:
    return f"{name} AS (SELECT *, time - time % {millis} + {millis - 1} AS window_end FROM {source})"


def trade_blocks() -> str:
    return ",\n  ".join([block("all"), block("buy", "side = 'buy'"), block("sell", "side = 'sell'")])


def trade_rows(millis: int, name: str = "tf") -> str:
    """CTEs `w` and `name`: trade blocks per window of the CTE `ev`."""
    return (
        f"{windowed(millis)},\n{name} AS (SELECT {KEYS}, window_end, {trade_blocks()} FROM w "
        f"WHERE event_type = 'trade' GROUP BY {KEYS}, window_end)"
    )


def snapshots(millis: int | None, levels: int | None) -> str:
    """CTEs up to `snap`: the top levels after every update, by live ranges of the writes."""
    group = KEYS if millis is None else f"{KEYS}, window_end"
    source = "ev" if millis is None else "bw"
    head = "" if millis is None else windowed(millis, "bw") + ",\n"
    limit = "" if levels is None else f" WHERE r <= {levels}"
    return f"""{head}upd AS (
  SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY time, seq) AS pos, count(*) OVER (PARTITION BY {group}) AS n
  FROM {source} WHERE event_type = 'levelUpdate'),
writes AS (
  SELECT *, lead(pos) OVER (PARTITION BY {group}, side, price ORDER BY pos) AS nxt FROM upd WHERE side IN ('ask', 'bid')),
live AS (
  SELECT {group}, side, price, quantity, unnest(generate_series(pos, coalesce(nxt, n + 1) - 1)) AS pos
  FROM writes WHERE quantity >= 1e-9),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {group}, pos, side ORDER BY CASE side WHEN 'ask' THEN price ELSE -price END) AS r
  FROM live),
snap AS (
  SELECT {', '.join('k.' + c.strip() for c in group.split(','))}, k.pos, u.time, k.side, CAST(k.r - 1 AS INTEGER) AS level, k.price, k.quantity
  FROM ranked k JOIN upd u USING ({group}, pos){limit})"""


def level_rows(millis: int, levels: int) -> str:
    """CTEs up to `bl`: the 15 measures per window, side and level."""
    plain = block("x", None, "pos").replace("AS x_", "AS ")
    return (
        f"{snapshots(millis, levels)},\nbl AS (SELECT {KEYS}, window_end, side, level, {plain} FROM snap "
        f"GROUP BY {KEYS}, window_end, side, level)"
    )


def wide_book(levels: int, name: str = "bf") -> str:
    """CTE `name`: `bl` turned into one row per window."""
    picks = ", ".join(
        f"max({m}) FILTER (WHERE side = '{label.split('_')[0]}' AND level = {label.split('_')[1]}) AS {label}_{m}"
        for label in book_labels(levels) for m in MEASURES
    )
    return f"{name} AS (SELECT {KEYS}, window_end, {picks} FROM bl GROUP BY {KEYS}, window_end)"
