"""Fixture events and a plain replay of the book, written for reading, not for speed."""

from __future__ import annotations

import random

SCHEMA = (
    "event_type string, exchange string, quote_asset string, base_asset string, "
    "time bigint, quantity double, price double, side string, seq bigint"
)

# (seconds, quantity, price, side) in arrival order; 2-minute windows, epoch based.
STREAM = [
    (7, 30, 12.5, "sell"), (81, 8, 10.5, "buy"), (81, 2, 11, "buy"),
    (31, 4, 9, "bid"), (31, 6, 8, "bid"), (75, 2.5, 9.5, "bid"), (75, 3, 8.5, "bid"), (75, 0, 9, "bid"),
    (44, 5, 11, "ask"), (44, 7, 12, "ask"), (93, 1.5, 10.75, "ask"), (93, 0, 12, "ask"), (93, 0, 11, "ask"),
    (203, 2, 9.25, "bid"), (211, 12, 10, "buy"), (238, 4, 10.25, "sell"),
]


def stream_rows():
    return [
        ("trade" if side in ("buy", "sell") else "levelUpdate", "north", "QQ", "ZED",
         seconds * 1000, float(q), float(p), side, seq)
        for seq, (seconds, q, p, side) in enumerate(STREAM)
    ]


def random_updates(n, seed, instruments=2, prices=15, span=4_000, odd_side=0.02):
    r = random.Random(seed)
    rows = []
    for seq in range(n):
        side = "other" if r.random() < odd_side else r.choice(["ask", "bid"])
        quantity = 0.0 if r.random() < 0.3 else round(r.uniform(0.5, 9), 2)
        rows.append((
            "levelUpdate", "ex", "USDT", f"A{min(r.randrange(instruments * 3), instruments - 1)}",
            r.randrange(span), quantity, float(100 + r.randrange(prices)), side, seq,
        ))
    return rows


def plain_replay(rows, window=None, levels=None):
    """[(base, window_end, pos, time, side, level, price, quantity)] of every snapshot."""
    groups = {}
    for row in rows:
        end = None if window is None else row[4] - row[4] % window + window - 1
        groups.setdefault((row[3], end), []).append(row)
    out = []
    for (base, end), updates in groups.items():
        book = {"ask": {}, "bid": {}}
        for pos, u in enumerate(sorted(updates, key=lambda u: (u[4], u[8])), 1):
            if u[7] in book:
                if u[5] < 1e-9:
                    book[u[7]].pop(u[6], None)
                else:
                    book[u[7]][u[6]] = u[5]
            for side, down in (("ask", False), ("bid", True)):
                for level, (p, q) in enumerate(sorted(book[side].items(), reverse=down)[:levels]):
                    out.append((base, end, pos, u[4], side, level, p, q))
    return out
