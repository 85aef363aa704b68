import pytest
from market import SCHEMA, plain_replay, random_updates, stream_rows

from tickloom.operators.book import message_books, replay_book, running_state, side_levels
from tickloom.operators.features import book_features, window_features, window_snapshots
from tickloom.operators.versions import book_versions, books_at
from tickloom.schemas import MEASURES, feature_columns


def _rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("page_rows", [None, 37])
@pytest.mark.parametrize("levels", [3, 5])
def test_snapshots_equal_plain_replay(spark, page_rows, levels):
    rows = random_updates(600, seed=levels)
    got = window_snapshots(
        spark.createDataFrame(rows, SCHEMA), "1s", levels, page_rows=page_rows
    )
    columns = ("base_asset", "window_end", "pos", "time", "side", "level", "price", "quantity")
    assert _rows(got, *columns) == sorted(plain_replay(rows, 1000, levels))


@pytest.mark.parametrize("page_rows", [None, 50])
def test_book_carried_over_windows(spark, page_rows):
    rows = random_updates(400, seed=9)
    got = window_snapshots(spark.createDataFrame(rows, SCHEMA), "1s", 4, scope="instrument", page_rows=page_rows)
    want = sorted((b, p, t, s, lv, pr, q) for b, _, p, t, s, lv, pr, q in plain_replay(rows, None, 4))
    assert _rows(got, "base_asset", "pos", "time", "side", "level", "price", "quantity") == want


def test_one_hot_instant(spark):
    """All updates of one key at one time: pages still split, order is by arrival."""
    rows = [r[:4] + (7,) + r[5:] for r in random_updates(500, seed=4, instruments=1)]
    got = window_snapshots(spark.createDataFrame(rows, SCHEMA), "1s", 5, page_rows=40)
    want = sorted((p, s, lv, pr, q) for _, _, p, _, s, lv, pr, q in plain_replay(rows, 1000, 5))
    assert _rows(got, "pos", "side", "level", "price", "quantity") == want


def test_running_state(spark):
    df = spark.createDataFrame([("hi", 1.0, 1.0, 0), ("hi", 2.0, 1.0, 1)], "k string, price double, quantity double, n int")
    got = {r["pos"]: r["state"] for r in running_state(df, ["k"], ["n"]).collect()}
    assert got == {1: {1.0: 1.0}, 2: {1.0: 1.0, 2.0: 1.0}}


@pytest.mark.parametrize("page_rows", [None, 20])
def test_message_books(spark, page_rows):
    rows = random_updates(120, seed=3, instruments=1, odd_side=0)
    rows = [r[:4] + (r[8] // 4,) + r[5:] for r in rows]  # four updates per message
    df = spark.createDataFrame(rows, SCHEMA)
    got = replay_book(df, ["base_asset"], None, last_of=["time"], page_rows=page_rows).withColumns(
        {"asks": side_levels(ask=True), "bids": side_levels(ask=False)}
    )
    want = {}
    for _, _, pos, time, side, _, p, q in plain_replay(rows):
        if pos % 4 == 0:
            want.setdefault(time, {"ask": [], "bid": []})[side].append((p, q))
    seen = {r["time"]: {"ask": [tuple(x) for x in r["asks"]], "bid": [tuple(x) for x in r["bids"]]} for r in got.collect()}
    assert seen == want
    assert message_books(df, ["base_asset"], ["time"]).count() == 30


GOLDEN = {  # count, volume, open_q, close_q, high_q, low_q, mean_q, std_q, open_p .. vwap
    "ask_0": (8, 29.5, 5, 1.5, 5, 1.5, 3.6875, 1.8114220933, 11, 10.75, 11, 10.75, 10.90625, 0.1293872924, 10.9618644068),
    "ask_1": (6, 38, 7, 5, 7, 5, 6.3333333333, 1.032795559, 12, 11, 12, 11, 11.6666666667, 0.5163977795, 11.7368421053),
    "ask_2": (1, 7, 7, 7, 7, 7, 7, None, 12, 12, 12, 12, 12, None, 12),
    "ask_3": (None,) * 15,
    "bid_0": (10, 31, 4, 2.5, 4, 2.5, 3.1, 0.7745966692, 9, 9.5, 9.5, 9, 9.3, 0.2581988897, 9.2419354839),
    "bid_1": (9, 38, 6, 3, 6, 3, 4.2222222222, 1.3944333776, 8, 8.5, 9, 8, 8.4444444444, 0.39086798, 8.3684210526),
    "bid_2": (6, 33, 6, 6, 6, 3, 5.5, 1.2247448714, 8, 8, 8.5, 8, 8.0833333333, 0.2041241452, 8.0454545455),
    "bid_3": (1, 6, 6, 6, 6, 6, 6, None, 8, 8, 8, 8, 8, None, 8),
    "ask_4": (None,) * 15,
    "bid_4": (None,) * 15,
}


def _check_label(row, label, values):
    for measure, want in zip(MEASURES, values):
        got = row[f"{label}_{measure}"]
        assert (got is None) == (want is None), (label, measure, got)
        if want is not None:
            assert got == pytest.approx(want, abs=1e-9), (label, measure)


def test_golden_stream(spark):
    events = spark.createDataFrame(stream_rows(), SCHEMA)
    rows = {r["window_end"]: r for r in window_features(events, "2m").collect()}
    assert sorted(rows) == [119999, 239999]
    assert list(rows[119999].asDict()) == feature_columns()
    assert {r["interval"] for r in rows.values()} == {120}
    first = rows[119999]
    _check_label(first, "all", (3, 40, 30, 2, 30, 2, 13.3333333333, 14.7422295917, 12.5, 11, 12.5, 10.5, 11.3333333333, 1.0408329997, 12.025))
    _check_label(first, "buy", (2, 10, 8, 2, 8, 2, 5, 4.2426406871, 10.5, 11, 11, 10.5, 10.75, 0.3535533906, 10.6))
    _check_label(first, "sell", (1, 30, 30, 30, 30, 30, 30, None, 12.5, 12.5, 12.5, 12.5, 12.5, None, 12.5))
    for label, values in GOLDEN.items():
        _check_label(first, label, values)
    _check_label(rows[239999], "bid_0", (1, 2, 2, 2, 2, 2, 2, None, 9.25, 9.25, 9.25, 9.25, 9.25, None, 9.25))
    for label in ("ask_0", "bid_1"):
        _check_label(rows[239999], label, (None,) * 15)


def test_compat_and_separate_rows(spark):
    events = spark.createDataFrame(stream_rows(), SCHEMA)
    rows = window_features(events, "2m", compat=True, joined=False).collect()
    assert len(rows) == 4
    for row in rows:
        assert (row["all_count"] is None) != (row["bid_0_count"] is None)
        assert row["sell_vwap"] == row["all_vwap"]


def test_level_count_follows_parameter(spark):
    events = spark.createDataFrame(stream_rows(), SCHEMA)
    rows = book_features(events, "2m", 2)
    assert "bid_1_vwap" in rows.columns and "bid_2_vwap" not in rows.columns


@pytest.mark.parametrize("every", [1, 7, 1000])
def test_rebuilt_books_equal_plain_replay(spark, every):
    rows = random_updates(300, seed=6)
    keys = ["exchange", "quote_asset", "base_asset"]
    versions = book_versions(spark.createDataFrame(rows, SCHEMA), keys, every=every, page_rows=50)
    want = sorted((b, p, s, lv, pr, q) for b, _, p, _, s, lv, pr, q in plain_replay(rows))
    numbered = spark.createDataFrame([(*r[1:4], i + 1) for r in {x[1:4]: x for x in rows}.values()
                                      for i in range(sum(x[1:4] == r[1:4] for x in rows))],
                                     "exchange string, quote_asset string, base_asset string, pos bigint")
    got = books_at(versions, numbered, keys, every)
    assert _rows(got, "base_asset", "pos", "side", "level", "price", "quantity") == want
    if every == 1000:  # one run: the updates themselves
        assert versions.count() <= len(rows)


def test_running_state_of_both_sides(spark):
    rows = [("k", "ask", 2.0, 1.0, 0), ("k", "bid", 1.0, 3.0, 1), ("k", "ask", 2.0, 0.0, 2)]
    got = running_state(spark.createDataFrame(rows, "k string, side string, price double, quantity double, n int"), ["k"], ["n"])
    assert [(r.pos, r.asks, r.bids) for r in got.orderBy("pos").collect()] == [
        (1, {2.0: 1.0}, {}), (2, {2.0: 1.0}, {1.0: 3.0}), (3, {}, {1.0: 3.0})]


def test_whole_books_have_tasks_by_cores_not_by_bytes(spark):
    rows = spark.createDataFrame([], SCHEMA)
    plan = str(replay_book(rows, ["base_asset"], None)._jdf.queryExecution().executedPlan())
    assert f", {8 * spark.sparkContext.defaultParallelism}), REPARTITION_BY_NUM" in plan


def test_rebuilt_books_stay_where_their_runs_were_dealt(spark):
    """A shuffle of versions and one of positions; books themselves, many rows each, are never shuffled. NULL keys match."""
    versions = spark.createDataFrame(
        [(None, 0, 1, "ask", 5.0, 2.0), (None, 0, 2, "ask", 4.0, 1.0), ("A", 0, 1, "bid", 3.0, 1.0)],
        "base_asset string, _run bigint, at bigint, side string, price double, quantity double")
    positions = spark.createDataFrame([(None, 2), ("A", 1), ("B", 1)], "base_asset string, pos bigint")
    books = books_at(versions, positions, ["base_asset"], 64)
    assert str(books._jdf.queryExecution().executedPlan()).count("Exchange hashpartitioning") == 2
    assert sorted(map(tuple, books.collect()), key=repr) == [
        ("A", 1, "bid", 0, 3.0, 1.0), (None, 2, "ask", 0, 4.0, 1.0), (None, 2, "ask", 1, 5.0, 2.0)]


def test_message_levels_are_those_of_the_books_and_rounded_once(spark, monkeypatch):
    """The same rows from plain arrays, in pages too; what is shown is computed for an update and not for every level of every book."""
    from pyspark.sql import functions as F

    from tickloom.operators import book, ordered

    rows = [r[:5] + (r[5] / 3, r[6] / 7) + r[7:] for r in random_updates(400, 8, span=400_000) if r[0] == "levelUpdate"]
    updates = spark.createDataFrame(rows, SCHEMA).withColumn("message", (F.col("seq") / 3).cast("long"))
    keys, message = ["base_asset"], ["time", "message"]
    shown = lambda c: F.round(c, 2)
    books = book.message_books(updates, keys, message, ["time", "seq"])
    want = book.explode_levels(books, [*keys, "pos", "message"]).withColumns({c: shown(F.col(c)) for c in ("price", "quantity")})
    for page in (None, 50):
        if page:
            monkeypatch.setattr(ordered, "PAGE_ROWS", page)
        got = book.message_levels(updates, keys, message, ["message"], ["time", "seq"], shown)
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        above, below = str(got._jdf.queryExecution().executedPlan()).split("MapInArrow", 1)
        assert "round(" not in above and "round(" in below
