"""Every ordered operator must give the same rows whether or not keys are cut into pages."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import frames as fr, ordered as od, windows as wn
from tickloom.operators.features import extended_stats

COLUMNS = ("all_close_price", "all_volume")


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(1)
    data = []
    for key, n in (("A", 230), ("B", 40), (None, 17)):  # one hot key, one NULL key
        for i in range(n):
            price = None if r.random() < 0.4 else round(r.uniform(1, 9), 2)
            data.append(("ex", "USDT", key, i * 60_000 + 59_999, price, float(i)))
    r.shuffle(data)
    return spark.createDataFrame(
        data, "exchange string, quote_asset string, base_asset string, window_end bigint, all_close_price double, all_volume double"
    )


def _same(build):
    plain, paged = (sorted(map(repr, build(p).collect())) for p in (None, 25))
    assert plain == paged
    assert plain
    return plain


def _line(rows, page_rows):
    o = fr.timeline(rows, page_rows=page_rows)
    assert o.paged == (page_rows is not None)
    return o


def test_positions(rows):
    _same(lambda p: _line(rows, p).df.drop("_page", "_hot"))
    got = _line(rows, 25).df.groupBy("base_asset").agg(F.sort_array(F.collect_list("_pos")).alias("p")).collect()
    assert {r.base_asset: r.p for r in got} == {"A": list(range(1, 231)), "B": list(range(1, 41)), None: list(range(1, 18))}


@pytest.mark.parametrize("build", [
    lambda o: fr.forward_fill(o, ["all_close_price"]),
    lambda o: fr.frames(o, COLUMNS, 9, batch_size=4),
    lambda o: fr.frame_labels(o, COLUMNS, 9, batch_size=4),
    lambda o: fr.differenced_frames(o, COLUMNS, 9),
    lambda o: fr.price_relative(o, 9),
    lambda o: fr.delta(o, "all_volume"),
    lambda o: fr.bounded_series(o, COLUMNS, 12),
    lambda o: fr.observation_pairs(o, COLUMNS, 9),
    lambda o: od.plain(od.running_sum(o, "total", F.col("all_volume"))),
    lambda o: od.plain(od.running_product(o, "total", F.lit(1.01))).withColumn("total", F.round("total", 9)),
    lambda o: od.position_slice(o, 20, 60),
], ids=["fill", "frames", "labels", "differences", "relative", "delta", "series", "pairs", "sum", "product", "slice"])
def test_paged_equals_plain(rows, build):
    _same(lambda p: build(_line(rows, p)))


def test_warm_up(rows):
    got = _same(lambda p: fr.drop_warm_up(rows, ["all_close_price"], 30, page_rows=p))
    assert len(got) == 200 + 10


def test_batches_and_pages(rows, monkeypatch):
    keys, order = ["base_asset"], ["window_end"]
    plain = sorted(map(repr, wn.count_batches(rows, 7, keys, order).collect()))
    named = rows.withColumnsRenamed({"window_end": "time"}).withColumn("seq", F.lit(0))
    listed = sorted(map(repr, wn.ordered_event_pages(named, "1h", keys, page=8, fields=("time", "all_volume")).collect()))
    monkeypatch.setattr(od, "PAGE_ROWS", 25)
    assert plain == sorted(map(repr, wn.count_batches(rows, 7, keys, order).collect()))
    assert listed == sorted(map(repr, wn.ordered_event_pages(named, "1h", keys, page=8, fields=("time", "all_volume")).collect()))
    assert len(plain) == 224 + 35 + 14


def test_frame_against_brute_force(rows):
    data = sorted((r.window_end, r.all_close_price, r.all_volume) for r in rows.where("base_asset = 'A'").collect())
    labelled = fr.frame_labels(_line(rows, 25), COLUMNS, 9).where("base_asset = 'A'").collect()
    assert len(labelled) == 230 - 10
    for r in labelled:
        assert [tuple(x) for x in r.frame] == [d[1:] for d in data[r.start:r.start + 9]]
        assert (r.current_price, r.next_price) == (data[r.start + 9][1], data[r.start + 10][1])


def test_multi_resolution(rows):
    known = rows.where("base_asset IS NOT NULL")
    coarse = known.where("pmod(window_end - 59999, 300000) = 0").withColumn("window_end", F.col("window_end") + 240_000)
    build = lambda p: fr.multi_resolution_frames(known, coarse, ["window_end"], rows=6, page_rows=p)
    _same(build)
    ends = sorted(r.window_end for r in coarse.where("base_asset = 'B'").collect())
    got = build(None).where("base_asset = 'B'").collect()
    assert len(got) == 35
    for r in got:
        assert [x[0] for x in r.coarse_frame] == [e for e in ends if e >= r.time][:6]


def test_extended_stats_of_large_groups(rows):
    values = rows.select("base_asset", "window_end", F.col("all_volume").alias("price"), (F.col("all_volume") * 2).alias("quantity"))

    def build(p):
        stats = extended_stats(values, ["base_asset"], ["window_end"], page_rows=p)
        return stats.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in stats.dtypes])

    _same(build)
    [row] = build(25).where("base_asset = 'B'").collect()
    assert (row.median_price, row.mad_price, row.first_price, row.last_quantity) == (19.5, 10.0, 0.0, 78.0)


def test_plain_path_is_one_shuffle(rows):
    plan = fr.frame_labels(_line(rows, None), COLUMNS, 9)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_a_frame_may_span_pages(spark):
    rows = spark.createDataFrame([("k", i, float(i)) for i in range(400)], "k string, t bigint, x double")

    def series(page_rows):
        line = fr.timeline(rows, ["k"], ["t"], page_rows)
        return {r.t: [x.t for x in r.series] for r in fr.bounded_series(line, ["t"], bars=300).collect()}

    assert series(100) == series(500) == {i: list(range(max(0, i - 299), i + 1)) for i in range(400)}


def test_one_hot_group_among_small_ones(spark):
    from tickloom.operators.features import extended_stats

    rows = [("hot", i, float(i % 37), float(i % 11)) for i in range(300)] + [(f"s{i % 20}", i, float(i), 1.0) for i in range(100)]
    frame = spark.createDataFrame(rows, "k string, seq bigint, price double, quantity double")

    def stats(page_rows):
        out = extended_stats(frame, ["k"], ["seq"], page_rows=page_rows).collect()
        return sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in out)

    assert stats(50) == stats(1000)


def test_spans_grow_with_rows_and_cores_not_with_pages(spark):
    rows = spark.range(1)
    assert od.span_count(rows, 2_400_000, 10) <= max(spark.sparkContext.defaultParallelism, 10)
    assert od.span_count(rows, 40_000_000, 4_000_000) == 10
    assert od.span_count(rows, 11, 10) == 2
