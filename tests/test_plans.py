"""The shape of the physical plans: shuffles, pushed filters, pruned columns, where aggregation starts."""

import re

import pytest
from market import SCHEMA, random_updates
from pyspark.sql import functions as F

from tickloom.operators.book import book_snapshots
from tickloom.operators.events import distinct_events
from tickloom.operators.features import book_features, trade_features
from tickloom.operators.windows import tumbling

KEYS = ["exchange", "quote_asset", "base_asset"]


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "events")
    spark.createDataFrame(random_updates(500, 1), SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _count(plan, operator):
    return len(re.findall(rf"\b{operator} ", plan))


def test_book_is_one_shuffle_and_one_sort(events):
    plan = _plan(book_snapshots(tumbling(events, "1s"), [*KEYS, "window_end"]))
    assert (_count(plan, "Exchange"), _count(plan, r"Sort(?= \[)")) == (1, 1)
    assert "Join" not in plan


def test_level_statistics_aggregate_before_the_shuffle(events):
    plan = _plan(book_features(events, "1s"))
    assert "partial_sum" in plan.split("MapInArrow")[0]
    assert _count(plan, "Exchange") == 3  # updates by window, statistics by level, labels to one row


def test_trade_features_push_and_prune(events):
    plan = _plan(trade_features(events, "1s"))
    assert _count(plan, "Exchange") == 1 and "partial_min_by" in plan
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,trade)]" in plan
    counted = _plan(tumbling(events, "1s").groupBy(*KEYS, "window_end").agg(F.count("*")))
    assert "price" not in re.search(r"ReadSchema: \S+", counted)[0]


def test_copies_are_combined_before_the_shuffle(events):
    plan = _plan(distinct_events(events.unionByName(events)))
    assert "partial_min" in plan and _count(plan, "Exchange") == 1


def test_frames_are_not_shuffled(spark):
    """Two resolutions: one exchange of single rows, no join, and no frame in it."""
    from tickloom.operators.frames import multi_resolution_frames

    def rows(step, n):
        return spark.createDataFrame([("k", i * step, float(i)) for i in range(n)], "k string, t bigint, x double")

    fine, coarse = rows(10, 200), rows(70, 30)
    built = multi_resolution_frames(fine, coarse, ["t", "x"], ["k"], "t", rows=20)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    paged = multi_resolution_frames(fine, coarse, ["t", "x"], ["k"], "t", rows=20, page_rows=60)
    plan = paged._jdf.queryExecution().executedPlan().toString()
    # pages: frames are made above the last exchange, and what moves below it are single rows
    assert "collect_list" in plan and "collect_list" not in plan[plan.index("Exchange hashpartitioning"):]
    assert sorted(map(repr, built.collect())) == sorted(map(repr, paged.collect()))


@pytest.mark.parametrize("page_rows", [3, 7, 60])
def test_frames_of_two_resolutions_over_pages(spark, page_rows):
    """Pages shorter than a frame, without coarse rows, or without fine ones; equal times; a NULL key."""
    from tickloom.operators.frames import multi_resolution_frames

    def rows(*spans):
        return spark.createDataFrame([(k, t, float(t)) for k, ts in spans for t in ts], "k string, t bigint, x double")

    fine = rows(("a", range(0, 400, 10)), ("a", range(2000, 2200, 10)), (None, range(0, 100, 10)), ("b", range(3)))
    coarse = rows(("a", [5, 10, 30, 2500]), ("a", range(600, 1900, 100)), (None, [0, 55]), ("c", range(9)))
    build = [multi_resolution_frames(fine, coarse, ["t", "x"], ["k"], "t", rows=6, page_rows=n) for n in (None, page_rows)]
    plain, paged = (sorted(map(repr, b.collect())) for b in build)
    assert plain == paged and len(plain) == 60 - 5 + 10 - 5


def test_archive_is_parsed_once(spark, tmp_path):
    """Events and failures of a topic come from one parse, however many failures there are."""
    from tickloom.operators.parse import read_depths, records
    from tickloom.schemas import ENVELOPE

    messages = spark.createDataFrame([(bytearray(b"{}"), {}, 1)], ENVELOPE)
    plan = records(read_depths(messages), "depths")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 2  # the parse, and the map check of unreadable payloads
