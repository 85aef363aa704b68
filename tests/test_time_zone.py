"""Windows, directories and adapters are in UTC whatever the session's zone."""

import pytest
from pyspark.sql import functions as F

from tickloom.plans.adapters import market_events
from tickloom.sources.writers import window_directories


@pytest.fixture
def far_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_directories_and_adapter(spark, far_zone):
    rows = spark.createDataFrame([(3_599_999,)], "window_end bigint")
    assert tuple(window_directories(rows).first()) == (3_599_999, "1970", "01", "01", "01")
    try:
        first = market_events(spark, "/root/testdata/sf0.001").agg(F.min("time")).first()[0]
    except Exception:
        pytest.skip("driver tables are not here")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert first == market_events(spark, "/root/testdata/sf0.001").agg(F.min("time")).first()[0]
