import pytest
from pyspark.sql import functions as F

from catalogflow.functions import ago_text, local_text, parse_local_text


@pytest.fixture(params=["UTC", "Asia/Bangkok", "America/New_York"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_is_the_same_in_every_session_zone(spark, zone):
    instant = F.timestamp_seconds(F.lit(0))
    row = spark.range(1).select(local_text(instant), ago_text(instant, 7)).first()
    assert tuple(row) == ("1970-01-01 07:00:00", "1969-12-25 07:00:00")


def test_text_back_to_the_instant(spark, zone):
    back = parse_local_text(F.col("t"))
    frame = spark.createDataFrame([("1970-01-01 07:00:01",), ("soon",), (None,)], "t string")
    assert [r[0] for r in frame.select(F.unix_seconds(back)).collect()] == [1, None, None]


def test_text_without_zone_counts_as_utc(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ '2024-02-28 23:30:00' AS ts")
    assert frame.select(local_text(F.col("ts"))).first()[0] == "2024-02-29 06:30:00"
