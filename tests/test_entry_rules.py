"""Missing values and points in time on entry."""

import os
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidepool.functions.json_fields import json_float
from tidepool.functions.moments import micros, moment
from tidepool.operators import clean as C
from tidepool.operators.profile import describe
from tidepool.plans import mart
from tidepool.sources.records import clean_hourly


def test_the_text_nan_is_missing(spark):
    df = spark.createDataFrame([("NaN", 1), ("2.0", 2), ("x", 3), (None, 4)], "v string, i int")
    assert [r[0] for r in C.to_numeric(df, ["v"]).orderBy("i").collect()] == [None, 2.0, None, None]
    described = {r["stat"] if "stat" in r else r[0]: r for r in describe(C.to_numeric(df, ["v"]).select("v"), ["v"]).collect()}
    assert not any(x != x for r in described.values() for x in r if isinstance(x, float))
    text = spark.createDataFrame([('{"a": "NaN"}',)], "j string")
    assert text.select(json_float(F.col("j"), "a")).first()[0] is None
    assert clean_hourly(spark.createDataFrame([{"periodStartUnix": "1", "id": "p", "txCount": "1", **{p: "NaN" for p in _doubles()}}])).first()[2] is None


def _doubles():
    from tidepool.schema import CLEAN_DOUBLES

    return CLEAN_DOUBLES.values()


@pytest.fixture
def new_york(monkeypatch):
    was = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    yield
    os.environ.pop("TZ")
    if was is not None:
        os.environ["TZ"] = was
    time.tzset()


def test_bounds_do_not_depend_on_the_drivers_zone(spark, new_york):
    hours = spark.range(48).select((F.lit("2024-01-29").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("hour_ts"))
    got = C.recent(hours, 0, datetime(2024, 1, 30)).agg(F.min(F.col("hour_ts").cast("string")), F.count("*")).first()
    assert tuple(got) == ("2024-01-30 00:00:00", 24)
    assert spark.range(1).select(moment(datetime(2024, 1, 1, tzinfo=timezone.utc)).cast("long")).first()[0] == 1_704_067_200


def test_incremental_across_a_clock_change(spark, new_york):
    start = F.lit("2024-11-02 12:00:00").cast("timestamp")
    rows = spark.range(36).select(
        F.lit("dexa").alias("dex"), F.lit("p").alias("pool_id"), (start + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("hour_ts"),
        F.col("id").cast("double").alias("volume_usd"), F.lit(1.0).alias("tvl_usd"), F.lit(1.0).alias("liquidity"))
    for known in range(14, 22):  # ends around the hour that New York has twice
        target = rows.where(F.col("volume_usd") < known)
        assert mart.incremental_features(rows, target).count() == 36 - known
    edge = rows.agg(micros(F.max("hour_ts"))).first()[0]
    assert rows.where(F.col("hour_ts") >= moment(edge)).count() == 1
