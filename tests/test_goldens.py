"""Hand-checked values and the rules for zero and missing values."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidepool import schema as L
from tidepool.functions import scalars as S
from tidepool.functions.json_fields import json_float, json_str, json_ts
from tidepool.functions.probability import chi2_p, normal_p
from tidepool.operators import clean as C
from tidepool.operators import combine as J
from tidepool.operators import profile as P
from tidepool.operators import stats as T
from tidepool.operators.features import change_rate, pool_features, time_features
from tidepool.operators.frames import dedup_latest, error_flag, ffill_bfill
from tidepool.operators.labels import label_spikes
from tidepool.plans import mart
from tidepool.sources import records as R


def hour(i):
    return datetime.fromtimestamp(1_704_067_200 + 3600 * i)


@pytest.fixture(scope="module", autouse=True)
def utc():
    import os
    import time

    old = os.environ.get("TZ")
    os.environ["TZ"] = "UTC"
    time.tzset()
    yield
    if old is None:
        del os.environ["TZ"]
    else:
        os.environ["TZ"] = old
    time.tzset()


def series(spark, volumes, tvl=None, pool="p"):
    tvl = tvl or [1.0] * len(volumes)
    rows = [("d", pool, hour(i), v, t, 1.0) for i, (v, t) in enumerate(zip(volumes, tvl))]
    return spark.createDataFrame(rows, "dex string, pool_id string, hour_ts timestamp, volume_usd double, tvl_usd double, liquidity double")


def column(df, name, order="hour_ts"):
    return [r[0] for r in df.orderBy(order).select(name).collect()]


def test_hour_key_of_file_names(spark):
    names = {
        "2025-05-22_pool.jsonl": "2025-05-22T000000",
        "20250522T090000_pool.jsonl": "20250522T090000",
        "20250522T094512_pool.jsonl": "20250522T090000",
        "20250522T0945_pool.jsonl": None,
        "notes.txt": None,
        "x2025-05-22_pool.jsonl": None,
    }
    df = spark.createDataFrame([(n,) for n in names], "name string").withColumn("key", S.hour_key(F.col("name")))
    assert {r["name"]: r["key"] for r in df.collect()} == names


def test_latest_file_per_hour(spark):
    names = ["20250522T090000_pool.jsonl", "20250522T093000_pool.jsonl", "20250522T100000_pool.jsonl", "a_pool.txt"]
    out = R.latest_file_per_hour(spark.createDataFrame([(n,) for n in names], "name string"))
    assert {r["name"]: r["action"] for r in out.collect()} == {names[0]: "archive", names[1]: "keep", names[2]: "keep"}


def test_uniform_hours_golden(spark):
    """Three observations in three different hours of the day."""
    seen = spark.createDataFrame([(3,), (11,), (20,)], "hour int")
    out = T.chi2_uniform(J.dense_counts(seen, "hour", 24)).first()
    assert out["chi2"] == pytest.approx(21.0)
    assert out["df"] == 23
    assert out["p"] == pytest.approx(0.581, abs=5e-4)


def _even_tail(x, df):
    """The finite sum that an even number of degrees of freedom has."""
    logs = [i * math.log(x / 2) - x / 2 - math.lgamma(i + 1) for i in range(df // 2)]
    top = max(logs)
    return math.exp(top) * math.fsum(math.exp(v - top) for v in logs)


def test_tail_probabilities(spark):
    zs = [0.0, 1e-9, 0.3, 1.7, 1.959963984540054, 5.0, 8.2, 30.0, -2.0]
    found = spark.createDataFrame([(z,) for z in zs], "z double").select("z", normal_p("z").alias("p")).collect()
    for z, p in found:
        assert p == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), rel=1e-11)
    odd = spark.createDataFrame([(3.841458820694124, 1), (36.41502850180731, 24), (7.814727903251179, 3)], "x double, df int")
    assert [r["p"] for r in odd.select(chi2_p("x", "df").alias("p")).collect()] == pytest.approx([0.05] * 3)
    cases = [(x * df, df) for df in (2, 4, 10, 50, 2000, 20_000) for x in (0.1, 0.5, 0.97, 1.0, 1.03, 2.0)]
    even = spark.createDataFrame(cases, "x double, df int").select("x", "df", chi2_p("x", "df").alias("p"))
    for x, df, p in even.collect():
        assert p == pytest.approx(_even_tail(x, df), rel=1e-9, abs=1e-300)
    edges = spark.createDataFrame([(0.0, 3), (None, 3), (float("nan"), 3), (1.0, 0), (1.0, None), (float("inf"), 3)], "x double, df int")
    assert [r["p"] for r in edges.select(chi2_p("x", "df").alias("p")).collect()] == [1.0, None, None, None, None, 0.0]


def test_negative_rate_golden(spark):
    """3 negative rows in 134 736."""
    df = spark.range(134_736).select(F.when(F.col("id") < 3, -1.0).otherwise(1.0).alias("tvl_usd"))
    assert P.rate(df, F.col("tvl_usd") < 0).first()["rate"] == pytest.approx(2.2265764161026006e-05, rel=1e-12)


def test_two_by_two_uses_the_continuity_correction(spark):
    tbl = spark.createDataFrame([(1, 10, 20), (2, 30, 40)], "fee_tier int, neg bigint, valid bigint")
    out = T.chi2_independence(tbl).first()
    # |ad - bc| = 200, n = 100: n (|ad - bc| - n/2)^2 / (r1 r2 c1 c2)
    assert out["chi2"] == pytest.approx(100 * (200 - 50) ** 2 / (30 * 70 * 40 * 60))
    assert out["df"] == 1


def test_holm_by_hand(spark):
    df = spark.createDataFrame([(0.01,), (0.04,), (0.03,), (0.005,)], "p double")
    got = {r["p"]: r["p_adj"] for r in T.holm(df).collect()}
    assert got == {0.005: pytest.approx(0.02), 0.01: pytest.approx(0.03), 0.03: pytest.approx(0.06), 0.04: pytest.approx(0.06)}


def test_too_many_categories_are_refused(spark):
    tbl = spark.range(1001).select(F.col("id").alias("fee_tier"), F.lit(1).alias("neg"), F.lit(2).alias("valid"))
    with pytest.raises(Exception, match="too many categories"):
        T.pairwise_z(tbl).collect()


def test_change_rate_treats_zero_as_unknown(spark):
    volumes = [5.0, 0.0, 4.0] + [1.0] * 21 + [10.0, 3.0, 0.0]
    df = change_rate(series(spark, volumes), "volume_usd", "rate")
    rates = column(df, "rate")
    assert rates[:24] == [None] * 24
    assert rates[24:] == [1.0, None, None]  # doubled; zero before; zero now


def test_change_rate_by_time_differs_across_gaps(spark):
    df = series(spark, [float(i + 1) for i in range(30)]).where(F.col("hour_ts") != F.lit(hour(3)))
    by_time = column(change_rate(df, "volume_usd", "rate", by_time=True), "rate")
    assert by_time[-3:] == [None, pytest.approx(29 / 5 - 1), pytest.approx(30 / 6 - 1)]
    by_row = column(change_rate(df, "volume_usd", "rate"), "rate")
    assert by_row[-5:] == [pytest.approx(x) for x in (26 / 1 - 1, 27 / 2 - 1, 28 / 3 - 1, 29 / 5 - 1, 30 / 6 - 1)]


def test_moving_averages_start_partial_and_rolling_means_do_not(spark):
    df = series(spark, [float(i) for i in range(30)])
    made = pool_features(df)
    assert column(made, "vol_ma_6h")[:7] == [0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.5]
    explored = time_features(
        df.withColumnRenamed("pool_id", "pool_address").withColumn("open_price", F.lit(0.0)).withColumn("close_price", F.lit(1.0))
    )
    assert column(explored, "volume_ma24")[:24] == [None] * 23 + [11.5]
    assert set(column(explored, "price_change")) == {None}


def test_features_drop_nothing_and_keep_load_ts(spark):
    df = series(spark, [1.0, 2.0]).withColumn("load_ts", F.col("hour_ts"))
    assert pool_features(df).columns[-1] == "load_ts"
    assert "load_ts" not in label_spikes(pool_features(df)).columns


def test_label_is_zero_without_a_value(spark):
    df = series(spark, [1.0, None, 3.0])
    assert column(label_spikes(df), "y") == [0, 0, 1]
    lone = series(spark, [None, None], pool="empty")
    assert column(label_spikes(lone), "y") == [0, 0]


def test_clip_keeps_missing_values(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (0.5,), (9.0,)], "x double").select(S.clip(F.col("x"), 0, 1).alias("x"))
    assert [r["x"] for r in df.collect()] == [0.0, None, 0.5, 1.0]


def test_fill_takes_the_flag_first(spark):
    df = series(spark, [1.0] * 5, [None, 2.0, None, None, 5.0])
    filled = ffill_bfill(error_flag(df, "tvl_usd"), ["pool_id"], "hour_ts", ["tvl_usd"], 7200)
    assert column(filled, "tvl_usd") == [2.0, 2.0, 2.0, 2.0, 5.0]
    assert column(filled, "tvl_error") == [1, 0, 1, 1, 0]


def test_minimal_and_broken_records(spark):
    lines = spark.createDataFrame(
        [('{"id": "1", "periodStartUnix": 1747904400, "liquidity": "123", "volumeUSD": "456"}',), ("{broken",), ('{"id": "2", "tvlUSD": "n/a"}',)],
        "value string",
    )
    good, bad = R.split_bad_records(lines)
    assert (good.count(), bad.count()) == (2, 1)
    for raw in (good.select(F.col("value").alias("raw"), F.lit(None).cast("timestamp").alias("load_ts")), R.land_raw(good)):
        rows = sorted(R.stage_pool_hourly(raw).collect(), key=lambda r: r["volume_usd"] is None)
        assert rows[0]["volume_usd"] == 456.0 and rows[0]["liquidity"] == 123.0
        assert rows[0]["hour_ts"] == datetime(2025, 5, 22, 9) and rows[0]["pool_id"] is None and rows[0]["open"] is None
        assert rows[1]["tvl_usd"] is None and rows[1]["hour_ts"] is None


def test_one_record_is_one_line(spark, tmp_path):
    out = str(tmp_path / "deep" / "folder" / "out")
    R.write_jsonl(spark.createDataFrame([("1", 5)], "id string, periodStartUnix bigint"), out)
    lines = spark.read.text(out).collect()
    assert [r["value"] for r in lines] == ['{"id":"1","periodStartUnix":5}']


def test_json_access_by_path(spark):
    df = spark.createDataFrame([('{"a": {"b": "1.5", "t": "0", "bad": "x"}}',)], "j string")
    row = df.select(
        json_str(F.col("j"), "a.b").alias("s"), json_float(F.col("j"), "a.b").alias("f"), json_float(F.col("j"), "a.bad").alias("bad"),
        json_ts(F.col("j"), "a.t").alias("t"), json_ts(F.col("j"), "a.bad").alias("tbad"), json_str(F.col("j"), "z").alias("z"),
    ).first()
    assert tuple(row) == ("1.5", 1.5, None, datetime(1970, 1, 1), None, None)


def test_flatten_and_has_pool(spark):
    df = spark.createDataFrame([('{"id": "x", "pool": {"id": "p", "token0": {"symbol": "A"}}}',), ('{"id": "y"}',)], "value string")
    records = R.as_records(df)
    assert "pool_token0_symbol" in R.flatten(records).columns
    assert [r["id"] for r in C.has_pool(records).collect()] == ["x"]
    assert records.schema.fieldNames() == L.RECORD.fieldNames()


def test_missing_days_and_hours(spark):
    stamps = [datetime(2025, 1, 1, h) for h in range(24)] + [datetime(2025, 1, 3, h) for h in range(22)]
    df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp")
    span = (date(2025, 1, 1), date(2025, 1, 3))
    assert [r["date"] for r in J.missing_days(df, "ts", *span).collect()] == [date(2025, 1, 2)]
    rows = {r["date"]: (r["hours"], r["complete"]) for r in J.missing_hours(df, "ts", *span).collect()}
    assert rows == {date(2025, 1, 2): (list(range(24)), True), date(2025, 1, 3): ([22, 23], False)}


def test_digits_of_the_source_text(spark):
    text = "123456789012345678901234567890"
    row = spark.createDataFrame([(text,)], "x string").select(
        S.digit_count(F.col("x")).alias("n"), S.scale_fixed_point(F.col("x")).alias("s"), F.col("x").try_cast("decimal(38,0)").alias("d")
    ).first()
    assert row["n"] == 30 and row["s"] == pytest.approx(1.2345678901234567e11) and str(row["d"]) == text


def test_newest_copy_wins_and_nothing_else_changes(spark):
    rows = [("a", 1, 10, 1.0), ("a", 1, 20, 2.0), ("a", 2, 5, 3.0), ("b", 1, None, 4.0)]
    df = spark.createDataFrame(rows, "id string, period int, loaded int, v double")
    kept = dedup_latest(df, ["id", "period"], "loaded", ["v"])
    assert sorted(tuple(r) for r in kept.collect() if r["id"] == "a") == [("a", 1, 20, 2.0), ("a", 2, 5, 3.0)]
    assert kept.columns == df.columns and kept.count() == 3


def test_freshness(spark):
    df = series(spark, [1.0, 2.0])
    assert mart.is_fresh(df, hour(1)).first()["fresh"] is True
    assert mart.is_fresh(df, hour(2)).first()["fresh"] is False
    assert mart.is_fresh(df.limit(0), hour(0)).first()["fresh"] is False


def test_as_of_and_recent_bounds(spark):
    df = series(spark, [float(i) for i in range(5)])
    assert J.as_of(df, F.lit(hour(2))).first()["volume_usd"] == 2.0
    assert J.as_of(df, F.lit(hour(-1))).count() == 0
    assert C.slice_interval(df, "hour_ts", hour(2)).count() == 1
    assert C.recent(df, 0, hour(3)).count() == 2
