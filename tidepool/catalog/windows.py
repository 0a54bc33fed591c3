"""Windowed features and labels (ids D2, D3, E13, E14, F1-F12)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidepool import fixtures as X
from tidepool.catalog.registry import (
    EXPLORED, FEATURE_COLUMNS_SQL, FEATURES, LABELLED, POOL_EVENTS, POOL_HOURLY, WIDE, epoch, epochs, feature_columns_out, query, r,
    rs,
)
from tidepool.functions.json_fields import epoch_to_ts
from tidepool.functions import scalars as S
from tidepool.functions.moments import moment
from tidepool.operators import combine as J
from tidepool.operators.features import change_rate, pct_change, pool_features, time_features
from tidepool.operators.frames import (
    error_flag, ffill_bfill, fitting_chunk, moving_avg, rolling_mean, rolling_std, row_frames,
)
from tidepool.operators.labels import label_spikes, pool_quantile
from tidepool.operators.quantiles import daily_sketches, quantiles_from_sketches
from tidepool.session import materialized


def hours(spark, sf):
    """The wide table with real timestamps."""
    return X.wide(spark, sf).withColumn("hour_ts", epoch_to_ts(F.col("hour_ts")))


def explored(spark, sf):
    return time_features(hours(spark, sf))


@query("f1_change_rate_24", f"""WITH {FEATURES}
SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, {rs('vol_rate_24h')} AS vol_rate_24h, {rs('tvl_rate_24h')} AS tvl_rate_24h
FROM features""")
def f1(spark, sf):
    df = change_rate(X.pool_hourly(spark, sf), "volume_usd", "vol_rate_24h")
    df = change_rate(df, "tvl_usd", "tvl_rate_24h")
    return df.select("pool_id", epoch("hour_ts").alias("hour_epoch"), r("vol_rate_24h").alias("vol_rate_24h"),
                     r("tvl_rate_24h").alias("tvl_rate_24h"))


@query("f1_change_rate_24_by_time", f"""WITH {POOL_HOURLY}
SELECT a.pool_id, {epochs('a.hour_ts')} AS hour_epoch, {rs('nullif(a.volume_usd, 0) / nullif(b.volume_usd, 0) - 1')} AS vol_rate_24h
FROM pool_hourly a LEFT JOIN pool_hourly b ON a.pool_id = b.pool_id AND b.hour_ts = a.hour_ts - INTERVAL 24 HOUR""")
def f1_time(spark, sf):
    df = change_rate(X.pool_hourly(spark, sf), "volume_usd", "vol_rate_24h", by_time=True)
    return df.select("pool_id", epoch("hour_ts").alias("hour_epoch"), r("vol_rate_24h").alias("vol_rate_24h"))


def _framed(spark, sf, rows):
    df = row_frames(X.pool_hourly(spark, sf), ["pool_id"], "hour_ts", {"ma": moving_avg("volume_usd", rows)}, rows)
    return df.select("pool_id", epoch("hour_ts").alias("hour_epoch"), r("ma").alias("ma"))


@query("f2_moving_avg_6", f"WITH {FEATURES} SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, {rs('vol_ma_6h')} AS ma FROM features")
def f2(spark, sf):
    return _framed(spark, sf, 6)


@query("f3_moving_avg_24", f"WITH {FEATURES} SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, {rs('vol_ma_24h')} AS ma FROM features")
def f3(spark, sf):
    return _framed(spark, sf, 24)


@query("f3_moving_avg_24_events", f"""SELECT event_id, {rs('avg(value) OVER (PARTITION BY event_type ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)')} AS ma FROM events""")
def f3_events(spark, sf):
    """Few keys with very many rows each: a fifth of all events in every series."""
    df = X.table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    chunk = fitting_chunk(df, ["event_type"], "ts", most=2000)
    framed = row_frames(df, ["event_type"], "ts", {"ma": moving_avg("value", 24)}, 24, chunk)
    return framed.select("event_id", r("ma").alias("ma"))


@query("f4_rolling_mean_24", f"WITH {EXPLORED} SELECT id, {rs('volume_ma24')} AS volume_ma24 FROM explored")
def f4(spark, sf):
    df = row_frames(hours(spark, sf), ["pool_address"], "hour_ts", {"volume_ma24": rolling_mean("volume_usd", 24)}, 24)
    return df.select("id", r("volume_ma24").alias("volume_ma24"))


@query("f5_rolling_std_24", f"WITH {EXPLORED} SELECT id, {rs('volume_volatility')} AS volume_volatility FROM explored")
def f5(spark, sf):
    df = row_frames(hours(spark, sf), ["pool_address"], "hour_ts", {"s": rolling_std("volume_usd", 24)}, 24)
    return df.select("id", r("s").alias("volume_volatility"))


@query("f6_deviation", f"WITH {EXPLORED} SELECT id, {rs('volume_deviation')} AS volume_deviation FROM explored")
def f6(spark, sf):
    return explored(spark, sf).select("id", r("volume_deviation").alias("volume_deviation"))


@query("f7_pct_change", f"""WITH {WIDE}
SELECT id, {rs('volume_usd / nullif(lag(volume_usd) OVER (PARTITION BY pool_address ORDER BY hour_ts), 0) - 1')} AS volume_change_1h
FROM wide""")
def f7(spark, sf):
    df = pct_change(hours(spark, sf), "volume_usd", "volume_change_1h")
    return df.select("id", r("volume_change_1h").alias("volume_change_1h"))


_HOLED = f"""WITH {WIDE}, holed AS (SELECT id, pool_address, hour_ts,
  CASE WHEN tvl_usd >= 40 THEN tvl_usd END AS tvl_usd FROM wide)"""


def _holed(spark, sf):
    return hours(spark, sf).select("id", "pool_address", "hour_ts", F.when(F.col("tvl_usd") >= 40, F.col("tvl_usd")).alias("tvl_usd"))


@query("f8_ffill_bfill", f"""{_HOLED}
SELECT id, coalesce(last_value(tvl_usd IGNORE NULLS) OVER (PARTITION BY pool_address ORDER BY hour_ts ROWS UNBOUNDED PRECEDING),
  first_value(tvl_usd IGNORE NULLS) OVER (PARTITION BY pool_address ORDER BY hour_ts
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS tvl_usd FROM holed""")
def f8(spark, sf):
    # chunks of five days, so that values are carried across chunk borders in this test data
    return ffill_bfill(_holed(spark, sf), ["pool_address"], "hour_ts", ["tvl_usd"], 5 * 86_400).select("id", "tvl_usd")


@query("f9_error_flag", f"{_HOLED} SELECT id, tvl_usd, CASE WHEN tvl_usd IS NULL THEN 1 ELSE 0 END AS tvl_error FROM holed")
def f9(spark, sf):
    return error_flag(_holed(spark, sf), "tvl_usd").select("id", "tvl_usd", "tvl_error")


@query("f11_pool_features", f"WITH {FEATURES} SELECT dex, {FEATURE_COLUMNS_SQL} FROM features")
def f11(spark, sf):
    return feature_columns_out(pool_features(X.pool_hourly(spark, sf)), "dex")


@query("f11_pool_features_chunked", f"WITH {FEATURES} SELECT dex, {FEATURE_COLUMNS_SQL} FROM features")
def f11_chunked(spark, sf):
    # five-day chunks make the chunk borders matter within the month the test data covers
    return feature_columns_out(pool_features(X.pool_hourly(spark, sf), chunk_seconds=5 * 86_400), "dex")


@query("f12_time_features", f"""WITH {EXPLORED}
SELECT id, {rs('volume_ma24')} AS volume_ma24, {rs('volume_deviation')} AS volume_deviation,
       {rs('volume_volatility')} AS volume_volatility, volume_tvl_ratio,
       {rs('price_change')} AS price_change FROM explored""")
def f12(spark, sf):
    df = explored(spark, sf)
    return df.select(
        "id", r("volume_ma24").alias("volume_ma24"), r("volume_deviation").alias("volume_deviation"),
        r("volume_volatility").alias("volume_volatility"), "volume_tvl_ratio",
        r("price_change").alias("price_change"),
    )


@query("d2_label_spikes", f"WITH {LABELLED} SELECT dex, y, {FEATURE_COLUMNS_SQL} FROM labelled")
def d2(spark, sf):
    """Flagship: features and spike labels of every pool-hour, which are unique by construction."""
    hourly = X.pool_hourly(spark, sf)
    return feature_columns_out(label_spikes(pool_features(hourly), unique_hours=True, history=hourly), "dex", "y")


@query("d2_label_spikes_any_rows", f"""WITH {POOL_EVENTS}
SELECT event_id, value, CASE WHEN value >= p THEN 1 ELSE 0 END AS y FROM pool_events
JOIN (SELECT pool_id, quantile_cont(value, 0.9) AS p FROM pool_events GROUP BY 1) USING (pool_id)""")
def d2_any(spark, sf):
    """The same on single events: nothing bounds a pool's rows, so pools are counted first."""
    df = label_spikes(X.pool_events(spark, sf).select("event_id", "pool_id", "value"), col="value")
    return df.select("event_id", "value", "y")


@query("e13_pool_quantile", f"""WITH {POOL_HOURLY}
SELECT pool_id, {rs('quantile_cont(volume_usd, 0.9)')} AS value FROM pool_hourly GROUP BY 1""")
def e13(spark, sf):
    return pool_quantile(X.pool_hourly(spark, sf)).select("pool_id", r("value").alias("value"))


@query("e13_event_quantile_by_counting", f"""
SELECT event_type, {rs('quantile_cont(value, 0.9)')} AS value FROM events GROUP BY 1""")
def e13_counting(spark, sf):
    """The way large groups take, here forced for every group."""
    from tidepool.operators.quantiles import exact_quantiles

    found = exact_quantiles(X.table(spark, sf, "events"), "value", [0.9], ["event_type"], direct_limit=0)
    return found.select("event_type", r("value").alias("value"))


# a pool's rows here are far fewer than the sketch's accuracy, so its answer is the discrete quantile
@query("e14_pool_quantile_approx", f"""WITH {POOL_HOURLY}
SELECT pool_id, quantile_disc(volume_usd, 0.9) AS value FROM pool_hourly GROUP BY 1""")
def e14(spark, sf):
    return pool_quantile(X.pool_hourly(spark, sf), approx=True)


@query("e14_sketch_by_day", f"""WITH {POOL_HOURLY} SELECT pool_id, strftime(hour_ts, '%Y-%m-%d') AS day, count(*) AS n,
  quantile_disc(volume_usd, 0.9) AS pct_90 FROM pool_hourly GROUP BY 1, 2""")
def e14_by_day(spark, sf):
    """One day of a pool has fewer rows than a sketch holds, so its answer is exact."""
    stored = materialized(daily_sketches(X.pool_hourly(spark, sf), "volume_usd", ["pool_id"]), "sketches")
    return quantiles_from_sketches(stored, {"pct_90": 0.9}, ["pool_id", "day"])


@query("e14_sketch_error", f"""WITH {POOL_HOURLY} SELECT dex, count(*) AS n, true AS near_50, true AS near_90, true AS near_99 FROM pool_hourly
WHERE hour_ts >= TIMESTAMP '2024-01-05' AND hour_ts < TIMESTAMP '2024-01-25' GROUP BY 1""")
def e14_error(spark, sf):
    """Thresholds of an exchange over twenty days of sketches of pools and days: ranks are off by at most 4 % of the rows."""
    hours = materialized(X.pool_hourly(spark, sf), "hours")
    stored = materialized(daily_sketches(hours, "volume_usd", ["dex", "pool_id"]), "sketches")
    span = stored.where("day >= '2024-01-05' and day < '2024-01-25'")
    marks = {"q50": 0.5, "q90": 0.9, "q99": 0.99}
    found = quantiles_from_sketches(span, marks, ["dex"]).withColumnRenamed("n", "_rows")
    rows = hours.where((F.col("hour_ts") >= moment(datetime(2024, 1, 5))) & (F.col("hour_ts") < moment(datetime(2024, 1, 25))))
    share = lambda c, less: F.avg((F.col("volume_usd") < F.col(c) if less else F.col("volume_usd") <= F.col(c)).cast("double"))
    near = [((share(c, True) <= q + 0.04) & (share(c, False) >= q - 0.04)).alias(f"near_{c[1:]}") for c, q in marks.items()]
    return rows.join(found, "dex").groupBy("dex").agg(F.count("*").alias("n"), *near)


@query("d3_as_of", f"""WITH {FEATURES}
SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, volume_usd, {rs('vol_ma_24h')} AS vol_ma_24h FROM features
WHERE hour_ts <= TIMESTAMP '2024-01-20 12:30:00' ORDER BY hour_ts DESC, pool_id LIMIT 1""")
def d3(spark, sf):
    row = J.as_of(pool_features(X.pool_hourly(spark, sf)), moment(datetime(2024, 1, 20, 12, 30)))
    return row.select("pool_id", epoch("hour_ts").alias("hour_epoch"), "volume_usd", r("vol_ma_24h").alias("vol_ma_24h"))


@query("d3_as_of_by_pool", f"""WITH {POOL_HOURLY}
SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, volume_usd FROM pool_hourly
WHERE hour_ts <= TIMESTAMP '2024-01-20 12:30:00' QUALIFY row_number() OVER (PARTITION BY pool_id ORDER BY hour_ts DESC) = 1""")
def d3_by_pool(spark, sf):
    row = J.as_of(X.pool_hourly(spark, sf), moment(datetime(2024, 1, 20, 12, 30)), by=["pool_id"])
    return row.select("pool_id", epoch("hour_ts").alias("hour_epoch"), "volume_usd")


@query("b24_f8_f9_impute_chain", f"""WITH {WIDE}, gone AS (
  SELECT id, pool_address, hour_ts, CASE WHEN tvl_usd >= 0 THEN tvl_usd END AS tvl_usd FROM wide)
SELECT id, CASE WHEN tvl_usd IS NULL THEN 1 ELSE 0 END AS tvl_error,
  coalesce(last_value(tvl_usd IGNORE NULLS) OVER (PARTITION BY pool_address ORDER BY hour_ts ROWS UNBOUNDED PRECEDING),
    first_value(tvl_usd IGNORE NULLS) OVER (PARTITION BY pool_address ORDER BY hour_ts
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS tvl_usd FROM gone""")
def impute(spark, sf):
    df = hours(spark, sf).withColumn("tvl_usd", S.null_negative(F.col("tvl_usd")))
    filled = ffill_bfill(error_flag(df, "tvl_usd"), ["pool_address"], "hour_ts", ["tvl_usd"])
    return filled.select("id", "tvl_error", "tvl_usd")
