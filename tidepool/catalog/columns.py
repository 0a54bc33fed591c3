"""Column expressions, filters and cut-offs (ids B9-B27, C2-C10)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidepool import fixtures as X
from tidepool.catalog.registry import (
    EXPLORED, LABELLED, POOL_EVENTS, POOL_HOURLY, WIDE, epoch, epochs, query, r, rs,
)
from tidepool.functions import scalars as S
from tidepool.functions.json_fields import epoch_to_ts
from tidepool.operators import clean as C
from tidepool.operators.features import pool_features, time_features
from tidepool.schema import NOT_FEATURES


@query("b9_to_numeric", f"""WITH {WIDE}
SELECT id, volume_usd, CAST(NULL AS DOUBLE) AS fee_text, CAST(fee_tier AS DOUBLE) AS fee_tier FROM wide""")
def b9(spark, sf):
    text = X.wide(spark, sf).select(
        "id", F.col("volume_usd").cast("string").alias("volume_usd"), F.concat(F.lit("x"), "fee_tier").alias("fee_text"),
        "fee_tier",
    )
    return C.to_numeric(text, ["volume_usd", "fee_text", "fee_tier"])


@query("b10_epoch_to_ts", f"""WITH {WIDE}
SELECT id, strftime(make_timestamp(hour_ts * 1000000), '%Y-%m-%d %H:%M:%S') AS stamp FROM wide""")
def b10(spark, sf):
    stamp = F.date_format(epoch_to_ts(F.col("hour_ts")), "yyyy-MM-dd HH:mm:ss")
    return X.wide(spark, sf).select("id", stamp.alias("stamp"))


@query("b11_split_id", f"""WITH {WIDE} SELECT id, string_split(id, '-')[1] AS pool_address,
string_split(id, '-')[2] AS block_index FROM wide""")
def b11(spark, sf):
    return C.split_id(X.wide(spark, sf).select("id"))


@query("b13_feature_columns", f"""WITH {LABELLED}
SELECT tvl_usd, volume_usd, liquidity, {rs('vol_ma_6h')} AS vol_ma_6h, vol_tvl_ratio FROM labelled""")
def b13(spark, sf):
    df = C.feature_columns(pool_features(X.pool_hourly(spark, sf)), NOT_FEATURES)
    return df.select("tvl_usd", "volume_usd", "liquidity", r("vol_ma_6h").alias("vol_ma_6h"),
                     "vol_tvl_ratio")


@query("b15_labels", f"""WITH {WIDE}
SELECT id, CASE WHEN tvl_usd >= 0 THEN token0_symbol END || '-' || token1_symbol AS pair,
       substr(id, 1, 8) || '...' AS short_8, substr(id, 1, 10) || '...' AS short_10 FROM wide""")
def b15(spark, sf):
    known = F.when(F.col("tvl_usd") >= 0, F.col("token0_symbol"))
    return X.wide(spark, sf).select(
        "id", S.pair_label(known, F.col("token1_symbol")).alias("pair"),
        S.short_label(F.col("id")).alias("short_8"), S.short_label(F.col("id"), 10).alias("short_10"),
    )


@query("b16_digit_count", f"""WITH {WIDE} SELECT id, CAST(length(liquidity_text) AS INTEGER) AS liquidity_digits,
CAST(length(sqrt_price_text) AS INTEGER) AS sqrt_price_digits FROM wide""")
def b16(spark, sf):
    return X.wide(spark, sf).select(
        "id", S.digit_count(F.col("liquidity_text")).alias("liquidity_digits"),
        S.digit_count(F.col("sqrt_price_text")).alias("sqrt_price_digits"),
    )


@query("b18_safe_log", f"""WITH {WIDE}
SELECT id, {rs('ln(CASE WHEN tvl_usd < 1e-10::DOUBLE THEN 1e-10::DOUBLE ELSE tvl_usd END)')} AS log_tvl,
       {rs('ln(CASE WHEN liquidity / 1e18::DOUBLE < 1e-10::DOUBLE THEN 1e-10::DOUBLE ELSE liquidity / 1e18::DOUBLE END)')} AS log_liquidity
FROM wide""")
def b18(spark, sf):
    return X.wide(spark, sf).select(
        "id", r(S.safe_log(F.col("tvl_usd"))).alias("log_tvl"),
        r(S.safe_log(S.scale_fixed_point(F.col("liquidity")))).alias("log_liquidity"),
    )


@query("b19_log10_log1p", f"""WITH {WIDE}
SELECT id, CASE WHEN tvl_usd > 0 THEN {rs('log10(CASE WHEN tvl_usd > 0 THEN tvl_usd END)')} END AS log10_tvl,
       {rs('ln(1 + volume_usd)')} AS log1p_volume FROM wide""")
def b19(spark, sf):
    return X.wide(spark, sf).select(
        "id", r(S.log10_positive(F.col("tvl_usd"))).alias("log10_tvl"), r(F.log1p("volume_usd")).alias("log1p_volume")
    )


@query("b20_local_hour", f"""WITH {WIDE}
SELECT id, CAST((hour_ts // 3600) % 24 AS INTEGER) AS hour_utc, CAST((hour_ts // 3600 + 9) % 24 AS INTEGER) AS hour_local FROM wide""")
def b20(spark, sf):
    ts = epoch_to_ts(F.col("hour_ts"))
    return X.wide(spark, sf).select("id", F.hour(ts).alias("hour_utc"), S.local_hour(ts).alias("hour_local"))


@query("b22_spike_flag", f"""WITH {POOL_HOURLY}
SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, CASE WHEN volume_usd >= tvl_usd THEN 1 ELSE 0 END AS y FROM pool_hourly""")
def b22(spark, sf):
    y = S.spike_flag(F.col("volume_usd"), F.col("tvl_usd"))
    return X.pool_hourly(spark, sf).select("pool_id", epoch("hour_ts").alias("hour_epoch"), y.alias("y"))


@query("b23_status", f"""WITH {WIDE}
SELECT id, CASE WHEN tvl_usd < 0 THEN 'anomalous' WHEN tvl_usd > 0 THEN 'normal' END AS status FROM wide""")
def b23(spark, sf):
    label = -F.signum("tvl_usd") * -1
    return X.wide(spark, sf).select("id", S.status(label, {1: "normal", -1: "anomalous"}).alias("status"))


@query("b24_null_negative", f"WITH {WIDE} SELECT id, CASE WHEN tvl_usd >= 0 THEN tvl_usd END AS tvl_usd FROM wide")
def b24(spark, sf):
    return C.null_negative(X.wide(spark, sf).select("id", "tvl_usd"))


@query("b25_price_change", f"WITH {WIDE} SELECT id, {rs('close_price / nullif(open_price, 0) - 1')} AS price_change FROM wide")
def b25(spark, sf):
    return X.wide(spark, sf).select("id", r(S.price_change(F.col("close_price"), F.col("open_price"))).alias("price_change"))


@query("b26_ratios", f"""WITH {WIDE}
SELECT id, volume_usd / nullif(tvl_usd, 0) AS strict, volume_usd / (tvl_usd + 1e-10::DOUBLE) AS eps,
       tvl_usd / (volume_usd + 1e-9::DOUBLE) AS inverse FROM wide""")
def b26(spark, sf):
    v, t = F.col("volume_usd"), F.col("tvl_usd")
    return X.wide(spark, sf).select(
        "id", S.ratio_or_null(v, t).alias("strict"), S.ratio_eps(v, t).alias("eps"),
        S.ratio_eps(t, v, 1e-9).alias("inverse"),
    )


@query("b27_quantile_flag", f"""WITH {WIDE}
SELECT id, volume_usd, volume_usd < lo OR volume_usd > hi AS is_outlier
FROM wide, (SELECT quantile_cont(volume_usd, 0.05) AS lo, quantile_cont(volume_usd, 0.99) AS hi FROM wide)""")
def b27(spark, sf):
    return C.quantile_flag(X.wide(spark, sf).select("id", "volume_usd"), "volume_usd", 0.05, 0.99)


@query("b27_scaling_check", f"WITH {WIDE} SELECT {rs('corr(liquidity, liquidity / 1e18::DOUBLE)')} AS corr FROM wide")
def b27_check(spark, sf):
    return C.scaling_check(X.wide(spark, sf), "liquidity", 1e18).select(r("corr").alias("corr"))


@query("c2_negatives", f"WITH {WIDE} SELECT id, hour_ts, tvl_usd FROM wide WHERE tvl_usd < 0")
def c2(spark, sf):
    return C.negatives(X.wide(spark, sf)).select("id", "hour_ts", "tvl_usd")


@query("c3_recent", f"""WITH {POOL_HOURLY}
SELECT pool_id, {epochs('hour_ts')} AS hour_epoch FROM pool_hourly WHERE hour_ts >= TIMESTAMP '2024-02-10' - INTERVAL 30 DAY""")
def c3(spark, sf):
    df = C.recent(X.pool_hourly(spark, sf), 30, datetime(2024, 2, 10))
    return df.select("pool_id", epoch("hour_ts").alias("hour_epoch"))


_CUT = f"""WITH {WIDE}
SELECT id, volume_usd FROM wide WHERE volume_usd <= (SELECT quantile_cont(volume_usd, 0.999) FROM wide)"""


@query("c4_cut_above_quantile", _CUT)
def c4(spark, sf):
    return C.cut_above_quantile(X.wide(spark, sf).select("id", "volume_usd"), "volume_usd")


@query("c4_cut_above_quantile_approx")
def c4_approx(spark, sf):
    return C.cut_above_quantile(X.wide(spark, sf).select("id", "volume_usd"), "volume_usd", approx=True)


@query("c4_cut_approx_error", f"WITH {WIDE} SELECT count(*) AS n, true AS near FROM wide")
def c4_error(spark, sf):
    """The approximate cut keeps the share asked for, within one in ten thousand rows and the ties at the limit."""
    rows = X.wide(spark, sf).select("id", "volume_usd")
    limit = C.cut_above_quantile(rows, "volume_usd", approx=True).agg(F.max("volume_usd")).scalar()
    low, high, n = F.count_if(F.col("volume_usd") < limit), F.count_if(F.col("volume_usd") <= limit), F.count("*")
    slack = n / 10_000 + 1
    return rows.agg(n.alias("n"), ((low <= 0.999 * n + slack) & (high >= 0.999 * n - slack)).alias("near"))


@query("c5_drop_missing", f"""WITH {EXPLORED}
SELECT id, {rs('volume_deviation')} AS volume_deviation, {rs('price_change')} AS price_change FROM explored
WHERE volume_deviation IS NOT NULL AND price_change IS NOT NULL""")
def c5(spark, sf):
    df = C.drop_missing(time_features(_hours(X.wide(spark, sf))), ["volume_deviation", "price_change"])
    return df.select("id", r("volume_deviation").alias("volume_deviation"), r("price_change").alias("price_change"))


def _hours(df):
    return df.withColumn("hour_ts", epoch_to_ts(F.col("hour_ts")))


@query("c6_clip", f"""WITH {WIDE}
SELECT id, CASE WHEN tvl_usd < 0 THEN 0 ELSE tvl_usd END AS tvl_usd, {rs('''CASE WHEN volume_usd > hi THEN hi
  WHEN volume_usd < lo THEN lo ELSE volume_usd END''')} AS volume_usd
FROM wide, (SELECT quantile_cont(volume_usd, 0.01) AS lo, quantile_cont(volume_usd, 0.99) AS hi FROM wide)""")
def c6(spark, sf):
    df = C.clip_quantiles(X.wide(spark, sf).select("id", "tvl_usd", "volume_usd"), "volume_usd")
    return df.select("id", S.clip(F.col("tvl_usd"), lo=0).alias("tvl_usd"), r("volume_usd").alias("volume_usd"))


@query("c7_positive", f"WITH {WIDE} SELECT id, volume_usd FROM wide WHERE volume_usd > 0")
def c7(spark, sf):
    return C.positive(X.wide(spark, sf), "volume_usd").select("id", "volume_usd")


@query("c8_iqr_cap", f"""WITH {WIDE}
SELECT id, {rs('least(volume_usd, q3 + 5 * (q3 - q1))')} AS volume_usd
FROM wide, (SELECT quantile_cont(volume_usd, 0.25) AS q1, quantile_cont(volume_usd, 0.75) AS q3 FROM wide)""")
def c8(spark, sf):
    df = C.iqr_cap(X.wide(spark, sf).select("id", "volume_usd"), "volume_usd")
    return df.withColumn("volume_usd", r("volume_usd"))


@query("c9_between_dates", f"""WITH {POOL_EVENTS}
SELECT event_id, pool_id FROM pool_events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""")
def c9(spark, sf):
    df = C.between_dates(X.pool_events(spark, sf), "ts", date(2024, 1, 5), date(2024, 1, 20))
    return df.select("event_id", "pool_id")


@query("c10_newer_than", f"""WITH {POOL_HOURLY}
SELECT pool_id, {epochs('hour_ts')} AS hour_epoch FROM pool_hourly
WHERE hour_ts > (SELECT max(hour_ts) FROM pool_hourly WHERE tvl_usd < 0)""")
def c10(spark, sf):
    df = X.pool_hourly(spark, sf)
    return C.newer_than(df, df.where("tvl_usd < 0")).select("pool_id", epoch("hour_ts").alias("hour_epoch"))


@query("e2_null_counts", f"""WITH {EXPLORED}
SELECT count(*) FILTER (volume_ma24 IS NULL) AS volume_ma24, count(*) FILTER (price_change IS NULL) AS price_change,
       count(*) FILTER (volume_usd IS NULL) AS volume_usd FROM explored""")
def e2(spark, sf):
    from tidepool.operators.profile import null_counts

    return null_counts(time_features(_hours(X.wide(spark, sf))), ["volume_ma24", "price_change", "volume_usd"])


