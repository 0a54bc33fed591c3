"""Data-quality and distribution reports, top-k, calendars, set operations (ids E, G, H, D4-D7)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidepool import fixtures as X
from tidepool.catalog.registry import (
    EXPLORED, POOL_EVENTS, POOL_HOURLY, WIDE, day, days, epoch, epochs, query, r, rs, sci, scis,
)
from tidepool.catalog.windows import explored, hours
from tidepool.functions import scalars as S
from tidepool.functions.json_fields import epoch_to_ts
from tidepool.operators import combine as J
from tidepool.operators import profile as P
from tidepool.session import materialized

# -- counts and rates --------------------------------------------------------------


@query("e1_summary", f"""WITH {WIDE}
SELECT count(*) AS "rows", count(DISTINCT pool_address) AS pools, count(DISTINCT (token0_symbol, token1_symbol)) AS pairs,
       min(hour_ts) AS first_ts, max(hour_ts) AS last_ts, {rs('avg(CASE WHEN tvl_usd IS NULL THEN 1 ELSE 0 END)', 9)} AS tvl_missing_rate,
       {rs('avg(CASE WHEN tvl_usd < 0 THEN 1 ELSE 0 END)', 9)} AS tvl_negative_rate FROM wide""")
def e1(spark, sf):
    df = P.summary(X.wide(spark, sf))
    return df.withColumns({c: r(c, 9) for c in ("tvl_missing_rate", "tvl_negative_rate")})


_COPIED = f"""WITH {WIDE}, copied AS (SELECT pool_address, volume_usd FROM wide
  UNION ALL SELECT pool_address, volume_usd FROM wide WHERE tvl_usd < 0)"""


def _copied(spark, sf):
    w = X.wide(spark, sf)
    return w.select("pool_address", "volume_usd").union(w.where("tvl_usd < 0").select("pool_address", "volume_usd"))


@query("e3_duplicate_count", f"""{_COPIED}
SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM copied)) AS BIGINT) AS duplicates FROM copied""")
def e3(spark, sf):
    return P.duplicate_count(_copied(spark, sf))


@query("e4_rate_by_fee_tier", f"""WITH {POOL_EVENTS}
SELECT fee_tier, {rs('avg(CASE WHEN tvl_usd < 0 THEN 1 ELSE 0 END)', 9)} AS rate FROM pool_events GROUP BY 1""")
def e4(spark, sf):
    df = P.rate(X.pool_events(spark, sf), F.col("tvl_usd") < 0, ["fee_tier"])
    return df.withColumn("rate", r("rate", 9))


@query("e5_value_counts", f"WITH {WIDE} SELECT fee_tier, count(*) AS count FROM wide GROUP BY 1")
def e5(spark, sf):
    return P.value_counts(X.wide(spark, sf), "fee_tier")


_DESCRIBED = ["volume_usd", "tvl_usd", "tx_count"]


def _describe_sql(source, col, by=""):
    return f"""SELECT {by}'{col}' AS "column", count({col}) AS count, {scis(f'avg({col})')} AS mean,
  {scis(f'stddev_samp({col})')} AS std, {scis(f'min({col})')} AS min, {scis(f'quantile_cont({col}, 0.25)')} AS p25,
  {scis(f'quantile_cont({col}, 0.5)')} AS p50, {scis(f'quantile_cont({col}, 0.75)')} AS p75, {scis(f'max({col})')} AS max
  FROM {source}"""


_STATS = ("mean", "std", "min", "p25", "p50", "p75", "max")


@query("e6_describe", f"WITH {WIDE} " + " UNION ALL ".join(_describe_sql("wide", c) for c in _DESCRIBED))
def e6(spark, sf):
    return P.describe(X.wide(spark, sf), _DESCRIBED).withColumns({c: sci(c) for c in _STATS})


_QUALITY = f"""WITH {WIDE}, quality AS (
  SELECT pool_address, count(tvl_usd) AS count, count(*) FILTER (tvl_usd < 0) AS negative_count,
         {rs('avg(CASE WHEN tvl_usd < 0 THEN 1 ELSE 0 END)', 9)} AS negative_share, min(tvl_usd) AS min, max(tvl_usd) AS max,
         {rs('avg(tvl_usd)')} AS mean FROM wide GROUP BY 1)"""


def _quality(spark, sf):
    df = P.pool_quality(X.wide(spark, sf))
    return df.withColumns({"negative_share": r("negative_share", 9), "mean": r("mean")})


@query("e7_pool_quality", f"{_QUALITY} SELECT * FROM quality")
def e7(spark, sf):
    return _quality(spark, sf)


@query("e8_quality_split", f"""{_QUALITY}
SELECT count(*) AS pools, count(*) FILTER (negative_share > 0) AS negative_pools,
       count(*) FILTER (negative_share = 0) AS valid_pools,
       {rs('count(*) FILTER (negative_share > 0) / count(*)', 9)} AS negative_pool_share,
       {rs('count(*) FILTER (negative_share = 0) / count(*)', 9)} AS valid_pool_share FROM quality""")
def e8(spark, sf):
    df = P.quality_split(_quality(spark, sf))
    return df.withColumns({c: r(c, 9) for c in ("negative_pool_share", "valid_pool_share")})


@query("e9_daily_volume", f"""WITH {POOL_HOURLY}
SELECT {days('hour_ts')} AS date, {rs('sum(volume_usd)', 4)} AS volume_usd FROM pool_hourly GROUP BY 1""")
def e9(spark, sf):
    df = J.daily_volume(X.pool_hourly(spark, sf), F.col("hour_ts"))
    return df.select(day("date").alias("date"), r("volume_usd", 4).alias("volume_usd"))


@query("e10_daily_by_pool", f"""WITH {POOL_HOURLY}
SELECT pool_id, {days('hour_ts')} AS date, {rs('sum(volume_usd)', 4)} AS volume_usd, {rs('sum(tvl_usd)', 4)} AS tvl_usd
FROM pool_hourly GROUP BY 1, 2""")
def e10(spark, sf):
    df = J.daily_volume(X.pool_hourly(spark, sf), F.col("hour_ts"), ["volume_usd", "tvl_usd"], ["pool_id"])
    return df.select("pool_id", day("date").alias("date"), r("volume_usd", 4).alias("volume_usd"), r("tvl_usd", 4).alias("tvl_usd"))


@query("e11_resample_daily", f"""WITH {POOL_HOURLY}, daily AS (
  SELECT pool_id, CAST(hour_ts AS DATE) AS d, sum(volume_usd) AS volume_usd FROM pool_hourly GROUP BY 1, 2), grid AS (
  SELECT pool_id, CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM daily GROUP BY 1)
SELECT pool_id, {days('d')} AS date, {rs('coalesce(volume_usd, 0)', 4)} AS volume_usd FROM grid LEFT JOIN daily USING (pool_id, d)""")
def e11(spark, sf):
    df = J.resample_daily(X.pool_hourly(spark, sf), F.col("hour_ts"), ["volume_usd"], ["pool_id"])
    return df.select("pool_id", day("date").alias("date"), r("volume_usd", 4).alias("volume_usd"))


@query("e12_hourly_pattern", f"""WITH {WIDE}
SELECT CAST((hour_ts // 3600 + 9) % 24 AS INTEGER) AS hour, count(*) AS count FROM wide WHERE tvl_usd < 0 GROUP BY 1""")
def e12(spark, sf):
    df = X.wide(spark, sf).where("tvl_usd < 0")
    return P.hourly_pattern(df, S.local_hour(epoch_to_ts(F.col("hour_ts"))))


_SEVEN = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


@query("e15_quantiles", f"WITH {WIDE} " + " UNION ALL ".join(
    f"SELECT {q}::DOUBLE AS q, {scis(f'quantile_cont(liquidity / 1e18::DOUBLE, {q})')} AS value FROM wide" for q in _SEVEN))
def e15(spark, sf):
    scaled = X.wide(spark, sf).select(S.scale_fixed_point(F.col("liquidity")).alias("x"))
    return P.quantiles(scaled, "x", _SEVEN).withColumn("value", sci("value"))


_TIER_STATS = f"""fee_stats AS (SELECT fee_tier, avg(volume_usd) AS volume_usd_mean, stddev_samp(volume_usd) AS volume_usd_std,
  max(volume_usd) AS volume_usd_max, avg(tvl_usd) AS tvl_usd_mean, stddev_samp(tvl_usd) AS tvl_usd_std,
  avg(tx_count) AS tx_count_mean, avg(volume_deviation) AS volume_deviation_mean,
  stddev_samp(volume_deviation) AS volume_deviation_std,
  avg(CASE WHEN abs(volume_deviation) > 3 THEN 1 ELSE 0 END) AS volume_deviation_anomaly_rate FROM explored GROUP BY 1)"""
_TIER_COLS = ["volume_usd_mean", "volume_usd_std", "volume_usd_max", "tvl_usd_mean", "tvl_usd_std", "tx_count_mean",
              "volume_deviation_mean", "volume_deviation_std", "volume_deviation_anomaly_rate"]


@query("e16_fee_tier_stats", f"WITH {EXPLORED}, {_TIER_STATS} SELECT fee_tier, " + ", ".join(
    f"{rs(c)} AS {c}" for c in _TIER_COLS) + " FROM fee_stats")
def e16(spark, sf):
    return P.fee_tier_stats(explored(spark, sf)).withColumns({c: r(c) for c in _TIER_COLS})


@query("e17_anomaly_rate", f"""WITH {EXPLORED}
SELECT protocol, {rs('avg(CASE WHEN abs(volume_deviation) > 3 THEN 1 ELSE 0 END)', 9)} AS rate FROM explored GROUP BY 1""")
def e17(spark, sf):
    return explored(spark, sf).groupBy("protocol").agg(r(P.anomaly_rate(F.col("volume_deviation")), 9).alias("rate"))


@query("e18_pair_counts", f"""WITH {WIDE}
SELECT token0_symbol, token1_symbol, count(*) AS count, token0_symbol || '-' || token1_symbol AS pair_label FROM wide
GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 15""")
def e18(spark, sf):
    return P.pair_counts(X.wide(spark, sf), 15)


@query("e19_crosstab", f"""WITH {POOL_EVENTS}
SELECT fee_tier, count(*) FILTER (tvl_usd < 0) AS neg, count(*) FILTER (NOT tvl_usd < 0) AS valid FROM pool_events GROUP BY 1""")
def e19(spark, sf):
    return P.crosstab(X.pool_events(spark, sf), "fee_tier", F.col("tvl_usd") < 0)


_CORR = ["volume_usd", "tvl_usd", "fees_usd", "tx_count", "liquidity", "volume_deviation", "volume_tvl_ratio"]


@query("e20_corr_matrix", f"WITH {EXPLORED} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {rs(f'corr({a}, {b})')} AS corr FROM explored" for a in _CORR for b in _CORR))
def e20(spark, sf):
    return P.corr_matrix(explored(spark, sf), _CORR).withColumn("corr", r("corr"))


@query("e21_moments", f"""WITH {WIDE}, m AS (SELECT avg(tvl_usd) AS m FROM wide), c AS (
  SELECT avg(pow(tvl_usd - m, 2)) AS m2, avg(pow(tvl_usd - m, 3)) AS m3, avg(pow(tvl_usd - m, 4)) AS m4 FROM wide, m)
SELECT {rs('avg(tvl_usd)')} AS mean, {rs('quantile_cont(tvl_usd, 0.5)')} AS median, {rs('stddev_samp(tvl_usd)')} AS std,
  {rs('any_value(m3) / pow(any_value(m2), 1.5)')} AS skewness, {rs('any_value(m4) / pow(any_value(m2), 2) - 3')} AS kurtosis
FROM wide, c""")
def e21(spark, sf):
    df = P.moments(X.wide(spark, sf), "tvl_usd")
    return df.select(*[r(c).alias(c) for c in ("mean", "median", "std", "skewness", "kurtosis")])


def _hist_sql(source, col, bins):
    return f"""b AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {source}), axis AS (SELECT unnest(range({bins})) AS bin),
  h AS (SELECT CAST(least(floor(({col} - lo) / ((hi - lo) / {bins})), {bins} - 1) AS BIGINT) AS bin, count(*) AS n
        FROM {source}, b GROUP BY 1)
SELECT CAST(axis.bin AS BIGINT) AS bin, {rs(f'lo + axis.bin * ((hi - lo) / {bins})')} AS lo, coalesce(n, 0) AS count
FROM axis LEFT JOIN h ON axis.bin = h.bin, b"""


@query("e22_histogram", f"WITH {WIDE}, " + _hist_sql("wide", "volume_usd", 100))
def e22(spark, sf):
    return P.histogram(X.wide(spark, sf), "volume_usd", 100).select("bin", r("lo").alias("lo"), "count")


@query("e22_histogram_log1p", f"WITH {WIDE}, logs AS (SELECT ln(1 + volume_usd) AS x FROM wide), " + _hist_sql("logs", "x", 50))
def e22_log(spark, sf):
    logs = X.wide(spark, sf).select(F.log(1 + F.col("volume_usd")).alias("x"))
    return P.histogram(logs, "x", 50).select("bin", r("lo").alias("lo"), "count")


@query("e23_box_stats", f"""WITH {WIDE}, q AS (SELECT quantile_cont(volume_usd, 0.25) AS q1, quantile_cont(volume_usd, 0.5) AS median,
  quantile_cont(volume_usd, 0.75) AS q3 FROM wide), w AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT count(volume_usd) AS count, {rs('any_value(q1)')} AS q1, {rs('any_value(median)')} AS median, {rs('any_value(q3)')} AS q3,
  min(volume_usd) FILTER (volume_usd >= lo) AS whisker_low, max(volume_usd) FILTER (volume_usd <= hi) AS whisker_high,
  count(*) FILTER (volume_usd < lo OR volume_usd > hi) AS outliers FROM wide, w""")
def e23(spark, sf):
    df = P.box_stats(X.wide(spark, sf), "volume_usd")
    return df.withColumns({c: r(c) for c in ("q1", "median", "q3")})


@query("e24_kde", f"""WITH {WIDE}, x AS (SELECT log10(liquidity / 1e18::DOUBLE) AS x FROM wide WHERE liquidity > 0), s AS (
  SELECT min(x) - 3 * stddev_samp(x) * pow(count(*), -0.2) AS lo, max(x) + 3 * stddev_samp(x) * pow(count(*), -0.2) AS hi,
         stddev_samp(x) * pow(count(*), -0.2) AS h, count(*) AS n FROM x), g AS (
  SELECT CAST(i AS INTEGER) AS i, lo + i * ((hi - lo) / 63) AS gx, h, n FROM s, range(64) t(i))
SELECT i, {rs('any_value(gx)')} AS x, {rs('sum(exp(-pow((x - gx) / h, 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi()))')} AS density
FROM g, x GROUP BY i""")
def e24(spark, sf):
    logs = X.wide(spark, sf).where("liquidity > 0").select(F.log10(S.scale_fixed_point(F.col("liquidity"))).alias("x"))
    return P.kde(logs, "x").select("i", r("x").alias("x"), r("density").alias("density"))


# The candidate scaling factors.
FACTORS = {"1e6": 1e6, "1e12": 1e12, "1e18": 1e18, "2^96": 2.0**96, "2^128": 2.0**128}


@query("e25_scale_sweep", f"WITH {WIDE} " + " UNION ALL ".join(
    f"SELECT '{n}' AS factor, * FROM ({_describe_sql(f'(SELECT {c} / {v!r}::DOUBLE AS {c} FROM wide)', c)})"
    for n, v in FACTORS.items() for c in ("liquidity", "sqrt_price")))
def e25(spark, sf):
    return P.scale_sweep(X.wide(spark, sf), ["liquidity", "sqrt_price"], FACTORS).withColumns({c: sci(c) for c in _STATS})


_FLAGGED = f"""WITH {EXPLORED}, flagged AS (SELECT *, coalesce(abs(volume_deviation) > 3, false) AS is_anomaly FROM explored)"""


def _flagged(spark, sf):
    return explored(spark, sf).withColumn("is_anomaly", S.is_true(F.abs("volume_deviation") > 3))


@query("e26_anomalies_by_pool", f"""{_FLAGGED} SELECT pool_address, count(*) AS anomalies FROM flagged WHERE is_anomaly
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def e26(spark, sf):
    return P.anomaly_counts(_flagged(spark, sf), ["pool_address"], k=10)


@query("e26_anomalies_by_pair", f"""{_FLAGGED} SELECT token0_symbol || '-' || token1_symbol AS token_pair, count(*) AS anomalies
FROM flagged WHERE is_anomaly GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def e26_pair(spark, sf):
    pair = S.pair_label(F.col("token0_symbol"), F.col("token1_symbol"))
    return P.anomaly_counts(_flagged(spark, sf).withColumn("token_pair", pair), ["token_pair"], k=10)


@query("e27_weekday_hour_profile", f"""WITH {POOL_HOURLY}
SELECT CAST(isodow(hour_ts) - 1 AS INTEGER) AS weekday, CAST(hour(hour_ts) AS INTEGER) AS hour, {rs('avg(volume_usd)', 9)} AS mean,
       count(*) FILTER (tvl_usd < 0) AS negatives FROM pool_hourly GROUP BY 1, 2""")
def e27(spark, sf):
    return P.weekday_hour_profile(X.pool_hourly(spark, sf), F.col("hour_ts")).withColumn("mean", r("mean", 9))


# -- top-k and samples ---------------------------------------------------------------


@query("g1_top_pools", f"""WITH {WIDE} SELECT pool_address, {rs('sum(volume_usd)', 4)} AS total FROM wide
GROUP BY 1 ORDER BY sum(CAST(volume_usd AS DECIMAL(18,2))) DESC, 1 LIMIT 5""")
def g1(spark, sf):
    return P.top_pools(X.wide(spark, sf), 5).withColumn("total", r("total", 4))


_RANKED = f"""WITH {EXPLORED}, lim AS (SELECT quantile_cont(volume_tvl_ratio, 0.99) AS rhi, quantile_cont(volume_deviation, 0.01) AS dlo,
  quantile_cont(volume_deviation, 0.99) AS dhi FROM explored), clipped AS (
  SELECT id, pool_address, hour_ts, CASE WHEN volume_tvl_ratio > rhi THEN rhi ELSE volume_tvl_ratio END AS volume_tvl_ratio,
    CASE WHEN volume_deviation > dhi THEN dhi WHEN volume_deviation < dlo THEN dlo ELSE volume_deviation END AS volume_deviation
  FROM explored, lim), scored AS (SELECT *, round(abs(volume_deviation) * volume_tvl_ratio, 6) AS score FROM clipped)"""


def _score():
    return F.round(F.abs("volume_deviation") * F.col("volume_tvl_ratio"), 6)


def _stored(spark, sf):
    """The features feed both the bounds and the ranking, so they are computed once."""
    return materialized(explored(spark, sf).select("id", "pool_address", "hour_ts", "volume_tvl_ratio", "volume_deviation"), "explored")


@query("g2_top_anomalies", f"""{_RANKED} SELECT id, {rs('score')} AS score FROM scored WHERE score IS NOT NULL
ORDER BY scored.score DESC, pool_address, hour_ts LIMIT 5""")
def g2(spark, sf):
    top = P.top_by(P.clip_for_ranking(_stored(spark, sf)), _score(), 5, ["pool_address", "hour_ts"])
    return top.select("id", r(_score()).alias("score"))


@query("g2_top_anomalies_unclipped", f"""WITH {EXPLORED} SELECT id FROM explored
WHERE abs(volume_deviation) * volume_tvl_ratio IS NOT NULL
ORDER BY abs(volume_deviation) * volume_tvl_ratio DESC, pool_address, hour_ts LIMIT 5""")
def g2_raw(spark, sf):
    return P.top_anomalies(explored(spark, sf), 5).select("id")


@query("g3_rank_pools", f"{_QUALITY} SELECT * FROM quality ORDER BY mean DESC, pool_address LIMIT 10")
def g3(spark, sf):
    return P.rank_pools(_quality(spark, sf), "mean", 10)


@query("g3_lowest_negative_share", f"""{_QUALITY} SELECT pool_address, negative_share FROM quality WHERE negative_share > 0
ORDER BY negative_share, pool_address LIMIT 20""")
def g3_tail(spark, sf):
    found = _quality(spark, sf).where("negative_share > 0")
    return P.rank_pools(found, "negative_share", 20, ascending=True).select("pool_address", "negative_share")


@query("g4_latest_row", f"""WITH {POOL_HOURLY} SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, volume_usd FROM pool_hourly
ORDER BY hour_ts DESC, pool_id LIMIT 1""")
def g4(spark, sf):
    row = P.latest_row(X.pool_hourly(spark, sf))
    return row.select("pool_id", epoch("hour_ts").alias("hour_epoch"), "volume_usd")


@query("g5_top_pools_of_rows", f"""{_RANKED} SELECT pool_address, {rs('max(score)')} AS best FROM scored WHERE score IS NOT NULL
GROUP BY 1 ORDER BY max(score) DESC, 1 LIMIT 3""")
def g5(spark, sf):
    df = P.top_pools_of_rows(P.clip_for_ranking(_stored(spark, sf)), _score(), 3)
    return df.withColumn("best", r("best"))


@query("g6_top_by_volume", f"{_FLAGGED} SELECT id, volume_usd FROM flagged WHERE is_anomaly ORDER BY volume_usd DESC, id LIMIT 5")
def g6(spark, sf):
    return P.top_by(_flagged(spark, sf).where("is_anomaly"), "volume_usd", 5, ["id"]).select("id", "volume_usd")


@query("g7_sample_n")
def g7(spark, sf):
    return P.sample_n(X.wide(spark, sf).select("id", "volume_usd", "tvl_usd", "fees_usd", "tx_count"), 5000, ["id"])


@query("g7_sample_size", f"""WITH {WIDE} SELECT least(5000, count(*)) AS n, least(5000, count(*)) AS ids, count(*) > 0 AS members FROM wide""")
def g7_size(spark, sf):
    """Exactly as many rows as asked for, no row twice, none from elsewhere."""
    drawn = g7(spark, sf)
    known = X.wide(spark, sf).select("id", F.lit(True).alias("_known"))
    return drawn.join(known, "id", "left").agg(
        F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.bool_and(F.col("_known")).alias("members")
    )


@query("d4_missing_days_by_pool", f"""WITH {POOL_HOURLY}, lim AS (
  SELECT pool_id, min(CAST(hour_ts AS DATE)) AS lo, max(CAST(hour_ts AS DATE)) AS hi FROM pool_hourly GROUP BY 1), d AS (
  SELECT pool_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM lim)
SELECT pool_id, {days('d')} AS date FROM d WHERE (pool_id, d) NOT IN (SELECT (pool_id, CAST(hour_ts AS DATE)) FROM pool_hourly)""")
def d4_by_pool(spark, sf):
    df = J.missing_hours_by(X.pool_hourly(spark, sf), "hour_ts", ["pool_id"])
    return df.where("complete").select("pool_id", day("date").alias("date"))


# -- calendars -------------------------------------------------------------------------

_START, _END = date(2023, 12, 25), date(2024, 2, 5)
_AXIS = "axis AS (SELECT CAST(unnest(generate_series(DATE '2023-12-25', DATE '2024-02-05', INTERVAL 1 DAY)) AS DATE) AS d)"


@query("d4_missing_days", f"""WITH {POOL_EVENTS}, {_AXIS}
SELECT {days('d')} AS date FROM axis WHERE d NOT IN (SELECT CAST(ts AS DATE) FROM pool_events)""")
def d4(spark, sf):
    return J.missing_days(X.pool_events(spark, sf), "ts", _START, _END).select(day("date").alias("date"))


_HOUR_TEXT = "array_to_string(list_sort(list(h)), ',')"


def _hours_out(df, *by):
    text = F.array_join(F.transform("hours", lambda h: h.cast("string")), ",")
    return df.select(*by, day("date").alias("date"), text.alias("hours"), "complete")


@query("d5_missing_hours", f"""WITH {POOL_EVENTS}, {_AXIS}, grid AS (SELECT d, h FROM axis, range(24) t(h))
SELECT {days('d')} AS date, {_HOUR_TEXT} AS hours, count(*) = 24 AS complete FROM grid
WHERE (d, h) NOT IN (SELECT (CAST(ts AS DATE), hour(ts)) FROM pool_events) GROUP BY d""")
def d5(spark, sf):
    return _hours_out(J.missing_hours(X.pool_events(spark, sf), "ts", _START, _END))


@query("d5_missing_hours_by_pool", f"""WITH {POOL_HOURLY}, lim AS (
  SELECT pool_id, min(CAST(hour_ts AS DATE)) AS lo, max(CAST(hour_ts AS DATE)) AS hi FROM pool_hourly GROUP BY 1), d AS (
  SELECT pool_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM lim), grid AS (SELECT pool_id, d, h FROM d, range(24) t(h))
SELECT g.pool_id, {days('d')} AS date, {_HOUR_TEXT} AS hours, count(*) = 24 AS complete FROM grid g
LEFT JOIN pool_hourly p ON p.pool_id = g.pool_id AND p.hour_ts = d + to_hours(h) WHERE p.pool_id IS NULL GROUP BY g.pool_id, d""")
def d5_by_pool(spark, sf):
    return _hours_out(J.missing_hours_by(X.pool_hourly(spark, sf), "hour_ts", ["pool_id"]), "pool_id")


# every pool with a broken stamp beside its hours: one row more in a report, not a grid up to it
_BROKEN = "TIMESTAMP '9999-12-31 05:00:00'"
_FIRST_DAY, _LAST_DAY = date(2024, 1, 2), date(2024, 1, 29)


def _with_broken(spark, sf):
    hours = X.pool_hourly(spark, sf).select("pool_id", "hour_ts")
    return hours.unionByName(hours.groupBy("pool_id").agg(F.expr(_BROKEN).alias("hour_ts")))


@query("d5_missing_spans_by_pool", f"""WITH {POOL_HOURLY}, n AS (
  SELECT pool_id, hour_ts, lead(hour_ts) OVER (PARTITION BY pool_id ORDER BY hour_ts) AS after FROM pool_hourly
  WHERE CAST(hour_ts AS DATE) BETWEEN DATE '2024-01-02' AND DATE '2024-01-29')
SELECT pool_id, {epochs('hour_ts')} + 3600 AS first_epoch, {epochs('after')} - 3600 AS last_epoch, ({epochs('after')} - {epochs('hour_ts')}) // 3600 - 1 AS hours
FROM n WHERE after > hour_ts + INTERVAL 1 HOUR""")
def d5_spans(spark, sf):
    spans = J.missing_spans(_with_broken(spark, sf), "hour_ts", ["pool_id"], _FIRST_DAY, _LAST_DAY)
    return spans.select("pool_id", epoch("first").alias("first_epoch"), epoch("last").alias("last_epoch"), "hours")


@query("d5_outside_range", f"""WITH {POOL_HOURLY}, b AS (
  SELECT pool_id, hour_ts FROM pool_hourly UNION ALL SELECT DISTINCT pool_id, {_BROKEN} FROM pool_hourly)
SELECT pool_id, count(*) AS "rows", {epochs('min(hour_ts)')} AS earliest, {epochs('max(hour_ts)')} AS latest FROM b
WHERE CAST(hour_ts AS DATE) NOT BETWEEN DATE '2024-01-02' AND DATE '2024-01-29' GROUP BY pool_id""")
def d5_outside(spark, sf):
    found = J.outside_range(_with_broken(spark, sf), "hour_ts", ["pool_id"], _FIRST_DAY, _LAST_DAY)
    return found.select("pool_id", "rows", epoch("earliest").alias("earliest"), epoch("latest").alias("latest"))


@query("d6_dense_counts", f"""WITH {WIDE} SELECT CAST(h AS INTEGER) AS hour, count(id) AS count FROM range(24) t(h)
LEFT JOIN (SELECT id, (hour_ts // 3600 + 9) % 24 AS lh FROM wide WHERE tvl_usd < 0) ON lh = h GROUP BY 1""")
def d6(spark, sf):
    local = S.local_hour(epoch_to_ts(F.col("hour_ts")))
    df = X.wide(spark, sf).where("tvl_usd < 0").select(local.alias("hour"))
    return J.dense_counts(df, "hour", 24)


@query("d7_only_top", f"""WITH {WIDE}, top AS (SELECT pool_address FROM wide GROUP BY 1
  ORDER BY sum(CAST(volume_usd AS DECIMAL(18,2))) DESC, 1 LIMIT 5), kept AS (SELECT * FROM wide JOIN top USING (pool_address))
SELECT pool_address, strftime(make_timestamp(hour_ts * 1000000), '%Y-%m-%d') AS date, {rs('sum(volume_usd)', 4)} AS volume_usd,
  {rs('sum(tvl_usd)', 4)} AS tvl_usd FROM kept GROUP BY 1, 2""")
def d7(spark, sf):
    df = hours(spark, sf)
    kept = J.only_top(df, P.top_pools(df, 5))
    out = J.daily_volume(kept, F.col("hour_ts"), ["volume_usd", "tvl_usd"], ["pool_address"])
    return out.select("pool_address", day("date").alias("date"), r("volume_usd", 4).alias("volume_usd"),
                      r("tvl_usd", 4).alias("tvl_usd"))


# -- set operations ----------------------------------------------------------------------


@query("h2_distinct_rows", f"WITH {WIDE} SELECT DISTINCT token0_symbol, token1_symbol FROM wide")
def h2(spark, sf):
    return J.distinct_rows(X.wide(spark, sf), ["token0_symbol", "token1_symbol"])


@query("h3_drop_exact_duplicates", f"{_COPIED} SELECT DISTINCT * FROM copied")
def h3(spark, sf):
    return J.drop_exact_duplicates(_copied(spark, sf))


@query("h4_minus", f"""WITH {POOL_HOURLY} SELECT DISTINCT pool_id, {days('hour_ts')} AS date FROM pool_hourly
EXCEPT SELECT pool_id, {days('hour_ts')} FROM pool_hourly WHERE volume_usd = 0""")
def h4(spark, sf):
    df = X.pool_hourly(spark, sf).select("pool_id", day("hour_ts").alias("date"), "volume_usd")
    return J.minus(df.select("pool_id", "date"), df.where("volume_usd = 0").select("pool_id", "date"))
