"""Tests, decomposition and scaling (ids I1-I7, J1, J2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool import fixtures as X
from tidepool.catalog.registry import EXPLORED, POOL_EVENTS, POOL_HOURLY, WIDE, day, days, query, r, rs
from tidepool.catalog.windows import explored
from tidepool.functions import scalars as S
from tidepool.functions.json_fields import epoch_to_ts
from tidepool.operators import combine as J
from tidepool.operators import profile as P
from tidepool.operators import scaling as Z
from tidepool.operators import stats as T


def _local_hours(spark, sf):
    local = S.local_hour(epoch_to_ts(F.col("hour_ts")))
    return J.dense_counts(X.wide(spark, sf).where("tvl_usd < 0").select(local.alias("hour")), "hour", 24)


@query("i1_chi2_uniform", f"""WITH {WIDE}, c AS (SELECT h, count(id) AS o FROM range(24) t(h)
  LEFT JOIN (SELECT id, (hour_ts // 3600 + 9) % 24 AS lh FROM wide WHERE tvl_usd < 0) ON lh = h GROUP BY 1)
SELECT {rs('sum(pow(o - e, 2) / e)')} AS chi2, CAST(count(*) - 1 AS BIGINT) AS df FROM c, (SELECT avg(o) AS e FROM c)""")
def i1(spark, sf):
    return T.chi2_uniform(_local_hours(spark, sf)).select(r("chi2").alias("chi2"), "df")


def _q(a: str, x: str) -> str:
    """Q(a, x) in SQL: one minus the lower tail, as one sum over x^(a + n) e^-x / gamma(a + n + 1)."""
    terms = f"range(CAST({x} + 20 * sqrt({x}) + 200 AS BIGINT))"
    lower = f"list_sum(list_transform({terms}, lambda n: exp(({a} + n) * ln({x}) - ({x}) - lgamma({a} + n + 1))))"
    return f"CASE WHEN {x} <= 0 THEN 1 WHEN {x} > 20 * ({a} + 50) THEN 0 ELSE greatest(1 - {lower}, 0) END"


def _p(q_of: str) -> str:
    return rs(q_of, 9)


_Z_P = _p(_q("0.5::DOUBLE", "(z * z / 2)"))
_CHI2_P = _p(_q("(df / 2.0::DOUBLE)", "(chi2 / 2)"))
_I1 = f"""WITH {WIDE}, c AS (SELECT h, count(id) AS o FROM range(24) t(h)
  LEFT JOIN (SELECT id, (hour_ts // 3600 + 9) % 24 AS lh FROM wide WHERE tvl_usd < 0) ON lh = h GROUP BY 1), test AS (
  SELECT sum(pow(o - e, 2) / e) AS chi2, CAST(count(*) - 1 AS BIGINT) AS df FROM c, (SELECT avg(o) AS e FROM c))"""


@query("i1_chi2_uniform_p", f"{_I1} SELECT {rs('chi2')} AS chi2, df, {_CHI2_P} AS p FROM test")
def i1_p(spark, sf):
    return T.chi2_uniform(_local_hours(spark, sf)).select(r("chi2").alias("chi2"), "df", r("p", 9).alias("p"))


def _table(spark, sf):
    return P.crosstab(X.pool_events(spark, sf), "fee_tier", F.col("tvl_usd") < 0)


_TABLE = f"""WITH {POOL_EVENTS}, tbl AS (SELECT fee_tier, count(*) FILTER (tvl_usd < 0) AS neg,
  count(*) FILTER (NOT tvl_usd < 0) AS valid FROM pool_events GROUP BY 1), tot AS (
  SELECT sum(neg) AS m, sum(valid) AS v, sum(neg + valid) AS n, count(*) AS k FROM tbl), chi AS (
  SELECT sum(pow(neg - (neg + valid) * m / n, 2) / ((neg + valid) * m / n)
           + pow(valid - (neg + valid) * v / n, 2) / ((neg + valid) * v / n)) AS chi2 FROM tbl, tot)"""


@query("i2_chi2_independence", f"""{_TABLE}
SELECT {rs('chi2')} AS chi2, CAST(k - 1 AS INTEGER) AS df, CAST(n AS BIGINT) AS n FROM chi, tot""")
def i2(spark, sf):
    return T.chi2_independence(_table(spark, sf)).select(r("chi2").alias("chi2"), "df", "n")


@query("i2_chi2_independence_p", f"""{_TABLE}, test AS (SELECT chi2, CAST(k - 1 AS INTEGER) AS df FROM chi, tot)
SELECT df, {_CHI2_P} AS p FROM test""")
def i2_p(spark, sf):
    return T.chi2_independence(_table(spark, sf)).select("df", r("p", 9).alias("p"))


_TWO = f"""WITH {POOL_EVENTS}, tbl AS (SELECT fee_tier >= 500 AS high, count(*) FILTER (tvl_usd < 0) AS neg,
  count(*) FILTER (NOT tvl_usd < 0) AS valid FROM pool_events GROUP BY 1), tot AS (
  SELECT sum(neg) AS m, sum(valid) AS v, sum(neg + valid) AS n FROM tbl), gap AS (
  SELECT abs(neg - (neg + valid) * m / n) AS g, (neg + valid) * m / n AS em, (neg + valid) * v / n AS ev FROM tbl, tot)"""


@query("i2_chi2_two_by_two", f"""{_TWO}
SELECT {rs('sum(pow(g - least(0.5, g), 2) / em + pow(g - least(0.5, g), 2) / ev)')} AS chi2, CAST(1 AS INTEGER) AS df FROM gap""")
def i2_yates(spark, sf):
    df = X.pool_events(spark, sf).withColumn("high", F.col("fee_tier") >= 500)
    return T.chi2_independence(P.crosstab(df, "high", F.col("tvl_usd") < 0)).select(r("chi2").alias("chi2"), "df")


@query("i3_cramers_v", f"{_TABLE} SELECT {rs('sqrt(chi2 / (n * (least(k, 2) - 1)))', 9)} AS cramers_v FROM chi, tot")
def i3(spark, sf):
    return T.cramers_v(_table(spark, sf)).select(r("cramers_v", 9).alias("cramers_v"))


_TREND = """{table}, c AS (SELECT {mean} AS w FROM tbl)
SELECT {z} AS z FROM tbl, tot, c GROUP BY ALL"""
_Z = ("sum((fee_tier - w) * (neg - (neg + valid) * m / n)) / sqrt(any_value(m) * (any_value(n) - any_value(m)) "
      "* sum((neg + valid) * pow(fee_tier - w, 2)) / (any_value(n) * (any_value(n) - 1.0::DOUBLE)))")


@query("i4_trend_test", _TREND.format(table=_TABLE, mean="avg(fee_tier)", z=rs(_Z)))
def i4(spark, sf):
    return T.trend_test(_table(spark, sf)).select(r("z").alias("z"))


@query("i4_trend_test_p", _TREND.format(table=_TABLE, mean="avg(fee_tier)", z=_Z).replace("WITH", "WITH test AS (WITH", 1) + f""")
SELECT {rs('z')} AS z, {_Z_P} AS p FROM test""")
def i4_p(spark, sf):
    return T.trend_test(_table(spark, sf)).select(r("z").alias("z"), r("p", 9).alias("p"))


@query("i4_trend_test_weighted", _TREND.format(
    table=_TABLE, mean="sum(fee_tier * (neg + valid)) / sum(neg + valid)", z=rs(_Z)))
def i4_weighted(spark, sf):
    return T.trend_test(_table(spark, sf), centering="weighted").select(r("z").alias("z"))


_PAIRS = f"""{_TABLE}, p AS (SELECT a.fee_tier AS a, b.fee_tier AS b, a.neg AS x, a.neg + a.valid AS nx,
  b.neg AS y, b.neg + b.valid AS ny FROM tbl a JOIN tbl b ON a.fee_tier < b.fee_tier), test AS (
  SELECT a, b, (x / nx - y / ny) / sqrt((x + y) / (nx + ny) * (1 - (x + y) / (nx + ny)) * (1 / nx + 1 / ny)) AS z FROM p)"""


@query("i5_pairwise_z", f"{_PAIRS} SELECT a, b, {rs('z')} AS z, {_Z_P} AS p FROM test")
def i5(spark, sf):
    return T.pairwise_z(_table(spark, sf)).select("a", "b", r("z").alias("z"), r("p", 9).alias("p"))


@query("i5_i6_pairwise_holm", f"""{_PAIRS}, tail AS (SELECT a, b, {_Z_P} AS p FROM test), s AS (
  SELECT *, p * (count(*) OVER () - row_number() OVER (ORDER BY p, a, b) + 1) AS step FROM tail)
SELECT a, b, p, {rs('least(1, max(step) OVER (ORDER BY p, a, b ROWS UNBOUNDED PRECEDING))', 7)} AS p_adj FROM s""")
def i5_holm(spark, sf):
    tests = T.pairwise_z(_table(spark, sf)).select("a", "b", r("p", 9).alias("p"))
    return T.holm(tests).select("a", "b", "p", r("p_adj", 7).alias("p_adj"))


@query("i6_holm", f"""WITH {POOL_EVENTS}, t AS (SELECT pool_id, fee_tier, (count(*) FILTER (tvl_usd < 0) + 1) / (3.0::DOUBLE * count(*)) AS p
  FROM pool_events GROUP BY 1, 2), s AS (SELECT *, p * (count(*) OVER (PARTITION BY pool_id)
    - row_number() OVER (PARTITION BY pool_id ORDER BY p, fee_tier) + 1) AS step FROM t)
SELECT pool_id, fee_tier, {rs('p', 9)} AS p,
       {rs('least(1, max(step) OVER (PARTITION BY pool_id ORDER BY p, fee_tier ROWS UNBOUNDED PRECEDING))', 9)} AS p_adj FROM s""")
def i6(spark, sf):
    """A family per pool: one made-up p-value for each of its fee tiers."""
    p = (F.count_if(F.col("tvl_usd") < 0) + 1) / (3.0 * F.count("*"))
    tests = X.pool_events(spark, sf).groupBy("pool_id", "fee_tier").agg(p.alias("p"))
    adjusted = T.holm(tests, family=["pool_id"])
    return adjusted.select("pool_id", "fee_tier", r("p", 9).alias("p"), r("p_adj", 9).alias("p_adj"))


_DAILY = f"""WITH {POOL_HOURLY}, raw AS (
  SELECT pool_id, CAST(hour_ts AS DATE) AS d, sum(volume_usd) AS volume_usd FROM pool_hourly GROUP BY 1, 2), grid AS (
  SELECT pool_id, CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM raw GROUP BY 1), daily AS (
  SELECT pool_id, d, coalesce(volume_usd, 0) AS x FROM grid LEFT JOIN raw USING (pool_id, d))"""


def _daily(spark, sf, by):
    return J.resample_daily(X.pool_hourly(spark, sf), F.col("hour_ts"), ["volume_usd"], by)


@query("i7_decompose_by_pool", f"""{_DAILY}, t AS (SELECT *, row_number() OVER w AS i, (row_number() OVER w - 1) % 7 AS phase,
    CASE WHEN count(x) OVER f = 7 THEN avg(x) OVER f END AS trend
  FROM daily WINDOW w AS (PARTITION BY pool_id ORDER BY d),
    f AS (PARTITION BY pool_id ORDER BY d ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)), s AS (
  SELECT *, avg(x - trend) OVER (PARTITION BY pool_id, phase) AS raw FROM t), c AS (
  SELECT *, raw - avg(CASE WHEN i <= 7 THEN raw END) OVER (PARTITION BY pool_id) AS seasonal FROM s)
SELECT pool_id, {days('d')} AS date, CAST(phase AS INTEGER) AS phase, {rs('trend', 5)} AS trend, {rs('seasonal', 5)} AS seasonal,
       {rs('x - trend - seasonal', 5)} AS resid FROM c""")
def i7(spark, sf):
    df = T.decompose(_daily(spark, sf, ["pool_id"]), ["pool_id"])
    return df.select("pool_id", day("date").alias("date"), F.col("phase").cast("int").alias("phase"),
                     *[r(c, 5).alias(c) for c in ("trend", "seasonal", "resid")])


@query("j1_standardize", f"""WITH {EXPLORED}, one AS (SELECT avg(volume_usd) AS mv, stddev_pop(volume_usd) AS sv, avg(tvl_usd) AS mt,
  stddev_pop(tvl_usd) AS st, avg(price_change) AS mp, stddev_pop(price_change) AS sp FROM explored)
SELECT id, {rs('(volume_usd - mv) / sv')} AS volume_usd, {rs('(tvl_usd - mt) / st')} AS tvl_usd,
       {rs('(price_change - mp) / sp')} AS price_change FROM explored, one""")
def j1(spark, sf):
    cols = ["volume_usd", "tvl_usd", "price_change"]
    return Z.standardize(explored(spark, sf).select("id", *cols), cols).withColumns({c: r(c) for c in cols})


@query("j2_min_max", f"""WITH {WIDE}, one AS (SELECT min(volume_usd) AS lo, max(volume_usd) AS hi, min(tvl_usd) AS tlo,
  max(tvl_usd) AS thi FROM wide)
SELECT id, {rs('(volume_usd - lo) / (hi - lo)')} AS volume_usd, {rs('(tvl_usd - tlo) / (thi - tlo)')} AS tvl_usd FROM wide, one""")
def j2(spark, sf):
    cols = ["volume_usd", "tvl_usd"]
    return Z.min_max(X.wide(spark, sf).select("id", *cols), cols).withColumns({c: r(c) for c in cols})


@query("j2_min_max_range", f"""WITH {WIDE}, one AS (SELECT min(volume_usd) AS lo, max(volume_usd) AS hi FROM wide)
SELECT id, {rs('50 + (volume_usd - lo) / (hi - lo) * 200')} AS size, 100::DOUBLE AS flat FROM wide, one""")
def j2_range(spark, sf):
    df = X.wide(spark, sf).select("id", F.col("volume_usd").alias("size"), F.lit(3.0).alias("flat"))
    return Z.min_max(df, ["size", "flat"], 50, 250, default=100).withColumn("size", r("size"))
