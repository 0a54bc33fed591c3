"""Registered queries and, where SQL can say the same, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# Engines add doubles in different orders, so reported sums and means are rounded on both
# sides. Single divisions of equal inputs are reported as they are. Adding zero turns a
# rounded -0.0 into 0.0.


def r(x: Column | str, digits: int = 6) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.round(x, digits) + F.lit(0.0)


def rs(expr: str, digits: int = 6) -> str:
    return f"(round(({expr})::DOUBLE, {digits}) + 0.0::DOUBLE)"


def sci(x: Column | str) -> Column:
    """Nine significant digits as text, for values of any size."""
    x = F.col(x) if isinstance(x, str) else x
    return F.format_string("%.8e", x)


def scis(expr: str) -> str:
    return f"printf('%.8e', ({expr})::DOUBLE)"


def epoch(x: Column | str) -> Column:
    return F.unix_timestamp(F.col(x) if isinstance(x, str) else x)


def epochs(expr: str) -> str:
    return f"CAST(epoch({expr}) AS BIGINT)"


def day(x: Column | str) -> Column:
    return F.date_format(F.col(x) if isinstance(x, str) else x, "yyyy-MM-dd")


def days(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


# -- the fixtures in SQL ---------------------------------------------------------

_VOLUME = "sum(CAST(CASE WHEN event_type = 'error' THEN 0 ELSE value END AS DECIMAL(18,2)))"
_K = "CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT)"
_DEX = "CASE WHEN user_id % 2 = 0 THEN 'dexa' ELSE 'dexb' END"

POOL_HOURLY = f"""pool_hourly AS (
  SELECT {_DEX} AS dex, '0x' || CAST(user_id AS VARCHAR) AS pool_id, hour_ts,
         CAST(v AS DOUBLE) AS volume_usd, CAST(k - 3 AS DOUBLE) AS tvl_usd, CAST(n AS DOUBLE) AS liquidity
  FROM (SELECT user_id, date_trunc('hour', ts) AS hour_ts, {_VOLUME} AS v, {_K} AS k, count(*) AS n
        FROM events GROUP BY 1, 2))"""

POOL_EVENTS = """pool_events AS (
  SELECT event_id, '0x' || CAST(user_id AS VARCHAR) AS pool_id, ts,
         CASE event_type WHEN 'view' THEN 100 WHEN 'click' THEN 500 WHEN 'signup' THEN 3000
              WHEN 'purchase' THEN 10000 ELSE 30 END AS fee_tier,
         CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) - 3 AS DOUBLE) AS tvl_usd, value
  FROM events)"""

WIDE = f"""wide AS (
  SELECT '0x' || CAST(user_id AS VARCHAR) || '-' || CAST(hour_ts // 3600 AS VARCHAR) AS id,
         '0x' || CAST(user_id AS VARCHAR) AS pool_address, CAST(hour_ts // 3600 AS VARCHAR) AS block_index,
         hour_ts, CAST(v AS DOUBLE) AS volume_usd, CAST(k - 3 AS DOUBLE) AS tvl_usd,
         CAST(liquidity_text AS DOUBLE) AS liquidity, CAST(a AS DOUBLE) * 0.5::DOUBLE AS volume_token0,
         CAST(a AS DOUBLE) * 2.0::DOUBLE AS volume_token1, CAST(v AS DOUBLE) * 0.003::DOUBLE AS fees_usd,
         open_price, high_price, low_price, close_price, tx_count, CAST(k - 50 AS DOUBLE) AS tick,
         CAST(sqrt_price_text AS DOUBLE) AS sqrt_price, close_price + 1::DOUBLE AS token0_price,
         1::DOUBLE / (close_price + 1::DOUBLE) AS token1_price, {_DEX} AS protocol,
         (['100', '500', '3000', '10000', '30'])[user_id % 5 + 1] AS fee_tier,
         'T' || CAST(user_id % 7 AS VARCHAR) AS token0_symbol, 'U' || CAST(user_id % 3 AS VARCHAR) AS token1_symbol,
         liquidity_text, sqrt_price_text
  FROM (SELECT *, CAST(k + 1 AS VARCHAR) || repeat('7', CAST(user_id % 20 + 10 AS INTEGER)) AS liquidity_text,
               CAST(k + 11 AS VARCHAR) || repeat('3', CAST(user_id % 7 + 18 AS INTEGER)) AS sqrt_price_text
        FROM (SELECT user_id, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS hour_ts, {_VOLUME} AS v, {_K} AS k,
                     CAST(count(*) AS BIGINT) AS tx_count, sum(CAST(value AS DECIMAL(18,2))) AS a,
                     arg_min(value, event_id) AS open_price, max(value) AS high_price, min(value) AS low_price,
                     arg_max(value, event_id) AS close_price
              FROM events GROUP BY 1, 2)))"""

COPIES = WIDE + """, copies AS (
  SELECT id, hour_ts AS period, volume_usd, hour_ts + 3600 AS load_epoch FROM wide
  UNION ALL SELECT id, hour_ts, volume_usd + 1, hour_ts + 7200 FROM wide)"""

_RATE = "nullif({c}, 0) / nullif(lag({c}, 24) OVER w, 0) - 1"

FEATURES = POOL_HOURLY + f""", features AS (
  SELECT *, {_RATE.format(c='volume_usd')} AS vol_rate_24h, {_RATE.format(c='tvl_usd')} AS tvl_rate_24h,
         avg(volume_usd) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS vol_ma_6h,
         avg(volume_usd) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS vol_ma_24h,
         volume_usd / nullif(tvl_usd, 0) AS vol_tvl_ratio
  FROM pool_hourly WINDOW w AS (PARTITION BY pool_id ORDER BY hour_ts))"""

LABELLED = FEATURES + """, labelled AS (
  SELECT f.*, CASE WHEN volume_usd >= pct_90 THEN 1 ELSE 0 END AS y
  FROM features f JOIN (SELECT pool_id, quantile_cont(volume_usd, 0.9) AS pct_90 FROM features GROUP BY 1) USING (pool_id))"""

_MA = "CASE WHEN count(volume_usd) OVER w = 24 THEN avg(volume_usd) OVER w END"

EXPLORED = WIDE + f""", explored AS (
  SELECT *, volume_usd / (volume_ma24 + 1e-10::DOUBLE) - 1 AS volume_deviation,
         volume_usd / (tvl_usd + 1e-10::DOUBLE) AS volume_tvl_ratio,
         close_price / nullif(open_price, 0) - 1 AS price_change
  FROM (SELECT *, {_MA} AS volume_ma24,
               CASE WHEN count(volume_usd) OVER w = 24 THEN stddev_samp(volume_usd) OVER w END AS volume_volatility
        FROM wide WINDOW w AS (PARTITION BY pool_address ORDER BY hour_ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)))"""

FEATURE_COLUMNS_SQL = ", ".join(
    [
        "pool_id", f"{epochs('hour_ts')} AS hour_epoch", "volume_usd", "tvl_usd", "liquidity",
        "vol_rate_24h", "tvl_rate_24h", "vol_tvl_ratio", *[f"{rs(c)} AS {c}" for c in ("vol_ma_6h", "vol_ma_24h")],
    ]
)


def feature_columns_out(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        "pool_id", epoch("hour_ts").alias("hour_epoch"), "volume_usd", "tvl_usd", "liquidity",
        "vol_rate_24h", "tvl_rate_24h", "vol_tvl_ratio", *[r(c).alias(c) for c in ("vol_ma_6h", "vol_ma_24h")],
        *extra,
    )
