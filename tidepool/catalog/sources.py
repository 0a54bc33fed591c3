"""Scans and sinks, and the typing of records (ids A1-A9, B1-B8, H1)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidepool import fixtures as X
from tidepool.catalog.registry import COPIES, POOL_HOURLY, WIDE, epoch, epochs, query, sci, scis
from tidepool.functions import scalars as S
from tidepool.functions.json_fields import json_float, json_str, json_ts
from tidepool.operators import clean as C
from tidepool.operators import combine as J
from tidepool.operators.frames import dedup_latest
from tidepool.session import materialized, new_folder
from tidepool.sources import records as R
from tidepool.sources import tables as TB

LOADED = datetime(2024, 2, 1)
LOADED_EPOCH = 1706745600


def _land_files(spark, sf):
    """The feed as JSONL, one folder per exchange."""
    folder = new_folder(spark, "landing")
    lines = X.raw_json(spark, sf)
    for protocol in ("dexa", "dexb"):
        part = lines.where(F.col("protocol") == protocol).select("value")
        part.write.text(f"{folder}/{protocol}/20240131T000000_pool.jsonl")
    return folder


def _staged_raw(spark, sf):
    return R.land_raw(X.raw_json(spark, sf), LOADED)


_TIER = "CASE WHEN protocol = 'dexa' THEN fee_tier END"


@query("a1_read_pool_jsonl", f"""WITH {WIDE}
SELECT id, hour_ts AS period, pool_address AS pool_id, token1_symbol, {_TIER} AS fee_tier, volume_usd,
       liquidity_text AS liquidity, protocol FROM wide""")
def a1(spark, sf):
    df = R.read_pool_jsonl(spark, _land_files(spark, sf), ["dexa", "dexb"])
    return df.select(
        "id", F.col("periodStartUnix").cast("bigint").alias("period"), F.col("pool.id").alias("pool_id"),
        F.col("pool.token1.symbol").alias("token1_symbol"), F.col("pool.feeTier").alias("fee_tier"),
        F.col("volumeUSD").cast("double").alias("volume_usd"), "liquidity", "protocol",
    )


@query("a2_land_raw", f"""WITH {WIDE}
SELECT id, tvl_usd, protocol, CAST({LOADED_EPOCH} AS BIGINT) AS load_epoch FROM wide""")
def a2(spark, sf):
    df = _staged_raw(spark, sf)
    return df.select(
        json_str(F.col("raw"), "id", True).alias("id"), json_float(F.col("raw"), "tvlUSD", True).alias("tvl_usd"),
        "protocol", epoch("load_ts").alias("load_epoch"),
    )


@query("a3_split_bad_records", f"""WITH {WIDE}
SELECT protocol, CASE WHEN volume_usd = 0 THEN 'bad' ELSE 'good' END AS side, count(*) AS lines
FROM wide GROUP BY ALL""")
def a3(spark, sf):
    zero = F.get_json_object("value", "$.volumeUSD").cast("double") == 0
    broken = F.when(zero, F.substring("value", 1, 40)).otherwise(F.col("value"))
    good, bad = R.split_bad_records(X.raw_json(spark, sf).select(broken.alias("value"), "protocol"))
    both = good.select("protocol", F.lit("good").alias("side")).unionByName(
        bad.select("protocol", F.lit("bad").alias("side"))
    )
    return both.groupBy("protocol", "side").agg(F.count("*").alias("lines"))


@query("a5_write_jsonl", f"WITH {WIDE} SELECT id, hour_ts, volume_usd, tx_count, fee_tier FROM wide")
def a5(spark, sf):
    path = new_folder(spark, "jsonl") + "/nested/out"
    R.write_jsonl(X.wide(spark, sf).select("id", "hour_ts", "volume_usd", "tx_count", "fee_tier"), path)
    return spark.read.schema("id string, hour_ts bigint, volume_usd double, tx_count bigint, fee_tier string").json(path)


@query("a6_materialize", f"WITH {WIDE} SELECT id, protocol, volume_usd, tvl_usd FROM wide")
def a6(spark, sf):
    path = new_folder(spark, "table")
    made = X.wide(spark, sf).select("id", "protocol", "volume_usd", "tvl_usd")
    TB.materialize(made.withColumn("volume_usd", F.lit(0.0)), path)
    TB.materialize(made, path, partition_by=["protocol"], cluster="id")
    return TB.read_table(spark, path, cols=["id", "protocol", "volume_usd", "tvl_usd"])


@query("a7_read_table", f"""WITH {POOL_HOURLY}
SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, volume_usd FROM pool_hourly WHERE volume_usd > 50""")
def a7(spark, sf):
    path = new_folder(spark, "table")
    TB.materialize(X.pool_hourly(spark, sf), path)
    df = TB.read_table(spark, path, F.col("volume_usd") > 50, ["pool_id", "hour_ts", "volume_usd"])
    return df.select("pool_id", epoch("hour_ts").alias("hour_epoch"), "volume_usd")


_NAMES = """names AS (SELECT DISTINCT CASE event_type
  WHEN 'signup' THEN strftime(ts, '%Y-%m-%d') || '_pool.jsonl'
  WHEN 'error' THEN 'note_' || CAST(event_id AS VARCHAR) || '.txt'
  ELSE strftime(ts, '%Y%m%dT%H%M%S') || '_pool.jsonl' END AS name FROM events), keyed AS (
  SELECT name, CASE WHEN regexp_matches(name, '^\\d{4}-\\d{2}-\\d{2}_pool\\.jsonl') THEN substr(name, 1, 10) || 'T000000'
    WHEN regexp_matches(name, '^\\d{8}T\\d{6}_pool\\.jsonl') THEN substr(name, 1, 11) || '0000' END AS hour_key FROM names)"""


def _names(spark, sf):
    e = X.table(spark, sf, "events")
    ts = F.col("ts").cast("timestamp")
    name = (
        F.when(F.col("event_type") == "signup", F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit("_pool.jsonl")))
        .when(F.col("event_type") == "error", F.concat(F.lit("note_"), F.col("event_id").cast("string"), F.lit(".txt")))
        .otherwise(F.concat(F.date_format(ts, "yyyyMMdd'T'HHmmss"), F.lit("_pool.jsonl")))
    )
    return e.select(name.alias("name")).distinct()


@query("a8_latest_file_per_hour", f"""WITH {_NAMES}
SELECT name, hour_key, CASE WHEN name = max(name) OVER (PARTITION BY hour_key) THEN 'keep' ELSE 'archive' END AS action
FROM keyed WHERE hour_key IS NOT NULL""")
def a8(spark, sf):
    return R.latest_file_per_hour(_names(spark, sf)).select("name", "hour_key", "action")


@query("a9_slice_interval", f"""WITH {POOL_HOURLY}
SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, volume_usd FROM pool_hourly
WHERE hour_ts >= TIMESTAMP '2024-01-15 11:00:00' AND hour_ts < TIMESTAMP '2024-01-15 12:00:00'""")
def a9(spark, sf):
    df = C.slice_interval(X.pool_hourly(spark, sf), "hour_ts", datetime(2024, 1, 15, 12))
    return df.select("pool_id", epoch("hour_ts").alias("hour_epoch"), "volume_usd")


@query("b1_json_str", f"""WITH {WIDE} SELECT id, pool_address AS pool_id, lower(token0_symbol) AS token0_id,
{_TIER} AS fee_tier, CAST(NULL AS VARCHAR) AS absent FROM wide""")
def b1(spark, sf):
    raw = F.col("value")
    return X.raw_json(spark, sf).select(
        json_str(raw, "id").alias("id"), json_str(raw, "pool.id").alias("pool_id"),
        json_str(raw, "pool.token0.id").alias("token0_id"), json_str(raw, "pool.feeTier").alias("fee_tier"),
        json_str(raw, "pool.nothing.here").alias("absent"),
    )


@query("b2_json_float", f"""WITH {WIDE}
SELECT id, volume_usd, tvl_usd, CAST(NULL AS DOUBLE) AS not_a_number, CAST(NULL AS DOUBLE) AS absent FROM wide""")
def b2(spark, sf):
    v = F.col("raw")
    return _staged_raw(spark, sf).select(
        json_str(v, "id", True).alias("id"), json_float(v, "volumeUSD", True).alias("volume_usd"),
        json_float(v, "tvlUSD", True).alias("tvl_usd"), json_float(v, "pool.id", True).alias("not_a_number"),
        json_float(v, "nothing", True).alias("absent"),
    )


@query("b3_json_ts", f"WITH {WIDE} SELECT id, hour_ts AS hour_epoch, CAST(NULL AS BIGINT) AS bad FROM wide")
def b3(spark, sf):
    raw = F.col("value")
    return X.raw_json(spark, sf).select(
        json_str(raw, "id").alias("id"), epoch(json_ts(raw, "periodStartUnix")).alias("hour_epoch"),
        epoch(json_ts(raw, "pool.id")).alias("bad"),
    )


_STAGED_SQL = f"""WITH {WIDE}
SELECT hour_ts AS hour_epoch, pool_address AS pool_id, lower(token0_symbol) AS token0_id,
       lower(token1_symbol) AS token1_id, tvl_usd, volume_usd, liquidity, open_price AS open, high_price AS high,
       low_price AS low, close_price AS close, CAST({LOADED_EPOCH} AS BIGINT) AS load_epoch FROM wide"""


def _staged_out(df):
    return df.select(
        epoch("hour_ts").alias("hour_epoch"), "pool_id", "token0_id", "token1_id", "tvl_usd", "volume_usd",
        "liquidity", "open", "high", "low", "close", epoch("load_ts").alias("load_epoch"),
    )


@query("b4_stage_pool_hourly", _STAGED_SQL)
def b4(spark, sf):
    raw = X.raw_json(spark, sf).select(F.col("value").alias("raw"), F.lit(LOADED).alias("load_ts"))
    return _staged_out(R.stage_pool_hourly(raw))


@query("b4_stage_pool_hourly_variant", _STAGED_SQL)
def b4_variant(spark, sf):
    return _staged_out(R.stage_pool_hourly(_staged_raw(spark, sf)))


@query("b5_flatten", f"""WITH {WIDE}
SELECT id, pool_address AS pool_id, lower(token0_symbol) AS pool_token0_id, token1_symbol AS pool_token1_symbol,
       {_TIER} AS "pool_feeTier", CAST(volume_usd AS DOUBLE) AS volume FROM wide""")
def b5(spark, sf):
    flat = R.flatten(R.as_records(X.raw_json(spark, sf)).drop("protocol"))
    return flat.select(
        "id", "pool_id", "pool_token0_id", "pool_token1_symbol", "pool_feeTier",
        F.col("volumeUSD").cast("double").alias("volume"),
    )


@query("b6_parse_maybe_json", f"""WITH {WIDE}
SELECT kind, count(*) AS n, count(DISTINCT id) AS ids, CAST(sum(hour_ts) AS BIGINT) AS hours
FROM wide, (VALUES ('bytes'), ('text'), ('parsed')) k(kind) GROUP BY kind""")
def b6(spark, sf):
    lines = X.raw_json(spark, sf).select(F.col("value").alias("raw"))
    forms = {
        "bytes": lines.select(F.encode("raw", "UTF-8").alias("raw")),
        "text": lines,
        "parsed": lines.select(F.try_parse_json("raw").alias("raw")),
    }
    out = None
    for kind, df in forms.items():
        v = R.parse_maybe_json(df, "raw").select(
            json_str(F.col("raw"), "id", True).alias("id"),
            json_str(F.col("raw"), "periodStartUnix", True).cast("bigint").alias("hour"),
        )
        part = v.agg(
            F.lit(kind).alias("kind"), F.count("*").alias("n"), F.count_distinct("id").alias("ids"),
            F.sum("hour").alias("hours"),
        )
        out = part if out is None else out.unionByName(part)
    return out


CLEAN_SQL = ("hour_ts, id, volume_usd, tvl_usd, liquidity, volume_token0, volume_token1, fees_usd, open_price, "
          "high_price, low_price, close_price, tx_count, tick, sqrt_price, token0_price, token1_price")


@query("b7_clean_hourly", f"WITH {WIDE} SELECT {CLEAN_SQL}, protocol FROM wide")
def b7(spark, sf):
    return R.clean_hourly(R.as_records(X.raw_json(spark, sf)), ["protocol"])


META_SQL = f"""id, {_TIER} AS fee_tier, lower(token0_symbol) AS token0_id, token0_symbol, 'Token ' || token0_symbol AS token0_name,
 '18' AS token0_decimals, lower(token1_symbol) AS token1_id, token1_symbol, 'Token ' || token1_symbol AS token1_name,
 '18' AS token1_decimals"""


@query("b8_pool_metadata", f"WITH {WIDE} SELECT DISTINCT {META_SQL} FROM wide")
def b8(spark, sf):
    lines = materialized(X.raw_json(spark, sf), "lines")
    return R.pool_metadata(R.as_records(lines.unionByName(lines)))


@query("b12_lower_columns", f"WITH {POOL_HOURLY} SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, volume_usd FROM pool_hourly")
def b12(spark, sf):
    df = X.pool_hourly(spark, sf).select(
        F.col("pool_id").alias("POOL_ID"), epoch("hour_ts").alias("Hour_Epoch"), F.col("volume_usd").alias("VOLUME_USD")
    )
    return C.lower_columns(df)


@query("c1_has_pool", f"WITH {WIDE} SELECT id, pool_address AS pool_id FROM wide WHERE protocol = 'dexa'")
def c1(spark, sf):
    lines = X.raw_json(spark, sf)
    # one exchange sends its records without the pool object here
    no_pool = F.concat(F.lit('{"id":"'), F.get_json_object("value", "$.id"), F.lit('"}'))
    mixed = lines.select(F.when(F.col("protocol") == "dexb", no_pool).otherwise(F.col("value")).alias("value"))
    return C.has_pool(R.as_records(mixed)).select("id", F.col("pool.id").alias("pool_id"))


@query("d1_with_pool", f"""WITH {WIDE}
SELECT c.id, c.hour_ts, c.volume_usd, m.fee_tier, m.token0_symbol, m.token1_symbol
FROM wide c LEFT JOIN (SELECT DISTINCT {META_SQL} FROM wide WHERE tvl_usd >= 0) m USING (id)""")
def d1(spark, sf):
    records = materialized(R.as_records(X.raw_json(spark, sf)), "records")
    meta = R.pool_metadata(records.where(F.col("tvlUSD").cast("double") >= 0))
    joined = J.with_pool(R.clean_hourly(records), meta)
    return joined.select("id", "hour_ts", "volume_usd", "fee_tier", "token0_symbol", "token1_symbol")


@query("f10_dedup_latest", f"""WITH {COPIES}
SELECT id, period, volume_usd, load_epoch FROM copies
QUALIFY row_number() OVER (PARTITION BY id, period ORDER BY load_epoch DESC) = 1""")
def f10(spark, sf):
    kept = dedup_latest(X.raw_copies(spark, sf), ["id", "period"], "load_ts", ["volume_usd"])
    return kept.select("id", "period", "volume_usd", epoch("load_ts").alias("load_epoch"))


@query("h1_union_protocols", f"""WITH {WIDE}
SELECT protocol AS dex, id, hour_ts, volume_usd, CASE WHEN protocol = 'dexa' THEN fee_tier END AS fee_tier FROM wide""")
def h1(spark, sf):
    w = X.wide(spark, sf)
    parts = {
        "dexa": w.where("protocol = 'dexa'").select("id", "hour_ts", "volume_usd", "fee_tier"),
        "dexb": w.where("protocol = 'dexb'").select("volume_usd", "id", "hour_ts"),
    }
    return J.union_protocols(parts)


@query("b14_tag", f"WITH {POOL_HOURLY} SELECT 'dexz' AS dex, pool_id, {epochs('hour_ts')} AS hour_epoch FROM pool_hourly")
def b14(spark, sf):
    df = C.tag(X.pool_hourly(spark, sf), "dexz")
    return df.select("dex", "pool_id", epoch("hour_ts").alias("hour_epoch"))


@query("b21_hour_key", f"WITH {_NAMES} SELECT name, hour_key FROM keyed")
def b21(spark, sf):
    return _names(spark, sf).withColumn("hour_key", S.hour_key(F.col("name")))


@query("b17_scale_fixed_point", f"""WITH {WIDE} SELECT id, {scis("CAST(liquidity_text AS DOUBLE) / 1e18::DOUBLE")} AS liquidity_scaled,
length(liquidity_text) AS digits FROM wide""")
def b17(spark, sf):
    return X.wide(spark, sf).select(
        "id", sci(S.scale_fixed_point(F.col("liquidity_text"))).alias("liquidity_scaled"),
        S.digit_count(F.col("liquidity_text")).cast("bigint").alias("digits"),
    )
