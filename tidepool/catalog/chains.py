"""Incremental builds, checks and streams (ids A4, K1-K5, L1-L6)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidepool import fixtures as X
from tidepool.catalog.models import labelled as labelled_rows
from tidepool.catalog.sources import CLEAN_SQL, META_SQL
from tidepool.catalog.registry import (
    FEATURE_COLUMNS_SQL, FEATURES, LABELLED, POOL_HOURLY, WIDE, day, epoch, epochs, feature_columns_out, query, r, rs,
)
from tidepool.functions.moments import moment
from tidepool.operators import forest as M
from tidepool.operators import ledger
from tidepool.operators.features import pool_features
from tidepool.plans import mart
from tidepool.schema import MART_FEATURES
from tidepool.session import materialized, new_folder
from tidepool.sources import records as R
from tidepool.sources import snapshots as SN
from tidepool.sources import tables as TB
from tidepool.streaming import jobs as ST
from tidepool.streaming import keyed_state as KS

_BASE = f"pool_id, {epochs('hour_ts')} AS hour_epoch, volume_usd"
_SPLIT = datetime(2024, 1, 20)
_UPSERTED = f"""WITH {POOL_HOURLY}
SELECT pool_id, {epochs('hour_ts')} AS hour_epoch,
       CASE WHEN hour_ts >= TIMESTAMP '2024-01-15' THEN volume_usd + 1 ELSE volume_usd END AS volume_usd FROM pool_hourly"""


def _old_and_new(spark, sf):
    """A target up to day 20 and a batch from day 15 on, whose overlap corrects volumes."""
    df = X.pool_hourly(spark, sf).withColumn("day", day("hour_ts"))
    old = df.where(F.col("hour_ts") < moment(_SPLIT))
    new = df.where(F.col("hour_ts") >= moment(datetime(2024, 1, 15))).withColumn("volume_usd", F.col("volume_usd") + 1)
    return old, new


@query("k1_upsert", _UPSERTED)
def k1(spark, sf):
    old, new = _old_and_new(spark, sf)
    out = TB.upsert(old, new, ["pool_id", "hour_ts"])
    return out.select("pool_id", epoch("hour_ts").alias("hour_epoch"), "volume_usd")


@query("k1_upsert_days", _UPSERTED)
def k1_days(spark, sf):
    old, new = _old_and_new(spark, sf)
    path = new_folder(spark, "target")
    TB.upsert_days(old, path, ["pool_id", "hour_ts"])
    TB.upsert_days(new, path, ["pool_id", "hour_ts"])
    return spark.read.parquet(path).select("pool_id", epoch("hour_ts").alias("hour_epoch"), "volume_usd")


def _wide_build(spark, sf):
    """Every record three times: an older load with another volume, the newest, and the newest again."""
    lines = materialized(X.raw_json(spark, sf), "lines")
    stale = lines.withColumn("value", F.regexp_replace("value", '"volumeUSD":"[^"]*"', '"volumeUSD":"1.5"'))
    at = lambda df, when: df.withColumn("load_ts", moment(when))
    new = at(lines, datetime(2024, 2, 2))
    return mart.build_wide(R.as_records(at(stale, datetime(2024, 2, 1)).unionByName(new).unionByName(new)))


@query("d1_wide_table", f"""WITH {WIDE} SELECT {CLEAN_SQL.replace(' id,', '')}, protocol, epoch(TIMESTAMP '2024-02-02')::BIGINT AS load_epoch, {META_SQL} FROM wide""")
def d1_wide(spark, sf):
    """Flattening, keeping the newest load, cleaning, metadata and their join as one plan, with all columns."""
    return _wide_build(spark, sf)["wide"].withColumn("load_epoch", epoch("load_ts")).drop("load_ts")


@query("d1_wide_by_protocol", f"""WITH {WIDE} SELECT protocol, CASE WHEN protocol = 'dexa' THEN fee_tier END AS fee_tier,
  count(*) AS n, {rs('sum(volume_usd)', 2)} AS volume_usd FROM wide GROUP BY 1, 2""")
def d1_by_protocol(spark, sf):
    wide = _wide_build(spark, sf)["wide"]
    return wide.groupBy("protocol", "fee_tier").agg(F.count("*").alias("n"), r(F.sum("volume_usd"), 2).alias("volume_usd"))


@query("k2_incremental_label", f"""WITH {LABELLED} SELECT y, {FEATURE_COLUMNS_SQL} FROM labelled
WHERE hour_ts > (SELECT max(hour_ts) FROM labelled WHERE hour_ts < TIMESTAMP '2024-01-20')""")
def k2(spark, sf):
    source = materialized(pool_features(X.pool_hourly(spark, sf)), "features")
    target = source.where(F.col("hour_ts") < moment(_SPLIT))
    return feature_columns_out(mart.incremental_label(source, target), "y")


_FROM_LEDGER = f"""WITH {LABELLED}, part AS (SELECT pool_id, hour_ts, volume_usd,
  CASE WHEN hour_ts < TIMESTAMP '2024-01-10' THEN TIMESTAMP '2024-01-10' WHEN hour_ts < TIMESTAMP '2024-01-20' THEN TIMESTAMP '2024-01-20'
       ELSE TIMESTAMP '2100-01-01' END AS step FROM features), limits AS (
  SELECT p.pool_id, p.step, quantile_cont(f.volume_usd, 0.9) AS cut FROM (SELECT DISTINCT pool_id, step FROM part) p
  JOIN features f ON f.pool_id = p.pool_id AND f.hour_ts < p.step GROUP BY 1, 2)
SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, volume_usd, CASE WHEN volume_usd >= cut THEN 1 ELSE 0 END AS y
FROM part JOIN limits USING (pool_id, step)"""


@query("k2_label_from_ledger", _FROM_LEDGER)
def k2_ledger(spark, sf):
    """Three arrivals, each labelled against all that had come by then; a correction is added and taken back on the way."""
    hours = materialized(X.pool_hourly(spark, sf).select("dex", "pool_id", "hour_ts", "volume_usd"), "hours")
    path, out = new_folder(spark, "ledger"), []
    edges = [datetime(2000, 1, 1), datetime(2024, 1, 10), _SPLIT, datetime(2100, 1, 1)]
    wrong = hours.where("pmod(hash(pool_id), 3) = 0").withColumn("volume_usd", F.col("volume_usd") * 3 + 1)
    wrong = wrong.where(F.col("hour_ts") < moment(edges[1]))
    ledger.append_rows(wrong, path, 0, "volume_usd", ["dex", "pool_id"])
    for n, (first, last) in enumerate(zip(edges, edges[1:]), 1):
        part = hours.where((F.col("hour_ts") >= moment(first)) & (F.col("hour_ts") < moment(last)))
        out.append(mart.label_from_ledger(part, path, n, withdrawn=wrong if n == 1 else None))
    made = out[0].unionByName(out[1]).unionByName(out[2])
    return made.select("pool_id", epoch("hour_ts").alias("hour_epoch"), "volume_usd", "y")


@query("k1_snapshot_upsert", _UPSERTED)
def k1_snapshot(spark, sf):
    old, new = _old_and_new(spark, sf)
    path = new_folder(spark, "snapshots")
    SN.upsert_snapshot(old, path, ["pool_id", "hour_ts"])
    SN.upsert_snapshot(new, path, ["pool_id", "hour_ts"])
    return SN.read_snapshot(spark, path, old.schema).select("pool_id", epoch("hour_ts").alias("hour_epoch"), "volume_usd")


@query("k1_snapshot_earlier", f"""WITH {POOL_HOURLY} SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, volume_usd FROM pool_hourly
WHERE hour_ts >= TIMESTAMP '2024-01-12' AND hour_ts < TIMESTAMP '2024-01-18'""")
def k1_earlier(spark, sf):
    """Six days of the first version, after the second has replaced half of them."""
    old, new = _old_and_new(spark, sf)
    path = new_folder(spark, "snapshots")
    SN.upsert_snapshot(old, path, ["pool_id", "hour_ts"])
    SN.upsert_snapshot(new, path, ["pool_id", "hour_ts"])
    days = SN.read_snapshot(spark, path, old.schema, version=1, first="2024-01-12", last="2024-01-17")
    return days.select("pool_id", epoch("hour_ts").alias("hour_epoch"), "volume_usd")


@query("k2_incremental_features", f"""WITH {FEATURES} SELECT {FEATURE_COLUMNS_SQL} FROM features
WHERE hour_ts > (SELECT max(hour_ts) FROM features WHERE hour_ts < TIMESTAMP '2024-01-20')""")
def k2_features(spark, sf):
    source = materialized(X.pool_hourly(spark, sf), "hours")
    return feature_columns_out(mart.incremental_features(source, source.where(F.col("hour_ts") < moment(_SPLIT))))


@query("k2_features_from_tails", f"""WITH {FEATURES} SELECT {FEATURE_COLUMNS_SQL} FROM features WHERE hour_ts >= TIMESTAMP '2024-01-20'""")
def k2_tails(spark, sf):
    """Two batches after day 20, each computed from the tails the step before left behind."""
    source = materialized(X.pool_hourly(spark, sf), "hours")
    between = lambda a, b: source.where((F.col("hour_ts") >= moment(a)) & (F.col("hour_ts") < moment(b)))
    steps = [datetime(2023, 1, 1), _SPLIT, datetime(2024, 1, 25), datetime(2030, 1, 1)]
    tails, made = source.limit(0), []
    for a, b in zip(steps, steps[1:]):
        features, after = mart.features_from_tails(between(a, b), tails)
        tails = materialized(after, "tails")
        made.append(features)
    return feature_columns_out(made[1].unionByName(made[2]))


@query("k2_late_hours", f"""WITH {POOL_HOURLY}
SELECT {_BASE} FROM pool_hourly WHERE hour_ts >= TIMESTAMP '2024-01-15' AND hour_ts < TIMESTAMP '2024-01-18' AND floor(volume_usd) % 3 = 0""")
def k2_late(spark, sf):
    """Hours that arrive after the target has newer ones."""
    source = materialized(X.pool_hourly(spark, sf), "hours")
    span = (F.col("hour_ts") >= moment(datetime(2024, 1, 15))) & (F.col("hour_ts") < moment(datetime(2024, 1, 18)))
    late = F.coalesce(span & (F.floor("volume_usd") % 3 == 0), F.lit(False))
    target = source.where((F.col("hour_ts") < moment(_SPLIT)) & ~late)
    return mart.late_hours(source.where(F.col("hour_ts") < moment(_SPLIT)), target).select("pool_id", epoch("hour_ts").alias("hour_epoch"), "volume_usd")


@query("k3_expect_not_null", f"""WITH {FEATURES}
SELECT 'pool_id' AS "column", count(*) FILTER (pool_id IS NULL) AS violations FROM features
UNION ALL SELECT 'hour_ts', count(*) FILTER (hour_ts IS NULL) FROM features
UNION ALL SELECT 'vol_rate_24h', count(*) FILTER (vol_rate_24h IS NULL) FROM features""")
def k3(spark, sf):
    return mart.expect_not_null(pool_features(X.pool_hourly(spark, sf)), ["pool_id", "hour_ts", "vol_rate_24h"])


_CHAINED = f"""WITH {LABELLED} SELECT dex, y, pool_id, {epochs('hour_ts')} AS hour_epoch, volume_usd, tvl_usd,
  vol_rate_24h, tvl_rate_24h, vol_tvl_ratio, {rs('vol_ma_6h')} AS vol_ma_6h, {rs('vol_ma_24h')} AS vol_ma_24h FROM labelled"""


@query("k4_run_stages", _CHAINED)
def k4(spark, sf):
    """Landed files to labels. An earlier load of every hour had another volume, and some lines are cut off."""
    folder = new_folder(spark, "landing")
    lines = materialized(X.raw_json(spark, sf), "lines")
    stale = lines.withColumn("value", F.regexp_replace("value", '"volumeUSD":"[^"]*"', '"volumeUSD":"1.5"'))
    broken = lines.withColumn("value", F.substring("value", 1, 30))
    raw = {}
    for p in ("dexa", "dexb"):
        loads = []
        for name, part, at in (("old", stale.union(broken), datetime(2024, 1, 31)), ("new", lines, datetime(2024, 2, 1))):
            path = f"{folder}/{p}/{name}_pool.jsonl"
            part.where(F.col("protocol") == p).select("value").write.text(path)
            loads.append(R.land_raw(R.read_lines(spark, path).select("value"), at))
        raw[p] = loads[0].unionByName(loads[1])
    df = mart.run_stages(raw)["labelled"]
    return df.select("dex", "y", "pool_id", epoch("hour_ts").alias("hour_epoch"), "volume_usd", "tvl_usd", "vol_rate_24h",
                     "tvl_rate_24h", "vol_tvl_ratio", r("vol_ma_6h").alias("vol_ma_6h"), r("vol_ma_24h").alias("vol_ma_24h"))


# every hour on both exchanges under one pool id, loaded twice, and every seventh hour without a pool id
_BOTH = f"""WITH {POOL_HOURLY}, twofold AS (
  SELECT d.dex, CASE WHEN CAST(epoch(hour_ts) AS BIGINT) // 3600 % 7 = 0 THEN NULL ELSE pool_id END AS pool_id, hour_ts, volume_usd
  FROM pool_hourly CROSS JOIN (VALUES ('dexa'), ('dexb')) d(dex))"""


def _both(spark, sf):
    """What ``run_stages`` makes of it; the copies loaded together differ in liquidity alone."""
    hours = X.pool_hourly(spark, sf).withColumn("hour", epoch("hour_ts"))
    lost = F.when(F.expr("hour div 3600 % 7") != 0, F.col("pool_id"))
    body = lambda spread: F.to_json(F.struct(
        F.struct(lost.alias("id")).alias("pool"), F.col("hour").alias("periodStartUnix"), F.col("volume_usd").cast("string").alias("volumeUSD"),
        F.col("tvl_usd").cast("string").alias("tvlUSD"), (F.col("liquidity") + spread).cast("string").alias("liquidity")))
    lines = hours.select(body(0).alias("value")).union(hours.where(lost.isNotNull()).select(body(1)))
    return mart.run_stages({p: R.land_raw(lines, datetime(2024, 2, 1)) for p in ("dexa", "dexb")})


@query("k4_run_stages_two_exchanges", f"""{_BOTH} SELECT dex, pool_id, {epochs('hour_ts')} AS hour_epoch, volume_usd FROM twofold""")
def k4_both(spark, sf):
    return _both(spark, sf)["features"].select("dex", "pool_id", epoch("hour_ts").alias("hour_epoch"), "volume_usd")


# both exchanges under one pool id, with volumes of their own; windows and thresholds must keep to one of them
_PAIR = f"""WITH {POOL_HOURLY}, pair AS (
  SELECT d.dex, pool_id, hour_ts, CASE WHEN d.dex = 'dexa' THEN volume_usd ELSE volume_usd * 50 + 7 END AS volume_usd,
         CASE WHEN d.dex = 'dexa' THEN tvl_usd ELSE tvl_usd + 2 END AS tvl_usd
  FROM pool_hourly CROSS JOIN (VALUES ('dexa'), ('dexb')) d(dex)), made AS (
  SELECT dex, pool_id, {epochs('hour_ts')} AS hour_epoch, hour_ts,
    CASE WHEN volume_usd <> 0 AND lag(volume_usd, 24) OVER w <> 0 THEN volume_usd / lag(volume_usd, 24) OVER w - 1 END AS vol_rate_24h,
    CASE WHEN tvl_usd <> 0 AND lag(tvl_usd, 24) OVER w <> 0 THEN tvl_usd / lag(tvl_usd, 24) OVER w - 1 END AS tvl_rate_24h,
    {rs('avg(volume_usd) OVER (w ROWS 5 PRECEDING)')} AS vol_ma_6h, {rs('avg(volume_usd) OVER (w ROWS 23 PRECEDING)')} AS vol_ma_24h,
    CASE WHEN tvl_usd <> 0 THEN volume_usd / tvl_usd END AS vol_tvl_ratio
  FROM pair WINDOW w AS (PARTITION BY dex, pool_id ORDER BY hour_ts))"""
_PAIR_COLUMNS = "dex, pool_id, hour_epoch, vol_rate_24h, tvl_rate_24h, vol_ma_6h, vol_ma_24h, vol_tvl_ratio"


def _pair(spark, sf):
    hours = X.pool_hourly(spark, sf).drop("dex")
    second = F.col("dex") == "dexb"
    pair = hours.withColumn("dex", F.explode(F.array(F.lit("dexa"), F.lit("dexb"))))
    pair = pair.withColumn("volume_usd", F.when(second, F.col("volume_usd") * 50 + 7).otherwise(F.col("volume_usd")))
    pair = pair.withColumn("tvl_usd", F.when(second, F.col("tvl_usd") + 2).otherwise(F.col("tvl_usd")))
    return materialized(pair.select("dex", "pool_id", "hour_ts", "volume_usd", "tvl_usd", "liquidity"), "pair")


def _pair_out(df):
    means = [r(c).alias(c) for c in ("vol_ma_6h", "vol_ma_24h")]
    return df.select("dex", "pool_id", epoch("hour_ts").alias("hour_epoch"), "vol_rate_24h", "tvl_rate_24h", *means, "vol_tvl_ratio")


@query("k4_features_two_exchanges", f"{_PAIR} SELECT {_PAIR_COLUMNS} FROM made")
def k4_pair(spark, sf):
    """The chain from landed lines, with rows that lack a pool beside them."""
    hours = _pair(spark, sf)
    text = {"volumeUSD": "volume_usd", "tvlUSD": "tvl_usd", "liquidity": "liquidity"}
    body = F.to_json(F.struct(F.struct(F.col("pool_id").alias("id")).alias("pool"), epoch("hour_ts").alias("periodStartUnix"),
                              *[F.col(c).cast("string").alias(n) for n, c in text.items()]))
    lost = F.to_json(F.struct(epoch("hour_ts").alias("periodStartUnix"), F.lit("12345").alias("volumeUSD")))
    raw = {}
    for p in ("dexa", "dexb"):
        mine = hours.where(F.col("dex") == p)
        raw[p] = R.land_raw(mine.select(body.alias("value")).union(mine.select(lost)), datetime(2024, 2, 1))
    return _pair_out(mart.run_stages(raw)["features"].where("pool_id is not null"))


_PAIR_AFTER = f"{_PAIR} SELECT {_PAIR_COLUMNS} FROM made WHERE hour_ts >= TIMESTAMP '2024-01-20'"


@query("k2_incremental_features_two_exchanges", _PAIR_AFTER)
def k2_pair(spark, sf):
    """The hours from day 20 on, again, behind the rows before them."""
    hours = _pair(spark, sf)
    old = hours.where(F.col("hour_ts") < moment(datetime(2024, 1, 25)))
    return _pair_out(mart.incremental_features(hours, old, reprocess_from=_SPLIT))


@query("k2_features_from_tails_two_exchanges", _PAIR_AFTER)
def k2_tails_pair(spark, sf):
    """Tails that have gone past day 20, taken anew from the history."""
    hours = _pair(spark, sf)
    _, tails = mart.features_from_tails(hours.where(F.col("hour_ts") < moment(datetime(2024, 1, 25))), hours.limit(0))
    return _pair_out(mart.features_from_tails(hours, tails, _SPLIT, hours)[0])


@query("l4_features_two_exchanges", f"{_PAIR} SELECT {_PAIR_COLUMNS} FROM made")
def l4_pair(spark, sf):
    """The stream's table after two arrivals, the second with late hours and with rows that lack a pool."""
    hours = _pair(spark, sf)
    path, mark, folder = (new_folder(spark, n) for n in ("features", "mark", "hours"))
    late = F.col("hour_ts").between(moment(datetime(2024, 1, 10)), moment(datetime(2024, 1, 12))) | (F.col("hour_ts") >= moment(_SPLIT))
    lost = hours.where(late).withColumn("pool_id", F.lit(None).cast("string"))
    for part in (hours.where(~late), hours.where(late).unionByName(lost)):
        part.write.mode("append").parquet(folder)
        ST.run_available(ST.table_stream(spark, folder, hours.schema), mark, each=ST.features_batch(path))
    return _pair_out(spark.read.parquet(path))


@query("l4_features_keyed_state", f"{_PAIR} SELECT {_PAIR_COLUMNS} FROM made")
def l4_state(spark, sf):
    """The same arrivals with the rows of each series held as keyed state; of the rows sent for an hour the last counts."""
    hours = _pair(spark, sf).withColumn("load_ts", moment(datetime(2024, 2, 1)))
    out, mark, folder = (new_folder(spark, n) for n in ("features", "mark", "hours"))
    late = F.col("hour_ts").between(moment(datetime(2024, 1, 10)), moment(datetime(2024, 1, 12))) | (F.col("hour_ts") >= moment(_SPLIT))
    wrong = hours.where(~late & (F.hour("hour_ts") == 7)).withColumn("volume_usd", F.col("volume_usd") * 2 + 1)
    wrong = wrong.withColumn("load_ts", moment(datetime(2024, 1, 31)))
    first = hours.where(~late & (F.hour("hour_ts") != 7)).unionByName(wrong)
    for part in (first, hours.where(late).unionByName(hours.where(~late & (F.hour("hour_ts") == 7)))):
        part.write.mode("append").parquet(folder)
        stream = KS.keyed_features(ST.table_stream(spark, folder, hours.schema), lateness_hours=24 * 62)
        KS.run(stream, mark, out)
    return _pair_out(KS.latest(spark.read.parquet(out).where("not passed")))


@query("k4_unkeyed", f"""{_BOTH} SELECT dex, {epochs('hour_ts')} AS hour_epoch, volume_usd FROM twofold WHERE pool_id IS NULL""")
def k4_unkeyed(spark, sf):
    """Rows that belong to no series."""
    return _both(spark, sf)["unkeyed"].select("dex", epoch("hour_ts").alias("hour_epoch"), "volume_usd")


@query("k3_violations_before_merging", f"""{_BOTH}
SELECT 'pool_id' AS "column", count(*) FILTER (pool_id IS NULL) AS violations FROM twofold
UNION ALL SELECT 'hour_ts', count(*) FILTER (hour_ts IS NULL) FROM twofold""")
def k3_both(spark, sf):
    return _both(spark, sf)["violations"]


@query("k5_is_fresh", f"""WITH {POOL_HOURLY} SELECT {epochs('max(hour_ts)')} AS newest,
  max(hour_ts) >= TIMESTAMP '2024-01-30 20:00:00' AS fresh FROM pool_hourly""")
def k5(spark, sf):
    df = mart.is_fresh(X.pool_hourly(spark, sf), datetime(2024, 1, 30, 20))
    return df.select(epoch("newest").alias("newest"), "fresh")


# -- streams -------------------------------------------------------------------------


def _by_day(df, spark, ts="hour_ts"):
    """A folder of files, one or more per day, as a stream source."""
    folder = new_folder(spark, "stream-source")
    df.repartition(4, F.to_date(ts)).write.parquet(folder)
    return folder


@query("a4_l1_ingest_stream", f"WITH {WIDE} SELECT id, volume_usd, protocol FROM wide")
def l1(spark, sf):
    folder, out, mark = (new_folder(spark, n) for n in ("landing", "raw", "mark"))
    lines = X.raw_json(spark, sf)
    for protocol in ("dexa", "dexb"):
        # every run takes what is new; the second one must not load the first folder again
        lines.where(F.col("protocol") == protocol).select("value").write.mode("append").text(folder)
        ST.run_available(ST.ingest_stream(spark, folder), mark, out)
    raw = R.as_records(spark.read.parquet(out).select("value"))
    even = F.substring("pool.id", 3, 20).cast("bigint") % 2 == 0
    return raw.select("id", F.col("volumeUSD").cast("double").alias("volume_usd"),
                      F.when(even, "dexa").otherwise("dexb").alias("protocol"))


@query("l2_dedup_stream", f"WITH {POOL_HOURLY} SELECT DISTINCT pool_id, {epochs('hour_ts')} AS hour_epoch FROM pool_hourly")
def l2(spark, sf):
    df = X.pool_hourly(spark, sf).select("pool_id", "hour_ts", "volume_usd")
    folder = _by_day(df.union(df), spark)
    stream = ST.dedup_stream(ST.table_stream(spark, folder, df.schema), ["pool_id", "hour_ts"], "hour_ts")
    out = new_folder(spark, "deduped")
    ST.run_available(stream, new_folder(spark, "mark"), out)
    return spark.read.parquet(out).select("pool_id", epoch("hour_ts").alias("hour_epoch"))


def _events(spark, sf):
    return X.pool_events(spark, sf).select("pool_id", "ts", F.col("value").alias("volume_usd"))


_ROLLED = """SELECT '0x' || CAST(user_id AS VARCHAR) AS pool_id, {start} AS start_epoch, {sum} AS sum, count(*) AS count
FROM {source} WHERE {end} <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY 1, 2"""


def _rolled(spark, sf, size, slide):
    df = _events(spark, sf)
    stream = ST.rollup_stream(ST.table_stream(spark, _by_day(df, spark, "ts"), df.schema), size=size, slide=slide)
    out = new_folder(spark, "rolled")
    ST.run_available(stream, new_folder(spark, "mark"), out)
    back = spark.read.parquet(out)
    return back.select("pool_id", epoch("start").alias("start_epoch"), r("sum", 4).alias("sum"), "count")


@query("l3_rollup_hourly", _ROLLED.format(
    start=epochs("date_trunc('hour', ts)"), sum=rs("sum(CAST(value AS DECIMAL(18,2)))", 4), source="events",
    end="date_trunc('hour', ts) + INTERVAL 1 HOUR"))
def l3(spark, sf):
    return _rolled(spark, sf, "1 hour", None)


@query("l3_rollup_sliding_6h", _ROLLED.format(
    start=epochs("s"), sum=rs("sum(CAST(value AS DECIMAL(18,2)))", 4),
    source="(SELECT *, date_trunc('hour', ts) - to_hours(i) AS s FROM events, range(6) t(i))", end="s + INTERVAL 6 HOUR"))
def l3_sliding(spark, sf):
    return _rolled(spark, sf, "6 hours", "1 hour")


@query("l4_features_foreach_batch", f"WITH {FEATURES} SELECT {FEATURE_COLUMNS_SQL} FROM features")
def l4(spark, sf):
    base = X.pool_hourly(spark, sf)
    path, mark, folder = (new_folder(spark, n) for n in ("features", "mark", "hours"))
    handle = ST.features_batch(path)
    # two arrivals; the second is older in part, so stored rows after it change as well
    late = F.col("hour_ts").between(moment(datetime(2024, 1, 10)), moment(datetime(2024, 1, 12))) | (
        F.col("hour_ts") >= moment(_SPLIT)
    )
    for part in (base.where(~late), base.where(late)):
        part.write.mode("append").parquet(folder)
        ST.run_available(ST.table_stream(spark, folder, base.schema), mark, each=handle)
    return feature_columns_out(spark.read.parquet(path))


@query("l5_alert_stream")
def l5(spark, sf):
    rows = materialized(labelled_rows(spark, sf), "labelled")
    model = M.fit_forest(rows, MART_FEATURES)
    source = _by_day(rows, spark)
    out = new_folder(spark, "alerts")
    stream = ST.table_stream(spark, source, rows.schema)
    ST.run_available(stream, new_folder(spark, "mark"), each=ST.alert_batch(model, out, 0.6))
    return spark.read.parquet(out)


@query("l6_sessions", """WITH e AS (SELECT '0x' || CAST(user_id AS VARCHAR) AS pool_id, ts FROM events), g AS (
  SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM e WINDOW w AS (PARTITION BY pool_id ORDER BY ts)), n AS (
  SELECT *, sum(opens) OVER (PARTITION BY pool_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS spell FROM g)
SELECT pool_id, CAST(epoch_us(min(ts)) AS BIGINT) AS start_us, CAST(epoch_us(max(ts) + INTERVAL 6 HOUR) AS BIGINT) AS end_us,
       count(*) AS "rows" FROM n GROUP BY pool_id, spell""")
def l6(spark, sf):
    df = ST.sessions(_events(spark, sf))
    return df.select("pool_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "rows")
