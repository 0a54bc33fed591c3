"""Upserts, incremental builds and streams equal a full rebuild."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidepool import fixtures as X
from tidepool.operators import forest as M
from tidepool.operators.features import pool_features
from tidepool.operators.labels import label_spikes
from tidepool.plans import mart
from tidepool.session import new_folder
from tidepool.sources import records as R
from tidepool.sources import tables as TB
from tidepool.streaming import jobs as ST

NAMES = ["vol_rate_24h", "tvl_rate_24h", "vol_ma_6h", "vol_ma_24h", "vol_tvl_ratio"]


def rounded(df):
    return df.select("pool_id", "hour_ts", *[F.round(c, 9).alias(c) for c in NAMES])


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def hours(spark, sf_dir):
    """Longer series than the smallest tables give: suppliers by ship date."""
    df = X.supplier_days(spark, sf_dir)
    return df.cache()


@pytest.mark.parametrize("recent_days", [0, 7, 400, 100_000])
def test_incremental_features_equal_a_rebuild(hours, recent_days):
    cut = hours.agg(F.percentile_approx(F.unix_timestamp("hour_ts"), 0.9)).first()[0]
    target = hours.where(F.unix_timestamp("hour_ts") <= cut)
    got = mart.incremental_features(hours, target, recent_days)
    newest = target.agg(F.max("hour_ts")).first()[0]
    assert same(rounded(got), rounded(pool_features(hours).where(F.col("hour_ts") > F.lit(newest))))
    assert same(rounded(mart.incremental_features(hours, target.limit(0))), rounded(pool_features(hours)))


def test_tails_leave_out_hours_that_are_passed(hours):
    features, tails = mart.features_from_tails(hours, hours.limit(0))
    assert same(rounded(features), rounded(pool_features(hours)))
    assert tails.groupBy("pool_id").count().agg(F.max("count")).first()[0] == 24
    again, unchanged = mart.features_from_tails(hours, tails)
    assert again.count() == 0 and same(unchanged, tails)


def test_late_hours_come_out_and_can_be_reprocessed(hours):
    cut = hours.agg(F.percentile_approx(F.unix_timestamp("hour_ts"), 0.5)).first()[0]
    old = hours.where(F.unix_timestamp("hour_ts") <= cut)
    slow = hours.agg(F.min("pool_id")).first()[0]
    start = old.where(F.col("pool_id") == slow).agg(F.percentile_approx("hour_ts", 0.8)).first()[0]
    late = (F.col("pool_id") == slow) & (F.col("hour_ts") >= F.lit(start)) & (F.unix_timestamp("hour_ts") <= cut)
    target = old.where(~late)
    assert same(mart.late_hours(hours, target), hours.where(late)) and hours.where(late).count() > 0
    want = rounded(pool_features(hours).where(F.col("hour_ts") >= F.lit(start)))
    assert same(rounded(mart.incremental_features(hours, target, reprocess_from=F.lit(start))), want)

    held = old.where(late).agg(F.max("hour_ts")).first()[0]
    _, tails = mart.features_from_tails(old.where(~late | (F.col("hour_ts") == F.lit(held))), hours.limit(0))
    assert same(mart.late_for_tails(old.where(late), tails), old.where(late & (F.col("hour_ts") < F.lit(held))))
    again, after = mart.features_from_tails(hours, tails, F.lit(start), hours)
    assert same(rounded(again), want)
    assert same(after, mart.features_from_tails(hours, hours.limit(0))[1])
    with pytest.raises(ValueError):
        mart.features_from_tails(hours, tails, F.lit(start))


def test_old_labels_are_not_revised_and_an_empty_target_gets_all(hours):
    source = pool_features(hours)
    assert mart.incremental_label(source, source.limit(0)).count() == hours.count()
    assert mart.incremental_label(source, source).count() == 0
    again = mart.incremental_label(source, source, reprocess_from=F.lit("2000-01-01").cast("timestamp"))
    assert same(again, label_spikes(source).where("hour_ts >= '2000-01-01'"))


def test_upsert_touches_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "k int, v int, day string")
    TB.upsert_days(make([(1, 1, "d1"), (2, 1, "d1"), (3, 1, "d2")]), path, ["k", "day"])
    before = {r[0] for r in spark.read.parquet(path).where("day = 'd2'").select(F.input_file_name()).collect()}
    TB.upsert_days(make([(2, 9, "d1"), (4, 9, "d3")]), path, ["k", "day"])
    TB.upsert_days(make([]), path, ["k", "day"])
    now = spark.read.parquet(path)
    assert sorted((r["k"], r["v"], r["day"]) for r in now.collect()) == [(1, 1, "d1"), (2, 9, "d1"), (3, 1, "d2"), (4, 9, "d3")]
    assert {r[0] for r in now.where("day = 'd2'").select(F.input_file_name()).collect()} == before


def test_create_or_replace_by_name(spark):
    name = "replace_me"
    try:
        TB.materialize(spark.range(3).toDF("x"), name)
        TB.materialize(spark.range(5).toDF("x"), name)
        assert TB.read_table(spark, name, "x > 1").count() == 3
        assert TB.read_table(spark, f"(select x from {name} where x = 4)").first()["x"] == 4
    finally:
        spark.sql(f"drop table if exists {name}")


def test_features_on_a_stream_with_late_and_corrected_hours(spark, sf_dir, tmp_path):
    path, mark, folder = (str(tmp_path / n) for n in ("features", "mark", "in"))
    source = X.pool_hourly(spark, sf_dir)
    wrong = source.where(F.dayofmonth("hour_ts") == 5).withColumn("volume_usd", F.col("volume_usd") + 100)
    arrivals = [
        source.where("dayofmonth(hour_ts) < 20 and dayofmonth(hour_ts) != 5").unionByName(wrong),
        source.where("dayofmonth(hour_ts) >= 20"),
        source.where("dayofmonth(hour_ts) = 5"),
    ]
    handle = ST.features_batch(path)
    for part in arrivals:
        part.write.mode("append").parquet(folder)
        ST.run_available(ST.table_stream(spark, folder, source.schema), mark, each=handle)
    want = rounded(pool_features(source))
    assert same(rounded(spark.read.parquet(path)), want)
    handle(arrivals[2], 99)  # a batch that is repeated after a failure
    assert same(rounded(spark.read.parquet(path)), want)


def test_each_file_is_loaded_once(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("landing", "raw", "mark"))
    spark.range(5).select(F.to_json(F.struct("id")).alias("value")).write.text(folder)
    for _ in range(2):
        ST.run_available(ST.ingest_stream(spark, folder), mark, out)
    assert spark.read.parquet(out).count() == 5
    spark.range(5, 8).select(F.to_json(F.struct("id")).alias("value")).write.mode("append").text(folder)
    ST.run_available(ST.ingest_stream(spark, folder), mark, out)
    assert spark.read.parquet(out).count() == 8


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    make = lambda rows: spark.createDataFrame(rows, "pool_id string, ts string, volume_usd double").withColumn(
        "ts", F.col("ts").cast("timestamp")
    )
    schema = make([]).schema
    for rows in ([("p", "2025-01-01 00:10:00", 1.0), ("p", "2025-01-01 05:00:00", 2.0)], [("p", "2025-01-01 00:20:00", 50.0), ("p", "2025-01-01 09:00:00", 3.0)]):
        make(rows).write.mode("append").parquet(folder)
        ST.run_available(ST.rollup_stream(ST.table_stream(spark, folder, schema)), mark, out)
    got = [(r["start"], r["sum"]) for r in spark.read.parquet(out).orderBy("start").collect()]
    assert [s for _, s in got] == [1.0, 2.0]


def test_sessions_stream_equals_batch(spark, sf_dir, tmp_path):
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    df = X.pool_events(spark, sf_dir).select("pool_id", "ts")
    df.write.parquet(folder)
    ST.run_available(ST.sessions(ST.table_stream(spark, folder, df.schema)), mark, out)
    limit = df.agg(F.max("ts") - F.expr("interval 1 hour")).first()[0]
    closed = ST.sessions(df).where(F.col("end") <= F.lit(limit))
    assert same(spark.read.parquet(out), closed)


def test_alert_stream_equals_batch(spark, hours, tmp_path):
    features = ["volume_usd", "tvl_usd", "liquidity"]
    model = M.fit_forest(hours, features, trees=20)
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    hours.write.parquet(folder)
    ST.run_available(ST.table_stream(spark, folder, hours.schema), mark, each=ST.alert_batch(model, out, 0.55))
    want = M.score(hours, model).where("score >= 0.55").select("pool_id", "hour_ts", "score")
    assert want.count() > 0 and same(spark.read.parquet(out).select(*want.columns), want)


def test_stages_replace_an_older_load(spark):
    line = '{{"id": "p-1", "periodStartUnix": {t}, "pool": {{"id": "p"}}, "volumeUSD": "{v}", "tvlUSD": "10", "liquidity": "1"}}'
    old = [(line.format(t=3600 * i, v=1),) for i in range(30)]
    new = [(line.format(t=3600 * i, v=i),) for i in range(30)]
    land = lambda rows, at: R.land_raw(spark.createDataFrame(rows, "value string"), datetime(2025, 1, at))
    parts = mart.run_stages({"dexa": land(old, 1).unionByName(land(new, 2)), "dexb": land(old[:0] or old, 1).limit(0)})
    rows = parts["labelled"].orderBy("hour_ts").collect()
    assert [r["volume_usd"] for r in rows] == [float(i) for i in range(30)]
    assert [r["y"] for r in rows] == [0] * 27 + [1] * 3
    assert rows[25]["vol_rate_24h"] == 24.0 and rows[24]["vol_rate_24h"] is None
    assert {r["violations"] for r in mart.expect_not_null(parts["features"], ["pool_id", "hour_ts"]).collect()} == {0}


def test_an_upsert_lost_in_its_swap_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "k int, v int, day string")
    TB.upsert_days(make([(1, 1, "d1"), (2, 1, "d1"), (3, 1, "d2")]), path, ["k", "day"])

    def lost(merged, target, day):
        """The day's files are gone and the new ones have not come."""
        for f in (tmp_path / "t" / "day=d1").iterdir():
            f.unlink()
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(TB, "_swap", lost)
        with pytest.raises(RuntimeError, match="lost"):
            TB.upsert_days(make([(2, 9, "d1")]), path, ["k", "day"])
    TB.upsert_days(make([(1, 5, "d1")]), path, ["k", "day"])
    now = sorted((r["k"], r["v"], r["day"]) for r in spark.read.parquet(path).collect())
    assert now == [(1, 5, "d1"), (2, 9, "d1"), (3, 1, "d2")]


def test_the_newest_copy_stays_whatever_batch_brings_it(spark, tmp_path):
    path = str(tmp_path / "features")
    columns = "dex string, pool_id string, hour_ts timestamp, volume_usd double, tvl_usd double, liquidity double, load_ts timestamp"
    make = lambda *rows: spark.createDataFrame([("dexa", "p", f"2024-01-0{d} 00:00:00", v, 1.0, 1.0, f"2024-02-0{n} 00:00:00") for d, v, n in rows], columns.replace("timestamp", "string")).withColumns({c: F.col(c).cast("timestamp") for c in ("hour_ts", "load_ts")})
    handle = ST.features_batch(path)
    handle(make((1, 500.0, 1), (1, 2.0, 2), (2, 7.0, 2)), 0)
    handle(make((1, 900.0, 1), (3, 4.0, 3)), 1)  # an older copy arrives later
    handle(make((2, 8.0, 4)), 2)
    got = [(r["volume_usd"], r["vol_ma_6h"]) for r in spark.read.parquet(path).orderBy("hour_ts").collect()]
    assert [v for v, _ in got] == [2.0, 8.0, 4.0]
    assert got[2][1] == pytest.approx(14 / 3)
    with pytest.raises(ValueError, match="load_ts"):
        handle(make((4, 1.0, 1)).drop("load_ts"), 3)


def test_recent_rows_are_read_from_their_days_alone(spark, hours, tmp_path):
    path = str(tmp_path / "t")
    hours.withColumn("day", F.date_format("hour_ts", "yyyy-MM-dd")).where("month(hour_ts) = 3").write.partitionBy("day").parquet(path)
    edge = F.lit("1995-01-01").cast("timestamp")
    plan = mart.day_between(spark.read.parquet(path), "day", edge, None)._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "1995-01-01" in filters.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_stream_table_keeps_exchanges_and_lists_rows_without_a_key(spark):
    """Two exchanges with one pool id, and rows without a pool: none is lost or merged with another."""
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(dex, pool, start + timedelta(hours=h), v + h, 1.0, 1.0) for dex, v in (("dexa", 1.0), ("dexb", 100.0)) for pool in ("p", None) for h in range(3)]
    batch = spark.createDataFrame(rows, "dex string, pool_id string, hour_ts timestamp, volume_usd double, tvl_usd double, liquidity double")
    path = new_folder(spark, "features")
    ST.features_batch(path)(batch, 0)
    ST.features_batch(path)(batch, 0)  # repeated after a failure
    made = spark.read.parquet(path)
    assert {(r["dex"], r["volume_usd"], r["vol_ma_6h"]) for r in made.collect()} == {
        (dex, v + h, v + h / 2) for dex, v in (("dexa", 1.0), ("dexb", 100.0)) for h in range(3)
    }
    assert spark.read.parquet(ST.unkeyed(path)).count() == 6
