"""The stream's feature table: what a batch costs, and that it equals a rebuild over short and long spans."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidepool.operators.features import pool_features
from tidepool.sources import tables as TB
from tidepool.streaming import jobs as ST

SCHEMA = "dex string, pool_id string, hour_ts timestamp, volume_usd double, tvl_usd double, liquidity double"


def hours(spark, rows):
    return spark.createDataFrame([(d, p, datetime(2024, 1, 1) + timedelta(hours=h), float(v), float(t), 1.0) for d, p, h, v, t in rows], SCHEMA)


def made_rows(days):
    """Two exchanges' hours of a pool with gaps, and a pool of its own; day by day their number differs."""
    return [(d, p, h, (h * 7) % 11 * (1 + i), h % 5) for i, (d, p) in enumerate([("a", "x"), ("b", "x"), ("a", "y")]) for h in range(0, days * 24, 1 + i)]


@pytest.mark.parametrize("days", [40, 200])
def test_batches_equal_a_rebuild(spark, tmp_path, days):
    path = str(tmp_path / "features")
    rows = made_rows(days)
    late = [r for r in rows if r[0] == "a" and days * 12 <= r[2] < days * 12 + 9]
    wrong = [(d, p, h, v + 1, t) for d, p, h, v, t in rows if d == "a" and h in (days * 12 + 30, days * 12 + 36)]
    first = [r for r in rows if r not in late and (*r[:3], r[3] + 1, r[4]) not in wrong] + wrong
    right = [(d, p, h, v - 1, t) for d, p, h, v, t in wrong]
    handle = ST.features_batch(path)
    for n, part in enumerate((first, late, right, [("b", "z", 5, 3, 0)])):
        handle(hours(spark, part), n)
    want = pool_features(hours(spark, [*rows, ("b", "z", 5, 3, 0)]), ["dex", "pool_id"], chunk_seconds=None)
    got = spark.read.parquet(path).drop("day").select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_batch_joins_its_series_once_and_has_no_seams_within_a_chunk(spark, tmp_path, monkeypatch):
    path, plans = str(tmp_path / "features"), []
    kept = ST.upsert_days
    monkeypatch.setattr(ST, "upsert_days", lambda df, *a: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), kept(df, *a))[1])
    handle = ST.features_batch(path)
    handle(hours(spark, made_rows(20)), 0)
    handle(hours(spark, [("a", "x", 100, 5, 5), ("a", "x", 600, 5, 5)]), 1)
    assert [p.count("Join ") for p in plans] == [0, 1]
    assert not any("Union" in p.split("Window")[0] for p in plans)


def test_the_first_upsert_writes_its_days_once(spark, tmp_path, monkeypatch):
    path, folders = str(tmp_path / "table"), []
    kept = TB.new_folder
    monkeypatch.setattr(TB, "new_folder", lambda spark, label: (folders.append(label), kept(spark, label))[1])
    rows = spark.range(20).withColumn("day", F.concat(F.lit("d"), (F.col("id") % 3).cast("string")))
    TB.upsert_days(rows.limit(0), path, ["id", "day"])
    TB.upsert_days(rows, path, ["id", "day"])
    assert not folders
    TB.upsert_days(rows.where("id < 4").union(spark.range(90, 91).withColumn("day", F.lit("d1"))), path, ["id", "day"])
    assert folders == ["upsert"]
    got = sorted((r["id"], r["day"]) for r in spark.read.parquet(path).collect())
    assert got == sorted([(i, f"d{i % 3}") for i in range(20)] + [(90, "d1")])
