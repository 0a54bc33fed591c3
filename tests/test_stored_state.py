"""Ledgers, snapshots, newest rows and sketches against what a look at all rows gives."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidepool import fixtures as X
from tidepool.operators import forest as M
from tidepool.operators import ledger
from tidepool.operators.features import pool_features
from tidepool.operators.labels import label_spikes
from tidepool.operators.quantiles import daily_sketches, exact_quantiles, quantiles_from_sketches
from tidepool.plans import mart
from tidepool.session import new_folder
from tidepool.sources import snapshots as SN

HOURS = "dex string, pool_id string, hour_ts timestamp, volume_usd double"


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def hot_hours(spark):
    """A third of the rows in one pool; values that lie close, repeat, change sign or are missing; a row without a pool."""
    start = datetime(2024, 1, 1)
    rows = [("a", "hot", start + timedelta(hours=i), 1.0 + (i * 37 % 101) * 1e-12) for i in range(300)]
    rows += [("a", "hot", start + timedelta(hours=i), float(i % 7 - 3)) for i in range(300, 400)]
    for p in range(8):
        rows += [("b", f"p{p}", start + timedelta(hours=i), None if i % 9 == 0 else float((i * p) % 11) / 3) for i in range(0, 400, 4)]
    rows += [("b", "nan", start, float("nan")), ("b", "none", start, None), ("b", None, start, 5.0), ("b", "inf", start, float("inf"))]
    rows += [("b", "zero", start + timedelta(hours=i), -0.0 if i % 2 else 0.0) for i in range(9)]
    return spark.createDataFrame(rows, HOURS)


def test_ledger_equals_all_history_at_every_step(spark):
    hours = hot_hours(spark).cache()
    path, series = new_folder(spark, "ledger"), ["dex", "pool_id"]
    edge = lambda day: F.lit(datetime(2024, 1, day).isoformat(" ")).cast("timestamp")
    for n, (day, until) in enumerate(((1, 9), (9, 13), (13, 21))):
        upto = hours.where(F.col("hour_ts") < edge(until))
        part = upto.where(F.col("hour_ts") >= edge(day))
        labels = mart.label_from_ledger(part, path, n)
        assert same(labels, label_spikes(part, by=series, history=upto))
        qs = [0.0, 0.25, 0.5, 0.9, 1.0]
        want = exact_quantiles(upto.where("pool_id is not null"), "volume_usd", qs, series)
        assert same(ledger.quantiles(spark, path, qs, series), want)
    ledger.append_rows(part, path, n, "volume_usd", series)  # a batch that is run again
    assert same(ledger.quantiles(spark, path, qs, series), want)
    small = new_folder(spark, "ledger")
    ledger.compact(spark, path, small, series)
    assert same(ledger.quantiles(spark, small, qs, series), want)


def test_ledger_takes_corrections_and_ignores_a_lost_batch(spark):
    hours = hot_hours(spark).cache()
    path, series = new_folder(spark, "ledger"), ["dex", "pool_id"]
    wrong = hours.where("pool_id = 'p3' and day(hour_ts) < 4")
    right = wrong.withColumn("volume_usd", F.lit(100.0))
    ledger.append_rows(hours, path, 0, "volume_usd", series)
    ledger.append_rows(right, path, 1, "volume_usd", series, withdrawn=wrong)
    # values without counts: the job was lost between its two tables
    ledger._entries(right, "volume_usd", series, 1).write.parquet(f"{path}/values/batch=2")
    now = hours.where("not (pool_id <=> 'p3' and day(hour_ts) < 4) and pool_id is not null").unionByName(right)
    assert same(ledger.quantiles(spark, path, [0.1, 0.9], series), exact_quantiles(now, "volume_usd", [0.1, 0.9], series))
    with pytest.raises(LookupError):
        ledger.quantiles(spark, new_folder(spark, "ledger"), [0.5], series)


def test_empty_ledger_batches(spark):
    none = hot_hours(spark).limit(0)
    path = new_folder(spark, "ledger")
    assert mart.label_from_ledger(none, path, 0).count() == 0
    assert ledger.quantiles(spark, path, [0.5], ["dex", "pool_id"], of=none).count() == 0


def test_opened_values_are_pruned_by_band(spark):
    """The scan of the values gets the bands as a filter, and no other column than it needs."""
    path, series = new_folder(spark, "ledger"), ["dex", "pool_id"]
    ledger.append_rows(hot_hours(spark), path, 0, "volume_usd", series)
    plan = ledger.quantiles(spark, path, [0.9], series)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "value#" in line]
    assert scans and all("band" in line.split("PushedFilters")[1] for line in scans)


def test_a_reader_between_the_two_steps_of_an_upsert_sees_the_old_table_whole(spark):
    path, schema = new_folder(spark, "snapshots"), "k int, v string, day string"
    table = lambda *rows: spark.createDataFrame(list(rows), schema)
    old = table((1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", "2024-01-03"))
    kind = old.schema
    assert SN.upsert_snapshot(old, path, ["k"]) == 1
    new = table((2, "B", "2024-01-02"), (4, "d", "2024-01-02"), (5, "e", "2024-01-04"))
    reading = SN.read_snapshot(spark, path, kind)
    written = SN.write_days(new, path, ["k"], 1)
    assert same(SN.read_snapshot(spark, path, kind), old)  # between the steps
    assert SN.publish(spark, path, 1, written) == 2
    want = old.where("k <> 2").unionByName(new)
    assert same(SN.read_snapshot(spark, path, kind), want)
    assert same(reading, old)  # planned before the swap, run after it
    assert same(SN.read_snapshot(spark, path, kind, version=1), old)
    assert same(SN.read_snapshot(spark, path, kind, first="2024-01-02", last="2024-01-03"), want.where("k in (2, 3, 4)"))
    with pytest.raises(AnalysisException):  # a second writer that started from version 1
        SN.publish(spark, path, 1, written)
    assert SN.upsert_snapshot(new.limit(0), path, ["k"]) == 2
    with pytest.raises(ValueError):
        SN.upsert_snapshot(table((9, "x", None)), path, ["k"])
    assert SN.read_snapshot(spark, new_folder(spark, "snapshots"), kind).count() == 0


def test_untouched_days_are_not_written_again(spark):
    path = new_folder(spark, "snapshots")
    old = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "k int, day string")
    SN.upsert_snapshot(old, path, ["k"])
    SN.upsert_snapshot(old.where("k = 2"), path, ["k"])
    first, second = SN._manifest(spark, path, 1), SN._manifest(spark, path, 2)
    assert first["2024-01-01"] == second["2024-01-01"] and first["2024-01-02"] != second["2024-01-02"]


def test_newest_rows_by_batches_equal_those_of_the_whole(spark, sf_dir):
    hours = pool_features(X.supplier_days(spark, sf_dir)).cache()
    cut = hours.agg(F.percentile_approx(F.unix_timestamp("hour_ts"), 0.5)).first()[0]
    old = F.unix_timestamp("hour_ts") <= cut
    kept = mart.newest_rows(mart.newest_rows(hours.limit(0), hours.where(~old)), hours.where(old))
    want = hours.groupBy("pool_id").agg(F.max("hour_ts").alias("hour_ts"))
    assert same(kept.select("pool_id", "hour_ts"), want)
    again = kept.withColumn("volume_usd", F.lit(-1.0))
    assert mart.newest_rows(kept, again).where("volume_usd <> -1").count() == 0


def _average_precision(rows):
    seen = hits = area = 0
    total = sum(y for _, y in rows)
    for s in sorted({s for s, _ in rows}, reverse=True):
        at = [y for t, y in rows if t == s]
        seen, hits = seen + len(at), hits + sum(at)
        area += sum(at) * hits / seen
    return area / total


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_pr_auc_of_scores_that_lie_close(spark, most):
    """Scores within one part in ten to the twelve, one score of a third of the rows, and rows without a score."""
    rows = [(0.5 + (i * 31 % 97) * 1e-13, int(i % 3 == 0)) for i in range(200)] + [(0.5, int(i % 5 == 0)) for i in range(100)]
    df = spark.createDataFrame([*rows, (None, 1), (float("nan"), 1)], "score double, y int")
    assert M.pr_auc(df, most).first()[0] == pytest.approx(_average_precision(rows), rel=1e-12)
    assert M.pr_auc(df.limit(0), most).first()[0] is None


def test_sketches_over_days(spark):
    hours = hot_hours(spark).cache()
    stored = daily_sketches(hours, "volume_usd", ["pool_id"])
    assert stored.where("pool_id in ('nan', 'none')").count() == 0
    whole = quantiles_from_sketches(stored, {"low": 0.0, "mid": 0.5, "high": 1.0}, ["pool_id"])
    small = whole.where("n <= 200")
    values = hours.where("volume_usd is not null and not isnan(volume_usd)")
    want = values.groupBy("pool_id").agg(F.count("*").alias("n"), F.min("volume_usd").alias("low"),
                                         F.expr("percentile_disc(0.5) within group (order by volume_usd)").alias("mid"),
                                         F.max("volume_usd").alias("high"))
    assert same(small, want.where("n <= 200"))
    hot = whole.where("pool_id = 'hot'").first()
    held = sorted(r["volume_usd"] for r in values.where("pool_id = 'hot'").collect())
    assert sum(v < hot["mid"] for v in held) <= 0.54 * len(held) and sum(v <= hot["mid"] for v in held) >= 0.46 * len(held)
    assert stored.limit(0).count() == 0 and quantiles_from_sketches(stored.limit(0), {"mid": 0.5}, ["pool_id"]).count() == 0
