"""Rows of a roll-up are dealt out before their windows are made, and its state is on disk."""

from pyspark.sql import functions as F

from tidepool.session import new_folder
from tidepool.streaming import jobs as ST
from tidepool.streaming import keyed_state as KS


def test_windows_are_made_from_dealt_rows(spark):
    """One file of a hot pool: its windows' sums begin in several tasks, not in the one that reads it."""
    folder = new_folder(spark, "events")
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 600)
    rows = spark.range(2000).select(F.lit("p").alias("pool_id"), ts.alias("ts"), F.lit(1.0).alias("volume_usd"))
    rows.coalesce(1).write.parquet(folder)
    rolled = ST.rollup_stream(ST.table_stream(spark, folder, rows.schema), size="6 hours", slide="1 hour")
    plan = rolled._jdf.queryExecution().analyzed().toString()
    assert 0 < plan.index("Expand") < plan.index("RepartitionByExpression")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == KS.PROVIDER
    out = new_folder(spark, "rolled")
    ST.run_available(rolled, new_folder(spark, "mark"), out)
    made = spark.read.parquet(out)
    # 36 rows in every window but the first five, which begin before the rows, and those still open
    assert made.groupBy("count").count().orderBy("count").tail(1)[0][0] == 36
    edge = rows.agg(F.max("ts") - F.expr("interval 1 hour")).first()[0]
    want = rows.groupBy(F.window("ts", "6 hours", "1 hour"), "pool_id").agg(F.sum("volume_usd").alias("sum"), F.count("*").alias("count"))
    want = want.where(F.col("window.end") <= F.lit(edge)).select("window.start", "pool_id", "sum", "count")
    got = made.select("start", "pool_id", "sum", "count")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
