"""Features from keyed state equal a rebuild, whatever order hours come in, and list what comes too late."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidepool.operators.features import pool_features
from tidepool.plans import mart
from tidepool.session import new_folder
from tidepool.streaming import jobs as ST
from tidepool.streaming import keyed_state as KS

LAYOUT = "dex string, pool_id string, hour_ts timestamp, load_ts timestamp, volume_usd double, tvl_usd double, liquidity double"
START = datetime(2024, 1, 1)


def rows_of(dex, pool, hours, load=0, factor=1.0):
    at = START + timedelta(days=30, hours=load)
    return [
        (dex, pool, START + timedelta(hours=h), at, None if h % 17 == 0 else factor * (h % 13), float(h % 5 - 1), 1.0) for h in hours
    ]


def rounded(df):
    cols = [F.round(c, 9).alias(c) for c in KS.NAMES]
    return df.select("dex", "pool_id", "hour_ts", "volume_usd", *cols)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_late_corrected_repeated_and_passed_hours(spark):
    """A hot pool on two exchanges; late hours, newer and older loads, copies, rows without a pool, and one hour too late."""
    hot = [h for h in range(300) if h % 6 or h < 200]
    first = rows_of("a", "p", hot) + rows_of("b", "p", range(40), factor=50.0) + rows_of("a", None, range(5)) + rows_of("a", "q", [3])
    second = (
        rows_of("a", "p", [h for h in range(230, 300) if h % 6 == 0], 1)  # late
        + rows_of("a", "p", range(250, 260), 1, 3.0)  # corrected
        + rows_of("a", "p", range(270, 275), -1, 9.0)  # an older load
        + rows_of("b", "p", range(40)[-5:], factor=50.0)  # copies
        + rows_of("a", "q", [1, 2], 1)
    )
    gone = rows_of("a", "p", [10], 2, 7.0)
    out, mark, folder = (new_folder(spark, n) for n in ("sent", "mark", "hours"))
    for part in (first, second, gone):
        batch = spark.createDataFrame(part, LAYOUT)
        batch.write.mode("append").parquet(folder)
        KS.run(KS.keyed_features(ST.table_stream(spark, folder, batch.schema), lateness_hours=72), mark, out)
    sent = spark.read.parquet(out)
    kept = spark.createDataFrame(first + second, LAYOUT).where("pool_id is not null")
    kept = mart.dedup_latest(kept, ["dex", "pool_id", "hour_ts"], "load_ts", ["volume_usd", "tvl_usd"])
    want = pool_features(kept, ["dex", "pool_id"])
    assert same(rounded(KS.latest(sent.where("not passed"))), rounded(want))
    passed = sent.where("passed").select("dex", "pool_id", "hour_ts", "volume_usd").collect()
    assert [tuple(r) for r in passed] == [("a", "p", START + timedelta(hours=10), 70.0)]
    # copies and older loads change nothing and are not sent again
    assert sent.where("dex = 'b'").agg(F.max("revision")).first()[0] == 1
