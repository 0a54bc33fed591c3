"""Records are parsed once, and what is no record or has no pool is still told apart."""

from datetime import datetime

from pyspark.sql import functions as F

from tidepool import schema as L
from tidepool.functions.json_fields import json_float, json_str, json_ts
from tidepool.plans import mart
from tidepool.sources import records as R

LINES = [
    '{"id":"a-1","periodStartUnix":3600,"pool":{"id":"a","token0":{"id":"x"},"token1":{"id":"y"}},"tvlUSD":"1.5","volumeUSD":2,"close":"NaN"}',
    '{"id":"a-2","periodStartUnix":"7200","pool":{"id":{"deep":[1]},"token0":"x","token1":null},"tvlUSD":[1],"liquidity":true,"open":1e3}',
    '{"id":"b-1","periodStartUnix":"soon","pool":"b","volumeUSD":"x"}',
    '{"id":"c-1","pool":{}}',
    '{"id":"d-1","pool":null}',
    "[1, 2]",
    "null",
    '"text"',
    '{"id":"e-1","per',
    "",
]


def lines(spark):
    return spark.createDataFrame([(x,) for x in LINES], "value string")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_variant_read_in_one_go_gives_what_paths_give(spark):
    raw = R.land_raw(lines(spark).where("value <> ''"), datetime(2024, 2, 1))
    r = F.col("raw")
    want = raw.select(
        json_ts(r, "periodStartUnix", True).alias("hour_ts"),
        *[json_str(r, p, True).alias(n) for n, p in L.STAGED.items()],
        *[json_float(r, p, True).alias(n) for n, p in L.STAGED_MEASURES.items()],
        "load_ts",
    )
    got = R.stage_pool_hourly(raw)
    assert got.columns == want.columns and got.count() == 9
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_the_chain_parses_a_line_once(spark, monkeypatch):
    plans = {}
    kept = mart.materialized
    monkeypatch.setattr(mart, "materialized", lambda df, label: (plans.__setitem__(label, plan_of(df)), kept(df, label))[1])
    out = mart.run_stages({"dexa": R.land_raw(lines(spark).repartition(1), datetime(2024, 2, 1))}, keys=("dex", "pool_id", "hour_ts"))
    assert plans["staged"].count("parseJson") == 1
    assert "_json" not in out["staging"].columns
    # all lines that are JSON, the four rows without a pool or hour among them
    assert out["staging"].count() == 8 and out["unkeyed"].count() == 6


def test_metadata_parses_a_record_once(spark):
    made = R.pool_metadata(R.as_records(lines(spark).repartition(1)))
    assert plan_of(made).count("from_json(") == 1
    # a pool without attributes is a pool; no pool, or none that can be read, is not
    assert sorted((r.id, r.token0_id) for r in made.collect() if r.id[0] in "acd") == [("a-1", "x"), ("a-2", None), ("c-1", None)]
    assert made.columns == ["id", *L.METADATA]


def test_metadata_of_copies_with_and_without_a_pool(spark):
    same = ['{"id":"a","pool":{}}', '{"id":"a"}', '{"id":"a","pool":{}}', '{"id":"b"}']
    made = R.pool_metadata(R.as_records(spark.createDataFrame([(x,) for x in same], "value string")))
    assert [r.id for r in made.collect()] == ["a"]
