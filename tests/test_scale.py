"""The skew-safe ways give the same results as the plain ones, on awkward data."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepool.operators.features import pool_features
from tidepool.operators.frames import dedup_latest, ffill_bfill, fitting_chunk, last_rows
from tidepool.operators.labels import label_spikes
from tidepool.operators.profile import histogram
from tidepool.operators.quantiles import exact_quantiles

QS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]


def frame(spark, values, groups):
    pdf = pd.DataFrame({"g": groups, "x": np.asarray(values, dtype=float)})
    return spark.createDataFrame(pdf), pdf


def check_quantiles(df, pdf, **how):
    got = {(r["g"], r["q"]): r["value"] for r in exact_quantiles(df, "x", QS, ["g"], **how).collect()}
    for g, part in pdf.groupby("g"):
        known = part["x"].dropna().to_numpy()
        for i, want in enumerate(np.quantile(known, QS) if len(known) else []):
            assert got.pop((g, i)) == pytest.approx(want, rel=1e-12, abs=1e-300), (g, QS[i])
    assert not got


@pytest.mark.parametrize("limit", [0, 500, None])
def test_quantiles_with_one_hot_group(spark, limit):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.lognormal(10, 4, 3000), rng.normal(0, 5, 1000), np.repeat(7.25, 1500), rng.normal(0, 1e-200, 300)])
    groups = ["hot"] * 3000 + ["signed"] * 1000 + ["same"] * 1500 + ["tiny"] * 300
    values[::97] = np.nan
    df, pdf = frame(spark, values, groups)
    check_quantiles(df, pdf, direct_limit=limit)


def test_quantiles_of_close_values_take_the_finer_bands(spark):
    values = 1.0 + np.arange(4000) * 1e-12  # all in one coarse and in one fine band
    df, pdf = frame(spark, np.random.default_rng(2).permutation(values), ["g"] * 4000)
    check_quantiles(df, pdf, direct_limit=0)
    check_quantiles(df, pdf, direct_limit=0, most=3)


def test_quantiles_do_not_show_the_size_of_a_group(spark):
    """Bit by bit the same below and above the limit, for values one part in 10^9 apart, very far apart, and infinite."""
    rng = np.random.default_rng(9)
    near = 12_345.678 * (1 + rng.permutation(3000) * 1e-9)
    far = np.concatenate([[-np.inf, np.inf, -1.7e308, 1.7e308, 5e-324, 0.0], np.exp(rng.normal(0, 200, 900)), -np.exp(rng.normal(0, 90, 300))])
    df, _ = frame(spark, np.concatenate([near, far]), ["near"] * len(near) + ["far"] * len(far))
    qs = [0.013, 0.1, 1 / 3, 0.5, 0.9, 0.987]
    whole, *others = (
        {(r["g"], r["q"]): r["value"] for r in exact_quantiles(df, "x", qs, ["g"], **how).collect()}
        for how in ({"direct_limit": None}, {}, {"direct_limit": 2000}, {"direct_limit": 0}, {"direct_limit": 100, "most": 5})
    )
    assert len(whole) == 12 and all(o == whole for o in others)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.floats(allow_nan=False, allow_infinity=False, width=32)),
        min_size=1, max_size=60,
    )
)
def test_quantiles_by_counting_match_any_input(spark, rows):
    df = spark.createDataFrame([(g, float(x)) for g, x in rows], "g string, x double")
    one = {(r["g"], r["q"]): r["value"] for r in exact_quantiles(df, "x", QS, ["g"], direct_limit=0).collect()}
    two = {(r["g"], r["q"]): r["value"] for r in exact_quantiles(df, "x", QS, ["g"], direct_limit=None).collect()}
    assert one.keys() == two.keys()
    for k in one:
        assert one[k] == two[k]  # to the last digit


def test_whole_column_quantiles_either_way(spark):
    df = spark.range(10_001).select(F.col("id").cast("double").alias("x"))
    for limit in (0, 10**9):
        got = [r["value"] for r in exact_quantiles(df, "x", [0.25, 0.5], direct_limit=limit).orderBy("q").collect()]
        assert got == [2500.0, 5000.0]
    assert exact_quantiles(df.limit(0), "x", [0.5]).where("value is not null").count() == 0


def gappy(spark, seed):
    """One pool with most rows, others short, with gaps from hours to months."""
    rng = np.random.default_rng(seed)
    rows = []
    for pool, n in [("hot", 900), ("b", 60), ("c", 23), ("d", 25), ("e", 1)]:
        steps = rng.choice([1, 1, 1, 2, 30, 900], size=n, p=[0.5, 0.2, 0.1, 0.1, 0.08, 0.02])
        for at in np.cumsum(steps):
            rows.append((pool, int(at) * 3600, float(rng.integers(0, 5)), float(rng.integers(-2, 5))))
    df = spark.createDataFrame(rows, "pool_id string, at bigint, volume_usd double, tvl_usd double")
    return df.withColumn("hour_ts", F.timestamp_seconds("at")).drop("at")


@pytest.mark.parametrize("chunk_hours", [1, 5, 24, 24 * 10, 24 * 400])
def test_chunked_windows_equal_whole_ones(spark, chunk_hours):
    df = gappy(spark, chunk_hours)
    whole = pool_features(df, chunk_seconds=None)
    cut = pool_features(df, chunk_seconds=chunk_hours * 3600)
    assert cut.count() == df.count()
    names = ["vol_rate_24h", "tvl_rate_24h", "vol_ma_6h", "vol_ma_24h", "vol_tvl_ratio"]
    rounded = [F.round(c, 9).alias(c) for c in names]
    one = whole.select("pool_id", "hour_ts", *rounded)
    two = cut.select("pool_id", "hour_ts", *rounded)
    assert one.exceptAll(two).count() == 0


def test_chunk_length_fits_the_densest_series(spark):
    df = gappy(spark, 5)
    assert fitting_chunk(df, ["pool_id"], "hour_ts") == 90 * 86_400
    day = df.groupBy("pool_id", F.to_date("hour_ts")).count().agg(F.max("count")).first()[0]
    assert fitting_chunk(df, ["pool_id"], "hour_ts", most=day) == 86_400
    assert fitting_chunk(df, ["pool_id"], "hour_ts", most=0) == 3600
    assert fitting_chunk(df.limit(0), ["pool_id"], "hour_ts") == 90 * 86_400


@pytest.mark.parametrize("chunk_hours", [1, 24, 24 * 30])
def test_chunked_fill_equals_pandas(spark, chunk_hours):
    df = gappy(spark, 9).withColumn("tvl_usd", F.when(F.col("tvl_usd") > 2, F.col("tvl_usd")))
    pdf = df.toPandas().sort_values(["pool_id", "hour_ts"])
    pdf["want"] = pdf.groupby("pool_id")["tvl_usd"].transform(lambda s: s.ffill().bfill())
    got = ffill_bfill(df, ["pool_id"], "hour_ts", ["tvl_usd"], chunk_hours * 3600).toPandas()
    both = pdf.merge(got, on=["pool_id", "hour_ts"], suffixes=("", "_got"))
    assert len(both) == len(pdf)
    assert ((both["want"] == both["tvl_usd_got"]) | (both["want"].isna() & both["tvl_usd_got"].isna())).all()


def test_a_key_with_a_third_of_all_copies(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"), F.col("id").alias("loaded")
    )
    kept = dedup_latest(df, ["id"], "loaded")
    assert kept.count() == 20_001
    assert kept.where("id = 'hot'").first()["loaded"] == 29_997


def test_limits_apply_before_the_shuffle(spark):
    df = gappy(spark, 3)
    plan = last_rows(df, ["pool_id"], "hour_ts", 24)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_label_of_a_hot_pool_by_counting(spark, monkeypatch):
    from tidepool.operators import labels

    df = gappy(spark, 4)
    plain = label_spikes(df)
    monkeypatch.setattr(labels, "DIRECT_LIMIT", 50)
    split = label_spikes(df)
    assert plain.exceptAll(split).count() == 0 and split.count() == df.count()


def test_histogram_of_a_constant_column(spark):
    df = spark.range(7).select(F.lit(3.0).alias("x"))
    rows = histogram(df, "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [0, 0, 7, 0] and rows[0]["lo"] == 2.5


def test_constant_and_empty_columns_give_missing_figures(spark):
    from tidepool.operators import profile as P
    from tidepool.operators import scaling as Z
    from tidepool.operators.clean import cut_above_quantile, scaling_check

    flat = spark.range(5).select(F.lit(3.0).alias("x"), F.col("id").cast("double").alias("y"))
    corr = {(r["a"], r["b"]): r["corr"] for r in P.corr_matrix(flat, ["x", "y"]).collect()}
    assert corr[("x", "y")] is None and corr[("y", "y")] == pytest.approx(1.0)
    assert scaling_check(flat, "x", 10).first()["corr"] is None
    assert P.kde(flat, "x", 4).where("density is not null").count() == 0
    assert P.moments(flat, "x").first()["median"] == 3.0
    assert Z.standardize(flat, ["x"]).where("x = 0").count() == 5
    assert Z.min_max(flat, ["x"]).where("x is null").count() == 5
    empty = flat.limit(0)
    assert P.describe(empty, ["x", "y"]).count() == 0 and P.box_stats(empty, "x").first()["count"] == 0
    assert P.kde(empty, "x", 4).where("density is not null").count() == 0
    assert cut_above_quantile(empty, "x").count() == 0 and histogram(empty, "x", 4).agg(F.sum("count")).first()[0] == 0


def test_filters_and_columns_reach_the_scan(spark, sf_dir, tmp_path):
    from datetime import datetime

    from tidepool import fixtures as X
    from tidepool.operators.clean import recent
    from tidepool.sources.tables import materialize, read_table

    path = str(tmp_path / "features")
    materialize(X.pool_hourly(spark, sf_dir), path)
    df = recent(read_table(spark, path), 30, datetime(2024, 2, 10)).select("pool_id", "volume_usd")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(hour_ts" in plan
    assert "ReadSchema: struct<pool_id:string,hour_ts:timestamp,volume_usd:double>" in plan


def test_feature_windows_share_one_exchange(spark, sf_dir, tmp_path):
    from tidepool import fixtures as X
    from tidepool.sources.tables import materialize, read_table

    path = str(tmp_path / "hours")
    materialize(X.pool_hourly(spark, sf_dir), path)
    made = pool_features(read_table(spark, path))
    made.write.format("noop").mode("overwrite").save()
    whole = pool_features(read_table(spark, path), chunk_seconds=None)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
