"""Data-quality and distribution reports: counts, rates, describe, box plots, histograms, top-k.

Every report is one aggregate with map-side combining, or a top-k that keeps k rows per
input partition. Whole-column bounds enter as scalar subqueries, evaluated once.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions import scalars as S
from tidepool.operators.attach import attach
from tidepool.operators.quantiles import exact_quantiles, quantile_row
from tidepool.session import materialized

# -- counts and rates ----------------------------------------------------------


def summary(df: DataFrame, pool: str = "pool_address", pair: Sequence[str] = ("token0_symbol", "token1_symbol"),
            ts: str = "hour_ts") -> DataFrame:
    """Rows, distinct pools and token pairs, first and last time, share of missing and negative values."""
    return df.agg(
        F.count("*").alias("rows"),
        F.count_distinct(pool).alias("pools"),
        F.count_distinct(F.struct(*pair)).alias("pairs"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        _rate(F.col("tvl_usd").isNull()).alias("tvl_missing_rate"),
        _rate(F.col("tvl_usd") < 0).alias("tvl_negative_rate"),
    )


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def duplicate_count(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one in every column."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def _rate(pred: Column) -> Column:
    return F.avg(S.is_true(pred).cast("int"))


def rate(df: DataFrame, pred: Column, by: Sequence[str] = (), out: str = "rate") -> DataFrame:
    """Share of rows for which ``pred`` holds; missing counts as not holding."""
    return df.groupBy(*by).agg(_rate(pred).alias(out))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), col)


def hourly_pattern(df: DataFrame, hour: Column) -> DataFrame:
    return df.groupBy(hour.alias("hour")).agg(F.count("*").alias("count"))


def pair_counts(df: DataFrame, k: int = 15, pair: Sequence[str] = ("token0_symbol", "token1_symbol")) -> DataFrame:
    counts = df.where(S.all_of([F.col(c).isNotNull() for c in pair])).groupBy(*pair).agg(F.count("*").alias("count"))
    top = counts.orderBy(F.desc("count"), *pair).limit(k)
    return top.withColumn("pair_label", S.pair_label(*[F.col(c) for c in pair]))


def crosstab(df: DataFrame, category: str, pred: Column) -> DataFrame:
    """Rows per category for which ``pred`` holds (``neg``) and does not (``valid``)."""
    holds = S.is_true(pred)
    return (
        df.where(F.col(category).isNotNull())
        .groupBy(category)
        .agg(F.count_if(holds).alias("neg"), F.count_if(~holds).alias("valid"))
    )


def anomaly_counts(df: DataFrame, by: Sequence[str], flag: str = "is_anomaly", k: int = 10) -> DataFrame:
    """The k groups with most flagged rows; groups without any are left out."""
    present = df.where(S.all_of([F.col(c).isNotNull() for c in by]))
    counts = present.groupBy(*by).agg(F.count_if(F.col(flag)).alias("anomalies"))
    return counts.where("anomalies > 0").orderBy(F.desc("anomalies"), *by).limit(k)


# -- distributions -------------------------------------------------------------


def melt(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``column`` and ``value``, one row per cell."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*by, F.inline(cells))


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample deviation, min, quartiles (interpolated), max per column and group."""
    cells = melt(df, cols, by)
    keys = [*by, "column"]
    basic = cells.groupBy(*keys).agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = quantile_row(cells, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, keys)
    renamed = quartiles.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "p25", "p50", "p75")
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    out = basic.join(renamed, same, "left")
    return out.select(*keys, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def moments(df: DataFrame, col: str) -> DataFrame:
    """Mean, median, sample deviation, population skewness and excess kurtosis."""
    median = exact_quantiles(df, col, [0.5]).select("value").scalar()
    return df.agg(
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"),
        F.skewness(col).alias("skewness"),
        F.kurtosis(col).alias("kurtosis"),
    ).select("mean", median.alias("median"), "std", "skewness", "kurtosis")


def quantiles(df: DataFrame, col: str, qs: Sequence[float]) -> DataFrame:
    """``q`` and ``value`` for each wanted quantile of the whole column."""
    levels = F.array(*[F.lit(float(q)) for q in qs])
    return exact_quantiles(df, col, qs).select(F.get(levels, F.col("q")).alias("q"), "value")


def scale_sweep(df: DataFrame, cols: Sequence[str], factors: dict[str, float]) -> DataFrame:
    """``describe`` of each column divided by each factor.

    Every statistic scales with its column, so the data is described once and only the
    summary rows are repeated per factor.
    """
    names = F.array(*[F.struct(F.lit(n).alias("factor"), F.lit(float(f)).alias("_f")) for n, f in factors.items()])
    once = describe(df, cols)
    each = once.select("*", F.inline(names))
    scaled = [(F.col(c) / F.col("_f")).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")]
    return each.select("column", "factor", "count", *scaled)


def _bounds(df: DataFrame, col: str) -> DataFrame:
    same = F.col("lo") == F.col("hi")
    return df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).select(
        F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between the smallest and largest value, the last one closed; empty bins included."""
    edge, bounds = F.col("_one"), _bounds(df, col)
    width = (edge["hi"] - edge["lo"]) / bins
    at = F.least(F.floor((F.col(col) - edge["lo"]) / width), F.lit(bins - 1)).cast("bigint")
    counted = attach(df.where(F.col(col).isNotNull()), bounds).groupBy(at.alias("_bin")).agg(F.count("*").alias("_n"))
    axis = attach(df.sparkSession.range(bins).withColumnRenamed("id", "bin"), bounds)
    lo = edge["lo"] + F.col("bin") * width
    return axis.join(counted, F.col("bin") == F.col("_bin"), "left").select(
        "bin", lo.alias("lo"), (lo + width).alias("hi"), F.coalesce("_n", F.lit(0)).alias("count")
    )


def box_stats(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends (outermost values within k interquartile ranges) and outlier count."""
    quartiles = quantile_row(df, col, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    q, x = F.col("_one"), F.col(col)
    low = q["q1"] - k * (q["q3"] - q["q1"])
    high = q["q3"] + k * (q["q3"] - q["q1"])
    out = attach(df.select(col), quartiles).agg(
        F.count(x).alias("count"),
        F.min(F.when(x >= low, x)).alias("whisker_low"),
        F.max(F.when(x <= high, x)).alias("whisker_high"),
        F.count_if((x < low) | (x > high)).alias("outliers"),
    )
    return attach(out, quartiles).select(
        "count", "_one.q1", "_one.median", "_one.q3", "whisker_low", "whisker_high", "outliers"
    )


def kde(df: DataFrame, col: str, points: int = 64, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on an even grid.

    One aggregate holds one sum per grid point, so rows are read once and none are multiplied.
    """
    one = df.agg(F.count(col).alias("n"), F.stddev_samp(col).alias("s"), F.min(col).alias("lo"), F.max(col).alias("hi"))
    h = F.col("s") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    bounds = one.select("n", h.alias("h"), (F.col("lo") - cut * h).alias("lo"), (F.col("hi") + cut * h).alias("hi"))
    stats, x = F.col("_one"), F.col(col)
    step = (stats["hi"] - stats["lo"]) / (points - 1)
    grid = lambda i: stats["lo"] + i * step
    sums = attach(df.select(col), bounds).agg(
        *[F.sum(F.exp(-F.pow(F.try_divide(x - grid(i), stats["h"]), F.lit(2.0)) / 2)).alias(f"_{i}") for i in range(points)]
    )
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"_{i}").alias("sum")) for i in range(points)])
    root = (2 * 3.141592653589793) ** 0.5
    return attach(sums.select(F.inline(cells)), bounds).select(
        "i", grid(F.col("i")).alias("x"), F.try_divide("sum", stats["n"] * stats["h"] * root).alias("density")
    )


def pearson(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation as an aggregate; missing for a constant column, where ``corr`` raises."""
    return F.try_divide(F.regr_sxy(a, b), F.sqrt(F.regr_sxx(a, b)) * F.sqrt(F.regr_syy(a, b)))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every two columns over the rows that have both."""
    pairs = list(combinations_with_replacement(cols, 2))
    with_itself = lambda c: F.when(F.var_pop(c) > 0, 1.0)
    one = df.agg(*[(with_itself(a) if a == b else pearson(a, b)).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{i}").alias("corr"))
        for i, (x, y) in enumerate(pairs)
        for a, b in ({(x, y), (y, x)})
    ]
    return one.select(F.inline(F.array(*cells)))


# -- grouped reports -------------------------------------------------------------


def pool_quality(df: DataFrame, pool: str = "pool_address", col: str = "tvl_usd") -> DataFrame:
    """Per pool: known values, negative ones, their share of all rows, min, max, mean."""
    x = F.col(col)
    return df.groupBy(pool).agg(
        F.count(x).alias("count"),
        F.count_if(x < 0).alias("negative_count"),
        _rate(x < 0).alias("negative_share"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.avg(x).alias("mean"),
    )


def quality_split(stats: DataFrame) -> DataFrame:
    """How many pools have negative values, and what share of all pools."""
    return stats.agg(
        F.count("*").alias("pools"),
        F.count_if(F.col("negative_share") > 0).alias("negative_pools"),
        F.count_if(F.col("negative_share") == 0).alias("valid_pools"),
    ).select(
        "*",
        F.try_divide("negative_pools", "pools").alias("negative_pool_share"),
        F.try_divide("valid_pools", "pools").alias("valid_pool_share"),
    )


def rank_pools(stats: DataFrame, by: str, k: int, pool: str = "pool_address", ascending: bool = False) -> DataFrame:
    order = F.asc(by) if ascending else F.desc(by)
    return stats.orderBy(order, pool).limit(k)


def anomaly_rate(col: Column, k: float = 3.0) -> Column:
    """Share of rows further than ``k`` from zero; a missing value is not an anomaly."""
    return F.avg(F.when(F.abs(col) > k, 1).otherwise(0))


def fee_tier_stats(df: DataFrame, tier: str = "fee_tier") -> DataFrame:
    return (
        df.where(F.col(tier).isNotNull())
        .groupBy(tier)
        .agg(
            F.avg("volume_usd").alias("volume_usd_mean"),
            F.stddev_samp("volume_usd").alias("volume_usd_std"),
            F.max("volume_usd").alias("volume_usd_max"),
            F.avg("tvl_usd").alias("tvl_usd_mean"),
            F.stddev_samp("tvl_usd").alias("tvl_usd_std"),
            F.avg("tx_count").alias("tx_count_mean"),
            F.avg("volume_deviation").alias("volume_deviation_mean"),
            F.stddev_samp("volume_deviation").alias("volume_deviation_std"),
            anomaly_rate(F.col("volume_deviation")).alias("volume_deviation_anomaly_rate"),
        )
    )


def weekday_hour_profile(df: DataFrame, ts: Column, col: str = "volume_usd") -> DataFrame:
    """Mean value and count of negative value-locked rows by weekday (Monday is 0) and hour."""
    return df.groupBy(F.weekday(ts).alias("weekday"), F.hour(ts).alias("hour")).agg(
        F.avg(col).alias("mean"), F.count_if(F.col("tvl_usd") < 0).alias("negatives")
    )


# -- top-k and samples -----------------------------------------------------------


def top_pools(df: DataFrame, k: int = 5, pool: str = "pool_address", col: str = "volume_usd") -> DataFrame:
    totals = df.where(F.col(pool).isNotNull()).groupBy(pool).agg(F.sum(col).alias("total"))
    return totals.orderBy(F.desc_nulls_last("total"), pool).limit(k)


def top_by(df: DataFrame, score: str | Column, k: int, ties: Sequence[str]) -> DataFrame:
    score = F.col(score) if isinstance(score, str) else score
    return df.where(score.isNotNull()).orderBy(score.desc(), *ties).limit(k)


def top_anomalies(df: DataFrame, k: int = 5, ties: Sequence[str] = ("pool_address", "hour_ts")) -> DataFrame:
    """Rows with the largest |deviation| x volume/value ratio."""
    return top_by(df, F.abs("volume_deviation") * F.col("volume_tvl_ratio"), k, ties)


def clip_for_ranking(df: DataFrame) -> DataFrame:
    """Bound the two ranking columns at their outer percentiles before ranking.

    The three bounds are computed at once and stored, as a ranking refers to them many times.
    """
    wanted = ["volume_tvl_ratio", "volume_deviation"]
    found = exact_quantiles(melt(df, wanted), "value", [0.01, 0.99], ["column"])
    at = lambda c, q: F.max(F.when((F.col("column") == c) & (F.col("q") == q), F.col("value")))
    bounds = found.agg(
        at(wanted[0], 1).alias("ratio_hi"), at(wanted[1], 0).alias("deviation_lo"), at(wanted[1], 1).alias("deviation_hi")
    )
    one = F.col("_one")
    clipped = {
        "volume_tvl_ratio": S.clip(F.col("volume_tvl_ratio"), hi=one["ratio_hi"]),
        "volume_deviation": S.clip(F.col("volume_deviation"), lo=one["deviation_lo"], hi=one["deviation_hi"]),
    }
    return attach(df, materialized(bounds, "bounds")).select(*[clipped[c].alias(c) if c in clipped else F.col(c) for c in df.columns])


def top_pools_of_rows(df: DataFrame, score: Column, k: int, pool: str = "pool_address") -> DataFrame:
    """The first k different pools when rows are read from the highest score down."""
    best = df.where(score.isNotNull()).groupBy(pool).agg(F.max(score).alias("best"))
    return best.orderBy(F.desc("best"), pool).limit(k)


def latest_row(df: DataFrame, ts: str = "hour_ts", ties: Sequence[str] = ("pool_id",)) -> DataFrame:
    return df.orderBy(F.desc(ts), *ties).limit(1)


def sample_n(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), the same ones on every run."""
    return df.orderBy(F.xxhash64(*key, F.lit(seed)), *key).limit(n)
