"""Feature sets of the mart and of the exploration model."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool import schema as L
from tidepool.functions import scalars as S
from tidepool.operators.frames import (
    HOURLY_CHUNK,
    lagged,
    moving_avg,
    rolling_mean,
    rolling_std,
    row_frames,
)

LAG_ROWS = 24


def change_rate(
    df: DataFrame,
    col: str,
    out: str,
    rows: int = LAG_ROWS,
    keys: Sequence[str] = ("pool_id",),
    order: str = "hour_ts",
    by_time: bool = False,
    chunk_seconds: int | None = HOURLY_CHUNK,
) -> DataFrame:
    """Change against the value ``rows`` rows earlier (zero on either side gives NULL).

    ``by_time`` compares with the value exactly ``rows`` hours earlier instead, which
    differs where a series has gaps. It is an equality join on key and hour, so it
    spreads over hours and needs no ordering at all.
    """
    if by_time:
        shifted = df.select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            (F.col(order) + F.make_interval(hours=F.lit(rows))).alias("_at"),
            F.col(col).alias("_before"),
        )
        same = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)] + [F.col(order) == F.col("_at")]
        framed = df.join(shifted, same, "left").select(*df.columns, "_before")
    else:
        framed = row_frames(df, keys, order, {"_before": lagged(col, rows)}, rows, chunk_seconds)
    return framed.withColumn(out, S.change_vs(F.col(col), F.col("_before"))).drop("_before")


def pct_change(
    df: DataFrame,
    col: str,
    out: str,
    keys: Sequence[str] = ("pool_address",),
    order: str = "hour_ts",
    chunk_seconds: int | None = HOURLY_CHUNK,
) -> DataFrame:
    """Change against the previous row in time order; a zero before gives NULL."""
    framed = row_frames(df, keys, order, {"_before": lagged(col, 1)}, 1, chunk_seconds)
    return framed.withColumn(out, F.try_divide(F.col(col), F.col("_before")) - 1).drop("_before")


def pool_features(
    df: DataFrame,
    keys: Sequence[str] = ("pool_id",),
    order: str = "hour_ts",
    chunk_seconds: int | None = HOURLY_CHUNK,
) -> DataFrame:
    """Change rates over 24 rows, moving averages over 6 and 24 rows, volume per value locked.

    All frames share one shuffle and one sort. Rows must be unique per key and hour.
    """
    framed = row_frames(
        df,
        keys,
        order,
        {
            "_volume_before": lagged("volume_usd", LAG_ROWS),
            "_tvl_before": lagged("tvl_usd", LAG_ROWS),
            "vol_ma_6h": moving_avg("volume_usd", 6),
            "vol_ma_24h": moving_avg("volume_usd", 24),
        },
        LAG_ROWS,
        chunk_seconds,
    )
    made = framed.select(
        "*",
        S.change_vs(F.col("volume_usd"), F.col("_volume_before")).alias("vol_rate_24h"),
        S.change_vs(F.col("tvl_usd"), F.col("_tvl_before")).alias("tvl_rate_24h"),
        S.ratio_or_null(F.col("volume_usd"), F.col("tvl_usd")).alias("vol_tvl_ratio"),
    )
    new = ["vol_rate_24h", "tvl_rate_24h", "vol_ma_6h", "vol_ma_24h", "vol_tvl_ratio"]
    carried = [c for c in df.columns if c != "load_ts"]
    tail = ["load_ts"] if "load_ts" in df.columns else []
    return made.select(*carried, *new, *tail)


def has_keys(keys: Sequence[str]) -> Column:
    """Whether a row belongs to a series: no part of its key is missing."""
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def series_features(
    df: DataFrame, keys: Sequence[str] = tuple(L.SERIES_KEY), order: str = "hour_ts", chunk_seconds: int | None = HOURLY_CHUNK
) -> DataFrame:
    """``pool_features`` of every series; all rows stay.

    A row that lacks a part of its key, or its hour, has no known rows before it: it stays out of the windows
    and its change rates and averages are missing.
    """
    whole = has_keys([*keys, order])
    made = pool_features(df.where(whole), keys, order, chunk_seconds)
    ratio = S.ratio_or_null(F.col("volume_usd"), F.col("tvl_usd"))
    lone = df.where(~whole).withColumn("vol_tvl_ratio", ratio)
    absent = [f for f in made.schema.fields if f.name not in lone.columns]
    return made.unionByName(lone.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent]))


def time_features(
    df: DataFrame,
    keys: Sequence[str] = ("pool_address",),
    order: str = "hour_ts",
    rows: int = 24,
    chunk_seconds: int | None = HOURLY_CHUNK,
) -> DataFrame:
    """Rolling mean and deviation, with no value until ``rows`` values are there, and ratios."""
    framed = row_frames(
        df,
        keys,
        order,
        {
            "volume_ma24": rolling_mean("volume_usd", rows),
            "volume_volatility": rolling_std("volume_usd", rows),
        },
        rows,
        chunk_seconds,
    )
    return framed.select(
        "*",
        (S.ratio_eps(F.col("volume_usd"), F.col("volume_ma24")) - 1).alias("volume_deviation"),
        S.ratio_eps(F.col("volume_usd"), F.col("tvl_usd")).alias("volume_tvl_ratio"),
        S.price_change(F.col("close_price"), F.col("open_price")).alias("price_change"),
    )
