"""Column scaling against whole-column statistics, which enter as one scalar subquery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators.attach import attach


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0."""
    one = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])
    stats = F.col("_one")

    def scaled(c):
        spread = stats[f"s_{c}"]
        return ((F.col(c) - stats[f"m_{c}"]) / F.when(spread == 0, 1.0).otherwise(spread)).alias(c)

    return attach(df, one).select(*[scaled(c) if c in cols else F.col(c) for c in df.columns])


def min_max(
    df: DataFrame, cols: Sequence[str], lo: float = 0.0, hi: float = 1.0, default: float | None = None
) -> DataFrame:
    """Rescale to [lo, hi]; a constant column becomes ``default`` (missing unless given)."""
    one = df.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols])
    stats = F.col("_one")

    def scaled(c):
        low, high = stats[f"lo_{c}"], stats[f"hi_{c}"]
        share = F.when(high > low, (F.col(c) - low) / (high - low) * (hi - lo) + lo)
        if default is not None:
            share = F.when(high == low, F.lit(float(default))).otherwise(share)
        return share.alias(c)

    return attach(df, one).select(*[scaled(c) if c in cols else F.col(c) for c in df.columns])
