"""Spike labels against a per-pool quantile of volume."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.scalars import spike_flag
from tidepool.operators.quantiles import DIRECT_LIMIT, approx_quantile, exact_quantiles
from tidepool.session import materialized


def pool_quantile(
    df: DataFrame,
    q: float = 0.9,
    col: str = "volume_usd",
    by: Sequence[str] = ("pool_id",),
    approx: bool = False,
    unique_hours: bool = False,
) -> DataFrame:
    """``by`` and ``value``: the quantile of ``col`` in each group.

    ``unique_hours`` states that rows are unique per pool and hour. A pool then has at
    most 8 784 rows a year and its size need not be counted first.
    """
    if approx:
        return approx_quantile(df, col, q, by)
    return exact_quantiles(df, col, [q], by, None if unique_hours else DIRECT_LIMIT).drop("q")


def label_spikes(
    df: DataFrame,
    q: float = 0.9,
    col: str = "volume_usd",
    by: Sequence[str] = ("pool_id",),
    approx: bool = False,
    unique_hours: bool = False,
    history: DataFrame | None = None,
) -> DataFrame:
    """Add ``y`` = 1 where ``col`` reaches its pool's quantile over all history.

    The threshold looks at the whole series, later rows included: it is a label for
    judging a model, not a feature. A pool without any value gets 0. ``history`` is the
    frame the thresholds come from when it is not ``df`` itself.

    The thresholds, one row per pool, are written first. Their true size then decides the
    join: a small table is broadcast and the rows are not shuffled at all; a large one is
    merged, and adaptive execution splits a hot pool.
    """
    return label_by(df, pool_quantile(history if history is not None else df, q, col, by, approx, unique_hours), col, by)


def label_by(df: DataFrame, found: DataFrame, col: str = "volume_usd", by: Sequence[str] = ("pool_id",)) -> DataFrame:
    """``label_spikes`` with the thresholds at hand (``by`` and ``value``). Rows without a key are left out."""
    limits = materialized(found, "thresholds")
    side = limits.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(by)], F.col("value").alias("_limit"))
    same = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(by)]
    known = df.where(" and ".join(f"`{k}` is not null" for k in by))
    joined = known.join(side, same, "left")
    kept = [c for c in df.columns if c != "load_ts"]
    return joined.select(*kept, spike_flag(F.col(col), F.col("_limit")).alias("y"))
