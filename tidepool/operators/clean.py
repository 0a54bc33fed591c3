"""Cleaning steps: typing, filters, cut-offs at quantiles, outlier flags."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions import scalars as S
from tidepool.functions.moments import moment
from tidepool.operators.attach import attach
from tidepool.operators.profile import pearson
from tidepool.operators.quantiles import approx_quantile, exact_quantiles, quantile_row


def to_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast the named columns to double; text that is no number, or says NaN, becomes missing."""
    return df.select(*[S.not_nan(F.col(c).try_cast("double")).alias(c) if c in cols else F.col(c) for c in df.columns])


def split_id(df: DataFrame, col: str = "id") -> DataFrame:
    return df.withColumns({"pool_address": S.id_address(F.col(col)), "block_index": S.id_index(F.col(col))})


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def feature_columns(df: DataFrame, drop: Sequence[str]) -> DataFrame:
    """Everything but the named columns, as double. Names that are absent are ignored."""
    kept = df.drop(*drop)
    return kept.select(*[F.col(c).cast("double").alias(c) for c in kept.columns])


def tag(df: DataFrame, dex: str, col: str = "dex") -> DataFrame:
    return df.select(F.lit(dex).alias(col), *[c for c in df.columns if c != col])


def has_pool(df: DataFrame, col: str = "pool") -> DataFrame:
    return df.where(F.col(col).isNotNull())


def negatives(df: DataFrame, col: str = "tvl_usd") -> DataFrame:
    return df.where(F.col(col) < 0)


def positive(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col) > 0)


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def null_negative(df: DataFrame, col: str = "tvl_usd") -> DataFrame:
    return df.withColumn(col, S.null_negative(F.col(col)))


def recent(df: DataFrame, days: int, as_of: datetime | Column, ts: str = "hour_ts") -> DataFrame:
    """Rows of the last ``days`` days. The bound is a literal, so it prunes partitions and row groups."""
    return df.where(F.col(ts) >= moment(as_of) - F.make_dt_interval(days=F.lit(days)))


def between_dates(df: DataFrame, ts: str, start: date, end: date) -> DataFrame:
    """Rows from the first to the last day, both included, as a range on the time itself."""
    first = F.lit(start).cast("timestamp")
    after = F.date_add(F.lit(end), 1).cast("timestamp")
    return df.where((F.col(ts) >= first) & (F.col(ts) < after))


def slice_interval(df: DataFrame, ts: str, end: Column | datetime, hours: int = 1) -> DataFrame:
    """Rows in [end - hours, end) in time order."""
    end = moment(end)
    start = end - F.make_dt_interval(hours=F.lit(hours))
    return df.where((F.col(ts) >= start) & (F.col(ts) < end)).orderBy(ts)


def newer_than(df: DataFrame, target: DataFrame, ts: str = "hour_ts") -> DataFrame:
    """Rows after the newest one in ``target``; all rows when the target is empty."""
    newest = target.agg(F.coalesce(F.max(ts), F.lit("1900-01-01").cast("timestamp"))).scalar()
    return df.where(F.col(ts) > newest)


def cut_above_quantile(df: DataFrame, col: str, q: float = 0.999, approx: bool = False) -> DataFrame:
    """Drop rows above a quantile of the whole column, and rows without a value."""
    if approx:
        limit = approx_quantile(df, col, q, []).select("value").scalar()
    else:
        limit = exact_quantiles(df, col, [q]).select("value").scalar()
    return df.where(F.col(col) <= limit)


def clip_quantiles(df: DataFrame, col: str, lo: float | None = 0.01, hi: float | None = 0.99) -> DataFrame:
    wanted = {n: q for n, q in (("lo", lo), ("hi", hi)) if q is not None}
    at = F.col("_one")
    clipped = S.clip(F.col(col), at["lo"] if lo is not None else None, at["hi"] if hi is not None else None)
    return attach(df, quantile_row(df, col, wanted)).withColumn(col, clipped).drop("_one")


def iqr_cap(df: DataFrame, col: str, k: float = 5.0) -> DataFrame:
    """Bound a column at its third quartile plus ``k`` interquartile ranges."""
    q = F.col("_one")
    capped = S.clip(F.col(col), hi=q["q3"] + k * (q["q3"] - q["q1"]))
    return attach(df, quantile_row(df, col, {"q1": 0.25, "q3": 0.75})).withColumn(col, capped).drop("_one")


def quantile_flag(df: DataFrame, col: str, lo: float, hi: float, flag: str = "is_outlier") -> DataFrame:
    """True outside the two quantiles; missing values are not flagged."""
    q = F.col("_one")
    outside = S.is_true((F.col(col) < q["lo"]) | (F.col(col) > q["hi"]))
    return attach(df, quantile_row(df, col, {"lo": lo, "hi": hi})).withColumn(flag, outside).drop("_one")


def scaling_check(df: DataFrame, col: str, factor: float) -> DataFrame:
    """Correlation of a column with its scaled self, which must stay 1."""
    return df.agg(pearson(F.col(col), S.scale_fixed_point(F.col(col), factor)).alias("corr"))
