"""Joins, as-of look-ups, set operations and calendars."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# -- joins and set operations --------------------------------------------------


def with_pool(clean: DataFrame, meta: DataFrame, key: str = "id") -> DataFrame:
    """Facts with their pool attributes; facts without a match keep missing attributes.

    No hint: the metadata has one row per pool-hour and grows with the facts, so the
    planner chooses by size, and adaptive execution splits a hot key.
    """
    return clean.join(meta, key, "left")


def union_protocols(parts: dict[str, DataFrame], tag: str = "dex") -> DataFrame:
    """All exchanges in one frame, matched by column name, each row tagged with its exchange."""
    tagged = [df.select(F.lit(name).alias(tag), *df.columns) for name, df in parts.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def minus(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``."""
    return a.subtract(b)


def only_top(df: DataFrame, top: DataFrame, key: str = "pool_address") -> DataFrame:
    """Rows whose key is among the k keys of ``top``; the planner broadcasts it if its size allows."""
    return df.join(top.select(key), key, "left_semi")


def as_of(df: DataFrame, t: Column, ts: str = "hour_ts", by: Sequence[str] = (), ties: Sequence[str] = ("pool_id",)):
    """The newest row at or before ``t``: one overall, or one per ``by``."""
    known = df.where(F.col(ts) <= t)
    if not by:
        return known.orderBy(F.desc(ts), *ties).limit(1)
    rest = [c for c in df.columns if c not in by]
    newest = known.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(ts)).alias("_row"))
    return newest.select(*[F.col(c) if c in by else F.col("_row")[c].alias(c) for c in df.columns])


# -- calendars -----------------------------------------------------------------


def day_axis(spark: SparkSession, start: date, end: date, name: str = "date") -> DataFrame:
    """One row per day, first and last day included."""
    days = (end - start).days + 1
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))


def hour_axis(spark: SparkSession, start: date, end: date) -> DataFrame:
    """``date`` and ``hour`` for every hour of every day."""
    return day_axis(spark, start, end).select("date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))


def missing_days(df: DataFrame, ts: str, start: date, end: date) -> DataFrame:
    """Calendar days without a single row."""
    present = df.select(F.to_date(ts).alias("date")).distinct()
    return day_axis(df.sparkSession, start, end).join(present, "date", "left_anti")


def missing_hours(df: DataFrame, ts: str, start: date, end: date) -> DataFrame:
    """Days that lack hours, with the hours they lack; ``complete`` when the whole day is absent."""
    present = df.select(F.to_date(ts).alias("date"), F.hour(ts).alias("hour")).distinct()
    gaps = hour_axis(df.sparkSession, start, end).join(present, ["date", "hour"], "left_anti")
    return _hour_lists(gaps, ["date"])


def missing_hours_by(df: DataFrame, ts: str, by: Sequence[str]) -> DataFrame:
    """The same for every series, between its own first and last day.

    Present hours are reduced to at most 24 per series and day before the lists are made;
    days without any hour come from the series' own day range.
    """
    present = df.select(*by, F.to_date(ts).alias("date"), F.hour(ts).alias("hour"))
    held = present.groupBy(*by, "date").agg(F.collect_set("hour").alias("_have"))
    days = held.groupBy(*by).agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    grid = days.select(*by, F.explode(F.sequence("_lo", "_hi")).alias("date"))
    lacking = F.array_except(
        F.sequence(F.lit(0), F.lit(23)), F.coalesce(F.col("_have"), F.array().cast("array<int>"))
    )
    listed = grid.join(held, [*by, "date"], "left").select(*by, "date", F.sort_array(lacking).alias("hours"))
    return listed.where(F.size("hours") > 0).withColumn("complete", F.size("hours") == 24)


def missing_spans(df: DataFrame, ts: str, by: Sequence[str], start: date, end: date) -> DataFrame:
    """Hours that a series lacks between its first and last one, as spans: ``first``, ``last`` and ``hours``.

    A gap is one row, however long it is. Only stamps from ``start`` to ``end`` (both days whole) count, so
    that a series has at most as many distinct hours as that range; ``outside_range`` reports the others.
    """
    inside = df.where(F.to_date(ts).between(F.lit(start), F.lit(end)))
    hours = inside.select(*by, F.date_trunc("hour", F.col(ts).cast("timestamp")).alias("_hour")).distinct()
    after = F.lead("_hour").over(Window.partitionBy(*by).orderBy("_hour"))
    lacking = ((F.unix_timestamp("_next") - F.unix_timestamp("_hour")) / 3600 - 1).cast("bigint")
    hour = F.expr("interval 1 hour")
    gaps = hours.withColumn("_next", after).withColumn("hours", lacking).where("hours > 0")
    return gaps.select(*by, (F.col("_hour") + hour).alias("first"), (F.col("_next") - hour).alias("last"), "hours")


def outside_range(df: DataFrame, ts: str, by: Sequence[str], start: date, end: date) -> DataFrame:
    """Series with stamps before ``start`` or after ``end``, or without one: ``rows`` of them, ``earliest`` and ``latest``."""
    inside = F.coalesce(F.to_date(ts).between(F.lit(start), F.lit(end)), F.lit(False))
    return df.where(~inside).groupBy(*by).agg(F.count("*").alias("rows"), F.min(ts).alias("earliest"), F.max(ts).alias("latest"))


#: Intervals of a series that are merged in one window.
MERGED_TOGETHER = 4096


def merge_intervals(df: DataFrame, by: Sequence[str], first: str, last: str, gap: Column, place: Column, sums: Sequence[str]) -> DataFrame:
    """Intervals of a series that lie at most ``gap`` apart as one, with ``sums`` added up.

    Two levels. Intervals, disjoint and in order of ``place``, a whole number, are merged within the (series, chunk of places)
    that they fall in. What lies between a chunk's first and last merged interval is done; only those two
    can reach into another chunk, and they alone are put in order along the series.
    """
    added = [F.min(first).alias(first), F.max(last).alias(last), *[F.sum(c).alias(c) for c in sums]]

    def merged(rows: DataFrame, keys: list[str]) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(first)
        opens = F.when(F.col(first) <= F.lag(last).over(order) + gap, 0).otherwise(1)
        numbered = rows.withColumn("_opens", opens).withColumn("_spell", F.sum("_opens").over(order))
        return numbered.groupBy(*keys, "_spell").agg(*added)

    within = [*by, "_chunk"]
    spells = merged(df.withColumn("_chunk", F.floor(place / MERGED_TOGETHER)), within)
    spells = spells.withColumn("_last", F.max("_spell").over(Window.partitionBy(*within)))
    inner = (F.col("_spell") > 1) & (F.col("_spell") < F.col("_last"))
    out = [*by, first, last, *sums]
    return spells.where(inner).select(*out).unionByName(merged(spells.where(~inner).select(*out), list(by)).select(*out))


def _hour_lists(gaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    lists = gaps.groupBy(*keys).agg(F.sort_array(F.collect_set("hour")).alias("hours"))
    return lists.withColumn("complete", F.size("hours") == 24)


def dense_counts(df: DataFrame, key: str, size: int) -> DataFrame:
    """Count per key on the full axis 0..size-1, zero where nothing was seen."""
    counts = df.groupBy(F.col(key).cast("bigint").alias("_key")).agg(F.count("*").alias("_n"))
    axis = df.sparkSession.range(size).withColumnRenamed("id", key)
    return axis.join(counts, F.col(key) == F.col("_key"), "left").select(
        F.col(key).cast("int").alias(key), F.coalesce("_n", F.lit(0)).alias("count")
    )


def daily_volume(df: DataFrame, ts: Column, cols: Sequence[str] = ("volume_usd",), by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.to_date(ts).alias("date")).agg(*[F.sum(c).alias(c) for c in cols])


def resample_daily(df: DataFrame, ts: Column, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Daily sums with every day between a series' first and last, 0 where nothing happened.

    Days are summed first; bounds and grid come from those sums, so a series costs as many
    rows as it has days.
    """
    daily = daily_volume(df, ts, cols, by)
    bounds = daily.groupBy(*by).agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    grid = bounds.select(*by, F.explode(F.sequence("_lo", "_hi")).alias("date"))
    filled = [F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in cols]
    return grid.join(daily, [*by, "date"], "left").select(*by, "date", *filled)
