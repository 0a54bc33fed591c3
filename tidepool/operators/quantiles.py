"""Exact quantiles by group that never gather a large group in one task.

Spark's ``percentile`` keeps every distinct value of a group in one aggregation
buffer. That is right for a group of bounded size, but one pool, or a whole column, can
be a third of all rows. So groups are counted first. Those up to ``DIRECT_LIMIT`` rows
use ``percentile``; in larger ones the order statistics are found by counting:

1. count values per (group, coarse logarithmic band); the counts are combined before
   the shuffle and each group has at most a few thousand bands;
2. running totals over the bands show which band holds each wanted rank;
3. a band of one value is the answer. One of up to ``most`` rows is counted value by value.
   Any other is split into ``PARTS`` equal parts between its least and largest value, and so on: a
   split always parts these two, so it goes on until every answer is found, however close the values lie.

Both ways weigh the two neighbouring values by the same formula, so the size of a group shows in no digit.
Ties and interpolation are exact on the real values. No window sees more than ``most`` rows.

Rows of a band that is split again are written once a level, one column wide; the input is read for
the groups' sizes, for the bands and for the rows in them. Store the result of an expensive plan before
asking for its quantiles. The keys of large groups and the picked bands are written as tables, and their real size decides
how they are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepool.session import materialized

# Bands per unit of ln(|value|): about 28 % wide.
RESOLUTION = 4
#: Parts of a band that is split.
PARTS = 1024
DIRECT_LIMIT = 1_000_000
_LOG_SPAN = 800  # |ln| of any finite double is below this


def log_band(value: Column, resolution: int) -> Column:
    """A whole number that never decreases as ``value`` grows."""
    magnitude = F.least(F.abs(value), F.lit(1.7e308))
    step = F.floor(F.log(magnitude) * resolution) + F.lit(_LOG_SPAN * resolution)
    return F.when(value > 0, step).when(value < 0, -step).otherwise(F.lit(0).cast("bigint"))


def value_band(value: Column) -> Column:
    """The coarse band of any double that is a number; the infinities have bands of their own."""
    far = F.lit(2 * _LOG_SPAN * RESOLUTION).cast("bigint")
    return F.when(value == float("inf"), far).when(value == float("-inf"), -far).otherwise(log_band(value, RESOLUTION))


def wanted_ranks(total: Column, qs: Sequence[float]) -> Column:
    """For each quantile the two neighbouring 0-based ranks and the place between them."""
    entries = []
    for i, q in enumerate(qs):
        at = F.lit(float(q)) * (total - 1)
        for side, rank in ((0, F.floor(at)), (1, F.ceil(at))):
            entries.append(F.struct(F.lit(i).alias("q"), F.lit(side).alias("side"), rank.cast("bigint").alias("rank"), at.alias("at")))
    return F.array(*entries)


def picked_ranks(wanted: Column, before: Column, count: Column) -> Column:
    """Those wanted ranks that fall in this band, counted from the band's start."""
    hit = F.filter(wanted, lambda t: (t["rank"] >= before) & (t["rank"] < before + count))
    return F.transform(hit, lambda t: F.struct(t["q"].alias("q"), t["side"].alias("side"), (t["rank"] - before).alias("rank"), t["at"].alias("at")))


def _between(low: Column, high: Column, at: Column) -> Column:
    """The formula of ``percentile``, with its order of operations."""
    return F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high)


def exact_quantiles(
    df: DataFrame,
    col: str | Column,
    qs: Sequence[float],
    by: Sequence[str] = (),
    direct_limit: int | None = DIRECT_LIMIT,
    most: int = DIRECT_LIMIT,
) -> DataFrame:
    """Linearly interpolated quantiles of the present values, one row per group and quantile.

    Columns: ``by``, ``q`` (position in ``qs``) and ``value``. Groups without any value are absent.
    ``direct_limit=None`` skips counting the groups. It is meant for callers whose key bounds
    a group, such as one row per pool and hour. Bands of more than ``most`` rows are split.
    """
    col = F.col(col) if isinstance(col, str) else col
    value = F.when(~F.isnan(col.cast("double")), col.cast("double"))
    names = [f"_by{i}" for i in range(len(by))]
    rows = df.select(*[F.col(b).alias(n) for b, n in zip(by, names)], value.alias("_v")).where("_v is not null")

    if direct_limit is None:
        found = _direct(rows, names, qs)
        return found.select(*[F.col(n).alias(b) for n, b in zip(names, by)], "q", "value")

    sizes = rows.groupBy(*names).agg(F.count("*").alias("_n"))
    large = materialized(sizes.where(F.col("_n") > direct_limit), "large-groups")
    if large.isEmpty():
        found = _direct(rows, names, qs)
    else:
        keys = large.select(*[F.col(n).alias(f"{n}_p") for n in names], F.lit(True).alias("_large"))
        same = [F.col(n).eqNullSafe(F.col(f"{n}_p")) for n in names]
        counted = _by_counting(rows.join(keys, same, "left_semi") if names else rows, names, qs, most)
        found = _direct(rows.join(keys, same, "left_anti"), names, qs).unionByName(counted) if names else counted
    return found.select(*[F.col(n).alias(b) for n, b in zip(names, by)], "q", "value")


def _direct(rows: DataFrame, names: list[str], qs: Sequence[float]) -> DataFrame:
    found = rows.groupBy(*names).agg(F.percentile("_v", [float(q) for q in qs]).alias("_values"))
    return found.select(*names, F.posexplode("_values").alias("q", "value"))


def _by_counting(rows: DataFrame, names: list[str], qs: Sequence[float], most: int) -> DataFrame:
    v, band = F.col("_v"), value_band(F.col("_v"))
    rows, group, wanted = rows.withColumn("_band", band), list(names), None
    answers = []
    while True:
        hist = rows.groupBy(*group, *([wanted] if wanted else []), "_band").agg(F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        order = Window.partitionBy(*group).orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("_before", F.coalesce(F.sum("_n").over(order), F.lit(0)))
        if wanted is None:
            hist = hist.withColumn("_wanted", wanted_ranks(F.sum("_n").over(Window.partitionBy(*group)), qs))
        picked = hist.withColumn("_wanted", picked_ranks(F.col("_wanted"), F.col("_before"), F.col("_n"))).where(F.size("_wanted") > 0)
        picked = materialized(picked.withColumn("_new", F.monotonically_increasing_id()), "bands")
        answers.append(picked.where(F.col("_low") == F.col("_high")).select(*names, F.explode("_wanted").alias("_t"), F.col("_low").alias("_v")))
        several = picked.where(F.col("_low") < F.col("_high"))
        if several.isEmpty():
            break
        held = _within(rows, several, [*group, "_band"], names)
        few = held.where(F.col("_size") <= most).groupBy(*names, "_id", "_wanted", "_v").agg(F.count("*").alias("_n"))
        order = Window.partitionBy("_id").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
        few = few.withColumn("_before", F.coalesce(F.sum("_n").over(order), F.lit(0)))
        few = few.withColumn("_wanted", picked_ranks(F.col("_wanted"), F.col("_before"), F.col("_n")))
        answers.append(few.select(*names, F.explode("_wanted").alias("_t"), "_v"))
        if several.where(F.col("_n") > most).isEmpty():
            break
        # the share of the way from the least to the largest value never falls as values grow
        share = (v - F.col("_low")) / (F.col("_high") - F.col("_low"))
        split = held.where(F.col("_size") > most).withColumn("_band", F.least(F.floor(share * PARTS), F.lit(PARTS - 1)))
        rows = materialized(split.select(*names, "_id", "_wanted", "_band", "_v"), "band-rows")
        group, wanted = [*names, "_id"], "_wanted"

    found = answers[0]
    for more in answers[1:]:
        found = found.unionByName(more)
    return answers_by_group(found, names)


def answers_by_group(found: DataFrame, names: Sequence[str]) -> DataFrame:
    """Quantiles from the values found at the wanted ranks (``_t``, ``_v``)."""
    side = lambda k: F.max(F.when(F.col("_t.side") == k, F.col("_v")))
    out = found.groupBy(*names, F.col("_t.q").alias("q")).agg(side(0).alias("_lo"), side(1).alias("_hi"), F.max("_t.at").alias("_at"))
    return out.select(*names, "q", _between(F.col("_lo"), F.col("_hi"), F.col("_at")).alias("value"))


def _within(rows: DataFrame, picked: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Rows in the picked bands, with the bands' bounds. A missing group key is a group like any other."""
    side = picked.select(*[F.col(k).alias(f"{k}_p") for k in keys], "_new", F.col("_wanted").alias("_left"), "_low", "_high", F.col("_n").alias("_size"))
    match = [F.col(k).eqNullSafe(F.col(f"{k}_p")) for k in keys]
    return rows.join(side, match).select(*names, "_v", F.col("_new").alias("_id"), F.col("_left").alias("_wanted"), "_low", "_high", "_size")


def quantile_row(
    df: DataFrame,
    col: str | Column,
    qs: dict[str, float],
    by: Sequence[str] = (),
    direct_limit: int | None = DIRECT_LIMIT,
) -> DataFrame:
    """Quantiles side by side: one row per group with the columns named in ``qs``."""
    found = exact_quantiles(df, col, list(qs.values()), by, direct_limit)
    wide = [F.max(F.when(F.col("q") == i, F.col("value"))).alias(n) for i, n in enumerate(qs)]
    return found.groupBy(*by).agg(*wide)


def approx_quantile(df: DataFrame, col: str, q: float, by: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """Sketch-based quantile: bounded state, and the answer is one of the values."""
    return df.groupBy(*by).agg(F.percentile_approx(col, q, accuracy).alias("value"))


# -- stored sketches -----------------------------------------------------------------

#: The size of a sketch. Its rank error is about 2.3 / k^0.9 of the rows, 1.3 % here.
SKETCH_K = 200


def daily_sketches(df: DataFrame, col: str, by: Sequence[str], ts: str = "hour_ts", k: int = SKETCH_K) -> DataFrame:
    """One sketch per group and day, to be stored: ``by``, ``day`` (yyyy-MM-dd), ``n`` and ``sketch``.

    A sketch is a few kilobytes whatever its rows, and is combined before the shuffle. Values that are missing or
    no number are left out, and days without any value are absent.
    """
    value = F.col(col).cast("double")
    rows = df.where(value.isNotNull() & ~F.isnan(value)).select(*by, F.date_format(ts, "yyyy-MM-dd").alias("day"), value.alias("_v"))
    return rows.groupBy(*by, "day").agg(F.count("*").alias("n"), F.kll_sketch_agg_double("_v", F.lit(k)).alias("sketch"))


def quantiles_from_sketches(sketches: DataFrame, qs: dict[str, float], by: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """Approximate quantiles over any days of stored sketches, one column per entry of ``qs``, beside ``n``.

    An answer is one of the values. It is exact, the discrete quantile, as long as a group has at most ``k`` rows.
    """
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("_all"))
    wide = [F.kll_sketch_get_quantile_double("_all", F.lit(float(q))).alias(name) for name, q in qs.items()]
    return merged.select(*by, "n", *wide)
