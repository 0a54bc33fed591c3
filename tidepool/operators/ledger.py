"""Exact quantiles of growing series from order statistics that are kept, without reading their history.

A ledger has two tables, both appended batch by batch. ``counts`` says how many values of a series lie in each
logarithmic band; ``values`` holds the values of a series and band with their counts, sorted by band.
An answer takes the running totals of the counts; of the values only the bands that hold an answer are opened, which
Parquet's statistics and the sort keep to few row groups. Equal, bit by bit, to ``exact_quantiles`` over all rows
ever added: the same ranks and the same formula.

The last step orders one band of one series at a time. A series with one row an hour, as here, has few; for
groups of any size use ``exact_quantiles``. ``compact`` folds the batches into one when they become many.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepool.operators.quantiles import answers_by_group, picked_ranks, value_band, wanted_ranks
from tidepool.session import materialized
from tidepool.sources.tables import exists


def append_rows(rows: DataFrame, path: str, batch: int, col: str, by: Sequence[str], withdrawn: DataFrame | None = None) -> None:
    """Add the present values of ``rows`` and take back those of ``withdrawn``, earlier rows that were corrected.

    A batch that is repeated under its number replaces what it wrote before. The counts are written
    last and make the batch known, so one that was lost half-way is not read. Rows without a key or a
    value count nowhere.
    """
    entries = _entries(rows, col, by, 1)
    if withdrawn is not None:
        entries = entries.unionByName(_entries(withdrawn, col, by, -1))
    _write(entries.groupBy(*by, "band", "value").agg(F.sum("n").alias("n")), path, batch, by)


def _entries(rows: DataFrame, col: str, by: Sequence[str], sign: int) -> DataFrame:
    # adding zero makes one value of -0.0 and 0.0, which Spark groups together anyway
    value = F.col(col).cast("double") + F.lit(0.0)
    known = rows.where(" and ".join(f"`{k}` is not null" for k in by)) if by else rows
    values = known.select(*by, value.alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value"))
    return values.select(*by, value_band(F.col("value")).alias("band"), "value", F.lit(sign).cast("bigint").alias("n"))


def _write(entries: DataFrame, path: str, batch: int, by: Sequence[str]) -> None:
    values = f"{path}/values/batch={batch}"
    entries.where("n <> 0").sortWithinPartitions("band").write.mode("overwrite").parquet(values)
    counts = entries.sparkSession.read.schema(entries.schema).parquet(values).groupBy(*by, "band")
    counts = counts.agg(F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    counts.write.mode("overwrite").parquet(f"{path}/counts/batch={batch}")


def _known_batches(spark: SparkSession, path: str) -> list[int]:
    if not exists(spark, f"{path}/counts"):
        return []
    return [r["batch"] for r in spark.read.parquet(f"{path}/counts").select("batch").distinct().collect()]


def quantiles(spark: SparkSession, path: str, qs: Sequence[float], by: Sequence[str], of: DataFrame | None = None) -> DataFrame:
    """``by``, ``q`` (position in ``qs``) and ``value`` over all rows added, for the series in ``of`` or for all.

    Series without a value are absent, so a ledger without any gives no rows if ``of`` says what series look like.
    """
    by, batches = list(by), _known_batches(spark, path)
    if not batches and of is None:
        raise LookupError(f"no value has been added to the ledger {path}")
    if not batches:
        return of.select(*by, F.lit(0).alias("q"), F.lit(None).cast("double").alias("value")).limit(0)
    counts = spark.read.parquet(*[f"{path}/counts/batch={b}" for b in batches])
    if of is not None and by:
        counts = counts.join(of.select(*by).distinct(), by, "left_semi")
    held = counts.groupBy(*by, "band").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    picked = _picked(held.where("n > 0"), by, "band", wanted_ranks(F.sum("n").over(Window.partitionBy(*by)), qs))
    picked = materialized(picked, "ledger-bands")
    single = picked.where("low = high").select(*by, F.explode("wanted").alias("_t"), F.col("low").alias("_v"))
    several = picked.where("low < high").select(*by, "band", "wanted")
    bands = [r["band"] for r in several.select("band").distinct().collect()]  # of a few thousand there are
    values = spark.read.parquet(*[f"{path}/values/batch={b}" for b in batches]).where(F.col("band").isin(bands))
    opened = values.join(several, [*by, "band"]).groupBy(*by, "band", "wanted", "value").agg(F.sum("n").alias("n"))
    found = _picked(opened.where("n > 0"), [*by, "band"], "value", F.col("wanted"))
    found = found.select(*by, F.explode("wanted").alias("_t"), F.col("value").alias("_v"))
    return answers_by_group(single.unionByName(found), by)


def _picked(rows: DataFrame, group: Sequence[str], order: str, wanted: Column) -> DataFrame:
    """The rows of a count table that hold a wanted rank, with those ranks counted from the row's start."""
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("wanted", wanted)
    placed = placed.withColumn("wanted", picked_ranks(F.col("wanted"), F.col("before"), F.col("n")))
    return placed.where(F.size("wanted") > 0).drop("before")


def compact(spark: SparkSession, path: str, target: str, by: Sequence[str]) -> None:
    """A ledger at ``target`` with one batch, numbered as the last of ``path``, that holds the same values."""
    batches = _known_batches(spark, path)
    values = spark.read.parquet(*[f"{path}/values/batch={b}" for b in batches])
    _write(values.groupBy(*by, "band", "value").agg(F.sum("n").alias("n")), target, max(batches), by)
