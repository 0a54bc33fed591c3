"""Stored tables: create-or-replace, filtered reads, and upsert for plain parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidepool.session import new_folder


def materialize(df: DataFrame, target: str, partition_by: Sequence[str] = (), cluster: str | None = None) -> None:
    """Create or replace a table from a query. ``target`` is a path if it holds a slash, else a table name.

    Rows of one partition are brought together by a rebalance, which adaptive execution
    splits again where a partition is large. ``cluster`` sorts rows within files by that
    column, so min/max statistics let readers skip row groups.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if cluster:
        df = df.sortWithinPartitions(*partition_by, cluster)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)


def read_table(
    spark: SparkSession, source: str, predicate: Column | str | None = None, cols: Sequence[str] | None = None
) -> DataFrame:
    """A path, a table, or a query in parentheses, with the filter and columns pushed to the scan."""
    if source.lstrip().startswith("("):
        df = spark.sql(source.strip()[1:-1])
    else:
        df = spark.read.parquet(source) if "/" in source else spark.table(source)
    if predicate is not None:
        df = df.where(predicate)
    return df.select(*cols) if cols else df


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A query against an outside warehouse; pass partitionColumn and bounds for a parallel read."""
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**options).load()


def upsert(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``new`` replacing or joining those of the same key.

    ``new`` must be unique per key. It is the small side in an hourly run; the planner
    broadcasts it only if its size allows.
    """
    side = new.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    untouched = target.join(side, same, "left_anti")
    return untouched.unionByName(new.select(*target.columns))


def upsert_days(new: DataFrame, path: str, keys: Sequence[str], day: str = "day") -> None:
    """Upsert into a parquet table partitioned by ``day``, reading and writing only touched days.

    A first call writes its days alone. Later the merged days are first written to the shared folder, as plain
    rows, since only the target is read by day, then noted in a table of one row
    beside the target, and then swapped in by dynamic partition overwrite. A job lost before the
    note leaves the old days. One lost in the swap may leave days missing, which the next call or
    ``finish_upsert`` puts in place from the noted copy before anything is read. Keep
    the shared folder's tables at least until then.
    """
    spark = new.sparkSession
    finish_upsert(spark, path, new.schema, day)
    if not exists(spark, path):
        new.hint("rebalance", day).write.mode("append").partitionBy(day).parquet(path)
        return
    staged = new_folder(spark, "upsert")
    new.write.parquet(f"{staged}/new")
    batch = spark.read.schema(new.schema).parquet(f"{staged}/new")
    days = [r[day] for r in batch.select(day).distinct().collect()]  # one value per touched day
    if not days:
        return
    old = spark.read.schema(new.schema).parquet(path).where(F.col(day).isin(days))
    upsert(old.select(*new.columns), batch, keys).write.parquet(f"{staged}/merged")
    _note(spark, path, f"{staged}/merged")
    finish_upsert(spark, path, new.schema, day)


def finish_upsert(spark: SparkSession, path: str, schema: StructType, day: str = "day") -> None:
    """Swap in the merged days that an upsert noted and did not finish; nothing to do otherwise."""
    if not exists(spark, _notes(path)):
        return
    noted = spark.read.schema("merged string").parquet(_notes(path)).where("merged IS NOT NULL").first()
    if noted is None:
        return
    _swap(spark.read.schema(schema).parquet(noted["merged"]).select(*schema.names), path, day)
    _note(spark, path, None)


def _swap(merged: DataFrame, path: str, day: str) -> None:
    swap = merged.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    swap.partitionBy(day).parquet(path)


def _notes(path: str) -> str:
    return f"{path.rstrip('/')}__upsert"


def _note(spark: SparkSession, path: str, merged: str | None) -> None:
    """One row in one file, so the note is there whole or not at all."""
    spark.range(1).select(F.lit(merged).cast("string").alias("merged")).coalesce(1).write.mode("overwrite").parquet(_notes(path))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a parquet table has been written to ``path``."""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True
