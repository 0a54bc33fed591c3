"""Day tables in versions: a reader sees one whole version, however a writer gets on or fails.

Days are written under new names and never changed. A version is a manifest, one small file that names the folder of
every day; publishing it is the only step a reader can notice. A job lost before that leaves folders that no
manifest names. There is one writer at a time; one that finds its version taken fails and can be run again.
Versions and folders are never deleted here; give them a lifetime rule.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidepool.session import materialized
from tidepool.sources.tables import exists, upsert


def newest_version(spark: SparkSession, path: str) -> int:
    """The last published version, 0 for none. Manifests are not opened: versions are folder names."""
    if not exists(spark, f"{path}/manifests"):
        return 0
    return spark.read.parquet(f"{path}/manifests").agg(F.max("version")).first()[0] or 0


def _manifest(spark: SparkSession, path: str, version: int) -> dict[str, str]:
    """Folder by day: as many entries as the table has days."""
    if version == 0:
        return {}
    found = spark.read.schema("day string, folder string").parquet(f"{path}/manifests/version={version}")
    return {r["day"]: r["folder"] for r in found.collect()}


def read_snapshot(
    spark: SparkSession, path: str, schema: StructType, day: str = "day", version: int | None = None,
    first: str | None = None, last: str | None = None,
) -> DataFrame:
    """One version of the table, the newest by default; only the days from ``first`` to ``last`` are listed and opened."""
    version = newest_version(spark, path) if version is None else version
    folders = {
        d: f for d, f in _manifest(spark, path, version).items() if (first is None or d >= first) and (last is None or d <= last)
    }
    return _days(spark, path, schema, day, folders)


def _days(spark: SparkSession, path: str, schema: StructType, day: str, folders: dict[str, str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    paths = [f"{path}/data/written={folder}/{day}={d}" for d, folder in sorted(folders.items())]
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*paths).select(*schema.names)


def upsert_snapshot(new: DataFrame, path: str, keys: Sequence[str], day: str = "day") -> int:
    """Publish a version in which the rows of ``new`` replace or join those of the same key; the version's number.

    ``new`` is unique per key and has its days as text (yyyy-MM-dd). Only touched days are read and written; an empty
    batch publishes nothing. Rows without a day are refused, since no day's folder could hold them.
    """
    spark = new.sparkSession
    version = newest_version(spark, path)
    folders = write_days(new, path, keys, version, day)
    return publish(spark, path, version, folders) if folders else version


def write_days(new: DataFrame, path: str, keys: Sequence[str], version: int, day: str = "day") -> dict[str, str]:
    """First step: the touched days, merged with those of ``version``, in a folder of their own that nobody reads yet."""
    spark = new.sparkSession
    batch = materialized(new, "snapshot-batch")
    days = [r[day] for r in batch.select(day).distinct().collect()]  # one value per touched day
    if None in days:
        raise ValueError("rows without a day can't be stored by day")
    if not days:
        return {}
    held = {d: f for d, f in _manifest(spark, path, version).items() if d in days}
    merged = upsert(_days(spark, path, new.schema, day, held), batch, keys) if held else batch
    folder = uuid.uuid4().hex
    merged.hint("rebalance", day).write.mode("errorifexists").partitionBy(day).parquet(f"{path}/data/written={folder}")
    return dict.fromkeys(days, folder)


def publish(spark: SparkSession, path: str, version: int, folders: dict[str, str]) -> int:
    """Second step: the next version, whose manifest takes the written days and all others as they were."""
    entries = sorted({**_manifest(spark, path, version), **folders}.items())
    manifest = spark.createDataFrame(entries, "day string, folder string").coalesce(1)
    manifest.write.mode("errorifexists").parquet(f"{path}/manifests/version={version + 1}")
    return version + 1
