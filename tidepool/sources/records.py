"""Landing and typing of pool-hour records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool import schema as L
from tidepool.functions.moments import moment
from tidepool.functions.scalars import not_nan
from tidepool.functions.json_fields import epoch_to_ts
from tidepool.functions.scalars import hour_key

# -- JSONL files -----------------------------------------------------------------


def read_pool_jsonl(spark: SparkSession, folder: str, protocols: Sequence[str]) -> DataFrame:
    """All ``<folder>/<protocol>/*_pool.jsonl`` files as records, tagged with their protocol.

    One reader over all globs with the record layout given, so there is no inference pass
    and only the fields in use are parsed.
    """
    globs = [f"{folder}/{p}/*_pool.jsonl*" for p in protocols]
    read = spark.read.schema(L.RECORD).json(globs)
    return read.select("*", _folder_name().alias("protocol"))


def _folder_name() -> Column:
    """The folder above the landed file. A landed "file" may itself be a folder of part files."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]*_pool\.jsonl", 1)


def read_lines(spark: SparkSession, globs: str | Sequence[str]) -> DataFrame:
    """``value`` (one line of a file) and ``protocol`` (its folder)."""
    paths = [globs] if isinstance(globs, str) else list(globs)
    return spark.read.text(paths).select("value", _folder_name().alias("protocol"))


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON record per line; missing folders are created."""
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def land_raw(lines: DataFrame, now: Column | datetime | None = None, text: str = "value") -> DataFrame:
    """``raw`` (VARIANT) and ``load_ts`` for every line; other columns are kept."""
    stamp = F.current_timestamp() if now is None else moment(now)
    rest = [c for c in lines.columns if c != text]
    return lines.select(F.try_parse_json(text).alias("raw"), *rest, stamp.alias("load_ts"))


def split_bad_records(lines: DataFrame, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """Lines that are JSON, and lines that are not. Nothing is lost: the second side is a table too."""
    good = F.try_parse_json(text).isNotNull()
    return lines.where(good), lines.where(~good)


def parse_maybe_json(df: DataFrame, col: str) -> DataFrame:
    """Turn a column of bytes or text into VARIANT; one that is parsed already stays as it is."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.BinaryType):
        parsed = F.try_parse_json(F.decode(F.col(col), "UTF-8"))
    elif isinstance(kind, T.StringType):
        parsed = F.try_parse_json(F.col(col))
    else:
        return df
    return df.select(*[parsed.alias(c) if c == col else F.col(c) for c in df.columns])


def as_records(lines: DataFrame, text: str = "value") -> DataFrame:
    """Parse text lines once into the record layout; a line that is no JSON gives all-missing fields."""
    rest = [c for c in lines.columns if c != text]
    return lines.select(F.from_json(text, L.RECORD).alias("_r"), *rest).select("_r.*", *rest)


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested fields as ``outer_inner`` columns. Works on the schema alone; no data is read."""

    def leaves(kind: T.StructType, path: tuple[str, ...]):
        for f in kind.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, here)
            else:
                yield here

    cols = [F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)) for path in leaves(df.schema, ())]
    return df.select(*cols)


# -- typed tables ------------------------------------------------------------------


def stage_pool_hourly(raw: DataFrame, col: str = "raw", keep: Sequence[str] = ("load_ts",)) -> DataFrame:
    """Eleven typed fields of each record. Text is parsed once per row, a VARIANT's fields are read in one go."""
    kind = raw.schema[col].dataType
    read = F.try_variant_get(col, "$", L.STAGED_RECORD) if isinstance(kind, T.VariantType) else F.from_json(col, L.RECORD)
    parsed = raw.select(read.alias("r"), *keep)
    return parsed.select(
        epoch_to_ts(F.col("r.periodStartUnix")).alias("hour_ts"),
        *[F.col(f"r.{p}").alias(n) for n, p in L.STAGED.items()],
        *[not_nan(F.col(f"r.{p}").try_cast("double")).alias(n) for n, p in L.STAGED_MEASURES.items()],
        *keep,
    )


def clean_hourly(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Record fields renamed and typed; ``hour_ts`` stays epoch seconds."""
    return records.select(
        F.col("periodStartUnix").try_cast("bigint").alias("hour_ts"),
        F.col("id").cast("string").alias("id"),
        *[not_nan(F.col(p).try_cast("double")).alias(n) for n, p in L.CLEAN_DOUBLES.items()],
        F.col("txCount").try_cast("bigint").alias("tx_count"),
        *keep,
    )


def pool_metadata(records: DataFrame) -> DataFrame:
    """Distinct pool attributes per record id, of records that have a pool.

    Whether a pool is there is an aggregate, not a filter: a filter would be moved below the parsing of the
    records, which would then be made and parsed twice.
    """
    attributes = [F.col(p).alias(n) for n, p in L.METADATA.items()]
    rows = records.select("id", *attributes, F.col("pool").isNotNull().alias("_pool"))
    return rows.groupBy("id", *L.METADATA).agg(F.max("_pool").alias("_pool")).where("_pool").drop("_pool")


# -- landed files --------------------------------------------------------------------


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``name`` and ``path`` of the files in a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path")


def latest_file_per_hour(files: DataFrame, name: str = "name") -> DataFrame:
    """For each hour keep the last file name and mark the others for the archive.

    Adds ``hour_key`` and ``action``. The last name per hour is an aggregate that is
    combined before its shuffle, so an hour with very many files costs no more than others.
    """
    landed = files.where(F.col(name).endswith("_pool.jsonl")).withColumn("hour_key", hour_key(F.col(name)))
    landed = landed.where("hour_key is not null")
    last = landed.groupBy(F.col("hour_key").alias("_hour")).agg(F.max(name).alias("_last"))
    both = landed.join(last, F.col("hour_key") == F.col("_hour"))
    action = F.when(F.col(name) == F.col("_last"), "keep").otherwise("archive")
    return both.withColumn("action", action).drop("_hour", "_last")
