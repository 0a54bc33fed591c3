"""The hourly work as Structured Streaming.

Streams run with ``availableNow`` by default: everything that has arrived is processed,
then the query stops, and the checkpoint remembers what was done.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from tidepool import schema as L
from tidepool.functions.moments import micros, moment
from tidepool.operators.combine import merge_intervals
from tidepool.operators.features import has_keys, pool_features
from tidepool.operators.forest import Forest, score
from tidepool.operators.frames import HOURLY_CHUNK, dedup_latest, time_chunk
from tidepool.plans.mart import day_between, preceding_rows, renamed_keys
from tidepool.session import materialized
from tidepool.sources.tables import exists, finish_upsert, upsert_days
from tidepool.streaming.keyed_state import PROVIDER


def ingest_stream(spark: SparkSession, folder: str, max_files: int = 10_000) -> DataFrame:
    """Lines of newly landed files with their file and load time; each file is read once."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(folder)
    return lines.select(
        "value", F.col("_metadata.file_name").alias("file_name"), F.current_timestamp().alias("load_ts")
    )


def table_stream(spark: SparkSession, folder: str, schema: StructType, max_files: int = 10_000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(folder)


def run_available(
    df: DataFrame, checkpoint: str, path: str | None = None, each: Callable[[DataFrame, int], None] | None = None,
    mode: str = "append",
) -> None:
    """Process all that has arrived into a parquet folder, or batch by batch into ``each``."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query: StreamingQuery = writer.foreachBatch(each).start() if each else writer.format("parquet").start(path)
    query.awaitTermination()


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str, delay: str = "2 hours") -> DataFrame:
    """Drop repeats that arrive within ``delay`` of the first copy, which is the one kept.

    Keeping the newest copy instead takes ``features_batch``, whose upsert replaces rows.
    """
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def rollup_stream(
    df: DataFrame, ts: str = "ts", pool: str = "pool_id", size: str = "1 hour", slide: str | None = None,
    delay: str = "1 hour", col: str = "volume_usd",
) -> DataFrame:
    """Windowed sums and means per pool; rows later than the watermark are dropped.

    A sliding window is a span of time, so it equals the row-based moving average only for
    pools without gaps. State is one running sum per open window and pool, held in RocksDB on disk: a first run over
    a long history has every window open at once.

    A row is in several windows, so rows are dealt out by pool and hour before the windows are made. The sums that a task
    begins are then its share of all, whatever the files' sizes.
    """
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    dealt = df.withWatermark(ts, delay).repartition(F.col(pool), F.date_trunc("hour", F.col(ts).cast("timestamp")))
    rolled = dealt.groupBy(window, pool).agg(
        F.sum(col).alias("sum"), F.count(col).alias("count"), F.avg(col).alias("mean")
    )
    return rolled.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), pool, "sum", "count", "mean")


def sessions(df: DataFrame, ts: str = "ts", pool: str = "pool_id", gap: str = "6 hours", delay: str = "1 hour") -> DataFrame:
    """Spells of activity per pool, closed by a gap. Works on batch frames and on streams.

    A batch never brings a pool's rows together: rows of one span of the gap's length are one interval
    (a combining aggregate), and the intervals are merged in two levels. Rows without a time are in no spell.
    """
    if not df.isStreaming:
        return _batch_sessions(df, ts, pool, gap)
    source = df.withWatermark(ts, delay)
    # Start and end are aggregates on purpose: a filter on the window column itself would be
    # pushed below the merging of sessions and cut sessions short.
    spells = source.groupBy(F.session_window(ts, gap), pool).agg(
        F.min(ts).alias("start"), (F.max(ts) + F.expr(f"interval {gap}")).alias("end"), F.count("*").alias("rows")
    )
    return spells.select(pool, "start", "end", "rows")


def features_batch(path: str, keys: Sequence[str] = ("dex", *L.POOL_HOUR_KEY)) -> Callable[[DataFrame, int], None]:
    """A batch handler that keeps a table of row-based features up to date at ``path``.

    Row windows do not exist on streams. Each batch is joined with the history its pools
    need, the plain feature function runs, and the changed days are upserted. A batch that
    is repeated after a failure gives the same table.

    ``keys`` name a row, without the hour a series. Rows that lack a part of the key have no place in
    a series and can't be told from each other: they go, all of them, to a table beside (``unkeyed``), by batch.

    With ``load_ts`` the newest copy of an hour stays, whatever batch brings it. Without it the
    later batch counts as newer, and the larger volume within a batch; a table holds batches of one kind.
    """
    base = ["dex", "pool_id", "hour_ts", "volume_usd", "tvl_usd", "liquidity"]

    series = [k for k in keys if k != "hour_ts"]

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        dated = "load_ts" in batch.columns
        cols = [*base, "load_ts"] if dated else base
        # stored first, because the batch is used several times below
        newest = "load_ts" if dated else "hour_ts"
        whole = has_keys(keys)
        batch.where(~whole).select(*cols).write.mode("overwrite").parquet(f"{unkeyed(path)}/batch={number}")
        fresh = materialized(dedup_latest(batch.where(whole), keys, newest, ["volume_usd", "tvl_usd"]).select(*cols), "batch")
        if not exists(spark, path):
            made = pool_features(fresh, series, chunk_seconds=_chunk(fresh))
        else:
            finish_upsert(spark, path, StructType([*pool_features(fresh, series).schema.fields, StructField("day", StringType())]))
            stored = spark.read.parquet(path)
            if ("load_ts" in stored.columns) != dated:
                raise ValueError(f"batches with and without load_ts can't share the table {path}")
            known = stored.select(*cols, "day")
            if dated:
                fresh = materialized(_not_older(fresh, known, keys), "batch")
            if fresh.isEmpty():
                return
            made = _with_history(fresh, known, series)
        upsert_days(made.withColumn("day", F.date_format("hour_ts", "yyyy-MM-dd")), path, keys)

    return handle


def _batch_sessions(df: DataFrame, ts: str, pool: str, gap: str) -> DataFrame:
    length = F.expr(f"unix_micros(timestamp_seconds(0) + interval {gap})")
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    spans = df.where(F.col(ts).isNotNull()).select(F.col(pool).alias("pool"), at.alias("at"), length.alias("gap"))
    spans = spans.withColumn("place", F.expr("(at - pmod(at, gap)) div gap"))
    found = spans.groupBy("pool", "place").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("rows"))
    merged = merge_intervals(found, ["pool"], "first", "last", length, F.col("place"), ["rows"])
    times = [F.timestamp_micros("first").alias("start"), (F.timestamp_micros("last") + F.expr(f"interval {gap}")).alias("end")]
    return merged.select(F.col("pool").alias(pool), *times, "rows")


def unkeyed(path: str) -> str:
    """Where ``features_batch`` puts rows that lack a part of their key."""
    return f"{path.rstrip('/')}__unkeyed"


def _not_older(fresh: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch of which no later load is stored; only the batch's days are read."""
    first, last = fresh.agg(micros(F.min("hour_ts")), micros(F.max("hour_ts"))).first()
    if first is None:
        return fresh
    held = day_between(known, "day", moment(first), moment(last))
    held = held.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("load_ts").alias("_stored"))
    same = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)]
    return fresh.join(held, [*same, F.col("_stored") > F.col("load_ts")], "left_anti")


def _with_history(fresh: DataFrame, known: DataFrame, series: Sequence[str]) -> DataFrame:
    """Features of the batch's rows and of the rows after them, given what is stored.

    A late or corrected hour changes the 24 rows that follow it, so every stored row from
    a pool's first touched hour on is computed again, behind the 24 rows before it. Where a row
    comes from says which stored rows are replaced and which rows only stand before, so neither takes a join.
    """
    since = materialized(fresh.groupBy(*series).agg(F.min("hour_ts").alias("since")), "since")
    before = materialized(preceding_rows(known, since, day="day", series=series), "before")
    first = since.agg(micros(F.min("since"))).first()[0]
    start, of_series = renamed_keys(since, series, F.col("since").alias("_since"))
    later = day_between(known, "day", moment(first), None).where(F.col("hour_ts") >= moment(first))
    after = later.join(start, of_series).where(F.col("hour_ts") >= F.col("_since"))
    chunk = _chunk(before, later, fresh)
    parts = [df.select(*fresh.columns, F.lit(n).alias("_from")) for n, df in enumerate((before, after, fresh))]
    rows = reduce(DataFrame.unionByName, parts)
    # the windows' own grouping, so that rows are dealt out and sorted once where there are no chunks
    within = [F.col(k) for k in series] + ([] if chunk is None else [time_chunk("hour_ts", chunk)])
    copies = Window.partitionBy(*within).orderBy("hour_ts").rangeBetween(Window.currentRow, Window.currentRow)
    rows = rows.withColumn("_newest", F.max("_from").over(copies)).where("_from <> 1 OR _newest = 1").drop("_newest")
    return pool_features(rows, series, chunk_seconds=chunk).where("_from > 0").drop("_from")


def _chunk(*parts: DataFrame) -> int | None:
    """Chunks for the windows over rows of one per series and hour; none if all lie within the length of one.

    A series then has no more rows than a chunk may have, and there are no seams to compute again.
    """
    hours = reduce(DataFrame.union, [df.select("hour_ts") for df in parts])
    first, last = hours.agg(micros(F.min("hour_ts")), micros(F.max("hour_ts"))).first()
    return None if first is None or last - first < HOURLY_CHUNK * 1_000_000 else HOURLY_CHUNK


def alert_batch(model: Forest, path: str, threshold: float = 0.6) -> Callable[[DataFrame, int], None]:
    """A batch handler that scores rows and stores the alerts of each batch under its own number."""

    def handle(batch: DataFrame, number: int) -> None:
        scored = score(batch, model).where(F.col("score") >= threshold)
        out = scored.select("pool_id", "hour_ts", "score")
        out.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return handle
