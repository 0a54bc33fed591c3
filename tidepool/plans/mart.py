"""The hourly chain from landed records to labelled features, whole or incremental."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool import schema as L
from tidepool.functions.moments import micros, moment
from tidepool.operators import ledger
from tidepool.operators.clean import newer_than, recent
from tidepool.operators.combine import as_of, union_protocols, with_pool
from tidepool.operators.features import LAG_ROWS, has_keys, series_features
from tidepool.operators.forest import Forest, fit_forest, load_model, save_model, score
from tidepool.operators.frames import dedup_latest, last_rows
from tidepool.operators.labels import label_by, label_spikes
from tidepool.session import materialized
from tidepool.sources.records import clean_hourly, pool_metadata, stage_pool_hourly

FEATURE_INPUT = ["dex", "pool_id", "hour_ts", "tvl_usd", "volume_usd", "liquidity", "load_ts"]


def run_stages(
    raw: dict[str, DataFrame], q: float = 0.9, dedup: bool = True, col: str = "raw", keys: Sequence[str] = ("dex", *L.POOL_HOUR_KEY)
) -> dict[str, DataFrame]:
    """Landed records by exchange -> staging, features and labelled features, in that order.

    Repeated loads of an exchange's pool-hour are reduced to the newest before any row-based
    window, because a repeated hour would shift every lag after it. ``keys`` names what makes a
    row; among copies loaded together all further columns decide, so the choice is the same
    however the rows are dealt out. ``keys`` without the hour are a series: windows and thresholds keep to it.
    Rows that lack a key can't be copies of each other: all stay, without windows and without a
    label, ``unkeyed`` lists them and ``violations`` counts them on the staged rows, before any is merged. Staged
    rows and features are written once, as they are read several times. Lines that were no JSON are left out; keep them with
    ``split_bad_records`` when landing.
    """
    # Parsed once, read for the counts, the merging and the rows without a key. Lines that were no JSON are left out
    # behind the write: a filter before it would parse every line a second time.
    marked = {n: df.withColumn("_json", F.col(col).isNotNull()) for n, df in raw.items()}
    staged = union_protocols({n: stage_pool_hourly(df, col, ["load_ts", "_json"]) for n, df in marked.items()})
    staged = materialized(staged, "staged").where("_json").drop("_json")
    violations = expect_not_null(staged, [k for k in keys if k != "dex"])
    whole = has_keys(keys)
    unkeyed = staged.where(~whole)
    if dedup:
        first = ["volume_usd", "tvl_usd"]
        ties = first + sorted(c for c in staged.columns if c not in (*keys, "load_ts", *first))
        staged = dedup_latest(staged.where(whole), keys, "load_ts", ties).unionByName(staged.where(~whole))
    series = [k for k in keys if k != "hour_ts"]
    features = materialized(series_features(staged.select(*FEATURE_INPUT), series), "features")
    labelled = label_spikes(features, q, by=series, unique_hours=dedup)
    return {"staging": staged, "features": features, "labelled": labelled, "violations": violations, "unkeyed": unkeyed}


def build_wide(records: DataFrame, keep: Sequence[str] = ("protocol", "load_ts")) -> dict[str, DataFrame]:
    """Parsed records -> ``clean``, ``metadata`` and ``wide``, the table that exploration starts from.

    Of repeated loads of a record (``id`` and ``periodStartUnix``) the newest stays; among copies loaded
    together the other fields decide. ``clean`` is typed, ``metadata`` has the distinct pool attributes of a
    record id, and ``wide`` joins both by id. A record without an id or hour can't be told from others: all of them stay in
    ``clean`` and, without an id, get no attributes. An id with several attribute sets has a row for each, as the metadata has.
    The merged records are written once, since all three tables come from them.
    """
    key = ["id", "periodStartUnix"]
    flat = records.select(*key, *[c for c in records.columns if c not in key])
    whole = has_keys(key)
    ties = ["volumeUSD", "tvlUSD"]
    ties += sorted(c for c in flat.columns if c not in (*key, "load_ts", *ties))
    kept = dedup_latest(flat.where(whole), key, "load_ts", ties).unionByName(flat.where(~whole))
    kept = materialized(kept, "merged-records")
    clean, meta = clean_hourly(kept, keep), pool_metadata(kept)
    return {"clean": clean, "metadata": meta, "wide": with_pool(clean, meta)}


def preceding_rows(
    known: DataFrame, since: DataFrame, rows: int = LAG_ROWS, recent_days: int = 7, day: str | None = None,
    series: Sequence[str] = tuple(L.SERIES_KEY),
) -> DataFrame:
    """The last ``rows`` stored rows of each series before its ``since`` (the columns of ``series``, and since).

    Most pools have them within the last days, which a literal time bound reads alone. Only
    if some pool has fewer there is the older history read, and then for those pools.
    ``day`` names a partition column with the hours' days (yyyy-MM-dd), so that only these are opened.
    """
    first = since.agg(micros(F.min("since"))).first()[0]
    if first is None:
        return known.limit(0)
    edge = moment(first) - F.make_dt_interval(days=F.lit(recent_days))
    start, same = renamed_keys(since, series, F.col("since").alias("_since"))

    def before(part: DataFrame, starts: DataFrame) -> DataFrame:
        mine = part.join(starts, same).where(F.col("hour_ts") < F.col("_since"))
        return last_rows(mine.select(*known.columns), series, "hour_ts", rows)

    opened = day_between(known, day, edge, None)
    near = materialized(before(opened.where(F.col("hour_ts") >= edge), start), "recent-rows")
    full = near.groupBy(*series).agg(F.count("*").alias("_n")).where(F.col("_n") >= rows)
    short = materialized(start.join(full, same, "left_anti"), "short-series")
    if short.isEmpty():
        return near
    far = before(day_between(known, day, None, edge).where(F.col("hour_ts") < edge), short)
    return last_rows(near.unionByName(far), series, "hour_ts", rows)


def renamed_keys(df: DataFrame, keys: Sequence[str], *more: Column) -> tuple[DataFrame, list[Column]]:
    """The keys of ``df`` under names of their own, beside ``more``, and the conditions that they equal a row's keys."""
    side = df.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *more)
    return side, [F.col(k) == F.col(f"_key_{k}") for k in keys]


def day_between(df: DataFrame, day: str | None, first: Column | None, last: Column | None) -> DataFrame:
    """Rows of the day partitions from that of ``first`` to that of ``last``; all without a partition column."""
    for bound, after in ((first, True), (last, False)):
        if day is not None and bound is not None:
            edge, at = F.date_format(bound, "yyyy-MM-dd"), F.col(day).cast("string")
            df = df.where(at >= edge if after else at <= edge)
    return df


def incremental_features(
    source: DataFrame, target: DataFrame, recent_days: int = 7, reprocess_from: Column | datetime | None = None,
    series: Sequence[str] = tuple(L.SERIES_KEY), day: str | None = None,
) -> DataFrame:
    """Features of hours newer than the target's newest, equal to those of a full rebuild.

    The newest hour is read first, so the new rows come from a scan with a literal bound.
    Row windows also need the 24 rows before a pool's first new one, however old they are;
    the filter on time comes after the windows. ``day`` names a partition column of the source with the
    hours' days, so that only the days needed are opened. Late hours at or before the newest are left out and
    listed by ``late_hours``, unless ``reprocess_from`` names the hour to start again from.
    """
    newest = target.agg(micros(F.max("hour_ts"))).first()[0]
    if newest is None:
        return series_features(source, series)
    new = F.col("hour_ts") > moment(newest) if reprocess_from is None else F.col("hour_ts") >= moment(reprocess_from)
    start = moment(newest) if reprocess_from is None else moment(reprocess_from)
    fresh = day_between(source, day, start, None).where(new)
    since = fresh.groupBy(*series).agg(F.min("hour_ts").alias("since"))
    before = preceding_rows(source, since, LAG_ROWS, recent_days, day, series)
    return series_features(before.unionByName(fresh), series).where(new)


def late_hours(source: DataFrame, target: DataFrame, series: Sequence[str] = tuple(L.SERIES_KEY)) -> DataFrame:
    """Rows of ``source`` that ``incremental_features`` leaves out: at or before the target's newest hour, but not in it."""
    newest = target.agg(micros(F.max("hour_ts"))).first()[0]
    if newest is None:
        return source.limit(0)
    return _not_in(source.where(F.col("hour_ts") <= moment(newest)), target, series)


def _not_in(rows: DataFrame, known: DataFrame, series: Sequence[str]) -> DataFrame:
    """Rows whose series and hour ``known`` has not."""
    keys = [*series, "hour_ts"]
    have, _ = renamed_keys(known, keys)
    return rows.join(have, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys], "left_anti")


def features_from_tails(
    fresh: DataFrame, tails: DataFrame, reprocess_from: Column | datetime | None = None, history: DataFrame | None = None,
    series: Sequence[str] = tuple(L.SERIES_KEY),
) -> tuple[DataFrame, DataFrame]:
    """Features of an hourly batch from a small state table, and that table's next content.

    ``tails`` holds the last 24 rows of every series. An hourly run then reads that and the
    batch, never the history. Rows without a key enter no tail. Hours a pool already has or has passed are left out, as in
    the other incremental forms; ``late_for_tails`` lists those it has passed. With ``reprocess_from`` the hours from there on
    are computed again: ``fresh`` holds all of them, and ``history`` the rows before, from which the tails are taken anew.
    """
    cols = tails.columns
    if reprocess_from is not None:
        if history is None:
            raise ValueError("reprocess_from needs the history: tails hold the last rows of a pool only")
        start = moment(reprocess_from)
        tails = last_rows(history.where(has_keys(series) & (F.col("hour_ts") < start)).select(*cols), series, "hour_ts", LAG_ROWS)
        fresh = fresh.where(F.col("hour_ts") >= start)
    ahead = _with_newest(fresh, tails, series).where(F.col("_newest").isNull() | (F.col("hour_ts") > F.col("_newest")))
    rows = tails.withColumn("_fresh", F.lit(False)).unionByName(ahead.select(*cols, F.lit(True).alias("_fresh")))
    features = series_features(rows, series).where("_fresh").drop("_fresh")
    return features, last_rows(rows.where(has_keys(series)).drop("_fresh"), series, "hour_ts", LAG_ROWS)


def late_for_tails(fresh: DataFrame, tails: DataFrame, series: Sequence[str] = tuple(L.SERIES_KEY)) -> DataFrame:
    """Rows of a batch that ``features_from_tails`` leaves out, but for hours that the tails hold."""
    passed = _with_newest(fresh, tails, series).where(F.col("hour_ts") <= F.col("_newest"))
    return _not_in(passed.select(*fresh.columns), tails, series)


def _with_newest(fresh: DataFrame, tails: DataFrame, series: Sequence[str]) -> DataFrame:
    newest = tails.groupBy(*series).agg(F.max("hour_ts").alias("_newest"))
    side, same = renamed_keys(newest, series, F.col("_newest"))
    return fresh.join(side, same, "left").drop(*[f"_key_{k}" for k in series])


def incremental_label(
    source: DataFrame, target: DataFrame, q: float = 0.9, reprocess_from: Column | datetime | None = None,
    unique_hours: bool = False, series: Sequence[str] = tuple(L.SERIES_KEY),
) -> DataFrame:
    """Labels for hours newer than the target's newest; thresholds come from all history.

    Labels that were written stay as they were. Late hours at or before the newest are
    left out, unless ``reprocess_from`` names the hour to start again from. ``unique_hours``
    states that ``source`` has one row per pool and hour, which saves counting the pools' sizes.
    """
    if reprocess_from is None:
        fresh = newer_than(source, target)
    else:
        fresh = source.where(F.col("hour_ts") >= moment(reprocess_from))
    return label_spikes(fresh, q, by=series, history=source, unique_hours=unique_hours)


def label_from_ledger(
    fresh: DataFrame, path: str, batch: int, q: float = 0.9, col: str = "volume_usd",
    series: Sequence[str] = tuple(L.SERIES_KEY), withdrawn: DataFrame | None = None,
) -> DataFrame:
    """Labels of a batch against all history, which is not read: its order statistics lie in the ledger at ``path``.

    The batch enters the ledger first, under its number, so its own values count. ``withdrawn`` holds rows
    as they were added before, which the batch corrects. Equal to ``incremental_label`` at every step.
    """
    ledger.append_rows(fresh, path, batch, col, series, withdrawn)
    limits = ledger.quantiles(fresh.sparkSession, path, [q], series, of=fresh).drop("q")
    return label_by(fresh, limits, col, series)


def expect_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column`` and ``violations``, one row per checked column, all in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in cols]))
    )


def is_fresh(df: DataFrame, hour: Column | datetime) -> DataFrame:
    """Whether the table has reached an hour, with the newest hour it has."""
    newest = df.agg(F.max("hour_ts").alias("newest"))
    return newest.select("newest", F.coalesce(F.col("newest") >= moment(hour), F.lit(False)).alias("fresh"))


def training_rows(labelled: DataFrame, as_of_ts: Column | datetime, days: int = 30) -> DataFrame:
    return recent(labelled, days, as_of_ts)


def train_and_register(
    labelled: DataFrame, path: str, version: int, as_of_ts: Column | datetime, days: int = 30,
    features: Sequence[str] = tuple(L.MART_FEATURES), alias: str = "production", trees: int = 200, seed: int = 42,
) -> Forest:
    """Fit on the last ``days``, log the mean score of those rows, store a version and point the alias to it."""
    rows = materialized(training_rows(labelled, as_of_ts, days), "training")
    model = fit_forest(rows, features, trees=trees, seed=seed)
    model = replace(model, nodes=materialized(model.nodes, "nodes"))
    mean = score(rows, model).agg(F.avg("score").alias("mean")).first()["mean"]
    save_model(model, path, version, alias, {} if mean is None else {"mean_anomaly_score": mean})
    return model


def score_from_alias(df: DataFrame, path: str, alias: str = "production", threshold: float | None = None) -> DataFrame:
    """Rows scored by the version that the alias points to."""
    return score_batch(df, load_model(df.sparkSession, path, alias), threshold)


def alerts(df: DataFrame, model: Forest, threshold: float = 0.6, at: Column | None = None) -> DataFrame:
    """Newest row of every pool, scored: ``pool_id``, ``hour_ts``, ``score``, ``is_anomaly``.

    Only one row per pool reaches the model. Scores lie in (0, 1], so a threshold above 1
    would never fire.
    """
    t = at if at is not None else F.lit("9999-12-31").cast("timestamp")
    newest = as_of(df.select("pool_id", "hour_ts", *model.features), t, by=["pool_id"])
    scored = score(newest, model)
    hit = F.coalesce(F.col("score") >= threshold, F.lit(False))
    return scored.select("pool_id", "hour_ts", "score", hit.alias("is_anomaly"))


def newest_rows(known: DataFrame, fresh: DataFrame, by: Sequence[str] = ("pool_id",)) -> DataFrame:
    """The newest row of every series, from the rows kept so far and a batch of features.

    Kept as a table of one row a series, it is all that ``alerts`` has to read: an hourly run never
    opens the history. Among rows of one hour that of the batch stays. Rows without a key are left out.
    """
    cols = known.columns
    rows = known.withColumn("_later", F.lit(0)).unionByName(fresh.select(*cols).withColumn("_later", F.lit(1)))
    rest = [c for c in cols if c not in by]
    whole = rows.where(" and ".join(f"`{k}` is not null" for k in by))
    newest = whole.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct("hour_ts", "_later")).alias("_row"))
    return newest.select(*[F.col(c) if c in by else F.col("_row")[c].alias(c) for c in cols])


def score_batch(df: DataFrame, model: Forest, threshold: float | None = None) -> DataFrame:
    """Score any rows that carry the features, whatever the case of their column names."""
    lowered = df.toDF(*[c.lower() for c in df.columns])
    cut = model.threshold if threshold is None else threshold
    scored = score(lowered, model)
    return scored.withColumn("is_anomaly", F.coalesce(F.col("score") >= cut, F.lit(False)))
