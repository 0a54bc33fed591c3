"""Isolation Forest: fitting, scoring, alerts, storage, evaluation (ids J3-J11).

Forest scores depend on random splits and have no SQL twin; tests check their properties.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidepool import fixtures as X
from tidepool.catalog.registry import LABELLED, epoch, epochs, query, r, rs
from tidepool.catalog.windows import explored
from tidepool.functions import scalars as S
from tidepool.functions.moments import moment
from tidepool.operators import forest as M
from tidepool.operators.attach import attach
from tidepool.operators.features import pool_features
from tidepool.operators.labels import label_spikes
from tidepool.plans import mart
from tidepool.schema import EXPLORATION_FEATURES, MART_FEATURES
from tidepool.session import materialized, new_folder
from tidepool.streaming import jobs as ST


def labelled(spark, sf):
    features = materialized(pool_features(X.pool_hourly(spark, sf)), "features")
    return label_spikes(features, unique_hours=True)


def _fitted(rows):
    return M.fit_forest(mart.training_rows(rows, datetime(2024, 1, 31)), MART_FEATURES)


@query("j3_fit_forest")
def j3(spark, sf):
    return _fitted(labelled(spark, sf)).nodes


@query("j4_score")
def j4(spark, sf):
    rows = materialized(labelled(spark, sf), "labelled")
    return M.score(rows, _fitted(rows)).select("pool_id", "hour_ts", "y", "score")


@query("j4_mean_score")
def j4_mean(spark, sf):
    return j4(spark, sf).agg(F.avg("score").alias("mean_anomaly_score"))


def _flagged(spark, sf):
    hour = explored(spark, sf)
    return M.flag(materialized(hour, "explored"), EXPLORATION_FEATURES, ["id"], 0.01)


@query("j5_flag_contamination")
def j5(spark, sf):
    return _flagged(spark, sf).select("id", "score", "label", "is_anomaly")


@query("j6_alerts")
def j6(spark, sf):
    rows = materialized(labelled(spark, sf), "labelled")
    return mart.alerts(rows, _fitted(rows), 0.6)


@query("j7_score_batch")
def j7(spark, sf):
    rows = materialized(labelled(spark, sf), "labelled")
    posted = rows.toDF(*[c.upper() for c in rows.columns])
    return mart.score_batch(posted, _fitted(rows)).select("pool_id", "hour_ts", "score", "is_anomaly")


@query("j8_save_and_load_model")
def j8(spark, sf):
    path = new_folder(spark, "models")
    M.save_model(_fitted(labelled(spark, sf)), path, 1, "production")
    return M.load_model(spark, path, "production").nodes


# a deterministic stand-in for the score, so that the ranking figures have a twin
_SCORED = f"WITH {LABELLED}, scored AS (SELECT *, volume_usd / nullif(tvl_usd, 0) AS score FROM labelled)"


def _scored(spark, sf):
    return labelled(spark, sf).withColumn("score", S.ratio_or_null(F.col("volume_usd"), F.col("tvl_usd")))


@query("j9_precision_recall_at_10", f"""{_SCORED}, top AS (SELECT hour_ts, sum(y) AS hits, count(*) AS picked FROM (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY hour_ts ORDER BY score DESC NULLS LAST, pool_id) <= 10) GROUP BY 1), tot AS (
  SELECT hour_ts, sum(y) AS positives FROM scored GROUP BY 1)
SELECT {epochs('hour_ts')} AS hour_epoch, CAST(picked AS BIGINT) AS picked, CAST(hits AS BIGINT) AS hits, CAST(positives AS BIGINT) AS positives,
       {rs('hits / picked')} AS precision_at_k, {rs('hits / nullif(positives, 0)')} AS recall_at_k FROM tot JOIN top USING (hour_ts)""")
def j9(spark, sf):
    df = M.at_k(_scored(spark, sf), 10)
    return df.select(epoch("hour_ts").alias("hour_epoch"), "picked", "hits", "positives",
                     r("precision_at_k").alias("precision_at_k"), r("recall_at_k").alias("recall_at_k"))


@query("j9_pr_auc", f"""{_SCORED}, pts AS (SELECT score, sum(y) AS pos, count(*) AS n FROM scored WHERE score IS NOT NULL GROUP BY 1), curve AS (
  SELECT pos, sum(pos) OVER w AS tp, sum(n) OVER w AS seen FROM pts WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
SELECT {rs('sum(pos * tp / seen) / sum(pos)')} AS pr_auc FROM curve""")
def j9_auc(spark, sf):
    return M.pr_auc(_scored(spark, sf)).select(r("pr_auc").alias("pr_auc"))


@query("j10_anomaly_table")
def j10(spark, sf):
    found = _flagged(spark, sf).where("is_anomaly")
    return found.select("id", S.short_label(F.col("pool_address")).alias("pool_short"), "hour_ts", "volume_usd", "score")


@query("j11_top_scored")
def j11(spark, sf):
    rows = materialized(labelled(spark, sf), "labelled")
    scored = M.score(rows, _fitted(rows))
    return M.top_scored(scored, 20, 0.5, ["pool_id", "hour_ts"]).select("pool_id", "hour_ts", "score")


@query("j10_anomaly_table_by_ratio", f"""{_SCORED} SELECT pool_id, {epochs('hour_ts')} AS hour_epoch,
  CASE WHEN score > 0.5 THEN -1 ELSE 1 END AS label FROM scored""")
def j10_ratio(spark, sf):
    """Labels from the stand-in score."""
    found = M.with_label(_scored(spark, sf).withColumn("is_anomaly", F.col("score") > 0.5))
    return found.select("pool_id", epoch("hour_ts").alias("hour_epoch"), "label")


@query("j11_top_scored_by_ratio", f"""{_SCORED} SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, {rs('score')} AS score
FROM (SELECT * FROM scored WHERE score >= 0.5 ORDER BY score DESC, pool_id, hour_ts LIMIT 20)""")
def j11_ratio(spark, sf):
    top = M.top_scored(_scored(spark, sf), 20, 0.5, ["pool_id", "hour_ts"])
    return top.select("pool_id", epoch("hour_ts").alias("hour_epoch"), r("score").alias("score"))


@query("j8_train_and_register", f"""WITH {LABELLED} SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, true AS same FROM labelled""")
def j8_register(spark, sf):
    """Two versions trained and registered; rows scored by the alias agree with the newer model, whose mean score is logged."""
    rows = materialized(labelled(spark, sf), "labelled")
    path = new_folder(spark, "models")
    mart.train_and_register(rows, path, 1, datetime(2024, 1, 20), trees=5, seed=1)
    model = mart.train_and_register(rows, path, 2, datetime(2024, 1, 31), trees=20)
    want = M.score(rows, model).select(F.col("pool_id").alias("p"), F.col("hour_ts").alias("h"), F.col("score").alias("s"))
    both = mart.score_from_alias(rows, path).join(want, (F.col("pool_id") == F.col("p")) & (F.col("hour_ts") == F.col("h")))
    mean = spark.read.parquet(f"{path}/version=2/metrics").where("name = 'mean_anomaly_score'").agg(F.max("value")).scalar()
    agrees = F.col("score").eqNullSafe(F.col("s")) & mean.between(0, 1)
    return both.select("pool_id", epoch("hour_ts").alias("hour_epoch"), agrees.alias("same"))


# -- what can be said about the forest in SQL -------------------------------------------

_COMPLETE = ("vol_rate_24h IS NOT NULL AND tvl_rate_24h IS NOT NULL AND vol_ma_24h IS NOT NULL "
             "AND vol_tvl_ratio IS NOT NULL")


@query("j3_forest_shape", f"""WITH {LABELLED}, n AS (SELECT count(*) AS n FROM labelled WHERE {_COMPLETE}
  AND hour_ts >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAY)
SELECT CAST(tree AS INTEGER) AS tree, CAST(least(n, 256) AS INTEGER) AS root_size, CAST(least(n, 256) AS BIGINT) AS leaf_rows,
       true AS balanced FROM n, range(200) t(tree)""")
def j3_shape(spark, sf):
    """Every tree starts from its full sample, loses no row on the way, and splits in two."""
    nodes = j3(spark, sf)
    leaf = F.col("feature") < 0
    return nodes.groupBy("tree").agg(
        F.max(F.when(F.col("node") == 0, F.col("size"))).alias("root_size"),
        F.sum(F.when(leaf, F.col("size")).otherwise(0)).alias("leaf_rows"),
        (F.count_if(leaf) == F.count_if(~leaf) + 1).alias("balanced"),
    )


@query("j4_score_domain", f"""WITH {LABELLED}
SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, {_COMPLETE} AS scored, {_COMPLETE} AS in_range FROM labelled""")
def j4_domain(spark, sf):
    """Complete rows, and only they, get a score, and it lies in (0, 1]."""
    df = j4(spark, sf)
    inside = F.coalesce((F.col("score") > 0) & (F.col("score") <= 1), F.lit(False))
    return df.select("pool_id", epoch("hour_ts").alias("hour_epoch"), F.col("score").isNotNull().alias("scored"),
                     inside.alias("in_range"))


@query("j6_alert_rows", f"""WITH {LABELLED} SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, {_COMPLETE} AS scored
FROM labelled QUALIFY row_number() OVER (PARTITION BY pool_id ORDER BY hour_ts DESC) = 1""")
def j6_rows(spark, sf):
    """Alerts look at the newest row of every pool."""
    df = j6(spark, sf)
    return df.select("pool_id", epoch("hour_ts").alias("hour_epoch"), F.col("score").isNotNull().alias("scored"))


@query("j7_batch_equals_score", f"""WITH {LABELLED} SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, true AS same FROM labelled""")
def j7_same(spark, sf):
    """Rows posted with upper-case names get the score the table scoring gives them."""
    rows = materialized(labelled(spark, sf), "labelled")
    model = _fitted(rows)
    posted = mart.score_batch(rows.toDF(*[c.upper() for c in rows.columns]), model)
    again = M.score(rows, model).select(F.col("pool_id").alias("p"), F.col("hour_ts").alias("h"), F.col("score").alias("s"))
    both = posted.join(again, (F.col("pool_id") == F.col("p")) & (F.col("hour_ts") == F.col("h")))
    return both.select("pool_id", epoch("hour_ts").alias("hour_epoch"), F.col("score").eqNullSafe(F.col("s")).alias("same"))


@query("j8_loaded_equals_saved", f"""WITH {LABELLED} SELECT CAST(tree AS INTEGER) AS tree, CAST(0 AS BIGINT) AS differing
FROM range(200) t(tree), (SELECT count(*) AS n FROM labelled WHERE {_COMPLETE}) WHERE n > 0""")
def j8_same(spark, sf):
    """Saving two versions and loading by alias gives back the newer one, node by node."""
    rows = materialized(labelled(spark, sf), "labelled")
    path = new_folder(spark, "models")
    M.save_model(M.fit_forest(rows, MART_FEATURES, trees=5, seed=1), path, 1, "production")
    model = _fitted(rows)
    M.save_model(model, path, 2, "production")
    loaded = M.load_model(spark, path).nodes
    gone = model.nodes.exceptAll(loaded).select("tree").unionByName(loaded.exceptAll(model.nodes).select("tree"))
    counts = gone.groupBy(F.col("tree").alias("_t")).agg(F.count("*").alias("_n"))
    trees = model.nodes.select("tree").distinct()
    return trees.join(counts, F.col("tree") == F.col("_t"), "left").select("tree", F.coalesce("_n", F.lit(0)).alias("differing"))


# -- scores walked in SQL ---------------------------------------------------------------

_TREES = 12
_INNER = 7  # nodes above the leaves of a tree of depth 3


def _data_forest(rows, sizes):
    """A forest that SQL can build as well: splits at fixed places between each feature's least and largest value."""
    whole = rows.dropna(subset=MART_FEATURES)
    bounds = whole.agg(F.array(*[F.min(c) for c in MART_FEATURES]).alias("lo"), F.array(*[F.max(c) for c in MART_FEATURES]).alias("hi"))
    ids = rows.sparkSession.range(_TREES * (2 * _INNER + 1))
    tree, node = F.floor(F.col("id") / (2 * _INNER + 1)).cast("int"), (F.col("id") % (2 * _INNER + 1)).cast("int")
    grid = attach(ids.select(tree.alias("tree"), node.alias("node")), bounds)
    inner = F.col("node") < _INNER
    place = (F.col("tree") * 3 + F.col("node") * 5) % len(MART_FEATURES)
    k = ((F.col("tree") * 7 + F.col("node") * 5) % 13 + 1).cast("double")
    lo, hi = F.col("_one.lo")[place], F.col("_one.hi")[place]
    nodes = grid.select(
        "tree", "node", F.when(inner, place).otherwise(-1).cast("int").alias("feature"),
        F.when(inner, lo + (hi - lo) * (k * k * k / 2744.0)).alias("split"),
        F.when(inner, F.col("node") * 2 + 1).alias("left"), F.when(inner, F.col("node") * 2 + 2).alias("right"),
        ((F.col("tree") * 5 + F.col("node") * 4) % sizes).cast("int").alias("size"),
        F.when(F.col("node") == 0, 0).when(F.col("node") < 3, 1).when(inner, 2).otherwise(3).alias("depth"),
    )
    return M.Forest(materialized(nodes, "nodes"), tuple(MART_FEATURES))


def _walked(sizes):
    """The same forest and, by a recursive walk, the score of every complete row."""
    f = len(MART_FEATURES)
    norm = f"(2.0::DOUBLE * (ln(255.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 2.0::DOUBLE * 255.0::DOUBLE / 256.0::DOUBLE)"
    beyond = ("CASE WHEN size <= 1 THEN 0.0::DOUBLE WHEN size = 2 THEN 1.0::DOUBLE ELSE "
              "2.0::DOUBLE * (ln(size - 1.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 2.0::DOUBLE * (size - 1.0::DOUBLE) / size END")
    low = ", ".join(f"min({c})" for c in MART_FEATURES)
    high = ", ".join(f"max({c})" for c in MART_FEATURES)
    return f"""WITH RECURSIVE {LABELLED}, complete AS (SELECT pool_id, hour_ts, y, [{", ".join(MART_FEATURES)}] AS x FROM labelled
  WHERE {_COMPLETE}), bounds AS (SELECT [{low}] AS lo, [{high}] AS hi FROM labelled WHERE {_COMPLETE}), places AS (
  SELECT tree, node, (tree * 3 + node * 5) % {f} + 1 AS place, CAST((tree * 7 + node * 5) % 13 + 1 AS DOUBLE) AS k,
         (tree * 5 + node * 4) % {sizes} AS size FROM range({_TREES}) t(tree), range({2 * _INNER + 1}) n(node)), nodes AS (
  SELECT tree, node, place, lo[place] + (hi[place] - lo[place]) * (k * k * k / 2744.0::DOUBLE) AS split, size FROM places, bounds), walk AS (
  SELECT pool_id, hour_ts, x, tree, CAST(0 AS BIGINT) AS node, 0 AS depth FROM complete, range({_TREES}) t(tree)
  UNION ALL SELECT w.pool_id, w.hour_ts, w.x, w.tree, CASE WHEN w.x[n.place] > n.split THEN 2 * w.node + 2 ELSE 2 * w.node + 1 END, w.depth + 1
  FROM walk w JOIN nodes n ON w.tree = n.tree AND w.node = n.node WHERE w.node < {_INNER}), scored AS (
  SELECT pool_id, hour_ts, pow(2.0::DOUBLE, -(sum(depth + {beyond}) / {_TREES}.0::DOUBLE) / {norm}) AS score
  FROM walk JOIN nodes USING (tree, node) WHERE node >= {_INNER} GROUP BY 1, 2)"""


@query("j4_score_walked", f"""{_walked(17)} SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, {rs('score', 9)} AS score
FROM labelled LEFT JOIN scored USING (pool_id, hour_ts)""")
def j4_walked(spark, sf):
    """Scores of a forest whose nodes come from the data by rule, against a walk of the same nodes."""
    rows = materialized(labelled(spark, sf), "labelled")
    scored = M.score(rows, _data_forest(rows, 17))
    return scored.select("pool_id", epoch("hour_ts").alias("hour_epoch"), r("score", 9).alias("score"))


@query("j4_mean_score_walked", f"{_walked(17)} SELECT {rs('avg(score)', 9)} AS mean_anomaly_score FROM scored")
def j4_mean_walked(spark, sf):
    rows = materialized(labelled(spark, sf), "labelled")
    return M.score(rows, _data_forest(rows, 17)).agg(r(F.avg("score"), 9).alias("mean_anomaly_score"))


# leaves of up to two rows: sums of paths are whole numbers, so equal scores are equal in both engines
_EVEN = _walked(3)


@query("j5_flag_walked", f"""{_EVEN} SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, {rs('score', 9)} AS score,
  CASE WHEN score > cut THEN -1 ELSE 1 END AS label, score > cut AS is_anomaly
FROM scored, (SELECT quantile_cont(score, 0.95) AS cut FROM scored)""")
def j5_walked(spark, sf):
    rows = materialized(labelled(spark, sf), "labelled")
    found = M.flag_by(rows, _data_forest(rows, 3), 0.05)
    return found.select("pool_id", epoch("hour_ts").alias("hour_epoch"), r("score", 9).alias("score"), "label", "is_anomaly")


_NEWEST = f"""{_EVEN} SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, {rs('score', 9)} AS score, coalesce(score >= 0.805, false) AS is_anomaly
FROM labelled LEFT JOIN scored USING (pool_id, hour_ts) QUALIFY row_number() OVER (PARTITION BY pool_id ORDER BY hour_ts DESC) = 1"""


def _alerts_out(found):
    return found.select("pool_id", epoch("hour_ts").alias("hour_epoch"), r("score", 9).alias("score"), "is_anomaly")


@query("j6_alerts_walked", _NEWEST)
def j6_walked(spark, sf):
    rows = materialized(labelled(spark, sf), "labelled")
    return _alerts_out(mart.alerts(rows, _data_forest(rows, 3), 0.805))


@query("j6_alerts_from_newest", _NEWEST)
def j6_newest(spark, sf):
    """Alerts from a table of each pool's newest row, which three arrivals keep up to date."""
    rows = materialized(labelled(spark, sf), "labelled")
    model = _data_forest(rows, 3)
    newest, edges = rows.limit(0), [datetime(2000, 1, 1), datetime(2024, 1, 10), datetime(2024, 1, 20), datetime(2100, 1, 1)]
    for first, last in zip(edges, edges[1:]):
        part = rows.where((F.col("hour_ts") >= moment(first)) & (F.col("hour_ts") < moment(last)))
        newest = materialized(mart.newest_rows(newest, part), "newest")
    return _alerts_out(mart.alerts(newest, model, 0.805))


@query("j7_score_batch_walked", f"""{_EVEN} SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, {rs('score', 9)} AS score,
  coalesce(score >= 0.805, false) AS is_anomaly FROM labelled LEFT JOIN scored USING (pool_id, hour_ts)""")
def j7_walked(spark, sf):
    rows = materialized(labelled(spark, sf), "labelled")
    posted = rows.toDF(*[c.upper() for c in rows.columns])
    return _alerts_out(mart.score_batch(posted, _data_forest(rows, 3), 0.805))


@query("l5_alert_stream_walked", f"""{_EVEN} SELECT pool_id, {epochs('hour_ts')} AS hour_epoch, {rs('score', 9)} AS score
FROM scored WHERE score >= 0.805""")
def l5_walked(spark, sf):
    """A stream over two arrivals of labelled rows, scored batch by batch."""
    rows = materialized(labelled(spark, sf), "labelled")
    handle = ST.alert_batch(_data_forest(rows, 3), out := new_folder(spark, "alerts"), 0.805)
    folder, mark = new_folder(spark, "rows"), new_folder(spark, "mark")
    old = F.col("hour_ts") < moment(datetime(2024, 1, 20))
    for part in (rows.where(old), rows.where(~old)):
        part.write.mode("append").parquet(folder)
        ST.run_available(ST.table_stream(spark, folder, rows.schema), mark, each=handle)
    found = spark.read.schema("pool_id string, hour_ts timestamp, score double").parquet(out)
    return found.select("pool_id", epoch("hour_ts").alias("hour_epoch"), r("score", 9).alias("score"))


@query("j9_pr_auc_walked", f"""{_EVEN}, pts AS (SELECT score, sum(y) AS pos, count(*) AS n FROM scored JOIN complete USING (pool_id, hour_ts) GROUP BY 1), curve AS (
  SELECT pos, sum(pos) OVER w AS tp, sum(n) OVER w AS seen FROM pts WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
SELECT {rs('sum(pos * tp / seen) / sum(pos)')} AS pr_auc FROM curve""")
def j9_walked(spark, sf):
    """Real forest scores, in ranges of at most a few points."""
    rows = materialized(labelled(spark, sf), "labelled")
    return M.pr_auc(M.score(rows, _data_forest(rows, 3)), most=5).select(r("pr_auc").alias("pr_auc"))
