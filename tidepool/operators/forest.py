"""Isolation Forest (Liu, Ting, Zhou, 2008) fitted and applied by Spark.

A tree needs 256 rows, however many rows there are. Fitting therefore thins the table by
a hash of the row key in one pass, deals the thinned rows to trees by further hashes,
and grows every tree in its own group of a few hundred rows. All choices are hashes of
keys and seeds, so the partitioning cannot change the model. The model is a table of
nodes, at most ``trees * (2 * 256 - 1)`` rows, which bounds what scoring ships to executors.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidepool.operators.attach import attach
from tidepool.operators.quantiles import exact_quantiles
from tidepool.session import materialized

SAMPLE = 256
THINNED = 4.0
AUTO_THRESHOLD = 0.5  # the cut for "contamination auto" on the paper's score

NODE_SCHEMA = T.StructType(
    [
        T.StructField("tree", T.IntegerType()),
        T.StructField("node", T.IntegerType()),
        T.StructField("feature", T.IntegerType()),  # -1 in a leaf
        T.StructField("split", T.DoubleType()),
        T.StructField("left", T.IntegerType()),
        T.StructField("right", T.IntegerType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("depth", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class Forest:
    nodes: DataFrame
    features: tuple[str, ...]
    sample: int = SAMPLE
    threshold: float = AUTO_THRESHOLD
    # per-feature replacement for missing values; empty means "a missing value has no score"
    fill: dict[str, float] = field(default_factory=dict)

    @cached_property
    def shipped(self) -> Broadcast:
        """The nodes as arrays on every executor, sent once per model: at most trees * (2 * sample - 1) rows."""
        return self.nodes.sparkSession.sparkContext.broadcast(_arrays(self.nodes.toPandas(), self.sample))


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary search tree of n keys."""
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


# -- fitting ---------------------------------------------------------------------


def tree_samples(
    df: DataFrame, features: Sequence[str], key: Sequence[str], trees: int, seed: int, sample: int = SAMPLE,
    thinned: float = THINNED,
) -> DataFrame:
    """``tree``, ``key`` hash and features: for each tree a uniform sample without replacement.

    The trees draw from ``thinned`` samples' worth of rows per tree, chosen by hash from all rows.
    """
    rows = df.select(F.xxhash64(*key).alias("_key"), *[F.col(c).cast("double").alias(c) for c in features])
    wanted = thinned * sample * trees
    total = rows.agg(F.count("*").cast("double").alias("n"))
    # one pass over everything
    thin = attach(rows, total).where(_uniform(F.xxhash64("_key", F.lit(seed))) * F.col("_one.n") < wanted)
    # each kept row asks every tree; one and a half samples per tree makes a shortfall negligible
    kept = F.least(F.col("_one.n"), F.lit(wanted))
    ask = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: _uniform(F.xxhash64("_key", t, F.lit(seed + 1))) * kept < 1.5 * sample,
    )
    asked = thin.withColumn("tree", F.explode(ask)).drop("_one")
    order = Window.partitionBy("tree").orderBy(F.xxhash64("_key", "tree", F.lit(seed + 2)), "_key")
    return asked.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= sample).drop("_rank")


def _uniform(h):
    """A hash as a number in [0, 1)."""
    return F.pmod(h, F.lit(1 << 52)) / F.lit(float(1 << 52))


def _grow(x: np.ndarray, limit: int, rng: np.random.Generator) -> list[tuple]:
    nodes: list[tuple] = []
    queue = [(0, np.arange(len(x)), 0)]
    issued = 1
    while queue:
        node, rows, depth = queue.pop(0)
        lo, hi = x[rows].min(axis=0), x[rows].max(axis=0)
        spread = np.flatnonzero(hi > lo)
        if depth >= limit or len(rows) <= 1 or len(spread) == 0:
            nodes.append((node, -1, 0.0, -1, -1, len(rows), depth))
            continue
        f = int(rng.choice(spread))
        split = float(rng.uniform(lo[f], hi[f]))
        goes_left = x[rows, f] <= split
        left, right = issued, issued + 1
        issued += 2
        nodes.append((node, f, split, left, right, len(rows), depth))
        queue.append((left, rows[goes_left], depth + 1))
        queue.append((right, rows[~goes_left], depth + 1))
    return nodes


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    key: Sequence[str] = ("pool_id", "hour_ts"),
    trees: int = 200,
    seed: int = 42,
    sample: int = SAMPLE,
    null_policy: str = "drop",
    thinned: float = THINNED,
) -> Forest:
    """Fit on the rows of ``df``; ``null_policy`` drops incomplete rows or fills them with medians.

    ``sample`` rows go into a tree, drawn from at most ``thinned * sample * trees`` rows in all.
    """
    features = tuple(features)
    fill: dict[str, float] = {}
    if null_policy == "median":
        from tidepool.operators.profile import melt

        medians = exact_quantiles(melt(df, features), "value", [0.5], ["column"])
        fill = {r["column"]: r["value"] for r in medians.collect()}  # one row per feature
        rows = df.fillna(fill)
    elif null_policy == "drop":
        rows = df.dropna(subset=list(features))
    else:
        raise ValueError(f"unknown null_policy {null_policy!r}")

    picked = tree_samples(rows, features, key, trees, seed, sample, thinned)
    limit = math.ceil(math.log2(max(sample, 2)))
    names = list(features)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_key", kind="stable")
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        nodes = _grow(pdf[names].to_numpy(dtype=float), limit, rng)
        out = pd.DataFrame(nodes, columns=["node", "feature", "split", "left", "right", "size", "depth"])
        out.insert(0, "tree", tree)
        return out

    grown = picked.groupBy("tree").applyInPandas(build, NODE_SCHEMA)
    # written once: a model that is refitted by every action would be slow and hard to audit
    return Forest(materialized(grown, "forest"), features, sample, AUTO_THRESHOLD, fill)


# -- scoring ---------------------------------------------------------------------


def _arrays(nodes: pd.DataFrame, sample: int) -> dict:
    """The forest as flat arrays: ``width`` slots per tree, one slot per node."""
    trees = np.sort(nodes["tree"].unique())
    width = int(nodes["node"].max()) + 1
    at = np.searchsorted(trees, nodes["tree"].to_numpy()) * width + nodes["node"].to_numpy()
    leaf = nodes["feature"].to_numpy() < 0
    own = nodes["node"].to_numpy()

    def table(values, dtype):
        out = np.zeros(len(trees) * width, dtype=dtype)
        out[at] = values
        return out

    beyond = np.array([average_path(n) for n in nodes["size"]])
    return {
        "trees": len(trees),
        "width": width,
        "depth": int(nodes["depth"].max()),
        "norm": average_path(sample),
        "feature": table(np.where(leaf, 0, nodes["feature"]), np.intp),
        # children are numbered together, so a step goes to the left child plus one if the
        # value is above the split; a leaf leads to itself and nothing is above its split
        "split": table(np.where(leaf, np.inf, nodes["split"]), np.float64),
        "left": table(np.where(leaf, own, nodes["left"]), np.intp),
        "path": table(np.where(leaf, nodes["depth"] + beyond, 0.0), np.float64),
    }


def _scores(forest: dict, x: np.ndarray) -> np.ndarray:
    """2^(-mean path / expected path): near 1 is anomalous, below 0.5 is ordinary.

    All rows of a batch take one step at a time, into arrays that are made once.
    """
    n = len(x)
    flat = np.ascontiguousarray(x).ravel()
    base = np.arange(n, dtype=np.intp) * x.shape[1]
    node, at, child = (np.empty(n, dtype=np.intp) for _ in range(3))
    value, cut, path, total = (np.zeros(n) for _ in range(4))
    above = np.empty(n, dtype=bool)
    for tree in range(forest["trees"]):
        part = slice(tree * forest["width"], (tree + 1) * forest["width"])
        feature, split, left, length = (forest[k][part] for k in ("feature", "split", "left", "path"))
        node[:] = 0
        for _ in range(forest["depth"]):
            np.take(feature, node, out=at, mode="clip")
            np.add(at, base, out=at)
            np.take(flat, at, out=value, mode="clip")
            np.take(split, node, out=cut, mode="clip")
            np.greater(value, cut, out=above)
            np.take(left, node, out=child, mode="clip")
            np.add(child, above, out=node)
        np.take(length, node, out=path, mode="clip")
        np.add(total, path, out=total)
    return np.exp2(-(total / forest["trees"]) / forest["norm"])


def score(df: DataFrame, model: Forest, out: str = "score") -> DataFrame:
    """Add the anomaly score, larger meaning more anomalous; missing where a feature is missing."""
    forest = model.shipped
    inputs = [
        F.coalesce(F.col(c).cast("double"), F.lit(model.fill[c])) if c in model.fill else F.col(c).cast("double")
        for c in model.features
    ]

    @F.pandas_udf(T.DoubleType())
    def scored(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        whole = ~np.isnan(x).any(axis=1)
        result = np.full(len(x), np.nan)
        if whole.any():
            result[whole] = _scores(forest.value, x[whole])
        return pd.Series(result).where(whole)

    return df.withColumn(out, scored(*inputs)).withColumn(out, F.when(~F.isnan(out), F.col(out)))


def training_threshold(df: DataFrame, model: Forest, contamination: float | str = "auto") -> float:
    """The score above which a share of ``contamination`` of the training rows lies."""
    if contamination == "auto":
        return AUTO_THRESHOLD
    scored = materialized(score(df, model).select("score"), "training-scores")
    return exact_quantiles(scored, "score", [1 - contamination]).first()["value"]


def flag(
    df: DataFrame,
    features: Sequence[str],
    key: Sequence[str],
    contamination: float | str = 0.01,
    trees: int = 100,
    seed: int = 42,
) -> DataFrame:
    """Fit and apply in one go: ``score``, ``label`` (-1 anomalous, 1 ordinary) and ``is_anomaly``.

    Scaling features does not change which side of a random split a row falls on, up to
    the random draw, so standardised and plain columns are both fine as input.
    """
    rows = df.dropna(subset=list(features))
    return flag_by(rows, fit_forest(rows, features, key, trees, seed), contamination)


def flag_by(rows: DataFrame, model: Forest, contamination: float | str = 0.01) -> DataFrame:
    """``flag`` with a model at hand: the share ``contamination`` of the scored rows is anomalous."""
    scored = materialized(score(rows, model).where("score is not null"), "scored")
    if contamination == "auto":
        cut = F.lit(AUTO_THRESHOLD)
    else:
        cut = exact_quantiles(scored, "score", [1 - contamination]).select("value").scalar()
    return with_label(scored.withColumn("is_anomaly", F.col("score") > cut))


def with_label(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.when(F.col("is_anomaly"), -1).otherwise(1))


def top_scored(df: DataFrame, n: int, threshold: float = 0.0, ties: Sequence[str] = ("pool_id",)) -> DataFrame:
    """The n highest scores at or above a threshold."""
    return df.where(F.col("score") >= threshold).orderBy(F.desc("score"), *ties).limit(n)


# -- storage ---------------------------------------------------------------------


def save_model(model: Forest, path: str, version: int, alias: str | None = None, metrics: dict[str, float] | None = None) -> None:
    """Write nodes, settings and metrics under ``path/version=N`` and point ``alias`` to that version."""
    spark = model.nodes.sparkSession
    folder = f"{path}/version={version}"
    model.nodes.coalesce(1).write.mode("errorifexists").parquet(f"{folder}/nodes")
    settings = [(list(model.features), model.sample, model.threshold, model.fill)]
    layout = "features array<string>, sample int, threshold double, fill map<string, double>"
    spark.createDataFrame(settings, layout).coalesce(1).write.mode("errorifexists").parquet(f"{folder}/settings")
    logged = spark.createDataFrame(sorted((metrics or {}).items()), "name string, value double")
    logged.coalesce(1).write.mode("errorifexists").parquet(f"{folder}/metrics")
    if alias:
        set_alias(spark, path, alias, version)


def set_alias(spark: SparkSession, path: str, alias: str, version: int) -> None:
    entry = spark.range(1).select(
        F.lit(alias).alias("alias"), F.lit(version).alias("version"), F.current_timestamp().alias("set_at")
    )
    entry.coalesce(1).write.mode("append").parquet(f"{path}/aliases")


def load_model(spark: SparkSession, path: str, alias: str = "production") -> Forest:
    """The version the alias was last pointed to."""
    found = (
        spark.read.parquet(f"{path}/aliases")
        .where(F.col("alias") == alias)
        .agg(F.max_by("version", F.struct("set_at", "version")).alias("version"))
        .first()["version"]
    )
    if found is None:
        raise LookupError(f"no model version carries the alias {alias!r} under {path}")
    folder = f"{path}/version={found}"
    s = spark.read.parquet(f"{folder}/settings").first()
    nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{folder}/nodes")
    return Forest(nodes, tuple(s["features"]), s["sample"], s["threshold"], dict(s["fill"] or {}))


# -- evaluation against the spike label --------------------------------------------


def at_k(scored: DataFrame, k: int = 10, hour: str = "hour_ts", ties: Sequence[str] = ("pool_id",)) -> DataFrame:
    """Precision and recall of the k highest scores in every hour against ``y``.

    The rank limit is applied before the shuffle as well as after, so an hour with very
    many pools sends k rows per input partition. Note that ``y`` looks at the whole series,
    future included: these figures judge a ranking, they do not forecast.
    """
    order = Window.partitionBy(hour).orderBy(F.desc_nulls_last("score"), *ties)
    top = scored.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)
    hits = top.groupBy(F.col(hour).alias("_hour")).agg(F.sum("y").alias("hits"), F.count("*").alias("picked"))
    total = scored.groupBy(hour).agg(F.sum("y").alias("positives"))
    both = total.join(hits, F.col(hour) == F.col("_hour"))
    return both.select(
        hour, "picked", "hits", "positives",
        (F.col("hits") / F.col("picked")).alias("precision_at_k"),
        F.try_divide("hits", "positives").alias("recall_at_k"),
    )


def pr_auc(scored: DataFrame, most: int = 1_000_000) -> DataFrame:
    """Area under the precision-recall curve (average precision over all thresholds), as one row.

    Rows are counted per distinct score, with a partial count before the shuffle, so a very common score is one point.
    The points are dealt to score ranges of about ``most`` points each, whose bounds Spark samples from
    the points themselves: the number of ranges grows with the points, however close together they lie.
    The running totals of the curve are taken over the ranges' totals first and then inside each range.
    Rows without a score are left out.
    """
    score = F.col("score").cast("double")
    points = scored.where(score.isNotNull() & ~F.isnan(score)).groupBy(score.alias("score"))
    points = materialized(points.agg(F.sum("y").alias("pos"), F.count("*").alias("n")), "score-points")
    ranges = max(1, math.ceil(points.count() / most))
    # written before it is used twice: the place of a bound must be the same for totals and points
    dealt = points.repartitionByRange(ranges, F.desc("score")).withColumn("_range", F.spark_partition_id())
    dealt = materialized(dealt, "score-ranges")
    totals = dealt.groupBy(F.col("_range").alias("_b")).agg(F.sum("pos").alias("_pos"), F.sum("n").alias("_n"))
    above = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    start = totals.select(
        "_b",
        F.coalesce(F.sum("_pos").over(above), F.lit(0)).alias("_tp"),
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_seen"),
    )
    inside = Window.partitionBy("_range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    curve = dealt.join(start, F.col("_range") == F.col("_b")).select(
        "pos",
        (F.col("_tp") + F.sum("pos").over(inside)).alias("tp"),
        (F.col("_seen") + F.sum("n").over(inside)).alias("seen"),
    )
    sums = curve.agg(F.sum(F.col("pos") * F.col("tp") / F.col("seen")).alias("area"), F.sum("pos").alias("total"))
    return sums.select(F.try_divide("area", "total").alias("pr_auc"))
