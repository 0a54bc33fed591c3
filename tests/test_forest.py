"""Properties of the forest: bounds, outliers, seeds, missing values, storage."""

import pytest
from pyspark.sql import functions as F

from tidepool.operators import forest as M
from tidepool.operators.profile import quantiles
from tidepool.plans import mart

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """2 000 ordinary rows and 20 far away."""
    u = lambda i: F.rand(i) - 0.5
    base = spark.range(2000).select(F.col("id"), *[u(i).alias(c) for i, c in enumerate(FEATURES, 1)])
    far = spark.range(2000, 2020).select(F.col("id"), *[(u(i) + 50).alias(c) for i, c in enumerate(FEATURES, 4)])
    return base.union(far).withColumn("pool_id", F.col("id").cast("string")).withColumn(
        "hour_ts", F.timestamp_seconds(F.col("id") * 3600)
    ).cache()


@pytest.fixture(scope="module")
def model(rows):
    return M.fit_forest(rows, FEATURES, ["id"], trees=50)


def test_scores_lie_in_range_and_find_planted_rows(rows, model):
    scored = M.score(rows, model)
    assert scored.where("score is null or score <= 0 or score > 1").count() == 0
    top = {r["id"] for r in M.top_scored(scored, 20, ties=["id"]).collect()}
    assert top == set(range(2000, 2020))
    assert scored.where("id < 2000").agg(F.avg("score")).first()[0] < 0.5


def test_same_seed_same_model_whatever_the_partitions(rows, model):
    again = M.fit_forest(rows.repartition(7, "a"), FEATURES, ["id"], trees=50)
    assert model.nodes.exceptAll(again.nodes).count() == 0
    other = M.fit_forest(rows, FEATURES, ["id"], trees=50, seed=43)
    assert model.nodes.exceptAll(other.nodes).count() > 0


def test_samples_are_exact_and_without_replacement(rows):
    drawn = M.tree_samples(rows, FEATURES, ["id"], 50, 42)
    counts = drawn.groupBy("tree").agg(F.count("*").alias("n"), F.count_distinct("_key").alias("d")).collect()
    assert len(counts) == 50 and all(r["n"] == r["d"] == 256 for r in counts)


def test_thinning_leaves_full_samples(spark):
    """More rows than the thinning keeps: every tree still gets its 256."""
    many = spark.range(60_000).select("id", *[F.rand(i).alias(c) for i, c in enumerate(FEATURES)])
    counts = M.tree_samples(many, FEATURES, ["id"], 10, 42).groupBy("tree").count().collect()
    assert sorted(r["count"] for r in counts) == [256] * 10


def test_few_rows_use_all_of_them(rows):
    small = M.fit_forest(rows.where("id < 40"), FEATURES, ["id"], trees=5)
    roots = small.nodes.where("node = 0").collect()
    assert [r["size"] for r in roots] == [40] * 5


def test_missing_features(rows, model):
    holed = rows.withColumn("a", F.when(F.col("id") % 2 == 0, F.col("a")))
    scored = M.score(holed, model)
    assert scored.where("score is null").count() == 1010
    median = M.fit_forest(holed, FEATURES, ["id"], trees=5, null_policy="median")
    assert M.score(holed, median).where("score is null").count() == 0
    with pytest.raises(ValueError):
        M.fit_forest(rows, FEATURES, ["id"], null_policy="guess")


def test_contamination_flags_its_share(rows):
    out = M.flag(rows, FEATURES, ["id"], contamination=0.01, trees=30)
    flagged = out.where("is_anomaly")
    assert flagged.count() == 21 and flagged.where("label = -1").count() == 21
    model = M.fit_forest(rows, FEATURES, ["id"], trees=30)
    cut = M.training_threshold(rows, model, 0.01)
    assert cut == pytest.approx(quantiles(out, "score", [0.99]).first()["value"])
    assert M.training_threshold(rows, model) == 0.5


def test_alias_points_to_the_newest_version(spark, rows, model, tmp_path):
    path = str(tmp_path / "registry")
    M.save_model(M.fit_forest(rows, FEATURES, ["id"], trees=3), path, 1, "production")
    M.save_model(model, path, 2)
    assert M.load_model(spark, path).nodes.select("tree").distinct().count() == 3
    M.set_alias(spark, path, "production", 2)
    loaded = M.load_model(spark, path)
    assert loaded.features == tuple(FEATURES)
    one, two = (M.score(rows, m).select("id", "score") for m in (model, loaded))
    assert one.exceptAll(two).count() == 0
    with pytest.raises(LookupError):
        M.load_model(spark, path, "staging")


def test_alerts_look_at_the_newest_row_of_each_pool(rows, model):
    twice = rows.union(rows.withColumns({"hour_ts": F.col("hour_ts") + F.expr("interval 3650 days"), "a": F.lit(80.0)}))
    out = mart.alerts(twice, model, 0.6)
    assert out.count() == 2020 and out.where("hour_ts < '1975-01-01'").count() == 0
    assert out.where("is_anomaly and score < 0.6").count() == 0


def test_scores_equal_a_walk_through_the_trees(rows, model):
    nodes = model.nodes.toPandas().set_index(["tree", "node"]).to_dict("index")
    points = rows.where("id % 199 = 0").orderBy("id").collect()
    got = {r["id"]: r["score"] for r in M.score(rows, model).collect()}
    for p in points:
        total = 0.0
        for tree in range(50):
            n = nodes[(tree, 0)]
            while n["feature"] >= 0:
                n = nodes[(tree, n["left"] if p[FEATURES[n["feature"]]] <= n["split"] else n["right"])]
            total += n["depth"] + M.average_path(n["size"])
        assert got[p["id"]] == pytest.approx(2 ** (-(total / 50) / M.average_path(256)))


def test_expected_path_lengths():
    assert [M.average_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert M.average_path(256) == pytest.approx(10.2448, abs=1e-3)
