import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from gleanwell.operators import quality_model, vectors


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 3))
    score = np.clip(5 + 3 * x[:, 0] - x[:, 1], 0, 10)
    labeled = spark.createDataFrame([(i, float(s)) for i, s in enumerate(score)], "fid bigint, quality_score double")
    features = spark.createDataFrame([(str(i), *map(float, r)) for i, r in enumerate(x)], "fid string, a double, b double, c double")
    return features, quality_model.training_data(labeled, features).persist()


def test_columns_and_split(data):
    _, train = data
    assert quality_model.feature_columns(train) == ["a", "b", "c"]
    assert train.count() == 600
    share = train.filter("is_test").count() / 600
    assert 0.2 <= share < 0.21


def test_regressor_beats_the_mean_and_survives_saving(spark, data, tmp_path):
    features, train = data
    model = quality_model.train_regressor(train, 15)
    test = model.transform(train.filter("is_test"))
    mean = train.agg(F.avg("quality_score")).first()[0]
    error = quality_model.regression_metrics(test, "quality_score", "prediction").first().rmse
    flat = quality_model.regression_metrics(test.withColumn("m", F.lit(mean)), "quality_score", "m").first().rmse
    assert error < 0.7 * flat
    quality_model.save_models({"regressor": model}, str(tmp_path))
    loaded = quality_model.load_model(str(tmp_path), "regressor")
    scored = quality_model.score_users(features.drop("c"), loaded)
    assert scored.count() == 600
    assert scored.filter(~F.col("quality_score").between(0, 10)).count() == 0
    assert scored.filter("is_quality_user = 1 and quality_score < 5").count() == 0


def test_classifier_importance(spark, data):
    _, train = data
    model = quality_model.train_classifier(train, 5)
    rows = quality_model.feature_importance(model, spark).collect()
    assert rows[0].feature == "a" and {r.feature for r in rows} == {"a", "b", "c"}


def test_importance_without_any_split_is_zero(spark, data):
    _, train = data
    model = quality_model.train_classifier(train.limit(30).withColumn("a", F.lit(1.0)).withColumn("b", F.lit(1.0)).withColumn("c", F.lit(1.0)), 2)
    assert [r.importance for r in quality_model.feature_importance(model, spark).collect()] == [0.0] * 3


def blobs(spark, centres, n=60, spread=0.05):
    rng = np.random.default_rng(6)
    rows = [
        (f"h{c}-{i}", c, [float(v) for v in np.array(p) + rng.normal(scale=spread, size=len(p))])
        for c, p in enumerate(centres) for i in range(n)
    ]
    return spark.createDataFrame(rows, "Hash string, blob int, x array<double>").withColumn(
        "reduced", array_to_vector("x")
    )


def test_kmeans_finds_blobs_and_k(spark):
    df = blobs(spark, [(0, 0), (5, 5), (0, 5), (5, 0)])
    model = vectors.best_kmeans(df, 4, restarts=2)
    pairs = model.transform(df).select("blob", "cluster_id").distinct().count()
    assert pairs == 4
    best = vectors.silhouettes(df, "Hash", ks=(2, 3, 4, 5), restarts=2).first()
    assert best.k == 4
    centres = vectors.centres_of(model, spark).collect()
    assert len(centres) == 4


def test_reduction_is_centred(spark):
    df = blobs(spark, [(1, 2, 3), (4, 4, 4)]).withColumn("features", array_to_vector("x")).drop("reduced")
    reduced, model = vectors.reduced(df, 2)
    rows = np.array([r.reduced.toArray() for r in reduced.collect()])
    assert abs(rows.mean(axis=0)).max() < 1e-9
    assert 0.9 < vectors.explained_variance(model) <= 1.0 + 1e-9


def test_hashed_vectors_have_unit_length(spark):
    df = spark.createDataFrame([("a", "red green blue"), ("b", "red red fish")], "Hash string, Text string")
    rows = vectors.hashed_vectors(df).collect()
    assert all(np.linalg.norm(r.features.toArray()) == pytest.approx(1) for r in rows if r.features.numNonzeros())
