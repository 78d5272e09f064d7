"""From posts and reactions to a quality score for every active author."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwell.operators import features, labeling, quality_model, sampling
from gleanwell.session import materialized
from gleanwell.sources import sinks, tables


def choose_users_to_label(casts: DataFrame, n_samples: int = sampling.SAMPLE_SIZE) -> DataFrame:
    """A varied sample of authors with their newest posts.

    Activity is written once: the segment cuts, the draws and the final join all read it.
    """
    activity = materialized(sampling.user_activity(casts))
    population = materialized(sampling.most_active(activity))
    sampled = sampling.sampled_users(population, n_samples)
    return sampling.users_to_label(casts, population, sampled)


def label_sample(
    casts: DataFrame, model: Callable[[list[str]], list[str]], out: str,
    n_samples: int = sampling.SAMPLE_SIZE,
) -> DataFrame:
    """Sample, ask the model, and keep both tables as JSON lines."""
    users = materialized(choose_users_to_label(casts, n_samples))
    sinks.write_json(users, f"{out}/users_to_label")
    labels = labeling.label_users(users, model)
    sinks.write_json(labels, f"{out}/labeled_users")
    return tables.read_json_lines(casts.sparkSession, f"{out}/labeled_users", tables.LABELED_USERS)


def build_features(casts: DataFrame, reactions: DataFrame, out: str) -> DataFrame:
    path = f"{out}/user_features"
    sinks.write_parquet(features.user_features(casts, reactions), path)
    return casts.sparkSession.read.parquet(path)


def train(
    spark: SparkSession, label_paths: Sequence[str], user_features: DataFrame, out: str,
    rounds: int = quality_model.ROUNDS,
) -> dict[str, PipelineModel]:
    """Both models from the first label table that exists; saved with the scaler."""
    labeled = tables.read_first_present(spark, label_paths, tables.LABELED_USERS)
    data = materialized(quality_model.training_data(labeled, user_features))
    models = {
        "classifier": quality_model.train_classifier(data, rounds),
        "regressor": quality_model.train_regressor(data, rounds),
        "scaler": quality_model.fit_scaler(data),
    }
    quality_model.save_models(models, f"{out}/models")
    importance = quality_model.feature_importance(models["classifier"], spark)
    sinks.write_parquet(importance, f"{out}/feature_importance")
    return models


def score_all(user_features: DataFrame, regressor: PipelineModel, out: str) -> DataFrame:
    """Scores of all authors as Parquet, and the best ones as CSV."""
    path = f"{out}/user_quality_scores"
    sinks.write_parquet(quality_model.score_users(user_features, regressor), path)
    scores = user_features.sparkSession.read.parquet(path).withColumn("fid", F.col("fid").cast("string"))
    sinks.write_high_quality_users(scores, f"{out}/high_quality_users")
    return scores
