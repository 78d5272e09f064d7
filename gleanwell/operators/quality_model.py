"""Author quality as a learnt function of behaviour features."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwell.functions.scalars import clip, is_quality_user, quality_category
from gleanwell.operators import boosting
from gleanwell.operators.boosting import LeafwiseModel
from gleanwell.operators.ranking import exact_quantiles
from gleanwell.operators.sampling import SEED, stratified_split

# Trees of both models at most, and the columns that are no features.
ROUNDS = 100
NOT_FEATURES = [
    "fid", "quality_score", "category", "reasoning", "content_themes", "is_quality", "quality_class",
]
SPLIT_MARK = "is_test"


def training_data(labeled: DataFrame, features: DataFrame) -> DataFrame:
    """Labelled authors with features, both classes of label, and the held-out fifth marked."""
    typed = features.withColumn("fid", F.col("fid").cast("bigint"))
    score = F.col("quality_score")
    joined = labeled.join(typed, "fid").withColumns(
        {"is_quality": is_quality_user(score), "quality_class": quality_category(score)}
    )
    return stratified_split(joined, "is_quality", "fid")


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NOT_FEATURES and c != SPLIT_MARK]


def with_all_features(features: DataFrame, columns: list[str]) -> DataFrame:
    """Missing feature columns are 0; missing values too."""
    absent = {c: F.lit(0.0) for c in columns if c not in features.columns}
    return (features.withColumns(absent) if absent else features).fillna(0.0, columns)


def _fit(data: DataFrame, estimator, columns: list[str]) -> PipelineModel:
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    return Pipeline(stages=[assembler, estimator]).fit(with_all_features(data, columns))


def train_classifier(data: DataFrame, rounds: int = ROUNDS) -> LeafwiseModel:
    """Quality or not. ``data`` comes from ``training_data``.

    Boosting stops early on the marked rows, which also serve for the report.
    """
    return boosting.fit(data, feature_columns(data), "is_quality", boosting.LOGISTIC, SPLIT_MARK, rounds, seed=SEED)


def train_regressor(data: DataFrame, rounds: int = ROUNDS) -> LeafwiseModel:
    return boosting.fit(data, feature_columns(data), "quality_score", boosting.SQUARED, SPLIT_MARK, rounds, seed=SEED)


def fit_scaler(data: DataFrame) -> PipelineModel:
    """Centred, unit-deviation features; kept with the models, not used by the trees."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    train = data.filter(~F.col(SPLIT_MARK))
    return _fit(train, scaler, feature_columns(data))


def feature_importance(model: LeafwiseModel, spark) -> DataFrame:
    """``feature, importance``, most important first, one row per feature column.

    Shares of the trees' gain: they add up to 1, or are all 0 where no tree has split.
    """
    rows = [(c, float(w)) for c, w in zip(model.columns, model.importance())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), F.col("feature").asc()
    )


def score_users(features: DataFrame, model: LeafwiseModel) -> DataFrame:
    """Scores of all authors: predicted, held within 0 to 10, flagged and binned."""
    predicted = model.transform(with_all_features(features, model.columns))
    score = clip(F.col("prediction"), 0.0, 10.0)
    return predicted.select("fid", score.alias("quality_score")).withColumns(
        {
            "is_quality_user": is_quality_user(F.col("quality_score")),
            "quality_category": quality_category(F.col("quality_score")),
        }
    )


def score_stats(scores: DataFrame, threshold: float = 7.0) -> DataFrame:
    """One row: how many authors, mean and median score, how many reach the threshold."""
    median = exact_quantiles(scores, "quality_score", {"median_score": 0.5})
    return scores.agg(
        F.count(F.lit(1)).alias("users"),
        F.avg("quality_score").alias("mean_score"),
        F.count_if(F.col("quality_score") >= threshold).alias("high_quality_users"),
        F.avg((F.col("quality_score") >= threshold).cast("double")).alias("high_quality_share"),
    ).withColumn("median_score", median.scalar())


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support of both classes, 0 where undefined."""
    counts = confusion(df, label, prediction)

    def cells(where):
        return F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0))

    is_label, is_predicted = F.col("label"), F.col("predicted")
    rows = counts.agg(
        *[
            cells(test).alias(f"{name}{c}")
            for c in (0, 1)
            for name, test in (
                ("hit", (is_label == c) & (is_predicted == c)),
                ("said", is_predicted == c),
                ("true", is_label == c),
            )
        ]
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("class"), F.col(f"hit{c}").alias("hit"),
                        F.col(f"said{c}").alias("said"), F.col(f"true{c}").alias("support"),
                    )
                    for c in (0, 1)
                ]
            )
        )
    )

    def share(whole: str):
        return F.when(F.col(whole) > 0, F.col("hit") / F.col(whole)).otherwise(0.0)

    p, r = F.col("precision"), F.col("recall")
    return rows.select(
        "class", share("said").alias("precision"), share("support").alias("recall"), "support"
    ).withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    error = F.col(label) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"))


def save_models(models: dict[str, LeafwiseModel | PipelineModel], path: str) -> None:
    for name, model in models.items():
        if isinstance(model, LeafwiseModel):
            model.save(f"{path}/{name}", SparkSession.getActiveSession())
        else:
            model.write().overwrite().save(f"{path}/{name}")


def load_model(path: str, name: str) -> LeafwiseModel:
    return LeafwiseModel.load(f"{path}/{name}", SparkSession.getActiveSession())


def load_scaler(path: str, name: str = "scaler") -> PipelineModel:
    return PipelineModel.load(f"{path}/{name}")
