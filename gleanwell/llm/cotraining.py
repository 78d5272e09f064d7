"""A quality classifier by co-training: one view of the text, one of the metadata.

Each view has its own logistic regression. In every round each labels the documents it is surest
of, and these labels join the training rows of the other view. In the end both views are
calibrated on labels that no round has seen and their log odds are added.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwell.llm.common import count_of, dropped, saved, word_list

SOURCES = 16  # of hashed sources in the metadata view
LANGUAGES = 8
ROUNDS = 3
SURE = 0.97  # probability from which a view's label is passed on
HELD_OUT = 4  # one labelled document in four calibrates and is never trained on
PSEUDO_WEIGHT = 0.25
CUT = 0.5
STEPS = 25


def text_view(text: Column) -> Column:
    """Statistics of the words and marks, as an array of doubles; all zero without words."""
    body = F.coalesce(text, F.lit(""))
    words = word_list(body)

    def of(words: Column) -> Column:
        n, size = F.size(words), F.greatest(F.length(F.array_join(words, "")), F.lit(1))
        share = lambda chars: count_of(body, chars) / size
        per_word = lambda value: value / F.greatest(n, F.lit(1))
        lines = F.split(body, "\n")
        return F.array(
            F.log1p(n.cast("double")), per_word(size), per_word(F.size(F.array_distinct(words))),
            share("A-Z"), share("0-9"), share("!"), share("#*$%&|<>"),
            share(".,;:?"), share("'\"()\\[\\]{}"), share("|"), share("_/\\\\=+~^@"),
            F.size(F.array_distinct(lines)) / F.size(lines), F.log1p(F.size(lines).cast("double")),
        )

    return F.element_at(F.transform(F.array(words), of), 1)


def meta_view(docs: DataFrame, source: str, lang: str, length: str) -> Column:
    """Hashed source, language and declared length, as an array of doubles."""
    hot = lambda c, n: [
        (F.pmod(F.xxhash64(F.col(c)), F.lit(n)) == k).cast("double") for k in range(n)
    ]
    size = F.log1p(F.greatest(F.coalesce(F.col(length).cast("double"), F.lit(0.0)), F.lit(0.0)))
    return F.array(*hot(source, SOURCES), *hot(lang, LANGUAGES), size, size * size, F.col(length).isNull().cast("double"))


@dataclass
class CoTrained:
    """The scored documents, each view's calibration and the labels passed on per round."""

    scored: DataFrame
    calibration: dict[str, tuple[float, float]]
    rounds: list[dict[str, int]]


def _fit(rows: DataFrame, features: str, label: str, weight: str) -> LogisticRegressionModel | None:
    """A model, or None while the rows have fewer than two classes."""
    if rows.select(label).distinct().limit(2).count() < 2:
        return None
    model = LogisticRegression(
        featuresCol=features, labelCol=label, weightCol=weight, maxIter=STEPS, regParam=1e-3, standardization=True
    )
    return model.fit(rows)


def _margin(model: LogisticRegressionModel | None, features: str) -> Column:
    """The log odds that the model gives, as one expression over the features."""
    if model is None:
        return F.lit(0.0)
    products = F.zip_with(F.col(features), F.array(*[F.lit(float(c)) for c in model.coefficients]), lambda a, b: a * b)
    return F.aggregate(products, F.lit(float(model.intercept)), lambda a, b: a + b)


def _probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(margin, F.lit(40.0)), F.lit(-40.0))))


def co_train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    lang: str = "lang", length: str = "n_chars", label: str = "quality", rounds: int = ROUNDS,
) -> CoTrained:
    """Score every document: doc_id, text_odds, meta_odds, score and kept.

    Features of all documents are computed once and saved; labels meet them on the id. A document
    with several labels has their majority; one without an id has none. Every round each view trains on
    the labels and on what the other passed on, of all documents without a label: those whose
    probability of either class is at least ``SURE``. Null texts and metadata are zeros. Without
    labels of both classes nothing is learned and every document has the same score.
    """
    slim = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), text_view(F.col(text)).alias("text"),
        meta_view(docs, source, lang, length).alias("meta"),
    )
    table = saved(slim.withColumn("row", F.monotonically_increasing_id()), "views")
    marks = labels.filter(F.col(label).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(
        F.avg((F.col(label) > 0).cast("double")).alias("y")
    ).withColumn("y", (F.col("y") >= 0.5).cast("double"))
    known = saved(
        table.join(marks, "doc_id").withColumn("aside", F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0), "labelled"
    )
    train, aside = known.filter("NOT aside"), known.filter("aside")
    pool = table.join(known.select("row"), "row", "left_anti").select("row", "text", "meta")
    base = train.select("text", "meta", "y", F.lit(1.0).alias("w"))
    passed: dict[str, DataFrame | None] = {"text": None, "meta": None}
    models: dict[str, LogisticRegressionModel | None] = {}
    report = []
    for _ in range(rounds + 1):
        for view in ("text", "meta"):
            rows = base if passed[view] is None else base.unionByName(passed[view])
            models[view] = _fit(rows.withColumn("x", array_to_vector(view)), "x", "y", "w")
        if len(report) == rounds:
            break
        counts = {}
        for view, other in (("text", "meta"), ("meta", "text")):
            p = _probability(_margin(models[view], view))
            sure = pool.withColumn("_p", p).filter((F.col("_p") >= SURE) | (F.col("_p") <= 1 - SURE))
            chosen = saved(sure.select(
                "text", "meta", (F.col("_p") >= 0.5).cast("double").alias("y"), F.lit(PSEUDO_WEIGHT).alias("w")
            ), "passed-on")
            if passed[other] is not None:
                dropped(passed[other])
            passed[other] = chosen
            counts[view] = chosen.count()
        report.append(counts)
    calibration = {}
    for view in ("text", "meta"):
        own = aside.select(F.array(_margin(models[view], view)).alias("m"), "y", F.lit(1.0).alias("w"))
        platt = _fit(own.withColumn("x", array_to_vector("m")), "x", "y", "w")
        calibration[view] = (float(platt.coefficients[0]), float(platt.intercept)) if platt else (1.0, 0.0)
    prior = aside.agg(F.avg("y")).first()[0]
    prior = 0.5 if prior is None else min(max(prior, 1e-3), 1 - 1e-3)
    odds = {v: F.lit(calibration[v][0]) * _margin(models[v], v) + F.lit(calibration[v][1]) for v in models}
    both = F.col("text_odds") + F.col("meta_odds") - F.log(F.lit(prior / (1 - prior)))
    scored = table.select("doc_id", odds["text"].alias("text_odds"), odds["meta"].alias("meta_odds"))
    scored = scored.withColumn("score", _probability(both)).withColumn("kept", F.col("score") >= CUT)
    return CoTrained(scored, calibration, report)
