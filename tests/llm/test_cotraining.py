import random

import pytest
from helpers import clashing, table

from gleanwell.llm import cotraining


def corpus(n=400, seed=1):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rnd.random() < 0.7
        words = [rnd.choice(["tone", "river", "stone", "the", "light"]) for _ in range(rnd.randint(20, 60))]
        text = " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)
        source = rnd.choice("abc") if good else rnd.choice("cde")
        rows.append((i, text, "en", source, len(text)))
        if i % 3 == 0:
            labels.append((i, int(good), 0))
    return rows, labels, {r[0]: r[1] == r[1].lower() for r in rows}


def test_held_out_accuracy(spark):
    rows, labels, truth = corpus()
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    result = cotraining.co_train(clashing(spark, rows), given)
    scored = {r.doc_id: r for r in result.scored.collect()}
    unseen = [i for i in truth if i % 3]
    assert sum(scored[i].kept == truth[i] for i in unseen) / len(unseen) > 0.95
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored.values())
    assert result.rounds[0]["text"] > 0  # the text view passes labels on


def test_gaps_and_missing_labels(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "words", "en", "a", 5), (1, "x " * 20_000, "en", "a", -1)]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scored = cotraining.co_train(table(spark, rows), none).scored.collect()
    assert len(scored) == 4 and len({r.score for r in scored}) == 1
    one_class = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert cotraining.co_train(table(spark, rows), one_class).scored.count() == 4
    assert cotraining.co_train(table(spark, []), one_class).scored.collect() == []


def test_expression_is_the_models_probability(spark):
    rows, labels, _ = corpus(90)
    given = spark.createDataFrame([(r[0], [float(len(r[1])), float(r[1].count("!"))], float(i % 2)) for i, r in enumerate(rows)], "id long, v array<double>, y double")
    data = given.withColumn("x", cotraining.array_to_vector("v")).withColumn("w", cotraining.F.lit(1.0))
    model = cotraining._fit(data, "x", "y", "w")
    own = data.withColumn("p", cotraining._probability(cotraining._margin(model, "v")))
    for r in model.transform(own).select("p", "probability").collect():
        assert r.p == pytest.approx(r.probability[1])


def test_marks_of_every_class_count(spark):
    given = spark.createDataFrame([("ab^\\@",), ("ab@",)], "text string")
    caret, plain = (r[0][11 - 1] for r in given.select(cotraining.text_view(cotraining.F.col("text"))).collect())
    assert caret == pytest.approx(3 / 5) and plain == pytest.approx(1 / 3)
