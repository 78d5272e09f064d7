"""Leaf-wise boosting against a plain model that works on one row list, one split at a time."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanwell.operators import boosting


def plain_cuts(values, bins):
    ordered = sorted(values)
    picked = {ordered[max(math.ceil(i / bins * len(ordered)), 1) - 1] for i in range(1, bins)}
    return [v for v in sorted(picked) if v < ordered[-1]]


def plain_trees(x, y, objective, rounds, leaves, rate, share, least, bins, seed):
    """Lists of (feature, threshold, gain) in the order of the splits, and the scores of the rows."""
    cuts = [plain_cuts(x[:, f], bins) for f in range(x.shape[1])]
    mean = y.mean()
    margin = np.full(len(y), math.log(mean / (1 - mean)) if objective == boosting.LOGISTIC else mean)
    draw, made = np.random.default_rng(seed), []
    whole = lambda v: np.round(v * boosting.SCALE)

    def best_of(rows, g, h, features):
        best = None
        worth = lambda r: (g[r].sum() / boosting.SCALE) ** 2 / (h[r].sum() / boosting.SCALE)
        for f in features:
            for cut in cuts[f]:
                left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if min(len(left), len(right)) < least or min(h[left].sum(), h[right].sum()) < boosting.LEAST_HESSIAN * boosting.SCALE:
                    continue
                gain = worth(left) + worth(right) - worth(rows)
                if gain > 1e-10 and (best is None or gain > best[0]):
                    best = gain, f, cut, left, right
        return best

    for _ in range(rounds):
        if objective == boosting.LOGISTIC:
            p = 1 / (1 + np.exp(-margin))
            g, h = whole(p - y), whole(p * (1 - p))
        else:
            g, h = whole(margin - y), whole(np.ones(len(y)))
        features = np.sort(draw.choice(x.shape[1], max(1, int(x.shape[1] * share + 0.5)), replace=False))
        ends = [(np.arange(len(y)), best_of(np.arange(len(y)), g, h, features))]
        splits = []
        while len(ends) < leaves and any(b for _, b in ends):
            i = max((i for i, e in enumerate(ends) if e[1]), key=lambda i: ends[i][1][0])
            gain, f, cut, left, right = ends.pop(i)[1]
            splits.append((f, cut, gain))
            ends += [(part, best_of(part, g, h, features)) for part in (left, right)]
        if not splits:
            break
        for rows, _ in ends:
            margin[rows] -= rate * (g[rows].sum() / boosting.SCALE) / (h[rows].sum() / boosting.SCALE)
        made.append(splits)
    return made, margin


def sample(n=300, seed=3):
    rnd = np.random.default_rng(seed)
    x = np.round(rnd.normal(size=(n, 4)), 2)
    x[:, 3] = rnd.integers(0, 3, n)
    return x, 2 * x[:, 0] * (x[:, 1] > 0) - x[:, 3] + rnd.normal(size=n) * 0.3


def frame(spark, x, y):
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "fid long, a double, b double, c double, d double, y double")


@pytest.mark.parametrize("objective", [boosting.SQUARED, boosting.LOGISTIC])
@pytest.mark.parametrize("local_rows", [0, 60, 50_000])
def test_equals_the_plain_model_split_by_split(spark, monkeypatch, objective, local_rows):
    """Whether nodes are counted by jobs, finished in tasks of their own, or some of each."""
    monkeypatch.setattr(boosting, "LOCAL_ROWS", local_rows)
    x, y = sample()
    if objective == boosting.LOGISTIC:
        y = (y > 0).astype(float)
    made, margin = plain_trees(x, y, objective, 4, 8, 0.3, 0.75, 10, 40, 42)
    df = frame(spark, x, y)
    model = boosting.fit(df.repartition(3), list("abcd"), "y", objective, rounds=4, leaves=8, rate=0.3, feature_share=0.75, least_rows=10, bins=40)
    assert len(model.trees) == len(made) == 4
    for tree, splits in zip(model.trees, made):
        found = sorted((f, t, round(g, 6)) for f, t, g in zip(tree.feature, tree.threshold, tree.gain) if f >= 0)
        assert found == sorted((int(f), c, round(g, 6)) for f, c, g in splits)
    got = np.array([r["score"] for r in model.transform(df).orderBy("fid").collect()])
    expected = 1 / (1 + np.exp(-margin)) if objective == boosting.LOGISTIC else margin
    assert np.allclose(got, expected, atol=1e-9)


def test_stops_early_and_keeps_the_best_trees(spark, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH", 2)
    x, _ = sample(200)
    noise = np.random.default_rng(9).normal(size=200)
    df = frame(spark, x, noise).withColumn("out", F.col("fid") % 4 == 0)
    model = boosting.fit(df, list("abcd"), "y", boosting.SQUARED, "out", rounds=30, leaves=6, rate=0.5, patience=3)
    every = boosting.fit(df, list("abcd"), "y", boosting.SQUARED, "out", rounds=len(model.trees) + 3, leaves=6, rate=0.5, patience=99)

    def loss(trees):
        m = boosting.LeafwiseModel(model.columns, model.objective, model.start, trees)
        return m.transform(df.filter("out")).agg(F.avg((F.col("score") - F.col("y")) ** 2)).first()[0]

    assert 0 < len(model.trees) < 30
    assert model.trees == every.trees
    losses = [loss(every.trees[:i]) for i in range(1, len(model.trees) + 1)]
    assert min(losses) == losses[-1]


def test_partitions_do_not_show_and_saving_keeps_all(spark, tmp_path):
    x, y = sample(150)
    df = frame(spark, x, y)
    one = boosting.fit(df.coalesce(1), list("abcd"), "y", boosting.SQUARED, rounds=2)
    two = boosting.fit(df.orderBy(F.rand(1)).repartition(7), list("abcd"), "y", boosting.SQUARED, rounds=2)
    assert one.trees == two.trees and one.splits()
    one.save(str(tmp_path), spark)
    loaded = boosting.LeafwiseModel.load(str(tmp_path), spark)
    assert (loaded.trees, loaded.start, loaded.columns) == (one.trees, one.start, one.columns)
    assert abs(one.importance().sum() - 1) < 1e-9


def test_awkward_rows(spark):
    schema = "a double, y double"
    nothing = boosting.fit(spark.createDataFrame([], schema), ["a"], "y", boosting.SQUARED)
    assert nothing.trees == [] and not nothing.splits() and nothing.importance().tolist() == [0.0]
    odd = [(None, 1.0)] * 30 + [(float("nan"), 1.0)] * 10 + [(2.0, 3.0)] * 40 + [(9.0, None)] * 5
    df = spark.createDataFrame(odd, schema)
    model = boosting.fit(df, ["a"], "y", boosting.SQUARED, rounds=2, rate=1.0)
    assert {(r["a"] if r["a"] == r["a"] else None, r["prediction"]) for r in model.transform(df).collect()} == {(None, 1.0), (2.0, 3.0), (9.0, 3.0)}
    same = boosting.fit(spark.createDataFrame([(1.0, float(i % 2)) for i in range(60)], schema), ["a"], "y", boosting.LOGISTIC)
    assert same.trees == [] and same.start == 0.0
