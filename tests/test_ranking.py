import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanwell.operators import ranking
from gleanwell.operators.sampling import stratified_split


@pytest.fixture
def scored(spark):
    rng = random.Random(1)
    rows = [(f"k{i:04d}", rng.choice([None, 1.0, 2.5, 2.75, 7.0, float("nan")])) for i in range(1000)]
    return rows, spark.createDataFrame(rows, "key string, score double")


@pytest.mark.parametrize("k", [0, 1, 150, 399, 901, 1000, 5000, None])
def test_top_k_in_order_with_gaps_last(scored, k):
    rows, df = scored
    missing = lambda s: s is None or s != s
    best = sorted(rows, key=lambda r: (missing(r[1]), 0 if missing(r[1]) else -r[1], r[0]))[:k]
    assert [r.key for r in ranking.top_k(df, "score", "key", k).collect()] == [r[0] for r in best]


def largest_range(df, *order):
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        _, counts = ranking.ranged(df, *order)
        return max(r._n for r in counts.collect())
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def test_one_equal_score_is_split_by_the_key(spark):
    df = spark.range(40_000).select(F.lit(3.0).alias("_score"), F.col("id").alias("_tie"))
    assert largest_range(df, F.col("_score").desc_nulls_last(), F.col("_tie").asc()) < 10_000
    top = ranking.top_k(df, "_score", "_tie", 20_000).collect()
    assert [r._tie for r in top] == list(range(20_000))


def test_a_far_outlier_takes_no_range_from_the_others(spark):
    df = spark.range(40_000).select(F.when(F.col("id") == 0, 1e12).otherwise(F.col("id") / 40_000).alias("_v"))
    assert largest_range(df, F.col("_v").asc()) < 10_000
    row = ranking.exact_quantiles(df, "_v", {"a": 0.5, "b": 1.0}).first()
    assert row.b == 1e12 and row.a == pytest.approx((20_000 + 20_001) / 2 / 40_000, abs=1e-4)


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [5.0] * 9, list(range(101)), [0.1, 9.9, 0.1, 4.4, None]])
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    row = ranking.exact_quantiles(df, "x", {"a": 0.5, "b": 0.9, "c": 0.0, "d": 1.0}).first()
    known = [v for v in values if v is not None]
    assert list(row) == pytest.approx(list(np.quantile(known, [0.5, 0.9, 0, 1])))


def test_numbering_by_time_slices(spark):
    start = dt.datetime(2024, 1, 1)
    rng = random.Random(2)
    rows = [(i % 3, start + dt.timedelta(minutes=rng.randrange(600)), i) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, at timestamp, id int")
    got = {r.id: r.position for r in ranking.numbered_by_time(df, ["g"], "at", "id").collect()}
    for g in range(3):
        ordered = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        assert [got[r[2]] for r in ordered] == list(range(1, len(ordered) + 1))


def test_split_holds_the_share_of_every_class(spark):
    rows = [(i, int(i % 10 == 0)) for i in range(500)]
    df = spark.createDataFrame(rows, "fid bigint, label int")
    split = stratified_split(df, "label", "fid")
    assert split.count() == 500
    counts = {r.label: r.n for r in split.filter("is_test").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert counts == {0: 90, 1: 10}
