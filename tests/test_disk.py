"""What lies on disk while author features are built: exchanges of one step, and no words with the posts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanwell.operators import density, engagement, features
from gleanwell.session import materialized


def exchanges(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    found = set()
    while files.hasNext():
        name = files.next().getName()
        if name.startswith("shuffle_"):
            found.add(name)
    return found


def test_a_written_table_leaves_no_exchange(spark):
    before = exchanges(spark)
    table = materialized(spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count())
    assert exchanges(spark) <= before
    assert table.count() == 7


@pytest.fixture(scope="module")
def told(spark):
    draw = random.Random(8)
    words = ["".join(draw.choices("abcdef", k=draw.choice([3, 4]))) for _ in range(200)]
    texts = [(i, " ".join(draw.choices(words, k=draw.randint(2, 40)))) for i in range(30)]
    posts = [(str(i), draw.choice(["1", "2", "3:4", "3", "", None]), str(i), draw.choice([0, draw.randrange(30)])) for i in range(300)]
    acts = []
    for i in range(900):
        h, f, _, _ = posts[draw.randrange(300)]
        acts.append((draw.choice([str(i), None]), draw.choice(["a", "b", "c", None]), draw.choice([f"{f}:{h}", f"{f}:{h}", "7:1", "x", None])))
    return (spark.createDataFrame(texts, "doc_id long, Text string"), spark.createDataFrame(posts, "Hash string, Fid string, Timestamp string, doc_id long"),
            spark.createDataFrame(acts, "Hash string, Fid string, TargetCastId string"))


def test_words_stay_in_their_table(told):
    texts, posts, _ = told
    casts = posts.join(features.text_facts(texts), "doc_id")
    assert all(kind not in ("binary", "array<string>") for _, kind in casts.dtypes)


@pytest.mark.parametrize("most", [3, 24])
def test_vocabularies_in_rounds(told, monkeypatch, most):
    texts, posts, _ = told
    want = features.user_text_features(posts.join(texts, "doc_id")).collect()
    monkeypatch.setattr(features, "ROUND_BYTES", 100)
    monkeypatch.setattr(features, "ROUNDS", most)
    got = features.user_text_features(posts.join(features.text_facts(texts), "doc_id")).collect()
    key = lambda r: str(r.fid)
    assert len(want) == 6
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g.fid == w.fid and tuple(g)[1:] == pytest.approx(tuple(w)[1:])


@pytest.mark.parametrize("rows", [1, 200, 10_000])
def test_engagement_in_rounds(told, monkeypatch, rows):
    _, posts, acts = told
    posts = posts.unionByName(posts.limit(50))
    keys = [(r.Fid, f"{r.Fid}:{r.Hash}") for r in posts.collect() if r.Fid is not None]
    told_acts = acts.collect()
    want = {}
    for fid, key in keys:
        for act in (a for a in told_acts if a.TargetCastId == key):
            who, n = want.setdefault(fid, (set(), []))
            who.add(act.Fid)
            n.append(act.Hash is not None)
    monkeypatch.setattr(engagement, "ROUND_ROWS", rows)
    got = engagement.author_engagement(posts.select(F.col("Fid").alias("fid"), "Hash"), acts).collect()
    assert {r.fid: (r.unique_reactors, r.total_reactions) for r in got} == {f: (len(who - {None}), sum(n)) for f, (who, n) in want.items()}


def test_any_number_of_vectors_is_laid_out(spark):
    many = spark.range(200_001).select("id", F.array(F.col("id").cast("double")).alias("v"))
    points = density.Points(many, "id", "v")
    assert points.n == 200_001 and sum(r["n"] for r in points.blocks.select(F.size("w").alias("n")).collect()) == points.n


@pytest.fixture(scope="module")
def vectors(spark):
    x = np.random.default_rng(4).normal(size=(600, 6)).round(2)
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<float>"), x


def test_long_vectors_take_more_blocks(vectors, monkeypatch):
    monkeypatch.setattr(density, "BLOCK", 1)
    monkeypatch.setattr(density, "BLOCK_NUMBERS", 30)
    assert len(density.Points(vectors[0], "id", "v", block=1).names) > 100


def test_blocks_are_read_and_not_exchanged(vectors, monkeypatch):
    plans, keep = [], density.materialized

    def noted(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, *args)

    points = density.Points(vectors[0], "id", "v", block=30)
    monkeypatch.setattr(density, "materialized", noted)
    cores = density.core_distances(points, 3)
    assert len(plans) == 1 and "Exchange" not in plans[0]
    x = vectors[1].astype(np.float32).astype(float)
    apart = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert sorted(c for r in cores.collect() for c in r["core"]) == pytest.approx(sorted(np.sort(apart, axis=1)[:, 3]), abs=1e-6)


def test_a_large_component_leaves_itself_out(vectors):
    """Two groups far apart and one point between: late rounds have a component of most points."""
    x = np.concatenate([vectors[1][:150], vectors[1][150:200] + 40, [[20.0] * 6]])
    rows = vectors[0].sparkSession.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    points = density.Points(rows, "id", "v", block=20)
    cores = density.core_distances(points, 3)
    apart = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)), density.PLACES)
    core = np.sort(apart, axis=1)[:, 3]
    reach = np.maximum(apart, np.maximum.outer(core, core))
    near, left, want = reach[0].copy(), set(range(1, len(x))), []
    while left:
        i = min(left, key=lambda r: near[r])
        left.remove(i)
        want.append(near[i])
        near = np.minimum(near, reach[i])
    assert sorted(r["w"] for r in density.spanning_tree(points, cores).collect()) == pytest.approx(sorted(want))
