"""What travels between tasks: places instead of posts, few blocks instead of many."""

import numpy as np
import pytest

from gleanwell.operators import density, recommend
from gleanwell.sources import tables

KEYS = ["user_id"]


@pytest.fixture(scope="module")
def told(spark):
    rep = lambda c, i: (f"h{c}-{i}", c * 3 + i % 2, f"text {9 - i} of {c % 2}", float(i), i, c, 1.0)
    rows = [(c, f"T{c % 2}", 10, [], [f"w{c}", "both"], 1.0, 1.0, 1.0, float(c), [rep(c, i) for i in range(5)]) for c in range(6)]
    table = spark.createDataFrame(rows, tables.CLUSTERS)
    answers = [(u, s, (u * s) % 6, (u + s) % 3 > 0) for u in range(9) for s in range(1, 8)] + [(8, 8, 99, True)]
    feedback = spark.createDataFrame(answers, "user_id bigint, seq int, cluster_id int, liked boolean")
    return table, feedback, recommend.cluster_weights(recommend.sessions_from(feedback, KEYS), table)


def test_places_give_the_same_combined_rows(spark, told):
    table, feedback, weighted = told
    summary, users = recommend.preference_summary(feedback, table, KEYS), recommend.users_to_follow(feedback, table, KEYS)
    want = recommend.combined_output(summary, recommend.recommended_posts(weighted, table, KEYS), users, KEYS)
    got = recommend.combined_output(summary, recommend.recommended_places(weighted, table, KEYS), users, KEYS, table)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(got.collect()) == sorted(want.collect())


def test_authors_to_follow_are_counted_without_their_texts(told):
    table, feedback, _ = told
    plan = recommend.users_to_follow(feedback, table, KEYS)._jdf.queryExecution().optimizedPlan().toString()
    assert all("text" not in line for line in plan.split("\n") if "Aggregate" in line or "Window" in line)


def test_blocks_stay_few(spark, monkeypatch):
    x = np.random.default_rng(1).normal(size=(500, 6)).round(3)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    monkeypatch.setattr(density, "CELLS", 100)
    points = density.Points(rows, "id", "v", block=2)
    assert len(points.about) <= 2 * max(density.BLOCKS, 2 * spark.sparkContext.defaultParallelism)
    apart = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    cores = density.core_distances(points, 4)
    got = sorted(c for r in cores.collect() for c in r["core"])
    assert got == pytest.approx(sorted(np.sort(apart, axis=1)[:, 4]), abs=1e-6)
    weights = sorted(r["w"] for r in density.spanning_tree(points, cores).collect())
    reach = np.maximum(apart, np.maximum.outer(np.sort(apart, axis=1)[:, 4], np.sort(apart, axis=1)[:, 4]))
    inside, best, want = np.zeros(500, bool), reach[0].copy(), []
    inside[0] = True
    for _ in range(499):
        at = int(np.argmin(np.where(inside, np.inf, best)))
        want.append(best[at])
        inside[at] = True
        best = np.minimum(best, reach[at])
    assert weights == pytest.approx(sorted(want), abs=1e-6)
