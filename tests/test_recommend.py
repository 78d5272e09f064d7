"""Sessions against a small independent model of the rules."""

import random

import pytest

from gleanwell.operators import onboarding, recommend
from gleanwell.sources import tables

KEYS = ["user_id"]


def cluster_rows(k=8, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(20)]
    rows = []
    for c in range(k):
        reps = [
            (f"h{c}-{i}", rng.randrange(6), f"text {c} {i}", float(rng.randrange(11)), rng.randrange(9), rng.randrange(4), 1.0)
            for i in range(rng.randrange(1, 6))
        ]
        rows.append((c, f"T{c % 3}", 10 + rng.randrange(90), [], rng.sample(words, 10),
                     float(rng.randrange(1, 10)), 1.0, 1.0, 1.0, reps))
    return rows


def feedback_rows(users=12, k=8, seed=4):
    rng = random.Random(seed)
    return [
        (u, s + 1, rng.randrange(k), rng.random() < 0.6, rng.randrange(6))
        for u in range(users) for s in range(rng.randrange(1, 8))
    ]


@pytest.fixture(scope="module")
def data(spark):
    clusters, feedback = cluster_rows(), feedback_rows()
    table = spark.createDataFrame(clusters, tables.CLUSTERS)
    answers = spark.createDataFrame(
        feedback, "user_id bigint, seq int, cluster_id int, liked boolean, post_idx int"
    )
    weighted = recommend.cluster_weights(recommend.sessions_from(answers, KEYS), table)
    return clusters, feedback, table, answers, weighted.persist()


def learn(clusters, answers):
    weights = {c[0]: 1.0 for c in clusters}
    by_id = {c[0]: c for c in clusters}
    for target, liked in answers:
        t = by_id[target]
        for c in clusters:
            if c[0] == target:
                weights[c[0]] *= 1.5 if liked else 0.5
            elif c[1] == t[1]:
                share = len(set(c[4]) & set(t[4])) / 10
                weights[c[0]] *= 1 + ((1.5 if liked else 1.2) - 1) * share
            else:
                weights[c[0]] *= 1 + ((0.8 if liked else 0.5) - 1) * 0.1
        top = max(weights.values())
        if top > 10:
            weights = {c: w / (top / 10) for c, w in weights.items()}
    return weights


def answers_of(feedback, user):
    return [(c, liked) for u, s, c, liked, _ in sorted(feedback) if u == user]


def test_weights(data):
    clusters, feedback, table, _, weighted = data
    got = {}
    for r in recommend.weight_rows(weighted, table, KEYS).collect():
        got.setdefault(r.user_id, {})[r.cluster_id] = r.weight
    for user, weights in got.items():
        assert weights == pytest.approx(learn(clusters, answers_of(feedback, user)))
        assert all(0 < w <= 10 for w in weights.values())


def test_weights_are_scaled_down_at_the_cap(spark, data):
    clusters, _, table, _, _ = data
    many = spark.createDataFrame([(1, i + 1, 2, True) for i in range(7)], "user_id bigint, seq int, cluster_id int, liked boolean")
    weighted = recommend.cluster_weights(recommend.sessions_from(many, KEYS), table)
    rows = {r.cluster_id: r.weight for r in recommend.weight_rows(weighted, table, KEYS).collect()}
    assert max(rows.values()) == pytest.approx(10)
    assert rows == pytest.approx(learn(clusters, [(2, True)] * 7))


def test_long_sessions_count_every_answer(spark, data):
    clusters, _, table, _, _ = data
    rows = [(1, i + 1, i % 5, i % 3 > 0) for i in range(12)]
    many = spark.createDataFrame(rows, "user_id bigint, seq int, cluster_id int, liked boolean")
    weighted = recommend.cluster_weights(recommend.sessions_from(many, KEYS), table)
    got = {r.cluster_id: r.weight for r in recommend.weight_rows(weighted, table, KEYS).collect()}
    assert got == pytest.approx(learn(clusters, [(c, liked) for _, _, c, liked in rows]))


def test_equal_weights_go_by_mean_post_score(spark):
    reps = [("h", 1, "text", 1.0, 1, 1, 1.0)]
    rows = [(c, f"T{c}", 10, [], [], 1.0, 1.0, 1.0, float(s), [(f"h{c}", *reps[0][1:])]) for c, s in ((0, 1), (1, 2), (2, 5), (3, 5))]
    table = spark.createDataFrame(rows, tables.CLUSTERS)
    disliked = spark.createDataFrame([(1, 1, 0, False)], "user_id bigint, seq int, cluster_id int, liked boolean")
    weighted = recommend.cluster_weights(recommend.sessions_from(disliked, KEYS), table)
    posts = recommend.recommended_posts(weighted, table, KEYS).orderBy("position").collect()
    assert [p.cluster_id for p in posts] == [2, 3, 1, 0]
    seen = weighted.selectExpr("*", "array(named_struct('cluster_id', 0, 'post_idx', 0)) AS shown")
    everything_of_the_chosen = seen.selectExpr("user_id", "answers", "weights", "array(named_struct('cluster_id', 9, 'post_idx', 0)) AS shown")
    assert recommend.next_post(everything_of_the_chosen, table, KEYS).count() == 1
    first = weighted.selectExpr("user_id", "cast(array() AS array<struct<seq:int,cluster_id:int,liked:boolean>>) AS answers", "weights", "cast(array() AS array<struct<cluster_id:int,post_idx:int>>) AS shown")
    assert recommend.next_post(first, table, KEYS).first().cluster_id == 2


def test_recommended_posts(data):
    clusters, feedback, table, _, weighted = data
    got = {}
    for r in recommend.recommended_posts(weighted, table, KEYS).orderBy("user_id", "position").collect():
        got.setdefault(r.user_id, []).append((r.cluster_id, r.hash))
    for user, posts in got.items():
        weights = learn(clusters, answers_of(feedback, user))
        expected = []
        for c in sorted(clusters, key=lambda c: -round(weights[c[0]], 12)):
            if weights[c[0]] < 0.5 or len(expected) >= 10:
                continue
            best = sorted(c[9], key=lambda p: p[3] * (p[4] + p[5] * 2), reverse=True)
            expected += [(c[0], p[0]) for p in best[: min(3, 10 - len(expected))]]
        assert sorted(posts) == sorted(expected)
        assert len(posts) <= 10


def test_users_to_follow(data):
    clusters, feedback, table, answers, _ = data
    got = {}
    for r in recommend.users_to_follow(answers, table, KEYS).orderBy("user_id", "rank").collect():
        got.setdefault(r.user_id, []).append((r.fid, r.score))
    reps = {c[0]: c[9] for c in clusters}
    for user in {r[0] for r in feedback}:
        points, given = {}, answers_of(feedback, user)
        for c, liked in given:
            for p in reps[c] if liked else []:
                points[p[1]] = points.get(p[1], 0) + 2.0 * p[3]
        for c, liked in given:
            for p in [] if liked else reps[c]:
                if p[1] in points:
                    points[p[1]] *= 0.5
        expected = sorted(points.items(), key=lambda x: -x[1])[:10]
        rows = got.get(user, [])
        assert dict(rows) == pytest.approx(dict(expected))
        assert [s for _, s in rows] == sorted([s for _, s in rows], reverse=True)


def test_first_question_asks_about_the_largest_good_cluster(spark, data):
    clusters, _, table, _, _ = data
    empty = spark.range(1).selectExpr(
        "id AS user_id", "cast(array() AS array<struct<seq:int,cluster_id:int,liked:boolean>>) AS answers",
        "cast(array() AS array<struct<cluster_id:int,post_idx:int>>) AS shown",
    )
    row = recommend.next_post(recommend.cluster_weights(empty, table), table, KEYS).first()
    best = max(clusters, key=lambda c: c[2] * c[5])
    appeal = [p[3] * (p[4] + p[5] * 2) for p in best[9]]
    assert (row.cluster_id, row.post_idx) == (best[0], appeal.index(max(appeal)))


def test_nothing_left_to_show_gives_no_row(spark, data):
    clusters, _, table, answers, weighted = data
    everything = [(c[0], i) for c in clusters for i in range(len(c[9]))]
    shown = spark.createDataFrame([(everything,)], "shown array<struct<cluster_id:int,post_idx:int>>")
    one = weighted.filter("user_id = 1").join(shown.selectExpr("1L AS user_id", "shown"), "user_id")
    assert recommend.next_post(one, table, KEYS).count() == 0


def test_repeated_likes_count_each_time(spark, data):
    _, _, table, _, _ = data
    twice = spark.createDataFrame([(1, 1, 2, True), (1, 2, 2, True)], "user_id bigint, seq int, cluster_id int, liked boolean")
    once = twice.filter("seq = 1")
    a = {r.fid: r.score for r in recommend.users_to_follow(twice, table, KEYS).collect()}
    b = {r.fid: r.score for r in recommend.users_to_follow(once, table, KEYS).collect()}
    assert a == pytest.approx({f: 2 * s for f, s in b.items()})


def test_narrowing_stops_after_three_rounds_and_halves_the_rest(spark):
    k = 30
    table = spark.createDataFrame(
        [(c, 100 + c, float(c), float(c)) for c in range(k)], "cluster_id int, size bigint, avg_reactions double, avg_replies double"
    )
    rounds = spark.createDataFrame(
        [(1, 1, None, [3, 4]), (1, 2, 10, [10, 11]), (1, 3, None, [5]), (1, 4, 20, [20])],
        "user_id bigint, round int, preferred int, shown array<int>",
    )
    row = onboarding.narrow_down(rounds, table, KEYS).first()
    assert row.preferences == [10] and len(row.candidates) == 11 and row.candidates[0] == 10
    far = [c for c in range(k) if c not in row.candidates and c not in (3, 4)]
    assert row.excluded == sorted({3, 4, 5, *far[: len(far) // 2]})


def test_equal_zero_profiles_are_fully_similar(spark):
    table = spark.createDataFrame([(0, 5, 0.0, 0.0), (1, 5, 0.0, 0.0)], "cluster_id int, size bigint, avg_reactions double, avg_replies double")
    assert {r.similarity for r in onboarding.similar_clusters(table).collect()} == {1.0}


def test_few_usable_clusters_are_all_picked(spark):
    table = spark.createDataFrame([(0, 500, 1.0, 1.0), (1, 400, 2.0, 2.0), (2, 50, 3.0, 3.0)], "cluster_id int, size bigint, avg_reactions double, avg_replies double")
    assert {r.cluster_id for r in onboarding.diverse_clusters(table).collect()} == {0, 1}
    assert {r.cluster_id for r in onboarding.diverse_clusters(table, excluded=[0]).collect()} == {1}
