"""Keywords against a small independent model, names, and representatives."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleanwell.operators import clusters, topics

TEXTS = {
    1: ["Machine learning models learn from data", "Machine learning of models; machine rooms",
        "The models and the data: machine learning!", "nothing shared here"],
    2: ["only one document in this cluster"],
    3: ["and the for", "the this"],
}


def posts_of(spark, texts=TEXTS):
    rows = [(f"h{c}-{i}", c, t, float(i)) for c, ts in texts.items() for i, t in enumerate(ts)]
    return spark.createDataFrame(rows, "Hash string, cluster_id int, Text string, cast_score double")


def model(texts, stop, size=100, top=30):
    """Weighted terms of one group of texts, straight from the definition."""
    docs = []
    for t in texts:
        words = [w for w in re.findall(r"\b\w\w+\b", t.lower()) if w not in stop]
        docs.append(Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])]))
    df = Counter(term for d in docs for term in d)
    uses = sum(docs, Counter())
    kept = sorted((t for t in df if df[t] >= 2), key=lambda t: (-uses[t], t))[:size]
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in kept}
    scores = Counter()
    for d in docs:
        w = {t: d[t] * idf[t] for t in kept if d[t]}
        norm = math.sqrt(sum(x * x for x in w.values()))
        for t, x in w.items():
            scores[t] += x / norm
    return sorted(((t, s) for t, s in scores.items()), key=lambda p: (-round(p[1], 9), p[0]))[:top]


def test_keywords_match_the_definition(spark):
    rows = topics.cluster_keywords(posts_of(spark)).filter("cluster_id = 1").orderBy("rank").collect()
    expected = model(TEXTS[1], set(topics.STOP_WORDS))
    assert [r.term for r in rows] == [t for t, _ in expected]
    assert [r.score for r in rows] == pytest.approx([s for _, s in expected])


def test_single_text_falls_back_to_counts(spark):
    rows = topics.cluster_keywords(posts_of(spark)).filter("cluster_id = 2").orderBy("rank").collect()
    assert [(r.term, r.score) for r in rows] == [("cluster", 1.0), ("document", 1.0), ("one", 1.0)]


def test_cluster_of_stop_words_has_no_keywords(spark):
    assert topics.cluster_keywords(posts_of(spark)).filter("cluster_id = 3").count() == 0


def test_word_counts_can_be_limited_to_first_texts(spark):
    texts = {1: [f"word{'abc'[i % 3]} shared" for i in range(9)]}
    df = posts_of(spark, texts)
    limited = topics.counted_words(df, [], 4, 10, first_texts=2)
    assert {r.word: r.n for r in limited.collect()} == {"worda": 1, "wordb": 1, "shared": 2}


@pytest.mark.parametrize(
    "words, name",
    [
        (["food", "recipes", "zzz"], "Food & Cooking"),
        (["painting", "artwork"], "Visual Arts"),
        (["painting", "drawing", "training"], "AI & Machine Learning"),
        (["gardens", "quiet", "xy"], "Gardens Quiet"),
        (["https", "quiet", "xy"], "Https Topics"),
        (["xy"], "Xy Topics"),
        ([], "Mixed Topics"),
    ],
)
def test_rule_names(spark, words, name):
    df = spark.createDataFrame([(words,)], "w array<string>")
    assert df.select(topics.rule_name(F.col("w"))).first()[0] == name


@pytest.mark.parametrize(
    "reply, name",
    [
        (' "Urban Gardens" ', "Urban Gardens"),
        ("Home\nand more", "Home"),
        ("It's fine", "Its fine"),
        ("one two three four five six seven eight nine ten", "one two three four five six seven eight"),
        ("x" * 50, "x" * 40),
    ],
)
def test_clean_name(spark, reply, name):
    df = spark.createDataFrame([(reply,)], "r string")
    assert df.select(topics.clean_name(F.col("r"))).first()[0] == name


def test_representatives_are_near_then_loud_without_repeats(spark):
    rows = [(f"h{i:02d}", 1, float(i), float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "Hash string, cluster_id int, distance_to_center double, reaction_count double")
    reps = clusters.representatives(df, "reaction_count", 5, 5, 10).orderBy("position").collect()
    assert [r.Hash for r in reps] == ["h00", "h01", "h02", "h03", "h04", "h29", "h28", "h27", "h26", "h25"]
    few = clusters.representatives(df.filter("distance_to_center < 3"), "reaction_count", 5, 5, 10)
    assert sorted(r.Hash for r in few.collect()) == ["h00", "h01", "h02"]


def test_failing_namer_leaves_rule_names(spark):
    records = spark.createDataFrame(
        [(1, ["gardens", "quiet"], [("first post",)])],
        "cluster_id int, top_words array<string>, representatives array<struct<text:string>>",
    )

    def broken(prompts):
        raise RuntimeError("no answer")

    assert topics.model_names(records, broken).first().model_name is None


def test_only_pairs_of_frequent_words_are_counted(spark, monkeypatch):
    text = " ".join(["alpha beta"] * 9 + [f"word{i}" for i in range(200)])
    posts = spark.createDataFrame([(c, f"h{i}", text) for c in (1, 2) for i in range(3)] + [(3, "x", "one two"), (3, "y", "one two")],
                                  "cluster_id int, Hash string, Text string")
    ranked, top = [], topics.top_per_group

    def counted(df, *args, **kwargs):
        ranked.append(df.filter("term LIKE '% %'").count())
        return top(df, *args, **kwargs)

    monkeypatch.setattr(topics, "top_per_group", counted)
    found = sorted((r.cluster_id, r.term) for r in topics.vocabulary(posts, size=2).collect())
    assert found == [(c, t) for c in (1, 2) for t in ("alpha", "alpha beta")] + [(3, t) for t in ("one", "one two")]
    assert max(ranked) == 2 * 2 + 1, ranked  # "alpha beta", "beta alpha" and "one two"; not the pairs of rare words


def test_texts_are_read_once_for_their_words_and_dealt_out_evenly(spark, monkeypatch):
    read, saved, keep = spark.sparkContext.accumulator(0), [], topics.materialized

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    def noted(df, *args):
        saved.append(keep(df, *args))
        return saved[-1]

    rows = [(i % 2, f"h{i}", f"alpha beta word{i}", 1.0) for i in range(80)]
    posts = spark.createDataFrame(rows, "cluster_id int, Hash string, Text string, cast_score double").coalesce(1)
    monkeypatch.setattr(topics, "materialized", noted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = topics.cluster_keywords(posts.mapInArrow(counted, posts.schema)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {(r.cluster_id, r.term) for r in found} == {(c, t) for c in (0, 1) for t in ("alpha", "beta", "alpha beta")}
    assert read.value == len(rows)
    lists = [df for df in saved if "words" in df.columns]
    assert len(lists) == 1 and lists[0].count() == len(rows)
    per_file = lists[0].groupBy("_metadata.file_path").count().collect()
    assert len(per_file) > 1 and max(r["count"] for r in per_file) <= len(rows) // 2
