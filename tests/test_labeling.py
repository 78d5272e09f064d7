import json

import pytest
from pyspark.sql import functions as F

from gleanwell.operators import labeling
from gleanwell.sources import tables


def users(spark, n=3, posts=2, chars=10):
    rows = [(i, [f"{j} " + "x" * chars for j in range(posts)], posts, 12.5, 0.1237, 0.0, "s") for i in range(n)]
    return spark.createDataFrame(rows, tables.USERS_TO_LABEL)


def parsed(spark, text):
    df = spark.createDataFrame([(text,)], "reply string")
    r = labeling.parse_replies(df).first()
    return r.quality_score, r.category, list(r.content_themes), r.reasoning


@pytest.mark.parametrize(
    "text, expected",
    [
        ("SCORE: 7/10\nCATEGORY: Low\nTHEMES: a, b\nREASONING: fine", (7.0, "High", ["a", "b"], "fine")),
        ("  SCORE: 2.5 of 10 \n", (2.5, "Spammer", ["general"], labeling.NO_REASON)),
        ("CATEGORY: High", (5.0, "High", ["general"], labeling.NO_REASON)),
        ("CATEGORY:\nTHEMES:", (5.0, "Average", [""], labeling.NO_REASON)),
        ("SCORE: high\nREASONING: x", (5.0, "Average", ["general"], labeling.BAD_REPLY)),
        ("SCORE:\nSCORE: 3", (5.0, "Average", ["general"], labeling.BAD_REPLY)),
        ("SCORE: 3\nSCORE: 9.1", (9.1, "Leader", ["general"], labeling.NO_REASON)),
        ("no structure", (5.0, "Average", ["general"], labeling.NO_REASON)),
        (None, (5.0, "Average", ["general"], labeling.BAD_REPLY)),
    ],
)
def test_parse(spark, text, expected):
    assert parsed(spark, text) == expected


def test_prompt_shows_thirty_short_posts(spark):
    prompt = labeling.user_prompts(users(spark, 1, posts=40, chars=200)).first().prompt
    lines = [x for x in prompt.split("\n") if x.startswith("- ")]
    assert len(lines) == 30 and all(len(x) == 2 + 150 + 3 and x.endswith("...") for x in lines)
    assert "Mean post length: 12 characters" in prompt and "12.37%" in prompt
    assert all(f"{kind}:" in prompt for kind in labeling.REPLY_KINDS)


def test_batches_hold_every_user_once(spark):
    rows = labeling.batch_prompts(users(spark, 200), size=5).collect()
    ids = [i for r in rows for i in r.fids]
    assert sorted(ids) == list(range(200)) and max(len(r.fids) for r in rows) <= 5


def test_failed_calls(spark):
    def broken(prompts):
        raise ValueError("no model")

    rows = labeling.label_users(users(spark), broken).collect()
    assert {(r.quality_score, r.category, r.reasoning) for r in rows} == {
        (5.0, "Average", "Error during batch processing: no model")}
    assert labeling.label_users(users(spark), broken, drop_failed=True).count() == 0


def test_invalid_rating_drops_the_whole_reply(spark):
    def rating(**kw):
        return {"fid": 1, "quality_score": 7.0, "category": "High", "reasoning": "r", "content_themes": ["a"], **kw}

    replies = [[rating(), rating(fid=2)], [rating(fid=3), rating(quality_score=11)], [rating(fid=4, category=None)], []]
    texts = [json.dumps({"ratings": r}) for r in replies] + ["not json", None]
    df = spark.createDataFrame([(t,) for t in texts], "reply string")
    assert sorted(r.fid for r in labeling.parse_ratings(df).collect()) == [1, 2]


def test_counts_and_examples(spark):
    df = spark.createDataFrame([(3, "Low"), (1, "Low"), (2, "High")], "fid bigint, category string")
    counts = {r.category: r.users for r in labeling.category_counts(df).collect()}
    assert counts == {"Spammer": 0, "Low": 2, "Average": 0, "High": 1, "Leader": 0}
    assert [(r.category, r.fid) for r in labeling.first_per_category(df).collect()] == [("Low", 1), ("High", 2)]
