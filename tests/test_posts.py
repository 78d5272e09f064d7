"""Hand-made posts and reactions for the cases the tables do not hold."""

import pytest

from gleanwell.operators import content, engagement, exports, features
from gleanwell.sources import tables

LONG = "a quiet text about gardens and the people who look after them every day"


def casts(spark, rows):
    return spark.createDataFrame(rows, tables.CASTS)


def reactions(spark, rows):
    return spark.createDataFrame(rows, tables.REACTIONS)


def scores(spark, pairs):
    return spark.createDataFrame([(f, s, 1, "High") for f, s in pairs], tables.SCORES)


def strict(spark, text=LONG, seconds="200000000", parent=None, author_score=5.0, by=("a", "b", "c")):
    posts = [("p", "1", text, None, seconds, parent), ("r", "9", "reply", None, seconds, "1:p")]
    acts = [(f"x{i}", f, "1:p") for i, f in enumerate(by)]
    trusted = [(f, 8.0) for f in ("a", "b", "c")] + [("1", author_score), ("9", 1.0)]
    return exports.quality_candidates(casts(spark, posts), reactions(spark, acts), scores(spark, trusted))


def test_strict_export_keeps_a_good_post(spark):
    row = strict(spark).first()
    assert (row.Hash, row.total_reactions, row.quality_reactions, row.total_replies, row.quality_replies) == (
        "p", 3, 3, 1, 0)
    assert row.engagement_score == 6 and row.timestamp == 200000000


@pytest.mark.parametrize(
    "change",
    [dict(text=None), dict(text="short"), dict(text="gm " + LONG), dict(text=LONG + " token"),
     dict(seconds="1"), dict(seconds="abc"), dict(parent="2:q"), dict(author_score=3.9),
     dict(by=("a", "b", "z"))],
)
def test_strict_export_drops(spark, change):
    assert strict(spark, **change).count() == 0


def test_empty_parent_is_top_level(spark):
    assert strict(spark, parent="").count() == 1


def test_repeated_scores_do_not_multiply_rows_but_fail_the_join(spark):
    double = scores(spark, [("1", 5.0), ("1", 6.0)])
    semi = scores(spark, [("1", 0.0)]).join(engagement.fids_scoring_at_least(double, 4), "fid", "left_semi")
    assert semi.count() == 1
    with pytest.raises(Exception, match="more than one score"):
        content.one_row_per_fid(double).collect()


def test_keys_without_hash_part_count_under_the_empty_hash(spark):
    acts = reactions(spark, [("x", "1", "abc"), ("y", "1", "5:abc"), ("z", "1", None), ("w", "1", "")])
    got = {r.target_hash: r.reaction_count for r in engagement.reaction_counts(acts).collect()}
    assert got == {"": 1, "abc": 1}


def test_author_engagement_needs_the_whole_key(spark):
    posts = casts(spark, [("h", "1", "t", None, "0", None), ("k", "2", "t", None, "0", None)])
    acts = reactions(spark, [("a", "7", "1:h"), ("b", "7", "1:h"), ("c", "8", "1:h"), ("d", "7", "2:h"),
                             (None, "9", "1:h")])
    rows = {r.fid: (r.unique_reactors, r.total_reactions) for r in engagement.author_engagement(posts, acts).collect()}
    assert rows == {"1": (3, 3)}


def test_features_of_hand_made_author(spark):
    texts = ["  GM friends", "why though?", "see HTTP://x.y", "çava bien", "free claim", "tiny", None]
    posts = casts(spark, [(f"h{i}", "1", t, None, str(i * 3600), None) for i, t in enumerate(texts)])
    row = features.user_text_features(posts).first()
    assert row.post_count == 5
    assert (row.gm_ratio, row.question_ratio, row.url_ratio, row.emoji_ratio, row.spam_ratio) == (0.2,) * 5
    words = ["friends", "why", "though", "see", "http", "bien", "free", "claim"]
    assert row.vocabulary_size == len(words) and row.vocabulary_richness == 1
    times = features.user_temporal_features(features.post_sizes(posts)).first()
    assert (times.active_hours, times.active_days, times.posting_regularity) == (5, 1, 0)
    assert times.avg_posts_per_day == 5


def test_one_post_author_has_default_times(spark):
    posts = casts(spark, [("h", "1", "a long text", None, "86400", None)])
    row = features.user_temporal_features(features.post_sizes(posts)).first()
    assert (row.posting_regularity, row.active_hours, row.active_days, row.avg_posts_per_day) == (0, 1, 1, 1)


def test_only_the_newest_posts_count(spark):
    posts = casts(spark, [(f"h{i:03d}", "1", "old text" if i < 5 else "newer text", None, str(i), None) for i in range(12)])
    assert features.user_text_features(posts, recent=7).first().min_length == len("newer text")
    assert features.user_temporal_features(features.post_sizes(posts), recent=2).first().avg_posts_per_day == 2


def test_author_without_countable_text_vanishes(spark):
    posts = casts(spark, [(f"h{i}", "1", "abc", None, str(i), None) for i in range(12)])
    acts = reactions(spark, [("a", "7", "1:h1")])
    assert features.user_features(posts, acts).count() == 0


def test_top_posts_per_author_never_exceed_the_limit(spark):
    rows = [(f"h{i}", str(i % 2), float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "Hash string, Fid string, cast_score double")
    kept = content.top_posts_per_author(df).collect()
    assert len(kept) == 20 and min(r.cast_score for r in kept) == 30
