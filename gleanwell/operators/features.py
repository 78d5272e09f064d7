"""Behaviour features per author."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanwell.functions import rules
from gleanwell.functions.scalars import post_moment, post_seconds, ratio, words_of
from gleanwell.operators import word_sets
from gleanwell.operators.engagement import author_engagement
from gleanwell.operators.ranking import newest_first, top_per_group
from gleanwell.session import dropped, materialized, scratch_folder

# How many posts make an author active, and how many recent ones are looked at.
MIN_POSTS = 10
FEATURE_MIN_CHARS = 5
ACTIVITY_MIN_CHARS = 10
RECENT_TEXTS = 100
RECENT_TIMES = 1000
# Bytes of word sets that are dealt to their authors at a time, and in how many parts at most.
ROUND_BYTES, ROUNDS = 1 << 28, 24

TEXT_FEATURES = [
    "avg_length", "median_length", "std_length", "min_length", "max_length", "vocabulary_size",
    "vocabulary_richness", "gm_ratio", "question_ratio", "url_ratio", "emoji_ratio", "spam_ratio",
    "post_count",
]
TEMPORAL_FEATURES = ["posting_regularity", "active_hours", "active_days", "avg_posts_per_day"]
ENGAGEMENT_FEATURES = [
    "unique_reactors", "total_reactions", "avg_reactions_per_post", "reactor_diversity",
]
TEXT_FACTS = ["chars", "n_words", "gm", "question", "url", "emoji", "spam", "words", "word_bytes"]
FEATURES = TEXT_FEATURES + TEMPORAL_FEATURES + ENGAGEMENT_FEATURES


def active_users(casts: DataFrame, min_posts: int = MIN_POSTS) -> DataFrame:
    """Authors with enough posts that have a text."""
    return (
        casts.filter(F.col("Text").isNotNull())
        .groupBy(F.col("Fid").alias("fid"))
        .agg(F.count(F.lit(1)).alias("posts"))
        .filter(F.col("posts") >= min_posts)
        .select("fid")
    )


def _measured(texts: DataFrame) -> DataFrame:
    """``Text`` replaced by what the features need of it: length, pattern tests and words without repeats."""
    others = [c for c in texts.columns if c != "Text"]
    text, lower = F.col("Text"), F.col("_lower")
    spelt = texts.withColumn("_lower", F.lower(text)).withColumn("_words", words_of(lower, 3))
    return spelt.select(
        *others,
        F.length(text).alias("chars"),
        F.size("_words").alias("n_words"),
        lower.rlike(r"(?U)\A\s*(?:gm|good morning)").alias("gm"),
        text.contains("?").alias("question"),
        lower.contains("http").alias("url"),
        (F.octet_length(text) > F.length(text)).alias("emoji"),
        rules.mentions_any(text, rules.FEATURE_SPAM).alias("spam"),
        F.array_distinct("_words").alias("own"),
    )


def text_facts(texts: DataFrame) -> DataFrame:
    """The facts of each text, for texts that are stored once for several posts.

    Joined to posts they stand in for ``Text`` in all functions here. The table is written. A text's
    words take one or two bytes each, since most of them are numbers; they stay in the table, and posts
    carry the number of their text's words there (``words``, which names the table in its metadata).
    """
    measured = materialized(_measured(texts))
    coded = word_sets.coded(measured, "own")
    size = F.octet_length("coded") + F.aggregate("rest", F.lit(0), lambda n, w: n + F.octet_length(w) + 8)
    folder = scratch_folder(texts.sparkSession)
    table = materialized(coded.withColumns({"words": F.monotonically_increasing_id(), "word_bytes": size}), folder)
    dropped(measured)
    return table.drop("coded", "rest").withMetadata("words", {"table": folder})


def feature_posts(casts: DataFrame) -> DataFrame:
    """Posts long enough to count, with their time as a number and their text or its facts."""
    others = [c for c in casts.columns if c == "Text" or c in TEXT_FACTS]
    return casts.filter(_chars(casts) > FEATURE_MIN_CHARS).select(
        F.col("Fid").alias("fid"), "Hash", *others, post_seconds(F.col("Timestamp")).alias("timestamp")
    )


def _chars(casts: DataFrame) -> Column:
    return F.col("chars") if "chars" in casts.columns else F.length("Text")


def post_sizes(casts: DataFrame) -> DataFrame:
    """All that the features other than text need of a post: ids, time, text length."""
    return casts.select(
        F.col("Fid").alias("fid"), "Hash", _chars(casts).alias("chars"),
        post_seconds(F.col("Timestamp")).alias("timestamp"),
    )


def user_text_features(casts: DataFrame, recent: int = RECENT_TEXTS) -> DataFrame:
    """Length, vocabulary and pattern features over each author's newest texts.

    One grouping of at most ``recent`` texts per author, each with its repeated words removed. Posts
    may come with the columns of ``text_facts`` in place of ``Text``; then no text is moved, words only
    in ``_vocabularies``, and the features are written.
    """
    newest = top_per_group(feature_posts(casts), ["fid"], newest_first(), recent)
    length = F.col("chars")

    def share(test):
        return F.avg(F.col(test).cast("double"))

    if "chars" in casts.columns:
        facts = newest
        words = [F.collect_set("words").alias("_sets"), F.sum("word_bytes").alias("_bytes")]
    else:
        facts = _measured(newest)
        words = [F.array_distinct(F.flatten(F.collect_list("own"))).alias("_own")]
    shape = facts.groupBy("fid").agg(
        F.avg(length).alias("avg_length"),
        F.median(length).alias("median_length"),
        F.stddev_pop(length).alias("std_length"),
        F.min(length).cast("bigint").alias("min_length"),
        F.max(length).cast("bigint").alias("max_length"),
        *words,
        F.sum("n_words").alias("_n_words"),
        share("gm").alias("gm_ratio"),
        share("question").alias("question_ratio"),
        share("url").alias("url_ratio"),
        share("emoji").alias("emoji_ratio"),
        share("spam").alias("spam_ratio"),
        F.count(F.lit(1)).alias("post_count"),
    )
    if "chars" in casts.columns:
        shape = materialized(shape.withColumn("_author", F.monotonically_increasing_id()))
        table = casts.sparkSession.read.parquet(casts.schema["words"].metadata["table"])
        shape = shape.join(_vocabularies(shape, table), "_author")
    else:
        shape = shape.withColumn("vocabulary_size", F.size("_own").cast("bigint"))
    richness = ratio(F.col("vocabulary_size"), F.col("_n_words"))
    return shape.withColumn("vocabulary_richness", richness).select("fid", *TEXT_FEATURES)


def _vocabularies(shape: DataFrame, table: DataFrame) -> DataFrame:
    """``_author, vocabulary_size``: the different words in the sets of ``table`` that an author's texts name.

    A set is moved once to each author with a text of those words. Authors take turns in rounds of
    about ``ROUND_BYTES``, or a share of ``ROUNDS``, whose exchanges are deleted before the next.
    """
    rounds = min(ROUNDS, -(-(shape.agg(F.sum("_bytes")).first()[0] or 0) // ROUND_BYTES)) or 1
    folder = scratch_folder(shape.sparkSession)
    sets = table.select("words", "coded", "rest")
    for turn in range(rounds):
        named = shape.filter(F.pmod(F.xxhash64("_author"), F.lit(rounds)) == turn) if rounds > 1 else shape
        each = named.select("_author", F.explode("_sets").alias("words")).join(sets, "words")
        lists = each.repartition("_author").groupBy("_author").agg(F.collect_list("coded").alias("_coded"), F.collect_list("rest").alias("_rest"))
        size = word_sets.union_size(F.col("_coded"), F.col("_rest"))
        found = materialized(lists.select("_author", size.alias("vocabulary_size")), folder, "append")
    return found


def user_temporal_features(sizes: DataFrame, recent: int = RECENT_TIMES) -> DataFrame:
    """When each author posts, over their newest posts.

    Hours are collected in a bit set and days are counted where the sorted date changes, so the
    whole feature set is one pass over the already sorted rows. ``sizes`` comes from ``post_sizes``.
    """
    slim = sizes.filter(F.col("chars") > FEATURE_MIN_CHARS).select("fid", "Hash", "timestamp")
    newest = top_per_group(slim, ["fid"], newest_first(), recent)
    older = Window.partitionBy("fid").orderBy(*newest_first())
    moment = post_moment(F.col("timestamp"))
    steps = newest.select(
        "fid",
        F.hour(moment).alias("hour"),
        F.to_date(moment).alias("date"),
        (F.col("timestamp") - F.lead("timestamp").over(older)).alias("gap"),
        F.lead(F.to_date(moment)).over(older).alias("older_date"),
    )
    many = F.count(F.lit(1)) >= 2
    days = F.count_if(~F.col("date").eqNullSafe(F.col("older_date")))
    span = F.date_diff(F.max("date"), F.min("date")) + 1
    return steps.groupBy("fid").agg(
        F.when(many, F.stddev_pop("gap")).otherwise(0.0).alias("posting_regularity"),
        F.when(many, F.bit_count(F.bit_or(F.expr("shiftleft(1, hour)"))))
        .otherwise(1).cast("bigint").alias("active_hours"),
        F.when(many, days).otherwise(1).cast("bigint").alias("active_days"),
        F.when(many, F.count(F.lit(1)) / span).otherwise(1.0).alias("avg_posts_per_day"),
    )


def user_engagement(sizes: DataFrame, reactions: DataFrame) -> DataFrame:
    """Reactors and reactions over all of an author's posts, per post with a countable text."""
    posts = (
        sizes.filter(F.col("chars") > FEATURE_MIN_CHARS)
        .groupBy("fid")
        .agg(F.count(F.lit(1)).alias("texts"))
    )
    total, unique = F.col("total_reactions"), F.col("unique_reactors")
    return (
        posts.join(author_engagement(sizes, reactions), "fid", "left")
        .fillna(0, ["unique_reactors", "total_reactions"])
        .select(
            "fid",
            "unique_reactors",
            "total_reactions",
            ratio(total, F.col("texts")).alias("avg_reactions_per_post"),
            ratio(unique, total).alias("reactor_diversity"),
        )
    )


def user_features(casts: DataFrame, reactions: DataFrame, min_posts: int = MIN_POSTS) -> DataFrame:
    """All features of every active author that has a countable text.

    The texts, or the facts of ``text_facts`` in their place, are read twice: once for their lengths,
    which are written down for all features but the text ones, and once for the newest texts.
    Authors are only joined one row each: each task cuts an author to the newest posts before
    any exchange, however many posts there are. Each kind of feature is written, so that only its own
    exchanges lie on disk while it is built.
    """
    sizes = materialized(post_sizes(casts))
    active = (
        sizes.filter(F.col("chars").isNotNull())
        .groupBy("fid")
        .agg(F.count(F.lit(1)).alias("posts"))
        .filter(F.col("posts") >= min_posts)
        .select("fid")
    )
    kinds = [
        materialized(user_text_features(casts)), materialized(user_temporal_features(sizes)),
        materialized(user_engagement(sizes, reactions)),
    ]
    joined = kinds[0].join(kinds[1], "fid").join(kinds[2], "fid").join(active, "fid")
    filled = [
        F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in FEATURES
    ]
    return joined.select("fid", *filled)


def feature_stats(features: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per feature with its mean and sample deviation."""
    columns = columns or [c for c in features.columns if c != "fid"]
    wide = features.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_samp(c).alias(f"{c}_std") for c in columns],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"), F.col(f"{c}_mean").alias("mean"), F.col(f"{c}_std").alias("std")
            )
            for c in columns
        ]
    )
    return wide.select(F.inline(rows))
