"""Choosing a varied set of authors for labelling, and train/test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanwell.functions.scalars import post_moment, post_seconds, shuffled_by
from gleanwell.operators.features import ACTIVITY_MIN_CHARS, MIN_POSTS
from gleanwell.operators.ranking import exact_quantiles, newest_first, top_k, top_per_group

# Population and sample sizes, and the posts kept per author.
POPULATION_CAP = 1_000_000
SAMPLE_SIZE = 10_000
LEAST_PER_SEGMENT = 100
POSTS_SHOWN = 50
SEED = 42


def user_activity(casts: DataFrame, min_posts: int = MIN_POSTS) -> DataFrame:
    """Activity figures of every author with enough countable posts."""
    text = F.col("Text")
    start = F.lower(F.left(text, F.lit(len("good morning"))))
    seconds = post_seconds(F.col("Timestamp"))
    greeting = start.startswith("gm") | start.startswith("good morning")
    return (
        casts.filter(F.length(text) > ACTIVITY_MIN_CHARS)
        .groupBy(F.col("Fid").alias("fid"))
        .agg(
            F.count(F.lit(1)).alias("post_count"),
            F.avg(F.length(text)).alias("avg_text_length"),
            F.max(seconds).alias("last_post_time"),
            F.min(seconds).alias("first_post_time"),
            F.count_if(greeting).alias("gm_posts"),
            F.count_if(text.contains("?")).alias("question_posts"),
            F.count_distinct(F.date_trunc("day", post_moment(seconds))).alias("active_days"),
        )
        .filter(F.col("post_count") >= min_posts)
        .withColumns(
            {
                "posts_per_day": F.col("post_count") / (F.col("active_days") + 1),
                "gm_ratio": F.col("gm_posts") / F.col("post_count"),
                "question_ratio": F.col("question_posts") / F.col("post_count"),
            }
        )
    )


def most_active(activity: DataFrame, cap: int | None = None) -> DataFrame:
    """Authors by number of posts; ``cap`` (``POPULATION_CAP`` where memory is short) keeps the first."""
    return top_k(activity, "post_count", "fid", cap)


def user_segments(activity: DataFrame, min_posts: int = MIN_POSTS) -> DataFrame:
    """One row per author and segment; an author may be in several."""
    cuts = exact_quantiles(activity, "post_count", {"q50": 0.5, "q90": 0.9})
    q = cuts.select(F.struct("q50", "q90")).scalar()
    posts = F.col("post_count")
    tests = {
        "high_volume": posts > F.col("_q")["q90"],
        "medium_volume": (posts > F.col("_q")["q50"]) & (posts <= F.col("_q")["q90"]),
        "low_volume": (posts >= min_posts) & (posts <= F.col("_q")["q50"]),
        "high_gm": F.col("gm_ratio") > 0.3,
        "questioners": F.col("question_ratio") > 0.2,
        "long_form": F.col("avg_text_length") > 200,
        "short_form": F.col("avg_text_length") < 50,
    }
    names = F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()]))
    return activity.withColumn("_q", q).select("fid", F.explode(names).alias("segment"))


N_SEGMENTS = 7


def segment_sample(segments: DataFrame, n_samples: int = SAMPLE_SIZE, seed: int = SEED) -> DataFrame:
    """An equal share per segment, drawn without replacement and repeatably."""
    share = max(n_samples // N_SEGMENTS, LEAST_PER_SEGMENT)
    drawn = segments.withColumn(
        "_draw", shuffled_by([F.col("fid"), F.col("segment"), seed])
    )
    return top_per_group(
        drawn, ["segment"], [F.col("_draw").asc(), F.col("fid").asc()], share
    ).drop("_draw")


def sampled_users(
    activity: DataFrame, n_samples: int = SAMPLE_SIZE, seed: int = SEED
) -> DataFrame:
    """Exactly ``n_samples`` author ids if there are that many: segment draws first, then others."""
    picked = (
        segment_sample(user_segments(activity), n_samples, seed).select("fid").distinct()
        .withColumn("_picked", F.lit(1))
    )
    drawn = activity.select("fid").join(picked, "fid", "left").select(
        "fid",
        F.coalesce("_picked", F.lit(0)).alias("from_segment"),
        shuffled_by([F.col("fid"), seed]).alias("_draw"),
    )
    return (
        drawn.orderBy(F.col("from_segment").desc(), F.col("_draw").asc(), F.col("fid").asc())
        .limit(n_samples)
        .select("fid", "from_segment")
    )


def users_to_label(
    casts: DataFrame, activity: DataFrame, sampled: DataFrame, posts_shown: int = POSTS_SHOWN
) -> DataFrame:
    """The sampled authors with their figures and newest posts, ready for labelling.

    A semi join leaves the posts of sampled authors; Spark copies a small sample to the tasks.
    """
    posts = casts.filter(F.length("Text") > ACTIVITY_MIN_CHARS).select(
        F.col("Fid").alias("fid"), "Hash", "Text",
        post_seconds(F.col("Timestamp")).alias("timestamp"),
    )
    of_sampled = posts.join(sampled.select("fid"), "fid", "left_semi")
    newest = top_per_group(of_sampled, ["fid"], newest_first(), posts_shown, rank="pos")
    collected = newest.groupBy("fid").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("pos", "Text"))), lambda p: p["Text"]
        ).alias("posts")
    )
    stats = activity.select("fid", "post_count", "avg_text_length", "gm_ratio", "question_ratio")
    return collected.join(stats, "fid").select(
        F.col("fid").cast("bigint").alias("fid"),
        "posts",
        "post_count",
        "avg_text_length",
        "gm_ratio",
        "question_ratio",
        F.element_at("posts", 1).alias("sample_post"),
    )


def sample_summary(users: DataFrame) -> DataFrame:
    """Range and mean of the three figures shown for a sample."""
    return users.agg(
        F.count(F.lit(1)).alias("users"),
        *[
            f(c).alias(f"{name}_{c}")
            for c in ("post_count", "avg_text_length", "gm_ratio")
            for name, f in (("min", F.min), ("max", F.max), ("avg", F.avg))
        ],
    )


def stratified_split(
    df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = SEED
) -> DataFrame:
    """Adds ``is_test``: the given share of every class, drawn repeatably.

    Rows are put in order by a hash. Positions are counted per (class, hash slice) and shifted
    by the earlier slices, so a class that holds most rows is still spread over many tasks.
    """
    drawn = df.withColumn("_draw", shuffled_by([F.col(key), seed]))
    drawn = drawn.withColumn("_slice", F.left("_draw", F.lit(3)))
    whole = Window.partitionBy(label)
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        drawn.groupBy(label, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            label,
            "_slice",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"),
            F.sum("_n").over(whole).alias("_size"),
        )
    )
    inner = Window.partitionBy(label, "_slice").orderBy("_draw", key)
    position = F.col("_shift") + F.col("_pos")
    return (
        drawn.withColumn("_pos", F.row_number().over(inner))
        .join(slices, [label, "_slice"])
        .withColumn("is_test", position <= F.ceil(F.col("_size") * F.lit(test_share)))
        .drop("_draw", "_slice", "_shift", "_size", "_pos")
    )
