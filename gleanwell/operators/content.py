"""Scoring posts and keeping a diverse best set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.operators.ranking import exact_quantiles, top_k, top_per_group
from gleanwell.session import materialized

# Weights and caps of the content filter.
AUTHOR_WEIGHT, REACTION_WEIGHT, REPLY_WEIGHT = 0.3, 0.3, 0.4
POSTS_PER_AUTHOR = 10
CONTENT_CAP = 100_000


def one_row_per_fid(scores: DataFrame) -> DataFrame:
    """Fail on repeated ids, which would multiply posts in the join below.

    The test is a single value beside the rows, which keeps the join's exchange bare for AQE.
    """
    twice = scores.filter("fid IS NOT NULL").groupBy("fid").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    repeated = twice.agg(F.max(F.col("fid").cast("string"))).scalar()
    fid = F.when(repeated.isNull(), F.col("fid")).otherwise(
        F.raise_error(F.concat(F.lit("more than one score for "), repeated))
    )
    return scores.select(fid.alias("fid"), "quality_score", "quality_category")


def add_author_scores(posts: DataFrame, scores: DataFrame) -> DataFrame:
    """Posts with their author's score, the trusted share of engagement and the post score.

    Both sides of the join are bare exchanges, so AQE splits an author with very many posts.
    """
    qr, qp = F.col("quality_reactions"), F.col("quality_replies")
    tr, tp = F.col("total_reactions"), F.col("total_replies")
    by_author = one_row_per_fid(scores).withColumnRenamed("fid", "Fid")
    joined = posts.join(by_author, "Fid", "left")
    return joined.select(
        *posts.columns,
        "quality_score",
        "quality_category",
        ((qr + qp * 2) / (tr + tp * 2 + 1)).alias("quality_engagement_ratio"),
        (
            F.col("quality_score") * AUTHOR_WEIGHT + qr * REACTION_WEIGHT + qp * REPLY_WEIGHT
        ).alias("cast_score"),
    )


def top_posts_per_author(posts: DataFrame, n: int = POSTS_PER_AUTHOR) -> DataFrame:
    """The n best posts of every author, best posts of all first."""
    best_first = [F.col("cast_score").desc_nulls_last(), F.col("Hash").asc()]
    return top_per_group(posts, ["Fid"], best_first, n).orderBy(*best_first)


def high_quality_casts(
    posts: DataFrame, scores: DataFrame, per_author: int = POSTS_PER_AUTHOR, cap: int | None = None
) -> DataFrame:
    """The best posts, at most ``per_author`` of each author, in score order; with ``cap``
    (``CONTENT_CAP`` where memory is short) at most that many."""
    best = top_posts_per_author(add_author_scores(posts, scores), per_author)
    return best if cap is None else top_k(materialized(best), "cast_score", "Hash", cap)


def content_stats(posts: DataFrame) -> DataFrame:
    return posts.agg(
        F.count(F.lit(1)).alias("posts"),
        F.count_distinct("Fid").alias("authors"),
        F.avg("quality_score").alias("avg_author_quality"),
        F.avg("quality_reactions").alias("avg_quality_reactions"),
        F.avg("quality_replies").alias("avg_quality_replies"),
        F.avg("quality_engagement_ratio").alias("avg_engagement_ratio"),
    )


def describe(df: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, sample deviation, extremes and quartiles of a column."""
    df = materialized(df.select(column))
    quartiles = exact_quantiles(df, column, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    q = quartiles.select(F.struct("q25", "q50", "q75")).scalar()
    return df.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    ).select(
        "count", "mean", "std", "min",
        q["q25"].alias("q25"), q["q50"].alias("q50"), q["q75"].alias("q75"), "max",
    )
