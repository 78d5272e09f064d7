"""How often posts were reacted to and replied to, and by whom.

Two key rules exist side by side: by the hash part of ``fid:hash`` alone (counts per post) and by
the whole key (counts per author). They give different results and are not unified.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.functions.scalars import has_value, key_part
from gleanwell.session import dropped, materialized, scratch_folder

QUALITY_FROM = 7.0
INCLUDED_FROM = 4.0
REACTION_POINTS, REPLY_POINTS = 2, 5
# Reactions that meet their posts at a time, and in how many parts at most.
ROUND_ROWS, ROUNDS = 5_000_000, 24


def fids_scoring_at_least(scores: DataFrame, threshold: float) -> DataFrame:
    """The author ids whose score reaches the threshold, for semi joins; an id may be there several times."""
    return scores.filter(F.col("quality_score") >= threshold).select("fid")


def count_per_target(df: DataFrame, key: str, target: str, count: str) -> DataFrame:
    """Rows per target hash; rows without a key are left out."""
    return (
        df.filter(has_value(F.col(key)))
        .groupBy(key_part(F.col(key)).alias(target))
        .agg(F.count(F.lit(1)).alias(count))
    )


def reaction_counts(reactions: DataFrame) -> DataFrame:
    return count_per_target(reactions, "TargetCastId", "target_hash", "reaction_count")


def reply_counts(casts: DataFrame) -> DataFrame:
    return count_per_target(casts, "ParentCastId", "parent_hash", "reply_count")


def quality_count_per_target(
    df: DataFrame,
    key: str,
    quality_fids: DataFrame,
    target: str,
    total: str,
    quality: str,
) -> DataFrame:
    """Rows per target hash, and how many of them come from quality authors.

    All rows are counted straight from the scan, combined in every task before their one
    exchange. Trusted rows are what a semi join on the author leaves, counted likewise; an author
    who writes a third of all rows is split by AQE, as both sides of that join are bare exchanges.
    """
    keyed = df.filter(has_value(F.col(key))).select(
        key_part(F.col(key)).alias(target), F.col("Fid").alias("_fid")
    )
    members = quality_fids.select(F.col("fid").alias("_fid"))
    trusted = keyed.join(members, "_fid", "left_semi").groupBy(target).agg(F.count(F.lit(1)).alias(quality))
    everyone = keyed.groupBy(target).agg(F.count(F.lit(1)).alias(total))
    both = everyone.join(trusted.withColumnRenamed(target, "_target"), F.expr(f"{target} <=> _target"), "left")
    return both.select(target, total, F.coalesce(quality, F.lit(0)).alias(quality))


def quality_reactions(reactions: DataFrame, quality_fids: DataFrame) -> DataFrame:
    return quality_count_per_target(
        reactions, "TargetCastId", quality_fids,
        "target_hash", "total_reactions", "quality_reactions",
    )


def quality_replies(casts: DataFrame, quality_fids: DataFrame) -> DataFrame:
    return quality_count_per_target(
        casts, "ParentCastId", quality_fids, "parent_hash", "total_replies", "quality_replies"
    )


def with_engagement(
    posts: DataFrame, casts: DataFrame, reactions: DataFrame, quality_fids: DataFrame
) -> DataFrame:
    """Posts with all and trusted reactions and replies, and the engagement score.

    Both counts have one row per post hash, so the posts are exchanged once for the two joins.
    """
    counts = ["total_reactions", "quality_reactions", "total_replies", "quality_replies"]
    return (
        posts.join(
            quality_reactions(reactions, quality_fids), F.col("Hash") == F.col("target_hash"), "left"
        )
        .join(quality_replies(casts, quality_fids), F.col("Hash") == F.col("parent_hash"), "left")
        .select(*posts.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
        .withColumn(
            "engagement_score",
            F.col("quality_reactions") * REACTION_POINTS + F.col("quality_replies") * REPLY_POINTS,
        )
    )


def author_engagement(casts: DataFrame, reactions: DataFrame) -> DataFrame:
    """Distinct reactors and reactions per author, matched on the whole ``fid:hash`` key.

    What both sides need is written first, with a part by the author's id up to its first colon, which
    the whole key begins with: all keys of an author lie in one part. Parts meet in rounds of about
    ``ROUND_ROWS`` reactions, or a share of ``ROUNDS``, whose exchanges are deleted before the next.
    """
    def part(key: str):
        return F.pmod(F.xxhash64(F.split_part(key, F.lit(":"), F.lit(1))), F.lit(ROUNDS)).cast("tinyint").alias("_part")

    acts = materialized(reactions.filter(F.col("TargetCastId").isNotNull()).select(
        "TargetCastId", F.col("Fid").alias("reactor"), F.when(F.col("Hash").isNotNull(), 1).alias("one"), part("TargetCastId")))
    rounds = min(ROUNDS, -(-acts.count() // ROUND_ROWS)) or 1  # Parquet footers only
    posts = casts.select("fid", "Hash", part("fid"))
    if rounds == 1:
        return _engaged(posts, acts)
    folder, posts = scratch_folder(casts.sparkSession), materialized(posts)
    for turn in range(rounds):
        now = F.col("_part") % rounds == turn
        found = materialized(_engaged(posts.filter(now), acts.filter(now)), folder, "append")
    for table in (acts, posts):
        dropped(table)
    return found


def _engaged(posts: DataFrame, acts: DataFrame) -> DataFrame:
    """Reactions are combined per (post, reactor) before the join and per (author, reactor) after
    it, so neither a post nor an author with very many reactions ends up in one group of rows.
    The join itself has bare exchanges on both sides, which lets AQE split a hot post.
    """
    pairs = acts.groupBy("TargetCastId", "reactor").agg(F.count("one").alias("n"))
    keys = posts.select("fid", F.concat("fid", F.lit(":"), "Hash").alias("TargetCastId"))
    return (
        pairs.join(keys, "TargetCastId")
        .groupBy("fid", "reactor")
        .agg(F.sum("n").alias("n"))
        .groupBy("fid")
        .agg(F.count("reactor").alias("unique_reactors"), F.sum("n").alias("total_reactions"))
    )
