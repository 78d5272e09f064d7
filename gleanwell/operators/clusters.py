"""Figures and representative posts of given clusters."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanwell.functions.scalars import as_fid, distance, hash_hex, shorten
from gleanwell.operators.ranking import top_per_group

# How many posts stand for a cluster.
CLOSEST, ENGAGED, REPRESENTATIVES = 10, 10, 10
EARLY_CLOSEST, EARLY_POPULAR = 5, 5


def cluster_sizes(posts: DataFrame) -> DataFrame:
    return posts.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))


def cluster_centres(posts: DataFrame, vector: str = "embedding") -> DataFrame:
    """Mean vector of each cluster; one summary buffer per cluster and task."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    return posts.groupBy("cluster_id").agg(
        vector_to_array(Summarizer.mean(array_to_vector(doubles))).alias("centre")
    )


def distance_to_centre(
    posts: DataFrame, centres: DataFrame, vector: str = "embedding"
) -> DataFrame:
    """Adds ``distance_to_center``. There is one centre per cluster, so the posts stay in place."""
    return (
        posts.join(centres, "cluster_id")
        .withColumn("distance_to_center", distance(F.col(vector), F.col("centre")))
        .drop("centre")
    )


def representatives(
    posts: DataFrame,
    score: str = "cast_score",
    closest: int = CLOSEST,
    engaged: int = ENGAGED,
    cap: int = REPRESENTATIVES,
) -> DataFrame:
    """Posts nearest to the centre, then the most engaged ones, without repeats, up to a cap.

    The choice is made on ids and numbers only; the few chosen ids then pick up their posts.
    """
    slim = posts.select("cluster_id", "Hash", "distance_to_center", score)
    near = top_per_group(
        slim, ["cluster_id"], [F.col("distance_to_center").asc_nulls_last(), F.col("Hash").asc()],
        closest, rank="pos",
    )
    loud = top_per_group(
        slim, ["cluster_id"], [F.col(score).desc_nulls_last(), F.col("Hash").asc()],
        engaged, rank="pos",
    ).withColumn("pos", F.col("pos") + closest)
    firsts = near.unionByName(loud).groupBy("cluster_id", "Hash").agg(F.min("pos").alias("pos"))
    chosen = top_per_group(firsts, ["cluster_id"], [F.col("pos").asc()], cap, rank="position")
    keys = chosen.select("cluster_id", "Hash", "position")
    return posts.join(keys, ["cluster_id", "Hash"])


def representative_records(reps: DataFrame) -> DataFrame:
    """One row per cluster with its representatives as an array of records, in order."""
    record = F.struct(
        "position",
        hash_hex(F.col("Hash")).alias("hash"),
        F.col("Fid").try_cast("bigint").alias("fid"),
        F.col("Text").alias("text"),
        F.col("quality_score").cast("double").alias("author_quality"),
        F.col("quality_reactions").cast("bigint").alias("quality_reactions"),
        F.col("quality_replies").cast("bigint").alias("quality_replies"),
        F.col("cast_score").cast("double").alias("cast_score"),
    )
    return reps.groupBy("cluster_id").agg(
        F.transform(
            F.sort_array(F.collect_list(record)), lambda r: r.dropFields("position")
        ).alias("representatives")
    )


def cluster_averages(posts: DataFrame) -> DataFrame:
    return posts.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("size"),
        F.avg("quality_score").alias("avg_quality_score"),
        F.avg("quality_reactions").alias("avg_quality_reactions"),
        F.avg("quality_replies").alias("avg_quality_replies"),
        F.avg("cast_score").alias("avg_cast_score"),
    )


def size_summary(records: DataFrame) -> DataFrame:
    """One row over all clusters: how many, how many posts, and the spread of their sizes."""
    return records.agg(
        F.count(F.lit(1)).alias("total_clusters"),
        F.sum("size").alias("total_posts"),
        F.struct(
            F.avg("size").alias("mean"),
            F.median("size").alias("median"),
            F.min("size").alias("min"),
            F.max("size").alias("max"),
        ).alias("cluster_sizes"),
    )


def early_cluster_info(posts: DataFrame) -> DataFrame:
    """The earlier cluster record: sizes, mean counts and representatives with distances."""
    stats = posts.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("size"),
        F.avg("reaction_count").alias("avg_reactions"),
        F.avg("reply_count").alias("avg_replies"),
    )
    reps = representatives(
        posts, "reaction_count", EARLY_CLOSEST, EARLY_POPULAR, EARLY_CLOSEST + EARLY_POPULAR
    )
    record = F.struct(
        "position",
        F.col("Text").alias("text"),
        F.col("reaction_count").alias("reactions"),
        F.col("reply_count").alias("replies"),
        as_fid(F.col("Fid")).alias("fid"),
        hash_hex(F.col("Hash")).alias("hash"),
        "distance_to_center",
    )
    listed = reps.groupBy("cluster_id").agg(
        F.transform(
            F.sort_array(F.collect_list(record)), lambda r: r.dropFields("position")
        ).alias("representative_posts")
    )
    return stats.join(listed, "cluster_id")


def early_cluster_summary(info: DataFrame, common_words: DataFrame) -> DataFrame:
    """Per cluster: size, start of the first representative and five common words."""
    words = common_words.filter(F.col("rank") <= 5).groupBy("cluster_id").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("rank", "word"))), lambda w: w["word"]
        ).alias("common_words")
    )
    first = F.try_element_at("representative_posts", F.lit(1))["text"]
    return info.join(words, "cluster_id", "left").select(
        F.col("cluster_id").alias("id"),
        "size",
        F.coalesce(shorten(first, 200, ellipsis=False), F.lit("")).alias("top_post"),
        F.coalesce("common_words", F.array().cast("array<string>")).alias("common_words"),
    )
