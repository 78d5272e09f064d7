"""From good posts to named topics, and from answers to recommendations."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.functions.scalars import as_fid, hash_hex
from gleanwell.operators import clusters, recommend, topics, vectors
from gleanwell.session import materialized
from gleanwell.sources import sinks, tables

Encoder = Callable[[list[str]], np.ndarray]


def with_vectors(posts: DataFrame, encoder: Encoder | None, prefix: str) -> DataFrame:
    """Posts with ``features``: the encoder's vectors, or hashed words where there is none."""
    if encoder is None:
        return vectors.hashed_vectors(posts)
    return vectors.as_features(vectors.encoded_vectors(posts, encoder, prefix=prefix)).drop("embedding")


def cluster_posts(
    posts: DataFrame, out: str, k: int = vectors.TOPICS, encoder: Encoder | None = None,
    components: int = vectors.COMPONENTS, restarts: int = vectors.RESTARTS,
    prefix: str = vectors.CLUSTERING_PREFIX,
) -> DataFrame:
    """Posts with a cluster and their distance to its centre. Models are saved beside them."""
    located, reducer = vectors.reduced(with_vectors(posts, encoder, prefix), components)
    located = materialized(located.drop("features"))
    kmeans = vectors.batch_kmeans(located, k, restarts)
    vectors.save_clustering(kmeans, reducer, f"{out}/models")
    placed = kmeans.transform(located).withColumn("vector", vector_to_array("reduced"))
    centres = vectors.centres_of(kmeans, posts.sparkSession)
    path = f"{out}/clustered_casts"
    sinks.write_parquet(
        clusters.distance_to_centre(placed, centres, "vector").drop("vector", "reduced"), path
    )
    return posts.sparkSession.read.parquet(path)


def describe_topics(
    clustered: DataFrame, out: str, namer: Callable[[list[str]], list[str | None]] | None = None
) -> DataFrame:
    """The cluster table and its summary, as JSON lines."""
    keywords = topics.cluster_keywords(clustered)
    reps = clusters.representatives(clustered)
    records = materialized(topics.cluster_records(clustered, reps, keywords, namer))
    sinks.write_json(topics.best_first(records), f"{out}/quality_clusters")
    sinks.write_json(clusters.size_summary(records), f"{out}/clustering_summary")
    return tables.read_json_lines(
        clustered.sparkSession, f"{out}/quality_clusters", tables.CLUSTERS
    )


def recommend_all(
    feedback: DataFrame, cluster_table: DataFrame, keys: Sequence[str], out: str
) -> DataFrame:
    """Preferences, posts and authors for every session, one nested row each, as JSON lines."""
    sessions = recommend.sessions_from(feedback, keys)
    weighted = recommend.cluster_weights(sessions, cluster_table)
    result = recommend.combined_output(
        recommend.preference_summary(feedback, cluster_table, keys),
        recommend.recommended_places(weighted, cluster_table, keys),
        recommend.users_to_follow(feedback, cluster_table, keys),
        keys,
        cluster_table,
    )
    path = f"{out}/recommendations"
    sinks.write_json(result, path)
    return feedback.sparkSession.read.schema(result.schema).json(path)


def embed_export(exported: DataFrame, encoder: Encoder, out: str) -> DataFrame:
    """The embedding table of a loose export, with fixed column types."""
    keyed = exported.filter(F.col("Text").isNotNull() & (F.col("Text") != ""))
    encoded = vectors.encoded_vectors(keyed, encoder, prefix=vectors.EARLY_PREFIX)
    table = encoded.select(
        hash_hex(F.col("Hash")).alias("hash_hex"), as_fid(F.col("Fid")).alias("fid"),
        F.col("Text").alias("text"), "embedding", "reaction_count", "reply_count",
    )
    path = f"{out}/cast_embeddings"
    sinks.write_embeddings(table, path)
    return tables.read_embeddings(exported.sparkSession, path)


def early_topics(
    embedded: DataFrame, out: str, k: int = vectors.EARLY_TOPICS,
    components: int = vectors.COMPONENTS, restarts: int = vectors.RESTARTS,
) -> DataFrame:
    """The earlier cluster records with common words and a summary, as JSON lines."""
    spark = embedded.sparkSession
    posts = embedded.select(
        F.col("hash_hex").alias("Hash"), F.col("fid").cast("string").alias("Fid"),
        F.col("text").alias("Text"), "embedding", "reaction_count", "reply_count",
    )
    located, reducer = vectors.reduced(vectors.as_features(posts), components)
    located = materialized(located.drop("features", "embedding"))
    kmeans = vectors.best_kmeans(located, k, restarts)
    vectors.save_clustering(kmeans, reducer, f"{out}/early_models")
    placed = materialized(
        clusters.distance_to_centre(
            kmeans.transform(located).withColumn("vector", vector_to_array("reduced")),
            vectors.centres_of(kmeans, spark), "vector",
        ).drop("vector", "reduced")
    )
    sinks.write_parquet(placed.select("Hash", "cluster_id"), f"{out}/cluster_labels")
    words = materialized(topics.common_words(placed, topics.FAST_STOP_WORDS))
    listed = words.groupBy("cluster_id").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("rank", "word", "n"))),
            lambda w: F.struct(w["word"].alias("word"), w["n"].alias("n")),
        ).alias("common_words")
    )
    info = materialized(clusters.early_cluster_info(placed))
    full = info.join(listed, "cluster_id", "left")
    sinks.write_json(full, f"{out}/cluster_info")
    sinks.write_json(clusters.early_cluster_summary(info, words), f"{out}/cluster_summary")
    return spark.read.schema(full.schema).json(f"{out}/cluster_info")
