"""The earlier onboarding rounds: similar clusters, varied picks and narrowing down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwell.functions.scalars import shuffled_by
from gleanwell.operators.bounded import book

# Sizes used when narrowing down.
MIN_CLUSTER_SIZE = 100
SIMILAR, SIMILAR_WHEN_NARROWING = 5, 10
PICKS, MAX_ROUNDS, FEW_CANDIDATES = 3, 3, 3


def _difference(a: Column, b: Column) -> Column:
    larger = F.greatest(a, b)
    return F.when(larger == 0, F.lit(0.0)).otherwise(F.abs(a - b) / larger)


def _similar_to(cluster: Column, pages: Column, n: int) -> Column:
    """The n clusters with the nearest size and engagement, best first, as (similarity, id)."""

    def likeness(c: Column) -> Column:
        parts = [_difference(c[f], cluster[f]) for f in ("size", "avg_reactions", "avg_replies")]
        return 1 - (parts[0] + parts[1] + parts[2]) / 3

    others = F.filter(pages, lambda c: c["cluster_id"] != cluster["cluster_id"])
    rated = F.transform(
        others,
        lambda c: F.struct(
            (-F.round(likeness(c), 9)).alias("order"), c["cluster_id"].alias("similar_id"),
            likeness(c).alias("similarity"),
        ),
    )
    return F.slice(F.sort_array(rated), 1, n)


def similar_clusters(clusters: DataFrame, n: int = SIMILAR) -> DataFrame:
    """For every cluster its n most similar ones: ``cluster_id, rank, similar_id, similarity``."""
    slim = clusters.select("cluster_id", "size", "avg_reactions", "avg_replies")
    rows = slim.withColumn("_book", book(slim, "cluster_id"))
    me = F.struct("cluster_id", "size", "avg_reactions", "avg_replies")
    return rows.select(
        "cluster_id", F.posexplode(_similar_to(me, F.col("_book"), n)).alias("pos", "s")
    ).select("cluster_id", (F.col("pos") + 1).alias("rank"), "s.similar_id", "s.similarity")


def _picks(pages: Column, excluded: Column, n: int, draw_parts: Sequence, min_size: int) -> Column:
    """Ids of a varied choice: the largest, second by reactions, third by replies, then draws."""
    usable = F.filter(
        pages, lambda c: (c["size"] > min_size) & ~F.array_contains(excluded, c["cluster_id"])
    )

    def nth(rows: Column, field: str, k: int) -> Column:
        ranked = F.sort_array(
            F.transform(rows, lambda c: F.struct((-c[field]).alias("v"), c["cluster_id"].alias("id")))
        )
        return F.get(ranked, F.lit(k))["id"]

    def with_draws(rows: Column) -> Column:
        fixed = F.array_distinct(
            F.array_compact(
                F.array(nth(rows, "size", 0), nth(rows, "avg_reactions", 1), nth(rows, "avg_replies", 2))
            )
        )
        drawn = F.transform(
            F.sort_array(
                F.transform(
                    rows,
                    lambda c: F.struct(
                        shuffled_by([*draw_parts, c["cluster_id"]]).alias("d"), c["cluster_id"].alias("id")
                    ),
                )
            ),
            lambda d: d["id"],
        )
        ids = F.transform(rows, lambda c: c["cluster_id"])
        return F.when(F.size(rows) < n, ids).otherwise(
            F.slice(F.array_distinct(F.concat(fixed, drawn)), 1, n)
        )

    return F.transform(F.array(usable), with_draws)[0]


def diverse_clusters(
    clusters: DataFrame, excluded: Sequence[int] = (), n: int = PICKS, seed: int = 42,
    min_size: int = MIN_CLUSTER_SIZE,
) -> DataFrame:
    """A varied choice of clusters to show: ``position, cluster_id``."""
    slim = clusters.select("cluster_id", "size", "avg_reactions", "avg_replies")
    none = F.array(*[F.lit(int(x)) for x in excluded]).cast("array<int>")
    one_row = clusters.agg(F.count(F.lit(1)).alias("n")).withColumn("_book", book(slim, "cluster_id"))
    chosen = _picks(F.col("_book"), none, n, [seed], min_size)
    return one_row.select(F.posexplode(chosen).alias("pos", "cluster_id")).select(
        (F.col("pos") + 1).alias("position"), "cluster_id"
    )


def narrow_down(
    rounds: DataFrame, clusters: DataFrame, keys: Sequence[str], max_rounds: int = MAX_ROUNDS,
    similar: int = SIMILAR_WHEN_NARROWING,
) -> DataFrame:
    """State of each session after its rounds: ``preferences, candidates, excluded``.

    ``rounds`` has ``round``, ``shown`` (ids) and ``preferred`` (id, or null for none of them).
    A preferred cluster leaves itself and its most similar ones as candidates and excludes half
    of all others, lowest ids first; no preference excludes what was shown. Rounds stop after
    ``max_rounds`` or once three or fewer candidates are left.
    """
    slim = clusters.select("cluster_id", "size", "avg_reactions", "avg_replies")
    played = rounds.filter(F.col("round").between(1, max_rounds)).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("round", "preferred", "shown"))).alias("rounds")
    )
    rows = played.withColumn("_book", book(slim, "cluster_id"))
    all_ids = F.transform(F.col("_book"), lambda c: c["cluster_id"])
    no_ids = F.array().cast("array<int>")

    def after(state: Column, r: Column) -> Column:
        me = F.filter(F.col("_book"), lambda c: c["cluster_id"] == r["preferred"])[0]
        near = F.transform(
            _similar_to(me, F.col("_book"), similar), lambda s: s["similar_id"]
        )
        candidates = F.concat(F.array(r["preferred"]), near)
        far = F.array_except(F.array_except(all_ids, candidates), state["excluded"])
        half = F.slice(far, F.lit(1), F.floor(F.size(far) / 2).cast("int"))
        narrowed = F.struct(
            F.concat(state["preferences"], F.array(r["preferred"])).alias("preferences"),
            candidates.alias("candidates"),
            F.array_sort(F.array_union(state["excluded"], half)).alias("excluded"),
        )
        refused = F.struct(
            state["preferences"].alias("preferences"),
            state["candidates"].alias("candidates"),
            F.array_sort(F.array_union(state["excluded"], r["shown"])).alias("excluded"),
        )
        moved = F.when(r["preferred"].isNull(), refused).otherwise(narrowed)
        return F.when(F.size(state["candidates"]) > FEW_CANDIDATES, moved).otherwise(state)

    start = F.struct(
        no_ids.alias("preferences"), all_ids.alias("candidates"), no_ids.alias("excluded")
    )
    return rows.withColumn("state", F.aggregate("rounds", start, after)).select(*keys, "state.*")


def onboarding_totals(clusters: DataFrame) -> DataFrame:
    return clusters.agg(
        F.count(F.lit(1)).alias("total_clusters"),
        F.sum("size").alias("total_posts"),
        F.min("size").alias("smallest"),
        F.max("size").alias("largest"),
    )
