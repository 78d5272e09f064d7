"""From posts, reactions and author scores to a diverse set of good posts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gleanwell.operators import content, exports
from gleanwell.sources import sinks


def select_posts(
    casts: DataFrame, reactions: DataFrame, scores: DataFrame, out: str, **rules_used
) -> DataFrame:
    """The strict export, then the best posts of each author, written as two tables."""
    spark = casts.sparkSession
    raw, best = f"{out}/quality_casts_raw", f"{out}/high_quality_casts"
    sinks.write_parquet(
        exports.export_quality_casts(casts, reactions, scores, **rules_used), raw
    )
    sinks.write_parquet(content.high_quality_casts(spark.read.parquet(raw), scores), best)
    return spark.read.parquet(best)


def loose_export(casts: DataFrame, reactions: DataFrame, out: str, **limits) -> DataFrame:
    path = f"{out}/filtered_casts"
    sinks.write_parquet(exports.export_filtered_casts(casts, reactions, **limits), path)
    return casts.sparkSession.read.parquet(path)
