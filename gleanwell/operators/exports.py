"""The two post exports: a loose one by engagement range, a strict one by trusted engagement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.functions import rules
from gleanwell.functions.scalars import has_value, post_seconds
from gleanwell.operators import engagement
from gleanwell.operators.ranking import top_k
from gleanwell.session import materialized

# Cutoffs and caps the exports are defined by.
RECENT_FROM = 133315200
LOOSE_REACTIONS = (10, 10000)
LOOSE_REPLIES = (5, 5000)
LOOSE_MIN_CHARS = 20
STRICT_MIN_CHARS = 50
STRICT_CAP = 200_000


def export_filtered_casts(
    casts: DataFrame,
    reactions: DataFrame,
    recent_from: int = RECENT_FROM,
    reaction_range: tuple[int, int] = LOOSE_REACTIONS,
    reply_range: tuple[int, int] = LOOSE_REPLIES,
) -> DataFrame:
    """Recent posts within an engagement range and without the loose spam words.

    Text rules sit on the scan, so posts they drop are never shuffled. Both counts join on the
    post hash, which costs the posts a single exchange.
    """
    text = F.col("Text")
    recent = casts.filter(
        (post_seconds(F.col("Timestamp")) >= recent_from)
        & text.isNotNull()
        & (F.length(text) >= LOOSE_MIN_CHARS)
        & ~rules.loose_spam(text)
        & ~F.coalesce(rules.url_only(text, F.col("Embeds")), F.lit(False))
    )
    joined = recent.join(
        engagement.reaction_counts(reactions), F.col("Hash") == F.col("target_hash"), "left"
    ).join(engagement.reply_counts(casts), F.col("Hash") == F.col("parent_hash"), "left")
    n_reactions = F.coalesce("reaction_count", F.lit(0))
    n_replies = F.coalesce("reply_count", F.lit(0))
    return joined.filter(
        n_reactions.between(*reaction_range) & n_replies.between(*reply_range)
    ).select(
        *casts.columns, n_reactions.alias("reaction_count"), n_replies.alias("reply_count")
    )


def export_summary(exported: DataFrame) -> DataFrame:
    return exported.agg(
        F.count(F.lit(1)).alias("total_casts"),
        *[
            f(c).alias(f"{name}_{label}")
            for c, label in (("reaction_count", "reactions"), ("reply_count", "replies"))
            for name, f in (("min", F.min), ("max", F.max), ("avg", F.avg))
        ],
    )


def quality_candidates(
    casts: DataFrame,
    reactions: DataFrame,
    scores: DataFrame,
    recent_from: int = RECENT_FROM,
    cashtag_mode: str = "literal",
    whole_words: bool = False,
) -> DataFrame:
    """All posts that pass the strict rules, before the size cap.

    The author test comes last, on the few posts left, so the wide rows are exchanged once, by
    hash, and never by author.
    """
    text = F.col("Text")
    seconds = post_seconds(F.col("Timestamp"))
    quality = engagement.fids_scoring_at_least(scores, engagement.QUALITY_FROM)
    included = engagement.fids_scoring_at_least(scores, engagement.INCLUDED_FROM)
    posts = casts.filter(
        text.isNotNull()
        & (F.length(text) >= STRICT_MIN_CHARS)
        & (seconds >= recent_from)
        & ~has_value(F.col("ParentCastId"))
        & ~rules.strict_spam(text, cashtag_mode, whole_words)
    ).select("Hash", "Fid", "Text", "Embeds", seconds.alias("timestamp"))
    engaged = engagement.with_engagement(posts, casts, reactions, quality).filter(
        ((F.col("quality_reactions") >= 3) | (F.col("quality_replies") >= 2))
        & (F.col("total_replies") > 0)
    )
    authors = included.select(F.col("fid").alias("Fid"))
    return engaged.join(authors, "Fid", "left_semi").select(*engaged.columns)


def export_quality_casts(
    casts: DataFrame, reactions: DataFrame, scores: DataFrame, cap: int | None = None, **rules_used
) -> DataFrame:
    """The strict export, highest engagement score first; ``cap`` (``STRICT_CAP`` where memory is
    short) keeps that many posts.

    With a cap the candidates are written once, since finding the cap and applying it read them.
    """
    candidates = quality_candidates(casts, reactions, scores, **rules_used)
    return top_k(candidates if cap is None else materialized(candidates), "engagement_score", "Hash", cap)
