"""Engagement, exports and content."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanwell.functions import rules
from gleanwell.operators import content, engagement, exports
from gleanwell.operators.ranking import top_k
from gleanwell.session import materialized
from verification.catalog import query, rounded
from verification.fixtures import LOOSE_REACTIONS, LOOSE_REPLIES, RECENT_FROM, Fixtures, with_views

REACTION_COUNTS = """reaction_counts AS (
  SELECT split_part(TargetCastId, ':', 2) AS target_hash, count(*) AS reaction_count
  FROM reactions WHERE TargetCastId IS NOT NULL AND TargetCastId <> '' GROUP BY 1)"""
REPLY_COUNTS = """reply_counts AS (
  SELECT split_part(ParentCastId, ':', 2) AS parent_hash, count(*) AS reply_count
  FROM casts WHERE ParentCastId IS NOT NULL AND ParentCastId <> '' GROUP BY 1)"""
TRUSTED_REACTIONS = """trusted_reactions AS (
  SELECT split_part(TargetCastId, ':', 2) AS target_hash, count(*) AS total_reactions,
         count(*) FILTER (WHERE Fid IN (SELECT fid FROM scores WHERE quality_score >= 7)) AS quality_reactions
  FROM reactions WHERE TargetCastId IS NOT NULL AND TargetCastId <> '' GROUP BY 1)"""
TRUSTED_REPLIES = """trusted_replies AS (
  SELECT split_part(ParentCastId, ':', 2) AS parent_hash, count(*) AS total_replies,
         count(*) FILTER (WHERE Fid IN (SELECT fid FROM scores WHERE quality_score >= 7)) AS quality_replies
  FROM casts WHERE ParentCastId IS NOT NULL AND ParentCastId <> '' GROUP BY 1)"""
ENGAGED = """engaged AS (
  SELECT *, quality_reactions * 2 + quality_replies * 5 AS engagement_score FROM (
    SELECT Hash, Fid, Text, Embeds, ParentCastId, TRY_CAST("Timestamp" AS BIGINT) AS seconds,
           coalesce(total_reactions, 0) AS total_reactions, coalesce(quality_reactions, 0) AS quality_reactions,
           coalesce(total_replies, 0) AS total_replies, coalesce(quality_replies, 0) AS quality_replies
    FROM casts LEFT JOIN trusted_reactions ON Hash = target_hash
               LEFT JOIN trusted_replies ON Hash = parent_hash))"""
SCORED = """scored AS (
  SELECT Hash, e.Fid AS Fid, total_reactions, quality_reactions, total_replies, quality_replies, engagement_score,
         quality_score, quality_category,
         (quality_reactions + quality_replies * 2) / CAST(total_reactions + total_replies * 2 + 1 AS DOUBLE)
           AS quality_engagement_ratio,
         quality_score * 0.3 + quality_reactions * 0.3 + quality_replies * 0.4 AS cast_score
  FROM engaged e LEFT JOIN scores s ON e.Fid = s.fid)"""


def contains_any(words: list[str]) -> str:
    return "(" + " OR ".join(f"lower(Text) LIKE '%{w}%'" for w in words) + ")"


SHORT_CLAIM = "(length(Text) < 100 AND lower(Text) LIKE '%claim%')"
LOW_EFFORT = "(" + " OR ".join(f"lower(Text) LIKE '{w}%'" for w in rules.LOW_EFFORT_PREFIXES) + ")"
CASHTAG = r"regexp_full_match(Text, '(?s)%\$[A-Z]{2,}%')"
STRICT_SPAM = "(" + " OR ".join(
    [LOW_EFFORT, SHORT_CLAIM, CASHTAG, *[contains_any(w) for w in rules.SPAM_LISTS.values()]]
) + ")"
STRICT = f"""strict AS (
  SELECT * FROM engaged
  WHERE Fid IN (SELECT fid FROM scores WHERE quality_score >= 4)
    AND Text IS NOT NULL AND length(Text) >= 50 AND seconds >= {RECENT_FROM}
    AND (ParentCastId IS NULL OR ParentCastId = '')
    AND (quality_reactions >= 3 OR quality_replies >= 2) AND total_replies > 0
    AND NOT {STRICT_SPAM})"""
STRICT_VIEWS = ",\n".join([TRUSTED_REACTIONS, TRUSTED_REPLIES, ENGAGED])
POST_VIEWS = with_views("casts", "reactions", "scores") + ", " + STRICT_VIEWS
LOOSE = f"""loose AS (
  SELECT c.*, coalesce(reaction_count, 0) AS reaction_count, coalesce(reply_count, 0) AS reply_count
  FROM casts c LEFT JOIN reaction_counts ON Hash = target_hash LEFT JOIN reply_counts ON Hash = parent_hash
  WHERE TRY_CAST("Timestamp" AS BIGINT) >= {RECENT_FROM}
    AND coalesce(reaction_count, 0) BETWEEN {LOOSE_REACTIONS[0]} AND {LOOSE_REACTIONS[1]}
    AND coalesce(reply_count, 0) BETWEEN {LOOSE_REPLIES[0]} AND {LOOSE_REPLIES[1]}
    AND Text IS NOT NULL AND length(Text) >= 20 AND NOT {contains_any(rules.LOOSE_SPAM)}
    AND NOT (Text = '' AND Embeds IS NOT NULL AND Embeds <> ''))"""
LOOSE_VIEWS = with_views("casts", "reactions") + ", " + ",\n".join([REACTION_COUNTS, REPLY_COUNTS, LOOSE])
SCORED_ROUNDED = """Hash, Fid, total_reactions, quality_reactions, total_replies, quality_replies, engagement_score,
  quality_score, quality_category, round(quality_engagement_ratio, 6) AS quality_engagement_ratio,
  round(cast_score, 6) AS cast_score"""


@query(with_views("reactions") + ", " + REACTION_COUNTS + " SELECT * FROM reaction_counts")
def reaction_counts(fx: Fixtures):
    return engagement.reaction_counts(fx.reactions())


@query(with_views("casts") + ", " + REPLY_COUNTS + " SELECT * FROM reply_counts")
def reply_counts(fx: Fixtures):
    return engagement.reply_counts(fx.casts())


def trusted(fx: Fixtures):
    return engagement.fids_scoring_at_least(fx.scores(), engagement.QUALITY_FROM)


@query(with_views("reactions", "scores") + ", " + TRUSTED_REACTIONS + " SELECT * FROM trusted_reactions")
def quality_reactions(fx: Fixtures):
    return engagement.quality_reactions(fx.reactions(), trusted(fx))


@query(with_views("casts", "scores") + ", " + TRUSTED_REPLIES + " SELECT * FROM trusted_replies")
def quality_replies(fx: Fixtures):
    return engagement.quality_replies(fx.casts(), trusted(fx))


def loose(fx: Fixtures):
    return exports.export_filtered_casts(
        fx.casts(), fx.reactions(), RECENT_FROM, LOOSE_REACTIONS, LOOSE_REPLIES
    )


@query(LOOSE_VIEWS + " SELECT * FROM loose")
def export_filtered_casts(fx: Fixtures):
    return loose(fx)


@query(
    LOOSE_VIEWS
    + """ SELECT count(*) AS total_casts,
      min(reaction_count) AS min_reactions, max(reaction_count) AS max_reactions,
      round(avg(reaction_count), 6) AS avg_reactions, min(reply_count) AS min_replies,
      max(reply_count) AS max_replies, round(avg(reply_count), 6) AS avg_replies FROM loose"""
)
def export_summary(fx: Fixtures):
    return rounded(exports.export_summary(loose(fx)))


def strict(fx: Fixtures):
    return exports.export_quality_casts(
        fx.casts(), fx.reactions(), fx.scores(), recent_from=RECENT_FROM
    )


@query(
    POST_VIEWS + ", " + STRICT
    + """ SELECT Hash, Fid, Text, Embeds, seconds AS timestamp, total_reactions, quality_reactions,
      total_replies, quality_replies, engagement_score
    FROM strict ORDER BY engagement_score DESC, Hash LIMIT 200000"""
)
def export_quality_casts(fx: Fixtures):
    return strict(fx)


@query(
    with_views("casts")
    + "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {test}) AS hits, count(*) AS posts FROM casts"
        for name, test in {
            "loose_spam": contains_any(rules.LOOSE_SPAM),
            "low_effort": LOW_EFFORT,
            "short_claim": SHORT_CLAIM,
            "cashtag": CASHTAG,
            **{n: contains_any(w) for n, w in rules.SPAM_LISTS.items()},
            "strict_spam": STRICT_SPAM,
        }.items()
    )
    + ")"
)
def spam_rule_hits(fx: Fixtures):
    """The rules read each stored text once, however many posts have it."""
    flags = rules.spam_flags(F.col("Text"))
    marked = fx.texts().select("doc_id", *[t.alias(n) for n, t in flags.items()])
    counted = fx.posts().join(marked, "doc_id").agg(
        F.count(F.lit(1)).alias("posts"), *[F.count_if(n).alias(n) for n in flags]
    )
    return counted.unpivot(["posts"], list(flags), "rule", "hits").select("rule", "hits", "posts")


def scored(fx: Fixtures):
    """Every post with its engagement and author score, before any rule drops one."""
    posts = fx.casts().select("Hash", "Fid")
    return content.add_author_scores(
        engagement.with_engagement(posts, fx.casts(), fx.reactions(), trusted(fx)), fx.scores()
    )


@query(POST_VIEWS + ", " + SCORED + f" SELECT {SCORED_ROUNDED} FROM scored")
def author_scored_casts(fx: Fixtures):
    return rounded(scored(fx))


@query(
    POST_VIEWS + ", " + SCORED
    + f""" SELECT {SCORED_ROUNDED} FROM scored
    QUALIFY row_number() OVER (PARTITION BY Fid ORDER BY cast_score DESC NULLS LAST, Hash) <= 10"""
)
def top_posts_per_author(fx: Fixtures):
    return rounded(content.top_posts_per_author(scored(fx)))


MOST_ENGAGED = 2_500


@query(
    POST_VIEWS + f""" SELECT Hash, engagement_score,
      CAST(row_number() OVER (ORDER BY engagement_score DESC, Hash) AS INTEGER) AS position
    FROM engaged QUALIFY position <= {MOST_ENGAGED}"""
)
def most_engaged(fx: Fixtures):
    """A cap that binds among many equal scores, with each row's place in the result's order."""
    posts = fx.casts().select("Hash", "Fid")
    engaged = engagement.with_engagement(posts, fx.casts(), fx.reactions(), trusted(fx)).select("Hash", "engagement_score")
    best = top_k(materialized(engaged), "engagement_score", "Hash", MOST_ENGAGED)
    place = Window.orderBy("_at")  # over the rows that the cap leaves
    return best.withColumn("_at", F.monotonically_increasing_id()).select(
        "Hash", "engagement_score", F.row_number().over(place).alias("position")
    )


def high_quality(fx: Fixtures):
    return content.high_quality_casts(strict(fx), fx.scores())


HIGH = (
    POST_VIEWS + ", " + STRICT + ", " + SCORED.replace("FROM engaged e", "FROM strict e")
    + """, high AS (
      SELECT * FROM (
        SELECT * FROM scored
        QUALIFY row_number() OVER (PARTITION BY Fid ORDER BY cast_score DESC NULLS LAST, Hash) <= 10)
      ORDER BY cast_score DESC NULLS LAST, Hash)"""
)


@query(HIGH + f" SELECT {SCORED_ROUNDED} FROM high")
def high_quality_casts(fx: Fixtures):
    return rounded(high_quality(fx).drop("Text", "Embeds", "timestamp"))


@query(
    HIGH
    + """ SELECT count(*) AS posts, count(DISTINCT Fid) AS authors,
      round(avg(quality_score), 6) AS avg_author_quality,
      round(avg(quality_reactions), 6) AS avg_quality_reactions,
      round(avg(quality_replies), 6) AS avg_quality_replies,
      round(avg(quality_engagement_ratio), 6) AS avg_engagement_ratio FROM high"""
)
def content_stats(fx: Fixtures):
    return rounded(content.content_stats(high_quality(fx)))


@query(
    POST_VIEWS + ", " + SCORED
    + """ SELECT count(cast_score) AS count, round(avg(cast_score), 6) AS mean,
      round(stddev_samp(cast_score), 6) AS std, round(min(cast_score), 6) AS min,
      round(quantile_cont(cast_score, 0.25), 6) AS q25, round(quantile_cont(cast_score, 0.5), 6) AS q50,
      round(quantile_cont(cast_score, 0.75), 6) AS q75, round(max(cast_score), 6) AS max FROM scored"""
)
def cast_score_describe(fx: Fixtures):
    return rounded(content.describe(scored(fx), "cast_score"))
