"""Sessions of answers against a cluster table with shared themes."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanwell.operators import onboarding, recommend
from gleanwell.session import materialized
from verification.catalog import joined, query, rounded
from verification.fixtures import Fixtures, with_views
from verification.queries_topics import RECORD_CTES, early_clusters, theme_clusters

KEYS = ["user_id", "session"]
MIN_SIZE = 20
SIMILAR = 4

BOOK = """book AS (
  SELECT cluster_id, 'Theme ' || cluster_id % 4 AS name, top_words, size, avg_quality_score,
         row_number() OVER (ORDER BY avg_cast_score DESC NULLS LAST, cluster_id) AS place
  FROM averages JOIN top_words USING (cluster_id)),
rep_rows AS (
  SELECT cluster_id, b.name AS name, place, b.top_words AS words, position - 1 AS idx, Hash AS hash, CAST(Fid AS BIGINT) AS fid, Text AS text,
         quality_score, quality_reactions, quality_replies,
         quality_score * (quality_reactions + quality_replies * 2) AS appeal
  FROM reps JOIN book b USING (cluster_id))"""
FACTORS = """factors AS (
  SELECT t.cluster_id AS target, c.cluster_id AS cluster_id, liked,
    CASE WHEN t.cluster_id = c.cluster_id THEN CASE WHEN liked THEN 1.5e0 ELSE 0.5e0 END
         WHEN t.name = c.name THEN
           1e0 + (CASE WHEN liked THEN 1.5e0 ELSE 1.2e0 END - 1e0) * (len(list_intersect(t.top_words, c.top_words)) / 10e0)
         ELSE 1e0 + (CASE WHEN liked THEN 0.8e0 ELSE 0.5e0 END - 1e0) * 0.1e0 END AS factor
  FROM book t, book c, (VALUES (true), (false)) l(liked))"""
WEIGHTS = """state AS (
  SELECT user_id, session, 0 AS seq, cluster_id, 1e0 AS w
  FROM (SELECT DISTINCT user_id, session FROM feedback), book
  UNION ALL
  SELECT user_id, session, seq, cluster_id, CASE WHEN m > 10 THEN w / (m / 10e0) ELSE w END FROM (
    SELECT s.user_id, s.session, f.seq, s.cluster_id, s.w * x.factor AS w,
           max(s.w * x.factor) OVER (PARTITION BY s.user_id, s.session) AS m
    FROM state s JOIN feedback f ON f.user_id = s.user_id AND f.session = s.session AND f.seq = s.seq + 1
    JOIN factors x ON x.target = f.cluster_id AND x.liked = f.liked AND x.cluster_id = s.cluster_id)),
asked AS (SELECT user_id, session, max(seq) AS asked FROM feedback GROUP BY ALL),
learnt AS (
  SELECT s.user_id, s.session, asked, s.cluster_id, w FROM state s
  JOIN asked a ON s.user_id = a.user_id AND s.session = a.session AND s.seq = a.asked)"""
HEAD = (
    with_views("clustered", "feedback", recursive=True) + ", "
    + ",\n".join([RECORD_CTES, BOOK])
)
LEARNT = HEAD + ", " + ",\n".join([FACTORS, WEIGHTS])


def sessions(fx: Fixtures):
    return recommend.sessions_from(fx.feedback(), KEYS)


def learnt(fx: Fixtures):
    """Sessions with their weights, and the cluster table they refer to."""
    table = theme_clusters(fx)
    return recommend.cluster_weights(sessions(fx), table), table


# Weights and scores are products of short decimals, so many lie exactly half way between two
# rounded values, where engines differ. The same small shift on both sides moves them off.
SHIFT = 3.7e-9


@query(LEARNT + f" SELECT user_id, session, cluster_id, round(w + {SHIFT}, 6) AS weight FROM learnt")
def cluster_weights(fx: Fixtures):
    weighted, table = learnt(fx)
    rows = recommend.weight_rows(weighted, table, KEYS)
    return rounded(rows.withColumn("weight", F.col("weight") + SHIFT))


@query(
    LEARNT
    + """ SELECT user_id, session, asked >= 4 AND max(w) > sum(w) / count(*) * 3 AS strong
    FROM learnt GROUP BY user_id, session, asked"""
)
def strong_signal(fx: Fixtures):
    weighted, _ = learnt(fx)
    return recommend.strong_signal(weighted, KEYS)


@query(
    LEARNT
    + """, heavy AS (
      SELECT user_id, session, asked, cluster_id, name,
             row_number() OVER (PARTITION BY user_id, session ORDER BY w DESC, place) AS hr
      FROM learnt JOIN book USING (cluster_id) WHERE w > 0.1),
    fresh AS (
      SELECT * FROM heavy h WHERE hr <= 10 AND NOT EXISTS (
        SELECT 1 FROM feedback f JOIN book b ON f.cluster_id = b.cluster_id
        WHERE f.user_id = h.user_id AND f.session = h.session AND b.name = h.name)),
    candidates AS (
      SELECT * FROM fresh WHERE asked < 3
      UNION ALL
      SELECT * FROM heavy h WHERE hr <= 5 AND (asked >= 3 OR NOT EXISTS (
        SELECT 1 FROM fresh x WHERE x.user_id = h.user_id AND x.session = h.session))),
    chosen AS (
      SELECT user_id, session,
             arg_min(cluster_id, md5(concat_ws('|', user_id, session, asked, cluster_id, 42))) AS chosen
      FROM candidates GROUP BY ALL),
    unseen AS (
      SELECT c.user_id, c.session, chosen, r.cluster_id, r.place, r.idx, r.hash, r.appeal
      FROM chosen c, rep_rows r
      WHERE NOT EXISTS (SELECT 1 FROM feedback f WHERE f.user_id = c.user_id AND f.session = c.session
                        AND f.cluster_id = r.cluster_id AND f.post_idx = r.idx))
    SELECT user_id, session, cluster_id, CAST(idx AS INTEGER) AS post_idx, hash FROM unseen
    QUALIFY row_number() OVER (PARTITION BY user_id, session ORDER BY
      cluster_id = chosen DESC, CASE WHEN cluster_id = chosen THEN appeal END DESC NULLS LAST, place, idx) = 1"""
)
def next_post(fx: Fixtures):
    weighted, table = learnt(fx)
    seen = fx.feedback().groupBy(*KEYS).agg(
        F.collect_list(F.struct("cluster_id", "post_idx")).alias("shown")
    )
    return recommend.next_post(weighted.join(seen, KEYS), table, KEYS)


LISTED = """ranked_reps AS (
  SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY appeal DESC, idx) AS pr FROM rep_rows),
listed AS (
  SELECT user_id, session, w.cluster_id AS cluster_id, name, array_to_string(words[1:5], ',') AS cluster_keywords,
         pr, hash, fid, text, quality_score AS author_quality, quality_reactions, quality_replies,
         row_number() OVER (PARTITION BY user_id, session ORDER BY w DESC, place, pr) AS position
  FROM learnt w JOIN ranked_reps r ON w.cluster_id = r.cluster_id WHERE w >= 0.5 AND pr <= 3)"""


@query(
    LEARNT + ", " + LISTED
    + """ SELECT user_id, session, CAST(position AS INTEGER) AS position, cluster_id, name AS cluster_theme,
      cluster_keywords, hash, fid, text, author_quality, quality_reactions, quality_replies
    FROM listed WHERE position <= 10"""
)
def recommended_posts(fx: Fixtures):
    weighted, table = learnt(fx)
    posts = recommend.recommended_posts(weighted, table, KEYS)
    return posts.withColumn("cluster_keywords", joined("cluster_keywords", ",")).select(
        *KEYS, "position", "cluster_id", "cluster_theme", "cluster_keywords", "hash", "fid", "text",
        "author_quality", "quality_reactions", "quality_replies",
    )


@query(
    HEAD
    + """ SELECT user_id, session, round(count(DISTINCT name) / CAST(count(*) AS DOUBLE), 6) AS diversity
    FROM feedback JOIN book USING (cluster_id) GROUP BY ALL"""
)
def cluster_diversity(fx: Fixtures):
    return rounded(recommend.diversity(fx.feedback(), theme_clusters(fx), KEYS))


PREFERENCES = """answers AS (SELECT f.*, name, top_words FROM feedback f JOIN book USING (cluster_id)),
themes_liked AS (
  SELECT user_id, session, string_agg(name, ',' ORDER BY first) AS preferred_themes FROM (
    SELECT user_id, session, name, min(seq) FILTER (WHERE liked) AS first FROM answers
    GROUP BY ALL HAVING count(*) FILTER (WHERE liked) > count(*) FILTER (WHERE NOT liked)) GROUP BY ALL),
word_counts AS (
  SELECT user_id, session, word, count(*) AS n, min(seq * 100 + i) AS first FROM (
    SELECT user_id, session, seq, unnest(top_words[1:5]) AS word, generate_subscripts(top_words[1:5], 1) AS i
    FROM answers WHERE liked) GROUP BY ALL),
words_liked AS (
  SELECT user_id, session, string_agg(word, ',' ORDER BY rank) AS top_keywords FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, session ORDER BY n DESC, first) AS rank FROM word_counts)
  WHERE rank <= 10 GROUP BY ALL),
given AS (
  SELECT user_id, session,
         coalesce(string_agg(CAST(cluster_id AS VARCHAR), ',' ORDER BY seq) FILTER (WHERE liked), '') AS liked_clusters,
         coalesce(string_agg(CAST(cluster_id AS VARCHAR), ',' ORDER BY seq) FILTER (WHERE NOT liked), '') AS disliked_clusters
  FROM feedback GROUP BY ALL)"""


@query(
    HEAD + ", " + PREFERENCES
    + """ SELECT user_id, session, coalesce(preferred_themes, '') AS preferred_themes,
      coalesce(top_keywords, '') AS top_keywords, liked_clusters, disliked_clusters
    FROM given LEFT JOIN themes_liked USING (user_id, session) LEFT JOIN words_liked USING (user_id, session)"""
)
def preference_summary(fx: Fixtures):
    df = recommend.preference_summary(fx.feedback(), theme_clusters(fx), KEYS)
    return df.select(
        *KEYS,
        *[joined(F.col(c).cast("array<string>"), ",").alias(c) for c in df.columns if c not in KEYS],
    )


FOLLOW = """seen AS (
  SELECT f.user_id, f.session, f.seq, f.liked, r.* FROM feedback f JOIN rep_rows r ON f.cluster_id = r.cluster_id),
followed AS (
  SELECT user_id, session, fid, score, quality_score, themes, sample_post,
         row_number() OVER (PARTITION BY user_id, session ORDER BY round(score, 9) DESC, first) AS rank
  FROM (SELECT user_id, session, fid,
          sum(2.0e0 * quality_score) FILTER (WHERE liked) * pow(0.5e0, count(*) FILTER (WHERE NOT liked)) AS score,
          arg_min(quality_score, seq * 100 + idx) FILTER (WHERE liked) AS quality_score,
          string_agg(DISTINCT name, ',' ORDER BY name) FILTER (WHERE liked) AS themes,
          arg_min(left(text, 150), seq * 100 + idx) FILTER (WHERE liked) AS sample_post,
          min(seq * 100 + idx) FILTER (WHERE liked) AS first
        FROM seen GROUP BY ALL) WHERE first IS NOT NULL)"""


@query(
    HEAD + ", " + FOLLOW
    + f""" SELECT user_id, session, CAST(rank AS INTEGER) AS rank, fid, round(score + {SHIFT}, 6) AS score,
      quality_score, themes, sample_post FROM followed WHERE rank <= 10"""
)
def users_to_follow(fx: Fixtures):
    df = recommend.users_to_follow(fx.feedback(), theme_clusters(fx), KEYS)
    shown = df.withColumn("themes", joined("themes", ",")).withColumn("score", F.col("score") + SHIFT)
    return rounded(shown)


@query(
    LEARNT + ", " + ",\n".join([PREFERENCES, FOLLOW, LISTED])
    + f""", posts_listed AS (
      SELECT user_id, session, string_agg(concat_ws(':', cluster_id, name, cluster_keywords, hash, fid, text), ';' ORDER BY position) AS posts
      FROM listed WHERE position <= 10 GROUP BY ALL),
    users_listed AS (
      SELECT user_id, session, string_agg(concat_ws(':', fid, CAST(round(score * 1000 + {SHIFT}) AS BIGINT), themes, sample_post), ';' ORDER BY rank) AS users
      FROM followed WHERE rank <= 10 GROUP BY ALL)
    SELECT user_id, session, coalesce(preferred_themes, '') AS preferred_themes, coalesce(top_keywords, '') AS top_keywords,
           liked_clusters, disliked_clusters, coalesce(posts, '') AS posts, coalesce(users, '') AS users
    FROM given LEFT JOIN themes_liked USING (user_id, session) LEFT JOIN words_liked USING (user_id, session)
    LEFT JOIN posts_listed USING (user_id, session) LEFT JOIN users_listed USING (user_id, session)"""
)
def combined_output(fx: Fixtures):
    weighted, table = learnt(fx)
    feedback = fx.feedback()
    nested = recommend.combined_output(
        recommend.preference_summary(feedback, table, KEYS),
        recommend.recommended_places(weighted, table, KEYS),
        recommend.users_to_follow(feedback, table, KEYS),
        KEYS,
        table,
    )
    told = [joined(F.col(f"preferences.{c}").cast("array<string>"), ",").alias(c)
            for c in ("preferred_themes", "top_keywords", "liked_clusters", "disliked_clusters")]
    post = lambda p: F.concat_ws(":", p["cluster_id"], p["cluster_theme"], joined(p["cluster_keywords"], ","), p["hash"], p["fid"], p["text"])
    user = lambda u: F.concat_ws(":", u["fid"], F.round(u["score"] * 1000 + SHIFT).cast("bigint"), joined(u["themes"], ","), u["sample_post"])
    return nested.select(
        *KEYS, *told,
        F.coalesce(joined(F.transform("recommendations", post), ";"), F.lit("")).alias("posts"),
        F.coalesce(joined(F.transform("recommended_users", user), ";"), F.lit("")).alias("users"),
    )


EARLY = """early AS (
  SELECT cluster_id, count(*) AS size, avg(quality_reactions) AS avg_reactions, avg(quality_replies) AS avg_replies
  FROM clustered GROUP BY cluster_id)"""


def difference_sql(field: str) -> str:
    return (
        f"CASE WHEN greatest(a.{field}, b.{field}) = 0 THEN 0e0 "
        f"ELSE abs(a.{field} - b.{field}) / CAST(greatest(a.{field}, b.{field}) AS DOUBLE) END"
    )


SIMILARITY = f"""similarity AS (
  SELECT a.cluster_id, b.cluster_id AS similar_id,
         1 - ({difference_sql('size')} + {difference_sql('avg_reactions')} + {difference_sql('avg_replies')}) / 3 AS similarity,
         row_number() OVER (PARTITION BY a.cluster_id ORDER BY round(1 - ({difference_sql('size')}
           + {difference_sql('avg_reactions')} + {difference_sql('avg_replies')}) / 3, 9) DESC, b.cluster_id) AS rank
  FROM early a JOIN early b ON a.cluster_id <> b.cluster_id)"""


@query(
    with_views("clustered") + ", " + ",\n".join([EARLY, SIMILARITY])
    + """ SELECT cluster_id, CAST(rank AS INTEGER) AS rank, similar_id, round(similarity, 6) AS similarity
    FROM similarity WHERE rank <= 5"""
)
def similar_clusters(fx: Fixtures):
    return rounded(onboarding.similar_clusters(early_clusters(fx)))


@query(
    with_views("clustered") + ", " + EARLY
    + f""", usable AS (SELECT * FROM early WHERE size > {MIN_SIZE}),
    picks AS (
      SELECT cluster_id, 1 AS src, '' AS d FROM usable QUALIFY row_number() OVER (ORDER BY size DESC, cluster_id) = 1
      UNION ALL
      SELECT cluster_id, 2, '' FROM usable QUALIFY row_number() OVER (ORDER BY avg_reactions DESC, cluster_id) = 2
      UNION ALL
      SELECT cluster_id, 3, '' FROM usable QUALIFY row_number() OVER (ORDER BY avg_replies DESC, cluster_id) = 3
      UNION ALL SELECT cluster_id, 4, md5('42|' || cluster_id) FROM usable)
    SELECT CAST(row_number() OVER (ORDER BY
             CASE WHEN (SELECT count(*) FROM usable) < 3 THEN cluster_id ELSE src END, d) AS INTEGER) AS position, cluster_id
    FROM (
      SELECT cluster_id, min(src) AS src, arg_min(d, src) AS d FROM picks GROUP BY cluster_id)
    QUALIFY position <= 3"""
)
def diverse_clusters(fx: Fixtures):
    return onboarding.diverse_clusters(early_clusters(fx), min_size=MIN_SIZE)


@query(
    with_views("clustered", "feedback", recursive=True) + ", " + ",\n".join([EARLY, SIMILARITY])
    + f""", near AS (
      SELECT cluster_id, list(similar_id ORDER BY rank) AS near FROM similarity WHERE rank <= {SIMILAR} GROUP BY cluster_id),
    rounds AS (
      SELECT user_id, session, seq AS round, CASE WHEN liked THEN cluster_id END AS preferred,
             [cluster_id, (cluster_id + 1) % 10, (cluster_id + 2) % 10] AS shown FROM feedback WHERE seq <= 3),
    all_ids AS (SELECT list(cluster_id ORDER BY cluster_id) AS ids FROM early),
    state AS (
      SELECT DISTINCT user_id, session, 0 AS round, CAST([] AS INTEGER[]) AS preferences, ids AS candidates,
             CAST([] AS INTEGER[]) AS excluded FROM rounds, all_ids
      UNION ALL
      SELECT user_id, session, round,
        CASE WHEN done OR preferred IS NULL THEN preferences ELSE list_append(preferences, preferred) END,
        CASE WHEN done OR preferred IS NULL THEN candidates ELSE cand END,
        CASE WHEN done THEN excluded
             WHEN preferred IS NULL THEN list_sort(list_distinct(list_concat(excluded, shown)))
             ELSE list_sort(list_distinct(list_concat(excluded, far[1:len(far) // 2]))) END
      FROM (SELECT *, list_filter(ids, lambda x: NOT list_contains(cand, x) AND NOT list_contains(excluded, x)) AS far
            FROM (SELECT s.user_id, s.session, r.round, preferences, candidates, excluded, preferred, shown, ids,
                    len(candidates) <= 3 AS done, list_prepend(preferred, near) AS cand
                  FROM state s JOIN rounds r ON r.user_id = s.user_id AND r.session = s.session AND r.round = s.round + 1
                  CROSS JOIN all_ids LEFT JOIN near n ON n.cluster_id = r.preferred)))
    SELECT user_id, session, array_to_string(preferences, ',') AS preferences,
           array_to_string(candidates, ',') AS candidates, array_to_string(excluded, ',') AS excluded
    FROM state QUALIFY round = max(round) OVER (PARTITION BY user_id, session)"""
)
def narrow_down(fx: Fixtures):
    c = F.col("cluster_id")
    rounds = fx.feedback().filter(F.col("seq") <= 3).select(
        *KEYS, F.col("seq").alias("round"), F.when(F.col("liked"), c).alias("preferred"),
        F.array(c, (c + 1) % 10, (c + 2) % 10).alias("shown"),
    )
    state = onboarding.narrow_down(rounds, materialized(early_clusters(fx)), KEYS, similar=SIMILAR)
    return state.select(
        *KEYS,
        *[joined(F.col(x).cast("array<string>"), ",").alias(x) for x in ("preferences", "candidates", "excluded")],
    )


@query(
    with_views("clustered") + ", " + EARLY
    + """ SELECT count(*) AS total_clusters, CAST(sum(size) AS BIGINT) AS total_posts, min(size) AS smallest,
      max(size) AS largest FROM early"""
)
def onboarding_totals(fx: Fixtures):
    return onboarding.onboarding_totals(early_clusters(fx))
