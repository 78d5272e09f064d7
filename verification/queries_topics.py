"""Clusters with given labels: representatives, keywords, names, records."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanwell.operators import clusters, topics
from gleanwell.session import materialized
from verification.catalog import joined, query, rounded
from verification.fixtures import Fixtures, with_views


def sql_list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


CENTRES = """centres AS (
  SELECT cluster_id, list(m ORDER BY i) AS centre FROM (
    SELECT cluster_id, i, avg(x) AS m FROM (
      SELECT cluster_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM clustered)
    GROUP BY cluster_id, i) GROUP BY cluster_id)"""
DISTANCES = """distances AS (
  SELECT c.*, list_distance(CAST(embedding AS DOUBLE[]), centre) AS distance_to_center
  FROM clustered c JOIN centres USING (cluster_id))"""


def reps_sql(score: str, near: int, loud: int, cap: int) -> str:
    return f"""reps AS (
  SELECT d.*, position FROM distances d JOIN (
    SELECT cluster_id, Hash, row_number() OVER (PARTITION BY cluster_id ORDER BY pos) AS position FROM (
      SELECT cluster_id, Hash, min(pos) AS pos FROM (
        SELECT cluster_id, Hash, row_number() OVER (PARTITION BY cluster_id ORDER BY distance_to_center, Hash) AS pos
        FROM distances QUALIFY pos <= {near}
        UNION ALL
        SELECT cluster_id, Hash, {near} + row_number() OVER (PARTITION BY cluster_id ORDER BY {score} DESC, Hash) AS pos
        FROM distances QUALIFY pos <= {near} + {loud})
      GROUP BY cluster_id, Hash)
    QUALIFY position <= {cap}) USING (cluster_id, Hash))"""


GRAMS = rf"""grams AS (
  SELECT cluster_id, Hash, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
  FROM (SELECT cluster_id, Hash,
          list_filter(regexp_extract_all(lower(Text), '[\p{{L}}\p{{N}}_]{{2,}}'),
                      lambda x: NOT list_contains({sql_list(topics.STOP_WORDS)}, x)) AS w FROM clustered))"""
KEYWORDS = """occurrences AS (SELECT cluster_id, Hash, unnest(g) AS term FROM grams),
tf AS (SELECT cluster_id, Hash, term, count(*) AS n FROM occurrences GROUP BY ALL),
vocabulary AS (
  SELECT cluster_id, term, ln((1 + docs_all) / CAST(1 + docs AS DOUBLE)) + 1 AS idf FROM (
    SELECT cluster_id, term, count(*) AS docs, sum(n) AS uses FROM tf GROUP BY cluster_id, term HAVING count(*) >= 2
    QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY sum(n) DESC, term) <= 100)
  JOIN (SELECT cluster_id, count(*) AS docs_all FROM clustered GROUP BY cluster_id) USING (cluster_id)),
weights AS (
  SELECT cluster_id, Hash, term, n * idf AS w FROM tf JOIN vocabulary USING (cluster_id, term)),
keywords AS (
  SELECT cluster_id, term, score,
         row_number() OVER (PARTITION BY cluster_id ORDER BY round(score, 9) DESC, term) AS rank
  FROM (SELECT cluster_id, term, sum(w / norm) AS score
        FROM weights JOIN (SELECT cluster_id, Hash, sqrt(sum(w * w)) AS norm FROM weights GROUP BY ALL)
          USING (cluster_id, Hash) GROUP BY cluster_id, term)
  QUALIFY rank <= 30),
top_words AS (
  SELECT cluster_id, list(term ORDER BY rank) FILTER (WHERE rank <= 10) AS top_words,
         list(term || '=' || printf('%.4f', score) ORDER BY rank) FILTER (WHERE rank <= 20) AS kw
  FROM keywords GROUP BY cluster_id)"""
THEME_ROWS = ", ".join(
    f"({i}, '{name}', {sql_list(words)})" for i, (name, words) in enumerate(topics.THEMES)
)


def title_sql(word: str) -> str:
    return (
        rf"list_aggregate(list_transform(regexp_extract_all({word}, '\p{{L}}+|[^\p{{L}}]+'), "
        r"lambda r: upper(r[1:1]) || lower(r[2:])), 'string_agg', '')"
    )


NAMES = f"""themes(ord, theme, words) AS (VALUES {THEME_ROWS}),
matched AS (
  SELECT cluster_id, min_by(theme, ord) AS theme FROM (
    SELECT cluster_id, ord, theme, len(list_filter(top_words,
             lambda w: len(list_filter(words, lambda t: contains(lower(w), t))) > 0)) AS hits
    FROM top_words, themes) WHERE hits >= 2 GROUP BY cluster_id),
long_words AS (
  SELECT cluster_id, list_filter(top_words, lambda w: length(w) > 4
           AND NOT list_contains({sql_list(topics.EMPTY_WORDS)}, lower(w))) AS lw FROM top_words),
names AS (
  SELECT cluster_id, coalesce(theme,
           CASE WHEN len(lw) >= 2 THEN {title_sql('lw[1]')} || ' ' || {title_sql('lw[2]')} END,
           CASE WHEN len(top_words) >= 1 THEN {title_sql('top_words[1]')} || ' Topics' END, 'Mixed Topics') AS name
  FROM top_words JOIN long_words USING (cluster_id) LEFT JOIN matched USING (cluster_id))"""
AVERAGES = """averages AS (
  SELECT cluster_id, count(*) AS size, avg(quality_score) AS avg_quality_score,
         avg(quality_reactions) AS avg_quality_reactions, avg(quality_replies) AS avg_quality_replies,
         avg(cast_score) AS avg_cast_score FROM clustered GROUP BY cluster_id)"""
VECTORS = with_views("clustered") + ", " + ",\n".join([CENTRES, DISTANCES])
REPS = reps_sql("cast_score", 10, 10, 10)
WORDS = with_views("clustered") + ", " + ",\n".join([GRAMS, KEYWORDS])
RECORD_CTES = ",\n".join([CENTRES, DISTANCES, REPS, GRAMS, KEYWORDS, NAMES, AVERAGES])


def placed(fx: Fixtures):
    posts = fx.clustered()
    return clusters.distance_to_centre(posts, clusters.cluster_centres(posts))


def reps(fx: Fixtures):
    return clusters.representatives(placed(fx))


@query(with_views("clustered") + "SELECT cluster_id, count(*) AS size FROM clustered GROUP BY cluster_id")
def cluster_sizes(fx: Fixtures):
    return clusters.cluster_sizes(fx.clustered())


@query(VECTORS + " SELECT Hash, cluster_id, round(distance_to_center, 6) AS distance_to_center FROM distances")
def distance_to_centre(fx: Fixtures):
    return rounded(placed(fx).select("Hash", "cluster_id", "distance_to_center"))


@query(VECTORS + ", " + REPS + " SELECT cluster_id, position, Hash, Text, cast_score FROM reps")
def cluster_representatives(fx: Fixtures):
    return reps(fx).select("cluster_id", "position", "Hash", "Text", "cast_score")


@query(WORDS + " SELECT cluster_id, rank, term, round(score, 6) AS score FROM keywords")
def cluster_keywords(fx: Fixtures):
    return rounded(topics.cluster_keywords(fx.clustered()))


@query(
    with_views("clustered")
    + rf"""SELECT cluster_id, rank, word, n FROM (
      SELECT cluster_id, word, count(*) AS n,
             row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, word) AS rank
      FROM (SELECT cluster_id, unnest(regexp_extract_all(lower(Text), '[\p{{L}}\p{{N}}_]+')) AS word FROM clustered)
      WHERE regexp_full_match(word, '[a-z]{{4,}}') AND NOT list_contains({sql_list(topics.EARLY_STOP_WORDS)}, word)
      GROUP BY cluster_id, word) WHERE rank <= 10"""
)
def cluster_common_words(fx: Fixtures):
    return topics.common_words(fx.clustered(), first_texts=None)


@query(WORDS + ", " + NAMES + " SELECT cluster_id, name FROM names")
def cluster_names(fx: Fixtures):
    lists = topics.keyword_lists(topics.cluster_keywords(fx.clustered()))
    return lists.select("cluster_id", topics.rule_name(F.col("top_words")).alias("name"))


def records(fx: Fixtures):
    return topics.cluster_records(fx.clustered(), reps(fx), topics.cluster_keywords(fx.clustered()))


RECORD_SQL = """ SELECT cluster_id, name, size, array_to_string(kw, ', ') AS keywords,
  array_to_string(top_words, ', ') AS top_words, round(avg_quality_score, 6) AS avg_quality_score,
  round(avg_quality_reactions, 6) AS avg_quality_reactions,
  round(avg_quality_replies, 6) AS avg_quality_replies, round(avg_cast_score, 6) AS avg_cast_score, rep_hashes
FROM averages JOIN names USING (cluster_id) JOIN top_words USING (cluster_id)
JOIN (SELECT cluster_id, string_agg(
        CASE WHEN length(Hash) % 4 = 0 THEN lower(hex(from_base64(Hash))) ELSE Hash END, ',' ORDER BY position
      ) AS rep_hashes FROM reps GROUP BY cluster_id) USING (cluster_id)"""


@query(with_views("clustered") + ", " + RECORD_CTES + RECORD_SQL)
def cluster_records(fx: Fixtures):
    df = records(fx)
    shown = F.transform("keywords", lambda k: F.format_string("%s=%.4f", k["term"], k["score"]))
    return rounded(
        df.withColumn("keywords", joined(shown, ", "))
        .withColumn("top_words", joined("top_words", ", "))
        .withColumn("rep_hashes", joined(F.transform("representatives", lambda r: r["hash"]), ","))
        .drop("representatives")
    )


@query(
    with_views("clustered")
    + """SELECT count(*) AS total_clusters, CAST(sum(size) AS BIGINT) AS total_posts, avg(size) AS mean,
      median(size) AS median, min(size) AS min, max(size) AS max
    FROM (SELECT count(*) AS size FROM clustered GROUP BY cluster_id)"""
)
def cluster_size_summary(fx: Fixtures):
    summary = clusters.size_summary(clusters.cluster_sizes(fx.clustered()))
    return summary.select("total_clusters", "total_posts", "cluster_sizes.*")


def early(fx: Fixtures):
    return placed(fx).withColumnsRenamed(
        {"quality_reactions": "reaction_count", "quality_replies": "reply_count"}
    )


EARLY_REPS = reps_sql("quality_reactions", 5, 5, 10)


@query(
    VECTORS + ", " + EARLY_REPS
    + """ SELECT cluster_id, size, round(avg_reactions, 6) AS avg_reactions, round(avg_replies, 6) AS avg_replies, posts
    FROM (SELECT cluster_id, count(*) AS size, avg(quality_reactions) AS avg_reactions,
            avg(quality_replies) AS avg_replies FROM clustered GROUP BY cluster_id)
    JOIN (SELECT cluster_id, string_agg(Fid || ':' || quality_reactions || ':' || quality_replies || ':' ||
            printf('%.5f', distance_to_center) || ':' || md5(Text), ',' ORDER BY position) AS posts
          FROM reps GROUP BY cluster_id) USING (cluster_id)"""
)
def early_cluster_info(fx: Fixtures):
    info = clusters.early_cluster_info(early(fx))
    shown = F.transform(
        "representative_posts",
        lambda p: F.concat_ws(
            ":", p["fid"].cast("string"), p["reactions"].cast("string"), p["replies"].cast("string"),
            F.format_string("%.5f", p["distance_to_center"]), F.md5(p["text"]),
        ),
    )
    return rounded(
        info.select("cluster_id", "size", "avg_reactions", "avg_replies", joined(shown, ",").alias("posts"))
    )


@query(
    VECTORS + ", " + EARLY_REPS
    + rf""", common AS (
      SELECT cluster_id, string_agg(word, ',' ORDER BY n DESC, word) AS common_words FROM (
        SELECT cluster_id, word, count(*) AS n
        FROM (SELECT cluster_id, unnest(regexp_extract_all(lower(Text), '[\p{{L}}\p{{N}}_]+')) AS word FROM clustered)
        WHERE regexp_full_match(word, '[a-z]{{4,}}') AND NOT list_contains({sql_list(topics.FAST_STOP_WORDS)}, word)
        GROUP BY cluster_id, word QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, word) <= 5)
      GROUP BY cluster_id)
    SELECT cluster_id AS id, size, top_post, common_words
    FROM (SELECT cluster_id, count(*) AS size FROM clustered GROUP BY cluster_id)
    JOIN (SELECT cluster_id, left(Text, 200) AS top_post FROM reps WHERE position = 1) USING (cluster_id)
    JOIN common USING (cluster_id)"""
)
def early_cluster_summary(fx: Fixtures):
    words = topics.common_words(fx.clustered(), topics.FAST_STOP_WORDS, first_texts=None)
    summary = clusters.early_cluster_summary(clusters.early_cluster_info(early(fx)), words)
    return summary.withColumn("common_words", joined("common_words", ","))


@query(
    with_views("clustered") + ", " + RECORD_CTES
    + """ SELECT cluster_id, 'Keywords: ' || array_to_string(top_words, ', ') || chr(10) || 'Sample posts:' || chr(10) ||
        string_agg(position || '. ' || left(Text, 200), chr(10) ORDER BY position) AS body
    FROM reps JOIN top_words USING (cluster_id) WHERE position <= 3 GROUP BY cluster_id, top_words"""
)
def naming_prompts(fx: Fixtures):
    prompts = topics.naming_prompts(records(fx))
    body = F.substr("prompt", F.lit(len(topics.NAMING_TASK) + 2))
    return prompts.select("cluster_id", body.alias("body"))


def short_titles(prompts: list[str]) -> list[str]:
    """A stand-in for a naming model: the first three keywords, quoted, with a second line."""
    lines = [p.split("Keywords: ")[1].split("\n")[0].split(", ") for p in prompts]
    return [' "' + " ".join(words[:3]) + '" \nbecause of the keywords' for words in lines]


@query(
    WORDS
    + """ SELECT cluster_id, CASE WHEN length(t) > 40 AND contains(t[:40], ' ')
            THEN regexp_replace(t[:40], ' [^ ]*$', '') ELSE t[:40] END AS name
    FROM (SELECT cluster_id, top_words[1] || ' ' || top_words[2] || ' ' || top_words[3] AS t FROM top_words)"""
)
def model_names(fx: Fixtures):
    named = topics.cluster_records(
        fx.clustered(), reps(fx), topics.cluster_keywords(fx.clustered()), namer=short_titles
    )
    return named.select("cluster_id", F.rtrim("name").alias("name"))


def theme_clusters(fx: Fixtures):
    """The cluster records under four shared theme names, so that themes repeat."""
    theme = F.concat(F.lit("Theme "), (F.col("cluster_id") % 4).cast("string"))
    return materialized(records(fx).withColumn("name", theme))


def early_clusters(fx: Fixtures):
    return early(fx).groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("size"),
        F.avg("reaction_count").alias("avg_reactions"),
        F.avg("reply_count").alias("avg_replies"),
    )
