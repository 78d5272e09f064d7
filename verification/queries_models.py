"""Labels, author models, vectors and clusterings."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanwell.functions.scalars import hash_hex as hex_of
from gleanwell.functions.scalars import quality_category
from gleanwell.operators import clusters, density, labeling, quality_model, vectors
from gleanwell.operators.features import FEATURES
from gleanwell.plans import restart
from gleanwell.session import materialized, scratch_folder
from gleanwell.sources import sinks, tables
from verification.catalog import joined, query, rounded
from verification.fixtures import Fixtures, with_views
from verification.queries_users import TO_LABEL, all_features, to_label



@query(with_views("scores") + "SELECT fid, quality_score, is_quality_user, quality_category FROM scores")
def quality_categories(fx: Fixtures):
    return fx.scores()


CATEGORIES = "(VALUES ('Spammer'), ('Low'), ('Average'), ('High'), ('Leader')) c(category)"


@query(
    with_views("scores")
    + f"""SELECT category, count(fid) AS users,
      round(count(fid) / CAST((SELECT count(*) FROM scores) AS DOUBLE), 6) AS share
    FROM {CATEGORIES} LEFT JOIN scores ON quality_category = category GROUP BY category"""
)
def category_counts(fx: Fixtures):
    return rounded(labeling.category_counts(fx.scores(), "quality_category"))


@query(
    with_views("scores")
    + """SELECT count(*) AS users, round(avg(quality_score), 6) AS mean_score,
      round(median(quality_score), 6) AS median_score,
      count(*) FILTER (WHERE quality_score >= 7) AS high_quality_users,
      round(avg(CAST(quality_score >= 7 AS INT)), 6) AS high_quality_share FROM scores"""
)
def score_stats(fx: Fixtures):
    return rounded(quality_model.score_stats(fx.scores()))


SECTION = """sections AS (
  SELECT fid, 'Author id: ' || fid || chr(10) || 'Posts: ' || post_count || chr(10) ||
    'Mean post length: ' || printf('%.0f', avg_text_length) || ' characters' || chr(10) ||
    'Share of greetings: ' || printf('%.2f', gm_ratio * 100) || '%' || chr(10) ||
    'Share of questions: ' || printf('%.2f', question_ratio * 100) || '%' || chr(10) ||
    'Newest posts:' || chr(10) || array_to_string(list_transform(posts[1:30], lambda p:
      '- ' || CASE WHEN length(p) > 150 THEN left(p, 150) || '...' ELSE p END), chr(10)) AS section
  FROM to_label)"""


@query(TO_LABEL + ", " + SECTION + " SELECT fid, section FROM sections")
def user_prompts(fx: Fixtures):
    prompts = labeling.user_prompts(to_label(fx))
    start, end = len(labeling.ONE_AUTHOR) + 3, len(labeling.ONE_ANSWER) + 2
    body = F.substr("prompt", F.lit(start), F.length("prompt") - (start - 1 + end))
    return prompts.select("fid", body.alias("section"))


@query(
    TO_LABEL + ", " + SECTION
    + """, placed AS (
      SELECT fid, section, md5(CAST(fid AS VARCHAR)) AS d, left(md5(CAST(fid AS VARCHAR)), 1) AS slice,
             row_number() OVER (PARTITION BY left(md5(CAST(fid AS VARCHAR)), 1) ORDER BY md5(CAST(fid AS VARCHAR))) - 1 AS place
      FROM sections)
    SELECT slice || '-' || (place // 25) AS batch, string_agg(CAST(fid AS VARCHAR), ',' ORDER BY place) AS fids,
           md5(string_agg(section, chr(10) || repeat('=', 80) || chr(10) ORDER BY place)) AS sections
    FROM placed GROUP BY 1"""
)
def batch_prompts(fx: Fixtures):
    prompts = labeling.batch_prompts(to_label(fx))
    start = len(labeling.MANY_AUTHORS) + 83
    return prompts.select(
        "batch",
        joined(F.col("fids").cast("array<string>"), ",").alias("fids"),
        F.md5(F.substr("prompt", F.lit(start))).alias("sections"),
    )


def length_judge(prompts: list[str]) -> list[str]:
    """A stand-in for a labelling model: the score follows the number of posts."""
    scores = [int(p.split("Posts: ")[1].split("\n")[0]) % 11 for p in prompts]
    return [f"SCORE: {s}/10\nTHEMES: posts, numbers\nREASONING: counted" for s in scores]


@query(
    TO_LABEL
    + """ SELECT fid, quality_score, CASE WHEN quality_score <= 2.5 THEN 'Spammer' WHEN quality_score <= 4.5 THEN 'Low'
        WHEN quality_score <= 6.5 THEN 'Average' WHEN quality_score <= 8.5 THEN 'High' ELSE 'Leader' END AS category,
      'counted' AS reasoning, 'posts,numbers' AS content_themes
    FROM (SELECT fid, CAST(post_count % 11 AS DOUBLE) AS quality_score FROM to_label)"""
)
def labels_by_model(fx: Fixtures):
    labels = labeling.label_users(to_label(fx), length_judge)
    return labels.withColumn("content_themes", joined("content_themes", ","))


def replies(fx: Fixtures):
    """Model replies of several shapes, made from labelled documents and their whole texts."""
    rows = fx.table("labels").join(fx.table("documents"), "doc_id")
    score = F.col("quality") * 8 + F.col("toxic") + 1
    nl = "\n"
    shapes = [
        F.concat(
            F.lit("SCORE: "), score.cast("string"), F.lit("/10\nCATEGORY: none\nTHEMES: "),
            F.col("lang"), F.lit(", "), F.col("source"), F.lit("\nREASONING: "), F.col("text"),
        ),
        F.concat(F.lit("  SCORE:  7.5 points \nCATEGORY: Leader\nTHEMES:\nREASONING:\n"), F.col("text")),
        F.concat(F.lit("CATEGORY: High\nREASONING: "), F.col("text")),
        F.concat(F.lit("SCORE: unknown\nREASONING: "), F.col("text")),
        F.concat(F.col("text"), F.lit(f"{nl}SCORE: 3{nl}SCORE: "), score.cast("string")),
        F.col("text"),
    ]
    reply = F.element_at(F.array(*shapes), (F.col("doc_id") % 6 + 1).cast("int"))
    return rows.select(F.col("doc_id").alias("fid"), reply.alias("reply"))


STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
REPLIES = f"""replies AS (
  SELECT doc_id AS fid, [
    'SCORE: ' || (quality * 8 + toxic + 1) || '/10' || chr(10) || 'CATEGORY: none' || chr(10) || 'THEMES: ' || lang || ', ' || source
      || chr(10) || 'REASONING: ' || text,
    '  SCORE:  7.5 points ' || chr(10) || 'CATEGORY: Leader' || chr(10) || 'THEMES:' || chr(10) || 'REASONING:' || chr(10) || text,
    'CATEGORY: High' || chr(10) || 'REASONING: ' || text,
    'SCORE: unknown' || chr(10) || 'REASONING: ' || text,
    text || chr(10) || 'SCORE: 3' || chr(10) || 'SCORE: ' || (quality * 8 + toxic + 1),
    text][doc_id % 6 + 1] AS reply
  FROM labels JOIN documents USING (doc_id)),
split AS (
  SELECT fid, list_transform(string_split({STRIP.format('reply')}, chr(10)), lambda x: {STRIP.format('x')}) AS lines FROM replies),
kinds AS (
  SELECT fid,
    list_transform(list_filter(lines, lambda x: starts_with(x, 'SCORE:')), lambda x:
      string_split({STRIP.format("string_split(" + STRIP.format("replace(x, 'SCORE:', '')") + ", '/')[1]")}, ' ')[1]) AS tokens,
    list_transform(list_filter(lines, lambda x: starts_with(x, 'CATEGORY:')), lambda x: {STRIP.format("replace(x, 'CATEGORY:', '')")})[-1] AS cat,
    list_transform(list_filter(lines, lambda x: starts_with(x, 'THEMES:')), lambda x: {STRIP.format("replace(x, 'THEMES:', '')")})[-1] AS themes,
    list_transform(list_filter(lines, lambda x: starts_with(x, 'REASONING:')), lambda x: {STRIP.format("replace(x, 'REASONING:', '')")})[-1] AS reason
  FROM split),
parsed AS (
  SELECT *, TRY_CAST(tokens[-1] AS DOUBLE) AS score,
         len(list_filter(tokens, lambda t: TRY_CAST(t AS DOUBLE) IS NULL)) > 0 AS bad FROM kinds)"""


@query(
    "WITH " + REPLIES
    + f""" SELECT fid, CASE WHEN bad THEN 5.0e0 ELSE coalesce(score, 5.0e0) END AS quality_score,
      CASE WHEN bad THEN 'Average' WHEN score <= 2.5 THEN 'Spammer' WHEN score <= 4.5 THEN 'Low'
           WHEN score <= 6.5 THEN 'Average' WHEN score <= 8.5 THEN 'High' WHEN score IS NOT NULL THEN 'Leader'
           WHEN cat <> '' THEN cat ELSE 'Average' END AS category,
      CASE WHEN bad OR themes IS NULL THEN 'general'
           ELSE array_to_string(list_transform(string_split(themes, ','), lambda t: {STRIP.format('t')}), ';') END AS content_themes,
      CASE WHEN bad THEN 'Error parsing model response' WHEN reason <> '' THEN reason ELSE 'Unable to parse response' END AS reasoning
    FROM parsed"""
)
def parsed_labels(fx: Fixtures):
    parsed = labeling.parse_replies(replies(fx)).drop("reply")
    return parsed.withColumn("content_themes", joined("content_themes", ";"))


@query(
    """SELECT doc_id AS fid, quality * 8.0e0 + toxic AS quality_score, 'High' AS category, source AS reasoning,
      lang || ',' || source AS content_themes
    FROM labels JOIN documents USING (doc_id) WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0"""
)
def parsed_ratings(fx: Fixtures):
    rows = fx.table("labels").join(fx.table("documents"), "doc_id")
    score = F.when(F.col("doc_id") % 7 == 0, 12).otherwise(F.col("quality") * 8 + F.col("toxic"))
    whole = F.format_string(
        '{"ratings":[{"fid":%d,"quality_score":%d,"category":"High","reasoning":"%s","content_themes":["%s","%s"]}]}',
        F.col("doc_id"), score, F.col("source"), F.col("lang"), F.col("source"),
    )
    reply = F.when(F.col("doc_id") % 11 == 0, F.left(whole, F.length(whole) - 9)).otherwise(whole)
    ratings = labeling.parse_ratings(rows.select(reply.alias("reply")))
    return ratings.withColumn("content_themes", joined("content_themes", ","))


@query(
    with_views("scores")
    + """SELECT quality_category AS category, CAST(min(CAST(fid AS BIGINT)) AS BIGINT) AS fid FROM scores GROUP BY 1"""
)
def category_examples(fx: Fixtures):
    labeled = fx.scores().select(
        F.col("fid").cast("bigint").alias("fid"), F.col("quality_category").alias("category")
    )
    return labeling.first_per_category(labeled).select("category", "fid")


HASHES = """hashes AS (
  SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN to_base64(unhex(md5(text))) WHEN 1 THEN '0x' || md5(text)
         ELSE md5(text) END AS hash FROM documents)"""


@query(
    "WITH " + HASHES
    + """ SELECT doc_id, CASE WHEN length(hash) % 4 = 0 THEN lower(hex(from_base64(hash))) ELSE hash END AS hash_hex FROM hashes"""
)
def hash_hex(fx: Fixtures):
    digest = F.md5("text")
    kind = F.col("doc_id") % 3
    hashed = (
        F.when(kind == 0, F.base64(F.unhex(digest)))
        .when(kind == 1, F.concat(F.lit("0x"), digest))
        .otherwise(digest)
    )
    return fx.table("documents").select("doc_id", hex_of(hashed).alias("hash_hex"))


GUESSED = """guessed AS (
  SELECT doc_id, quality, CAST(n_chars > 1500 AS INTEGER) AS guess, quality * 8.0e0 + 2 - toxic * 2 AS score,
         CAST(n_chars % 11 AS DOUBLE) AS guessed_score FROM labels JOIN documents USING (doc_id))"""


def guessed(fx: Fixtures):
    """Labels beside a guess from the text length, to check the report figures exactly."""
    return fx.table("labels").join(fx.table("documents"), "doc_id").select(
        "quality", (F.col("n_chars") > 1500).cast("int").alias("guess"),
        (F.col("quality") * 8.0 + 2 - F.col("toxic") * 2).alias("score"),
        (F.col("n_chars") % 11).cast("double").alias("guessed_score"),
    )


@query("WITH " + GUESSED + " SELECT CAST(quality AS INTEGER) AS label, guess AS predicted, count(*) AS n FROM guessed GROUP BY ALL")
def confusion(fx: Fixtures):
    return quality_model.confusion(guessed(fx), "quality", "guess")


@query(
    "WITH " + GUESSED
    + """, cells AS (
      SELECT c AS class, count(*) FILTER (WHERE quality = c AND guess = c) AS hit,
             count(*) FILTER (WHERE guess = c) AS said, count(*) FILTER (WHERE quality = c) AS support
      FROM guessed, (VALUES (0), (1)) v(c) GROUP BY c),
    shares AS (SELECT class, support, hit / CAST(said AS DOUBLE) AS p, hit / CAST(support AS DOUBLE) AS r FROM cells)
    SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, support, round(2 * p * r / (p + r), 6) AS f1 FROM shares"""
)
def classification_report(fx: Fixtures):
    return rounded(quality_model.classification_report(guessed(fx), "quality", "guess"))


@query(
    "WITH " + GUESSED
    + """ SELECT round(sqrt(avg((score - guessed_score) ** 2)), 6) AS rmse,
      round(avg(abs(score - guessed_score)), 6) AS mae FROM guessed"""
)
def regression_metrics(fx: Fixtures):
    return rounded(quality_model.regression_metrics(guessed(fx), "score", "guessed_score"))


@query(with_views("labeled") + "SELECT fid, quality_score FROM labeled")
def training_rows(fx: Fixtures):
    """Labels written as JSON lines by several tasks, read back as training does."""
    path = scratch_folder(fx.spark, "labels")
    sinks.write_json(fx.labeled().repartition(4), path)
    return tables.read_first_present(fx.spark, [f"{path}-none", path], tables.LABELED_USERS).select("fid", "quality_score")


@query(with_views("scores") + "SELECT fid, quality_score FROM scores WHERE quality_score >= 7")
def best_users_csv(fx: Fixtures):
    path = scratch_folder(fx.spark, "best-users")
    sinks.write_high_quality_users(fx.scores(), path)
    return fx.spark.read.option("header", True).schema("fid string, quality_score double").csv(path)


@query(with_views("scores") + "SELECT fid, quality_score, is_quality_user, quality_category FROM scores")
def scores_written(fx: Fixtures):
    path = scratch_folder(fx.spark, "scores")
    sinks.write_parquet(fx.scores(), path)
    return tables.read_parquet(fx.spark, path, view="written_scores").sparkSession.sql("SELECT * FROM written_scores")


@query(with_views("scores") + "SELECT quality_category, count(*) AS users, count(DISTINCT fid) AS fids FROM scores GROUP BY ALL")
def scores_table(fx: Fixtures):
    """A catalogue table made from a query, twice over its own name, and read by that name."""
    name = f"scores_{uuid.uuid4().hex}"
    sinks.write_table(fx.scores(), name)
    sinks.write_table(fx.scores(), name)
    found = materialized(fx.spark.table(name).groupBy("quality_category").agg(
        F.count(F.lit(1)).alias("users"), F.count_distinct("fid").alias("fids")))
    fx.spark.sql(f"DROP TABLE {name}")
    return found


@query(
    with_views("clustered")
    + """SELECT Hash AS hash_hex, CAST(Fid AS BIGINT) AS fid, CAST(len(embedding) AS INTEGER) AS numbers,
      round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS total,
      quality_reactions AS reaction_count, quality_replies AS reply_count FROM clustered"""
)
def embeddings_written(fx: Fixtures):
    path = scratch_folder(fx.spark, "embeddings")
    posts = fx.clustered().select(
        F.col("Hash").alias("hash_hex"), F.col("Fid").alias("fid"), F.col("Text").alias("text"), "embedding",
        F.col("quality_reactions").alias("reaction_count"), F.col("quality_replies").alias("reply_count"),
    )
    sinks.write_embeddings(posts, path)
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return tables.read_embeddings(fx.spark, path).select(
        "hash_hex", "fid", F.size("embedding").alias("numbers"), F.round(total, 4).alias("total"),
        "reaction_count", "reply_count",
    )


def training(fx: Fixtures, users=None):
    users = all_features(fx) if users is None else users
    return materialized(quality_model.training_data(fx.labeled(), users))


# Trees, reductions and clusterings have no SQL text. Their queries run them with the full settings
# over all rows and return what must hold of any right result.


@query("SELECT 0 AS class, true AS in_range, true AS adds_up, true AS beats_majority UNION ALL SELECT 1, true, true, true")
def quality_classifier(fx: Fixtures):
    """Over the held-out rows; on the rows of the training no fewer are right than by the larger class alone."""
    data = training(fx)
    rated = materialized(quality_model.train_classifier(data).transform(data).select("is_test", "is_quality", "prediction"))
    test, label = rated.filter("is_test"), F.col("is_quality").cast("int")
    report = quality_model.classification_report(test, "is_quality", "prediction")
    known = test.groupBy(label.alias("class")).agg(F.count(F.lit(1)).alias("n"))
    within = [F.col(c).between(0, 1) for c in ("precision", "recall", "f1")]
    right = rated.filter("NOT is_test").agg(
        (F.count_if(label == F.col("prediction")) >= F.greatest(F.count_if(label == 1), F.count_if(label == 0))).alias("right")).scalar()
    return report.join(known, "class").select(
        "class", (within[0] & within[1] & within[2]).alias("in_range"), (F.col("support") == F.col("n")).alias("adds_up"), right.alias("beats_majority")
    )


@query("SELECT true AS ordered, true AS below_the_span, true AS beats_the_mean")
def quality_regression(fx: Fixtures):
    """Over the held-out rows; on the rows of the training the error is below the labels' deviation as soon as a tree splits."""
    data = training(fx)
    model = quality_model.train_regressor(data)
    rated = materialized(model.transform(data).select("is_test", "quality_score", "prediction"))
    found = quality_model.regression_metrics(rated.filter("is_test"), "quality_score", "prediction")
    fitted = quality_model.regression_metrics(rated.filter("NOT is_test"), "quality_score", "prediction").select("rmse").scalar()
    deviation = rated.filter("NOT is_test").agg(F.stddev_pop("quality_score")).scalar()
    return found.select(
        ((F.col("mae") > 0) & (F.col("mae") <= F.col("rmse"))).alias("ordered"), (F.col("rmse") < 5).alias("below_the_span"),
        ((fitted < deviation - 1e-9) == F.lit(model.splits())).alias("beats_the_mean"),
    )


@query(f"SELECT {len(FEATURES)} AS features, true AS adds_up, true AS in_order")
def feature_importance(fx: Fixtures):
    """The shares add up to 1, or to 0 where no tree has split."""
    model = quality_model.train_classifier(training(fx))
    found = quality_model.feature_importance(model, fx.spark).agg(
        F.count(F.lit(1)).cast("int").alias("features"), F.round(F.sum("importance"), 6).alias("total"),
        F.collect_list("importance").alias("all"),
    )
    total = F.lit(1.0 if model.splits() else 0.0)
    return found.select("features", (F.col("total") == total).alias("adds_up"), (F.col("all") == F.sort_array("all", asc=False)).alias("in_order"))


@query("SELECT true AS some, 0 AS out_of_range, 0 AS wrong_flag, 0 AS wrong_bin, 0 AS changed_by_saving")
def scored_users(fx: Fixtures):
    """Scores of all authors by the saved model, loaded again, beside those of the model itself."""
    path, users = scratch_folder(fx.spark, "models"), materialized(all_features(fx))
    model = quality_model.train_regressor(training(fx, users))
    quality_model.save_models({"regressor": model}, path)
    scored = quality_model.score_users(users, quality_model.load_model(path, "regressor"))
    own = quality_model.score_users(users, model).select("fid", F.col("quality_score").alias("own"))
    score = F.col("quality_score")
    wrong = lambda test: F.count_if(~test).cast("int")
    return scored.join(own, "fid").agg(
        (F.count(F.lit(1)) > 0).alias("some"), wrong(score.between(0, 10)).alias("out_of_range"),
        wrong(F.col("is_quality_user") == (score >= 5).cast("int")).alias("wrong_flag"),
        wrong(F.col("quality_category") == quality_category(score)).alias("wrong_bin"),
        wrong(score == F.col("own")).alias("changed_by_saving"),
    )


@query("SELECT 0e0 AS worst_mean, 0e0 AS worst_deviation")
def scaled_features(fx: Fixtures):
    """Means of zero and deviations of one over the rows that the scaler was fitted on."""
    data = training(fx)
    scaled = quality_model.fit_scaler(data).transform(data.filter("NOT is_test"))
    each = scaled.select(F.posexplode(vector_to_array("scaled")).alias("i", "x")).groupBy("i").agg(
        F.abs(F.avg("x")).alias("m"), F.stddev_samp("x").alias("d"))
    off = F.when(F.col("d") > 0, F.abs(F.col("d") - 1)).otherwise(F.lit(0.0))  # a constant stays zero
    return each.agg(F.round(F.max("m"), 6).alias("worst_mean"), F.round(F.max(off), 6).alias("worst_deviation"))


def texts(fx: Fixtures):
    return fx.table("documents").select(
        F.col("doc_id").cast("string").alias("Hash"), F.col("text").alias("Text")
    )


def length_encoder(prompts: list[str]) -> np.ndarray:
    """A stand-in for an encoder: lengths and counts of two letters."""
    return np.array([[len(p), p.count("a"), p.count("e")] for p in prompts], dtype="float64")


@query(
    f"""SELECT Hash, round(a / n, 4) AS x, round(b / n, 4) AS y, round(c / n, 4) AS z FROM (
      SELECT *, sqrt(a * a + b * b + c * c) AS n FROM (
        SELECT CAST(doc_id AS VARCHAR) AS Hash, CAST(length(t) AS DOUBLE) AS a,
               CAST(length(t) - length(replace(t, 'a', '')) AS DOUBLE) AS b,
               CAST(length(t) - length(replace(t, 'e', '')) AS DOUBLE) AS c
        FROM (SELECT doc_id, '{vectors.CLUSTERING_PREFIX}' || text AS t FROM documents)))"""
)
def encoded_vectors(fx: Fixtures):
    encoded = vectors.encoded_vectors(texts(fx), length_encoder)
    return encoded.select(
        "Hash", *[F.round(F.col("embedding")[i].cast("double"), 4).alias(c) for i, c in enumerate("xyz")]
    )


@query("SELECT CAST(doc_id AS VARCHAR) AS Hash, 1e0 AS norm FROM documents")
def hashed_vectors(fx: Fixtures):
    vector = vector_to_array("features")
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    return vectors.hashed_vectors(texts(fx)).select("Hash", F.round(norm, 6).alias("norm"))


def reduced(fx: Fixtures):
    posts = vectors.as_features(fx.clustered().drop("cluster_id"))
    df, model = vectors.reduced(posts)
    return materialized(df.select("Hash", "Fid", "Text", "reduced", "quality_score",
                                  "quality_reactions", "quality_replies", "cast_score")), model


@query(with_views("clustered") + f"SELECT count(*) AS posts, {vectors.COMPONENTS} AS components, 0e0 AS worst_mean, 0 AS out_of_order FROM clustered")
def pca_scores(fx: Fixtures):
    df, _ = reduced(fx)
    each = df.select(F.posexplode(vector_to_array("reduced")).alias("i", "x")).groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), F.var_samp("x").alias("v"))
    before = F.lag("v").over(Window.orderBy("i"))  # one row per component
    return each.withColumn("rises", F.coalesce(F.col("v") > before + 1e-9, F.lit(False))).agg(
        F.max("n").alias("posts"), F.count(F.lit(1)).cast("int").alias("components"),
        F.round(F.max(F.abs("m")), 6).alias("worst_mean"), F.count_if("rises").cast("int").alias("out_of_order"),
    )


def clustering_facts(fx: Fixtures, df, model):
    """Posts, topics in use, posts that are nearer to another centre, and the distance column's faults."""
    placed = model.transform(df).withColumn("vector", vector_to_array("reduced"))
    own = clusters.distance_to_centre(placed, vectors.centres_of(model, fx.spark), "vector")
    every = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    near = F.array_min(F.transform(every, lambda c: F.sqrt(F.aggregate(
        F.zip_with(c, F.col("vector"), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))))
    return own.agg(
        F.count(F.lit(1)).alias("posts"), (F.count_distinct("cluster_id") <= model.k).alias("few_enough"),
        F.count_if(F.col("distance_to_center") > near + 1e-6).alias("misplaced"),
    )


CLUSTERING = "SELECT count(*) AS posts, true AS few_enough, 0 AS misplaced FROM clustered"


@query(with_views("clustered") + CLUSTERING)
def kmeans_topics(fx: Fixtures):
    """Mini-batches with the library's defaults; saved and loaded before it is used."""
    df, reducer = reduced(fx)
    path = scratch_folder(fx.spark, "clustering")
    best = vectors.batch_kmeans(df)
    vectors.save_clustering(best, reducer, path)
    loaded, _ = vectors.load_clustering(path)
    facts = clustering_facts(fx, df, best)
    same = loaded.transform(df).select("Hash", F.col("cluster_id").alias("c")).join(best.transform(df), "Hash")
    moved = same.agg(F.count_if(F.col("c") != F.col("cluster_id"))).scalar()
    return facts.withColumn("misplaced", F.col("misplaced") + moved)


@query(with_views("clustered") + CLUSTERING)
def full_topics(fx: Fixtures):
    """The earlier generation's clustering: more starts and steps."""
    df, _ = reduced(fx)
    return clustering_facts(fx, df, vectors.full_kmeans(df))


@query(f"SELECT {len(vectors.K_RANGE)} AS tried, true AS in_range, true AS best_first, true AS first_beats_the_last")
def choose_k(fx: Fixtures):
    df, _ = reduced(fx)
    s, after = F.col("silhouette"), F.lead("silhouette").over(Window.orderBy("rank"))  # one row per k
    ranked = vectors.silhouettes(df, "Hash").withColumn("falls", F.coalesce(s >= after, F.lit(True)))
    return ranked.agg(
        F.count(F.lit(1)).cast("int").alias("tried"), F.min(s.between(-1, 1)).alias("in_range"), F.min("falls").alias("best_first"),
        (F.max(F.when(F.col("rank") == 1, s)) > F.min(s)).alias("first_beats_the_last"),
    )


@query(
    """SELECT round(avg(CAST(x AS DOUBLE)), 6) AS mean, round(stddev_pop(CAST(x AS DOUBLE)), 6) AS std
    FROM (SELECT unnest(embedding) AS x FROM embeddings)"""
)
def vector_spread(fx: Fixtures):
    return rounded(vectors.vector_spread(fx.table("embeddings")))


REACH = f"""rows AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
apart AS (SELECT a.vec_id, list_distance(a.x, b.x) AS d FROM rows a JOIN rows b ON a.vec_id <> b.vec_id),
cores AS (SELECT vec_id, d AS core FROM apart QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d) = {density.SAMPLES})"""


def embedding_points(fx: Fixtures):
    return density.Points(fx.table("embeddings"), "vec_id", "embedding")


@query(f"WITH {REACH} SELECT vec_id, round(core, 5) AS core FROM cores")
def core_distances(fx: Fixtures):
    """Every embedding's distance to its tenth neighbour, found by blocks and bounds."""
    points = embedding_points(fx)
    cores = density.core_distances(points).select("block", F.posexplode("core").alias("at", "core"))
    of_point = cores.select(density.point_id(F.col("block"), F.col("at")).alias("id"), F.round("core", 5).alias("core"))
    ids = points.numbered().join(of_point, "id")
    return points.rows.join(ids, "x").select(F.col("key").alias("vec_id"), "core")


@query(
    f"""WITH RECURSIVE {REACH},
    points AS (SELECT min(vec_id) AS id, any_value(core) AS core, x FROM rows JOIN cores USING (vec_id) GROUP BY x),
    edges AS MATERIALIZED (SELECT a.id AS u, b.id AS v, greatest(list_distance(a.x, b.x), a.core, b.core) AS w
      FROM points a JOIN points b ON a.id <> b.id),
    growing AS (
      SELECT 0 AS step, v AS id, w FROM edges WHERE u = (SELECT min(id) FROM points)
      UNION ALL
      SELECT step + 1, g.id, least(g.w, e.w) FROM growing g, (SELECT arg_min(id, w) AS taken FROM growing) t, edges e
      WHERE e.u = taken AND e.v = g.id)
    SELECT round(w, 5) AS weight, count(*) AS edges FROM (SELECT min(w) AS w FROM growing GROUP BY step) GROUP BY 1"""
)
def spanning_tree(fx: Fixtures):
    """The weights of a lightest tree of mutual reachability; DuckDB grows one point by point."""
    points = embedding_points(fx)
    tree = density.spanning_tree(points, density.core_distances(points))
    return tree.groupBy(F.round("w", 5).alias("weight")).agg(F.count(F.lit(1)).alias("edges"))


@query(with_views("clustered") + "SELECT count(*) AS posts, 0 AS too_small, true AS largest_first, true AS k_within FROM clustered")
def density_guide(fx: Fixtures):
    """Density clusters of the reduced posts and the k they suggest; labels are held against brute force in the tests."""
    df, _ = reduced(fx)
    labels = materialized(density.density_clusters(df, "Hash"))
    k = density.number_of_topics(labels)
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    found = sizes.filter(F.col("label") >= 0)
    before = F.lag("n").over(Window.orderBy("label"))  # one row per cluster
    rises = found.select((F.col("n") > before).alias("rises")).agg(F.coalesce(F.max("rises"), F.lit(False))).scalar()
    return sizes.agg(
        F.sum("n").alias("posts"), F.count_if((F.col("label") >= 0) & (F.col("n") < density.CLUSTER_SIZE)).cast("int").alias("too_small"),
    ).select("posts", "too_small", (~rises).alias("largest_first"), F.lit(density.LEAST_K <= k <= density.MOST_K).alias("k_within"))


@query(with_views("clustered") + "SELECT Hash, length(Text) AS characters, 16 AS ranges FROM clustered")
def stage_in_ranges(fx: Fixtures):
    """A stage over all posts in restartable ranges; it is started twice, and the second run only reads."""
    path = scratch_folder(fx.spark, "ranges")
    work = lambda df: df.select("Hash", F.length("Text").alias("characters"))
    for _ in range(2):
        done = restart.run_in_ranges(fx.clustered(), "Hash", work, path, ranges=16)
    return done.select("Hash", "characters", F.lit(len(restart.finished_ranges(fx.spark, path))).alias("ranges"))
