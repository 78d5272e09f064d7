"""Learning what users like from their answers, for all sessions at once.

A session is one row: its answers in order, which are one user's. The cluster table travels as an
array (``book``) in base order, best mean post score first and then by id, and weights are an array
in the same order. Equal weights always fall back on the base order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanwell.functions.scalars import shorten, shuffled_by
from gleanwell.operators.bounded import book
from gleanwell.operators.ranking import top_per_group
from gleanwell.session import materialized

# How answers change weights, and the limits of a session and its results.
LIKE_SAME, LIKE_OTHER = 1.5, 0.8
DISLIKE_SAME, DISLIKE_OTHER = 0.5, 1.2
OTHER_SHARE = 0.1
WEIGHT_CAP = 10.0
ACTIVE_ABOVE, RECOMMEND_FROM = 0.1, 0.5
MAX_QUESTIONS, STRONG_AFTER, STRONG_RATIO = 7, 4, 3
POSTS_PER_CLUSTER, RECOMMENDATIONS = 3, 10
LIKED_POINTS, DISLIKED_FACTOR = 2.0, 0.5
SUMMARY_WORDS, WORDS_PER_CLUSTER = 10, 5
SAMPLE_CHARS = 150


def sessions_from(feedback: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per session with all its answers in order."""
    answer = F.struct("seq", "cluster_id", "liked")
    return feedback.groupBy(*keys).agg(F.sort_array(F.collect_list(answer)).alias("answers"))


def pages_of(clusters: DataFrame, *columns: str | Column) -> Column:
    """The clusters in base order as an array of structs: ``cluster_id`` and the given columns."""
    base = F.coalesce(-F.col("avg_cast_score"), F.lit(float("inf")))
    return book(clusters.select(base.alias("_base"), "cluster_id", *columns), "_base")


def _same_words(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def _factor(cluster: Column, target: Column, liked: Column) -> Column:
    """What one answer on ``target`` multiplies the weight of ``cluster`` with."""
    shared = _same_words(cluster["top_words"], target["top_words"]) / F.lit(10)

    def either(like: float, dislike: float) -> Column:
        return F.when(liked, F.lit(like)).otherwise(F.lit(dislike))

    same_theme = 1 + (either(LIKE_SAME, DISLIKE_OTHER) - 1) * shared
    other = 1 + (either(LIKE_OTHER, DISLIKE_SAME) - 1) * F.lit(OTHER_SHARE)
    return (
        F.when(cluster["cluster_id"] == target["cluster_id"], either(LIKE_SAME, DISLIKE_SAME))
        .when(cluster["name"] == target["name"], same_theme)
        .otherwise(other)
    )


def factor_table(clusters: DataFrame) -> Column:
    """One struct for all clusters: their ids in base order, and per cluster answered on the
    factors of all weights, for a like and for a dislike."""
    def factors(pages: Column, liked: bool) -> Column:
        return F.transform(pages, lambda t: F.transform(pages, lambda c: _factor(c, t, F.lit(liked))))

    pages = F.col("pages")
    one = clusters.sparkSession.range(1).select(pages_of(clusters, "name", "top_words").alias("pages"))
    return one.select(F.struct(
        F.transform(pages, lambda c: c["cluster_id"]).alias("ids"),
        factors(pages, True).alias("like"), factors(pages, False).alias("dislike"),
    )).scalar()


def cluster_weights(sessions: DataFrame, clusters: DataFrame) -> DataFrame:
    """Adds ``weights``: one number per cluster after all answers, in base order.

    Each answer multiplies every weight by a factor looked up by position. When the largest
    exceeds the cap, all are scaled down. Answers on unknown clusters change nothing.
    """
    table = F.col("_table")
    rows = sessions.withColumn("_table", factor_table(clusters))
    known = F.filter("answers", lambda a: F.array_contains(table["ids"], a["cluster_id"]))

    def scaled(moved: Column, top: Column) -> Column:
        return F.when(top > WEIGHT_CAP, F.transform(moved, lambda w: w / (top / F.lit(WEIGHT_CAP)))).otherwise(moved)

    def after(weights: Column, answer: Column) -> Column:
        rows_of = F.when(answer["liked"], table["like"]).otherwise(table["dislike"])
        factors = F.element_at(rows_of, F.array_position(table["ids"], answer["cluster_id"]).cast("int"))
        moved = F.transform(F.array(F.zip_with(weights, factors, lambda w, f: w * f)), lambda m: F.struct(m.alias("m"), F.array_max(m).alias("top")))
        return F.transform(moved, lambda x: scaled(x["m"], x["top"]))[0]

    start = F.transform(table["ids"], lambda _: F.lit(1.0))
    return rows.withColumn("weights", F.aggregate(known, start, after)).drop("_table")


def weight_rows(weighted: DataFrame, clusters: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The weights as rows: session keys, ``cluster_id``, ``weight``."""
    pairs = F.zip_with(
        "_book", "weights", lambda c, w: F.struct(c["cluster_id"].alias("cluster_id"), w.alias("weight"))
    )
    return weighted.withColumn("_book", pages_of(clusters)).select(*keys, F.inline(pairs))


def strong_signal(weighted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whether a session could stop early: enough answers, and one weight far above the mean."""
    total = F.aggregate("weights", F.lit(0.0), lambda s, w: s + w)
    clear = F.array_max("weights") > total / F.size("weights") * STRONG_RATIO
    return weighted.select(*keys, ((F.size("answers") >= STRONG_AFTER) & clear).alias("strong"))


def _appeal(post: Column) -> Column:
    return post["author_quality"] * (post["quality_reactions"] + post["quality_replies"] * 2)


def _by(rows: Column, value, tie) -> Column:
    """Rows by ``value`` descending, ties by ``tie`` ascending."""
    keyed = F.transform(rows, lambda r: F.struct((-value(r)).alias("v"), tie(r).alias("t"), r.alias("r")))
    return F.transform(F.sort_array(keyed), lambda k: k["r"])


def next_post(
    weighted: DataFrame, clusters: DataFrame, keys: Sequence[str], seed: int = 42
) -> DataFrame:
    """The post to show next in each session: keys, ``cluster_id``, ``post_idx``, ``hash``.

    Needs ``shown``, an array of (cluster_id, post_idx) structs. With no answer yet, the largest
    good cluster is asked about; then unseen themes; from the third answer on the heaviest
    clusters. Draws among candidates follow a hash of the session, so they can be repeated.
    Sessions that have seen every post give no row.
    """
    posts = F.transform(
        "representatives",
        lambda p, i: F.struct(
            F.col("cluster_id"), i.alias("post_idx"), p["hash"].alias("hash"), _appeal(p).alias("appeal")
        ),
    )
    pages = pages_of(clusters, "name", "size", "avg_quality_score", posts.alias("posts"))
    asked = F.size("answers")
    base = weighted.withColumn("_book", pages).withColumn(
        "_heavy",
        _by(
            F.filter(
                F.transform(
                    "_book",
                    lambda c, i: F.struct(
                        c["cluster_id"].alias("cluster_id"), c["name"].alias("name"),
                        F.get("weights", i).alias("weight"), i.alias("place"),
                    ),
                ),
                lambda x: x["weight"] > ACTIVE_ABOVE,
            ),
            lambda x: x["weight"], lambda x: x["place"],
        ),
    )
    seen_themes = F.transform(
        F.filter(
            "_book",
            lambda c: F.exists("answers", lambda a: a["cluster_id"] == c["cluster_id"]),
        ),
        lambda c: c["name"],
    )
    new = F.filter(
        F.slice("_heavy", 1, 10), lambda x: ~F.array_contains(F.col("_seen"), x["name"])
    )
    five = F.slice("_heavy", 1, 5)
    candidates = F.when(asked < 3, F.when(F.size(new) > 0, new).otherwise(five)).otherwise(five)

    def draw(c: Column) -> Column:
        return shuffled_by([*[F.col(k) for k in keys], asked, c["cluster_id"], seed])

    drawn = F.array_min(
        F.transform("_candidates", lambda c: F.struct(draw(c).alias("d"), c["cluster_id"].alias("id")))
    )["id"]
    placed = F.transform("_book", lambda c, i: F.struct(c["cluster_id"].alias("cluster_id"), (c["size"] * c["avg_quality_score"]).alias("worth"), i.alias("place")))
    biggest = _by(placed, lambda c: c["worth"], lambda c: c["place"])[0]["cluster_id"]
    first_id = F.when(asked < 3, F.element_at("_book", 1)["cluster_id"])
    chosen = F.when(asked == 0, biggest).otherwise(F.coalesce(drawn, first_id))

    unseen = F.filter(
        F.flatten(F.transform("_book", lambda c: c["posts"])),
        lambda p: ~F.exists(
            "shown", lambda s: (s["cluster_id"] == p["cluster_id"]) & (s["post_idx"] == p["post_idx"])
        ),
    )
    inside = F.filter("_unseen", lambda p: p["cluster_id"] == F.col("_chosen"))
    best = F.get(_by(inside, lambda p: p["appeal"], lambda p: p["post_idx"]), F.lit(0))
    return (
        base.withColumn("_seen", seen_themes)
        .withColumn("_candidates", candidates)
        .withColumn("_chosen", chosen)
        .withColumn("_unseen", unseen)
        .withColumn("_post", F.coalesce(best, F.get("_unseen", F.lit(0))))
        .filter(F.col("_post").isNotNull() & F.col("_chosen").isNotNull())
        .select(*keys, "_post.cluster_id", "_post.post_idx", "_post.hash")
    )


def _best_posts(clusters: DataFrame) -> Column:
    """Per cluster in base order its best three posts as ``best``."""
    listed = F.transform(
        "representatives",
        lambda p, i: F.struct(
            i.alias("idx"), F.col("cluster_id"), F.col("name").alias("cluster_theme"),
            F.slice("top_words", 1, WORDS_PER_CLUSTER).alias("cluster_keywords"),
            p.alias("post"), _appeal(p).alias("appeal"),
        ),
    )
    best = F.slice(_by(listed, lambda p: p["appeal"], lambda p: p["idx"]), 1, POSTS_PER_CLUSTER)
    return pages_of(clusters, best.alias("best"))


def recommended_places(
    weighted: DataFrame, clusters: DataFrame, keys: Sequence[str], n: int = RECOMMENDATIONS
) -> DataFrame:
    """One row per session with ``places``: which posts it gets, as numbers into ``_best_posts``."""
    heavy = _by(
        F.filter(
            F.transform("_book", lambda c, i: F.struct(
                F.get("weights", i).alias("weight"), i.alias("place"), F.when(c["best"].isNotNull(), F.size(c["best"])).alias("size"))),
            lambda x: x["weight"] >= RECOMMEND_FROM,
        ),
        lambda x: x["weight"], lambda x: x["place"],
    )
    whole = F.sequence(F.lit(0), F.lit(POSTS_PER_CLUSTER - 1))
    taken = F.transform(heavy, lambda x: F.when(x["size"].isNotNull(), F.transform(
        F.filter(whole, lambda i: i < x["size"]), lambda i: F.struct(x["place"].alias("cluster"), i.alias("post")))))
    return weighted.withColumn("_book", _best_posts(clusters)).select(*keys, F.slice(F.flatten(taken), 1, n).alias("places"))


def _post_at(place: Column) -> Column:
    return F.get(F.get("_book", place["cluster"])["best"], place["post"])


def recommended_posts(
    weighted: DataFrame, clusters: DataFrame, keys: Sequence[str], n: int = RECOMMENDATIONS
) -> DataFrame:
    """Up to ``n`` posts per session from its heaviest clusters, at most three from each.

    Rows: keys, ``position`` and the post with its cluster's id, theme and keywords. The best
    three of each cluster are chosen once; sessions only put the clusters in order.
    """
    placed = recommended_places(weighted, clusters, keys, n)
    return (
        placed.select(*keys, F.posexplode("places").alias("position", "place"))
        .withColumn("_book", _best_posts(clusters))
        .withColumn("p", _post_at(F.col("place")))
        .select(
            *keys, (F.col("position") + 1).alias("position"), "p.cluster_id", "p.cluster_theme",
            "p.cluster_keywords", "p.post.*",
        )
    )


def diversity(cluster_sets: DataFrame, clusters: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct themes per entry of each cluster set; ``cluster_sets`` has one row per entry."""
    names = clusters.select("cluster_id", "name")
    return cluster_sets.join(names, "cluster_id").groupBy(*keys).agg(
        (F.count_distinct("name") / F.count(F.lit(1))).alias("diversity")
    )


def preference_summary(
    feedback: DataFrame, clusters: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Per session: themes liked more often than disliked, frequent keywords, the answers by kind.

    Repeated answers count each time. Lists keep the order of first appearance.
    """
    known = clusters.select("cluster_id", "name", "top_words")
    answers = feedback.join(known, "cluster_id")
    themes = (
        answers.groupBy(*keys, "name")
        .agg(
            F.count_if("liked").alias("likes"),
            F.count_if(~F.col("liked")).alias("dislikes"),
            F.min(F.when(F.col("liked"), F.col("seq"))).alias("first"),
        )
        .filter(F.col("likes") > F.col("dislikes"))
        .groupBy(*keys)
        .agg(_listed(["first"], "name").alias("preferred_themes"))
    )
    words = (
        answers.filter("liked")
        .select(
            *keys, "seq",
            F.posexplode(F.slice("top_words", 1, WORDS_PER_CLUSTER)).alias("idx", "word"),
        )
        .groupBy(*keys, "word")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("seq", "idx")).alias("first"))
    )
    top = top_per_group(
        words, keys, [F.col("n").desc(), F.col("first").asc()], SUMMARY_WORDS, rank="rank"
    )
    keywords = top.groupBy(*keys).agg(_listed(["rank"], "word").alias("top_keywords"))
    given = feedback.groupBy(*keys).agg(
        _listed(["seq"], "cluster_id", F.col("liked")).alias("liked_clusters"),
        _listed(["seq"], "cluster_id", ~F.col("liked")).alias("disliked_clusters"),
    )
    empty = F.array().cast("array<string>")
    return (
        given.join(themes, list(keys), "left")
        .join(keywords, list(keys), "left")
        .select(
            *keys,
            F.coalesce("preferred_themes", empty).alias("preferred_themes"),
            F.coalesce("top_keywords", empty).alias("top_keywords"),
            "liked_clusters",
            "disliked_clusters",
        )
    )


def _listed(order: list[str], value: str, only: Column | None = None) -> Column:
    item = F.struct(*order, value)
    item = item if only is None else F.when(only, item)
    return F.transform(F.sort_array(F.collect_list(item)), lambda x: x[value])


def users_to_follow(
    feedback: DataFrame, clusters: DataFrame, keys: Sequence[str], n: int = RECOMMENDATIONS
) -> DataFrame:
    """Authors to follow per session: points per liked appearance, halved per disliked one.

    Points add up and halvings multiply, so both are plain sums over appearances of an author
    among the representatives of the clusters answered on. Answers are dealt by session once;
    the representatives meet them there, and texts are looked up for the authors that stay.
    """
    listed = clusters.select(
        "cluster_id", "name", F.posexplode("representatives").alias("idx", "post")
    ).select(
        "cluster_id", "name", "idx", "post.fid", "post.author_quality",
        shorten(F.col("post.text"), SAMPLE_CHARS, ellipsis=False).alias("text"),
    )
    # Numbers that sort as the texts do travel in their place; one row per representative.
    texts = materialized(
        listed.select("text").distinct().withColumn("place", F.row_number().over(Window.orderBy("text")))
    )
    posts = materialized(listed.join(texts, listed["text"].eqNullSafe(texts["text"])).drop("text"))
    tasks = int(feedback.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = feedback.select(*keys, "seq", "cluster_id", "liked").repartition(tasks, *keys).join(posts, "cluster_id")
    liked = F.col("liked")
    first = F.min(F.when(liked, F.struct("seq", "idx", "author_quality", "place")))
    authors = (
        seen.groupBy(*keys, "fid")
        .agg(
            F.sum(F.when(liked, F.col("author_quality") * LIKED_POINTS)).alias("points"),
            F.count_if(~liked).alias("dislikes"),
            F.sort_array(F.collect_set(F.when(liked, F.col("name")))).alias("themes"),
            first.alias("first"),
        )
        .filter(F.col("first").isNotNull())
        .withColumn("score", F.col("points") * F.pow(F.lit(DISLIKED_FACTOR), F.col("dislikes")))
    )
    order = [
        F.round("score", 9).desc(), F.col("first.seq").asc(), F.col("first.idx").asc(),
    ]
    best = top_per_group(authors, keys, order, n, rank="rank").withColumn("place", F.col("first.place"))
    return best.join(texts, "place").select(
        *keys, "rank", "fid", "score", F.col("first.author_quality").alias("quality_score"),
        "themes", F.col("text").alias("sample_post"),
    )


def combined_output(
    preferences: DataFrame, posts: DataFrame, users: DataFrame, keys: Sequence[str],
    clusters: DataFrame | None = None,
) -> DataFrame:
    """One nested row per session: preferences, recommendations and recommended users.

    ``posts`` has the rows of ``recommended_posts``, or with ``clusters`` those of
    ``recommended_places``: then no post is moved, and sessions with the same posts lie together.
    """
    told = preferences.select(
        *keys, F.struct(*[c for c in preferences.columns if c not in keys]).alias("preferences")
    )

    def nested(df: DataFrame, order: str, name: str) -> DataFrame:
        fields = [order, *[c for c in df.columns if c not in (*keys, order)]]
        return df.groupBy(*keys).agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct(*fields))), lambda r: r.dropFields(order)
            ).alias(name)
        )

    advised = nested(users, "rank", "recommended_users")
    if clusters is None:
        return told.join(nested(posts, "position", "recommendations"), list(keys), "left").join(advised, list(keys), "left")

    def shown(place: Column) -> Column:
        post = _post_at(place)
        named = [post[c].alias(c) for c in ("cluster_id", "cluster_theme", "cluster_keywords")]
        fields = clusters.schema["representatives"].dataType.elementType.names
        return F.struct(*named, *[post["post"][c].alias(c) for c in fields])

    got = posts.filter(F.size("places") > 0)
    whole = told.join(got, list(keys), "left").join(advised, list(keys), "left").sortWithinPartitions("places")
    return whole.withColumn("_book", _best_posts(clusters)).select(
        *keys, "preferences", F.transform("places", shown).alias("recommendations"), "recommended_users"
    )
