"""Keywords, common words and names of clusters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanwell.functions.scalars import shorten, strip, title_case, words_of
from gleanwell.operators.clusters import cluster_averages, representative_records
from gleanwell.operators.ranking import top_per_group
from gleanwell.session import materialized

# Stop words, sizes of the keyword lists and the theme table.
STOP_WORDS = [
    "the", "and", "for", "this", "that", "with", "from", "have", "will", "your", "what", "when",
    "where", "which", "their", "would", "there", "could", "should", "about", "after", "before",
    "because", "been", "being", "just", "like", "more", "very", "much", "some", "only", "into",
    "over", "than", "then", "them", "these", "those", "through", "during", "while", "such", "both",
    "each", "other",
]
EARLY_STOP_WORDS = [
    "that", "this", "with", "from", "have", "will", "your", "what", "when", "where", "which",
    "their", "would", "there", "could", "should", "about", "after", "before", "because", "been",
    "being",
]
FAST_STOP_WORDS = [*EARLY_STOP_WORDS, "just", "like", "more", "very", "much", "some", "only"]
VOCABULARY, KEYWORDS, MIN_DOCUMENTS = 100, 30, 2
FALLBACK_TEXTS, COMMON_TEXTS, COMMON_WORDS = 200, 100, 10
RECORD_KEYWORDS, TOP_WORDS = 20, 10
THEMES = [
    ("Food & Cooking", ["food", "recipe", "cooking", "meal", "restaurant", "eat", "delicious",
                        "taste", "dinner", "lunch"]),
    ("Coffee & Drinks", ["coffee", "tea", "drink", "beverage", "cafe"]),
    ("Product Building", ["build", "ship", "launch", "product", "app", "software", "code",
                          "developer"]),
    ("AI & Machine Learning", ["ai", "ml", "machine learning", "artificial intelligence", "model"]),
    ("Design & UX", ["design", "ui", "ux", "interface", "user experience"]),
    ("Visual Arts", ["art", "artist", "creative", "paint", "draw", "artwork"]),
    ("Music", ["music", "song", "album", "artist", "band", "concert"]),
    ("Photography", ["photo", "photography", "picture", "shot", "camera"]),
    ("Writing & Books", ["write", "writing", "author", "book", "story", "novel"]),
    ("Travel", ["travel", "trip", "journey", "destination", "explore"]),
    ("Fitness & Health", ["fitness", "workout", "exercise", "gym", "health"]),
    ("Family & Parenting", ["family", "kids", "children", "parenting", "parent"]),
    ("Fashion & Style", ["fashion", "style", "outfit", "clothes", "wear"]),
    ("Startups & Business", ["startup", "founder", "entrepreneur", "business", "company"]),
    ("Career & Jobs", ["job", "career", "work", "hiring", "recruit"]),
    ("Finance & Investing", ["invest", "investment", "market", "trading", "finance"]),
    ("Gaming", ["game", "gaming", "play", "gamer", "video game"]),
    ("Movies & TV", ["movie", "film", "cinema", "watch", "series"]),
    ("Sports", ["sport", "sports", "team", "player", "game", "match"]),
    ("Nature & Outdoors", ["nature", "outdoor", "hiking", "mountain", "forest"]),
    ("Science & Research", ["science", "research", "study", "experiment", "discovery"]),
    ("Politics", ["politics", "political", "policy", "government", "election"]),
    ("Philosophy & Ideas", ["philosophy", "think", "thought", "idea", "question"]),
    ("Community", ["community", "people", "friends", "social", "together"]),
    ("News & Media", ["news", "media", "journalism", "report", "story"]),
    ("Education", ["education", "learn", "teach", "student", "school"]),
    ("Mental Wellness", ["mental", "wellness", "mindfulness", "meditation", "therapy"]),
]
THEME_MATCHES = 2
EMPTY_WORDS = ["https", "com", "org", "net", "post", "share", "like"]
MEANINGFUL_ABOVE = 4
NAME_MAX_CHARS = 40


def grams_of(text: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """Words of two or more characters without stop words, followed by their adjacent pairs."""
    return F.transform(F.array(single_words(text, stop_words)), _with_pairs)[0]


def single_words(text: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    found = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))
    return F.filter(found, lambda w: ~w.isin(stop_words))


def word_lists(posts: DataFrame, stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """The words of each text, ``cluster_id, Hash, words``, taken once for all steps that count them.

    The texts are dealt out evenly first: where posts come from a join, those with a cluster may all lie
    in a few tasks, which would then hold the terms of most texts in every later step.
    """
    texts = posts.select("cluster_id", "Hash", "Text").hint("rebalance")
    return materialized(texts.select("cluster_id", "Hash", single_words(F.col("Text"), stop_words).alias("words")))


def _with_pairs(words: Column) -> Column:
    return F.concat(words, _pairs(words))


def _pairs(words: Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(
        F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b)
    )


def _counted(grams: DataFrame, min_documents: int, words: DataFrame | None = None) -> DataFrame:
    """Uses and documents of each term of ``grams``, one array per text; of pairs only those of ``words``.

    Both are counted in one pass: each text sends its terms once as occurrences and once, without
    repeats, as documents. Sums combine before the shuffle.
    """
    zero, one = F.lit(0), F.lit(1)
    marks = F.concat(
        F.transform("grams", lambda g: F.struct(g.alias("term"), one.alias("uses"), zero.alias("docs"))),
        F.transform(
            F.array_distinct("grams"),
            lambda g: F.struct(g.alias("term"), zero.alias("uses"), one.alias("docs")),
        ),
    )
    terms = grams.select("cluster_id", F.inline(marks))
    for end in (1, -1) if words is not None else ():
        part = F.substring_index("term", " ", end)
        terms = terms.withColumn("word", part).join(words, ["cluster_id", "word"], "left_semi")
    return (
        terms.groupBy("cluster_id", "term")
        .agg(F.sum("uses").alias("uses"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= min_documents)
    )


def vocabulary(
    posts: DataFrame, stop_words: list[str] = STOP_WORDS, size: int = VOCABULARY,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    return _vocabulary(word_lists(posts, stop_words), size, min_documents)


def _vocabulary(lists: DataFrame, size: int = VOCABULARY, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The most frequent terms of each cluster with their inverse document frequency.

    Words are counted first. A pair is used no more often than either of its words, so only pairs of
    words that are as frequent as the last of a cluster's list of words can be in its list of terms, and no
    others are counted. Each cluster's list is cut to size before the shuffle on the cluster.
    """
    words = lists.select("cluster_id", F.col("words").alias("grams"))
    singles = materialized(_counted(words, min_documents))
    by_use = [F.col("uses").desc(), F.col("term").asc()]
    listed = top_per_group(singles, ["cluster_id"], by_use, size, rank="place")
    least = listed.groupBy("cluster_id").agg(F.min(F.when(F.col("place") == size, F.col("uses"))).alias("least"))
    frequent = singles.join(least, "cluster_id").filter(F.col("uses") >= F.coalesce("least", F.lit(0)))
    frequent = materialized(frequent.select("cluster_id", F.col("term").alias("word")))
    pairs = words.withColumn("grams", F.transform(F.array("grams"), _pairs)[0])
    terms = singles.unionByName(_counted(pairs, min_documents, frequent))
    kept = top_per_group(terms, ["cluster_id"], by_use, size)
    sizes = lists.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    idf = F.log((F.col("n") + 1) / (F.col("docs") + 1)) + 1
    return kept.join(sizes, "cluster_id").select("cluster_id", "term", idf.alias("idf"))


def tfidf_keywords(
    posts: DataFrame, terms: DataFrame, stop_words: list[str] = STOP_WORDS, keywords: int = KEYWORDS
) -> DataFrame:
    return _tfidf_keywords(word_lists(posts, stop_words), terms, keywords)


def _tfidf_keywords(lists: DataFrame, terms: DataFrame, keywords: int = KEYWORDS) -> DataFrame:
    """Per cluster the terms with the highest summed weight: ``cluster_id, rank, term, score``.

    ``terms`` comes from ``vocabulary`` and has at most 100 terms per cluster, so Spark copies it
    to the tasks while it is small, and only occurrences of these terms go on.
    """
    hits = (
        lists.select(
            "cluster_id", "Hash", F.explode(F.transform(F.array("words"), _with_pairs)[0]).alias("term")
        )
        .join(terms, ["cluster_id", "term"])
        .groupBy("cluster_id", "Hash", "term")
        .agg((F.count(F.lit(1)) * F.first("idf")).alias("weight"))
    )
    per_text = Window.partitionBy("cluster_id", "Hash")
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(per_text))
    scores = (
        hits.withColumn("weight", F.col("weight") / norm)
        .groupBy("cluster_id", "term")
        .agg(F.sum("weight").alias("score"))
    )
    # Rounded for the order only: equal scores must not be told apart by the last binary digit.
    order = [F.round("score", 9).desc(), F.col("term").asc()]
    return top_per_group(scores, ["cluster_id"], order, keywords, rank="rank")


def counted_words(
    posts: DataFrame, stop_words: list[str], min_letters: int, top: int,
    first_texts: int | None = None, text_order: str = "Hash", descending: bool = False,
) -> DataFrame:
    """Most frequent words per cluster: ``cluster_id, rank, word, n``.

    ``first_texts`` limits the count to that many texts per cluster, in the given order.
    """
    if first_texts is not None:
        order = F.col(text_order).desc_nulls_last() if descending else F.col(text_order).asc()
        posts = top_per_group(posts, ["cluster_id"], [order, F.col("Hash").asc()], first_texts)
    words = posts.select("cluster_id", F.explode(words_of(F.lower("Text"), min_letters)).alias("word"))
    counts = (
        words.filter(~F.col("word").isin(stop_words))
        .groupBy("cluster_id", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return top_per_group(
        counts, ["cluster_id"], [F.col("n").desc(), F.col("word").asc()], top, rank="rank"
    )


def common_words(
    posts: DataFrame, stop_words: list[str] = EARLY_STOP_WORDS, first_texts: int | None = None
) -> DataFrame:
    return counted_words(posts, stop_words, 4, COMMON_WORDS, first_texts)


def cluster_keywords(posts: DataFrame, fallback_texts: int | None = None) -> DataFrame:
    """Weighted keywords; clusters without a shared vocabulary get plain word counts instead.

    ``fallback_texts`` (``FALLBACK_TEXTS`` where time is short) counts that many of their best posts only.
    """
    lists = word_lists(posts)
    terms = materialized(_vocabulary(lists))
    weighted = _tfidf_keywords(lists, terms).select("cluster_id", "rank", "term", "score")
    covered = terms.select("cluster_id").distinct()
    if lists.join(covered, "cluster_id", "left_anti").isEmpty():
        return weighted  # the posts are not read again
    bare = posts.join(covered, "cluster_id", "left_anti")
    counts = counted_words(
        bare, STOP_WORDS, 3, KEYWORDS, fallback_texts, "cast_score", descending=True
    ).select("cluster_id", "rank", F.col("word").alias("term"), F.col("n").cast("double").alias("score"))
    return weighted.unionByName(counts)


def keyword_lists(keywords: DataFrame) -> DataFrame:
    """One row per cluster: ``keywords`` with scores and ``top_words``, both in rank order."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", "term", "score")))
    return (
        keywords.groupBy("cluster_id")
        .agg(ranked.alias("ranked"))
        .select(
            "cluster_id",
            F.transform(
                F.slice("ranked", 1, RECORD_KEYWORDS), lambda k: F.struct(k["term"], k["score"])
            ).alias("keywords"),
            F.transform(F.slice("ranked", 1, TOP_WORDS), lambda k: k["term"]).alias("top_words"),
        )
    )


def rule_name(top_words: Column) -> Column:
    """A name from the first ten keywords: a theme, two long words, one word, or a default."""

    table = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit("|".join(words)).alias("words")) for name, words in THEMES]
    )

    def fits(theme: Column) -> Column:
        hits = F.filter(top_words, lambda w: F.regexp_like(F.lower(w), theme["words"]))
        return F.size(hits) >= THEME_MATCHES

    theme = F.get(F.filter(table, fits), F.lit(0))["name"]
    empty = F.array(*[F.lit(w) for w in EMPTY_WORDS])
    long_words = F.filter(
        top_words,
        lambda w: (F.length(w) > MEANINGFUL_ABOVE) & ~F.array_contains(empty, F.lower(w)),
    )
    two = F.when(
        F.size(long_words) >= 2,
        F.concat_ws(" ", title_case(F.get(long_words, F.lit(0))), title_case(F.get(long_words, F.lit(1)))),
    )
    one = F.when(F.size(top_words) >= 1, F.concat(title_case(F.get(top_words, F.lit(0))), F.lit(" Topics")))
    return F.coalesce(theme, two, one, F.lit("Mixed Topics"))


NAMING_TASK = (
    "Name the topic of the following group of posts in two to four words. The name should be "
    "specific, easy to recognise, and a noun phrase that people in this topic would use "
    "themselves. Answer with the name alone."
)


def naming_prompts(records: DataFrame, task: str = NAMING_TASK) -> DataFrame:
    """``cluster_id, prompt`` for a naming model: ten keywords and the start of three posts."""
    first = F.transform(
        F.slice("representatives", 1, 3),
        lambda r, i: F.concat_ws(". ", (i + 1).cast("string"), shorten(r["text"], 200, ellipsis=False)),
    )
    return records.select(
        "cluster_id",
        F.concat_ws(
            "\n",
            F.lit(task),
            F.concat(F.lit("Keywords: "), F.array_join(F.slice("top_words", 1, 10), ", ")),
            F.lit("Sample posts:"),
            F.array_join(first, "\n"),
        ).alias("prompt"),
    )


def clean_name(reply: Column) -> Column:
    """First line without quotes, cut at the last blank within 40 characters."""
    plain = strip(F.translate(strip(reply), "\"'", ""))
    line = F.substring_index(plain, "\n", 1)
    head = F.left(line, F.lit(NAME_MAX_CHARS))
    cut = F.when(F.instr(head, " ") > 0, F.regexp_replace(head, r"(?s) [^ ]*\z", "")).otherwise(head)
    return F.when(F.length(line) > NAME_MAX_CHARS, cut).otherwise(line)


def model_names(
    records: DataFrame, namer: Callable[[list[str]], list[str | None]], batch: int = 8
) -> DataFrame:
    """``cluster_id, model_name``. ``namer`` gets prompts and returns replies, or raises.

    A failed batch leaves its names null, so the rule name takes their place.
    """

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                try:
                    replies = list(namer(part["prompt"].tolist()))
                except Exception:
                    replies = [None] * len(part)
                yield pd.DataFrame({"cluster_id": part["cluster_id"], "reply": replies})

    replies = naming_prompts(records).mapInPandas(ask, "cluster_id int, reply string")
    name = clean_name(F.col("reply"))
    return replies.select("cluster_id", F.when(name != "", name).alias("model_name"))


def cluster_records(
    posts: DataFrame, reps: DataFrame, keywords: DataFrame,
    namer: Callable[[list[str]], list[str | None]] | None = None,
) -> DataFrame:
    """The cluster table: name, size, keywords, averages and representatives.

    All parts have one row per cluster; clusters without posts have none.
    """
    parts = (
        cluster_averages(posts)
        .join(keyword_lists(keywords), "cluster_id", "left")
        .join(representative_records(reps), "cluster_id", "left")
        .withColumn("top_words", F.coalesce("top_words", F.array().cast("array<string>")))
        .withColumn("name", rule_name(F.col("top_words")))
    )
    if namer is not None:
        parts = parts.join(model_names(parts, namer), "cluster_id", "left").withColumn(
            "name", F.coalesce("model_name", "name")
        )
    return parts.select(
        "cluster_id", "name", "size", "keywords", "top_words", "avg_quality_score",
        "avg_quality_reactions", "avg_quality_replies", "avg_cast_score", "representatives",
    )


def best_first(records: DataFrame) -> DataFrame:
    return records.orderBy(F.col("avg_cast_score").desc_nulls_last(), F.col("cluster_id").asc())
