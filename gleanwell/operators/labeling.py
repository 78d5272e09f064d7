"""Quality labels from an outside model: prompts, calls in batches, and reading the replies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanwell.functions.scalars import (
    QUALITY_LABELS,
    category_order,
    reply_category,
    shorten,
    strip,
)
from gleanwell.operators.ranking import top_per_group

# Batch sizes, how much of an author a prompt shows, defaults for unusable replies.
BATCH_OF_ONE_PROMPT, BATCH_PER_CALL = 25, 24
POSTS_IN_PROMPT, CHARS_PER_POST = 30, 150
DEFAULT_SCORE, DEFAULT_CATEGORY, DEFAULT_THEME = 5.0, "Average", "general"
NO_REASON, BAD_REPLY = "Unable to parse response", "Error parsing model response"
REPLY_KINDS = ["SCORE", "CATEGORY", "THEMES", "REASONING"]

SCALE = """Scale from 0 to 10:
0 to 2 Spammer: greetings, give-aways and repeats, hardly any effort
3 to 4 Low: very short posts of little substance
5 to 6 Average: some interesting posts among many weak ones
7 to 8 High: thoughtful, informative or entertaining most of the time
9 to 10 Leader: original insight that starts discussions"""
ONE_AUTHOR = "Rate how good the posts of the following author are.\n" + SCALE
ONE_ANSWER = """Answer in exactly four lines:
SCORE: a number
CATEGORY: Spammer, Low, Average, High or Leader
THEMES: themes, separated by commas
REASONING: one or two sentences"""
MANY_AUTHORS = (
    "Rate how good the posts of each of the following authors are. For every author give the id, "
    "a score, the category of that score, a short reason and the main themes. Judge substance, "
    "originality, variety and effort over all posts shown.\n" + SCALE
)
RULER = "=" * 80

RATING = (
    "fid bigint, quality_score double, category string, reasoning string, content_themes array<string>"
)


def user_section(users: DataFrame) -> Column:
    """What a prompt says about one author: figures and the start of the newest posts."""

    def percent(share: Column) -> Column:
        return F.format_string("%.2f%%", F.bround(share * 100, 2))

    posts = F.transform(
        F.slice("posts", 1, POSTS_IN_PROMPT),
        lambda p: F.concat(F.lit("- "), shorten(p, CHARS_PER_POST)),
    )
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Author id: "), F.col("fid").cast("string")),
        F.concat(F.lit("Posts: "), F.col("post_count").cast("string")),
        F.format_string("Mean post length: %d characters", F.bround("avg_text_length", 0).cast("bigint")),
        F.concat(F.lit("Share of greetings: "), percent(F.col("gm_ratio"))),
        F.concat(F.lit("Share of questions: "), percent(F.col("question_ratio"))),
        F.lit("Newest posts:"),
        F.array_join(posts, "\n"),
    )


def user_prompts(users: DataFrame, task: str = ONE_AUTHOR, answer: str = ONE_ANSWER) -> DataFrame:
    """``fid, prompt``: one prompt per author."""
    return users.select(
        "fid", F.concat_ws("\n\n", F.lit(task), user_section(users), F.lit(answer)).alias("prompt")
    )


def batch_prompts(
    users: DataFrame, size: int = BATCH_OF_ONE_PROMPT, task: str = MANY_AUTHORS, slice_digits: int = 1
) -> DataFrame:
    """``batch, fids, prompt``: one prompt for up to ``size`` authors.

    Authors are numbered within slices of their hash, so no task numbers them all; use more
    ``slice_digits`` for more authors.
    """
    drawn = F.md5(F.col("fid").cast("string"))
    sliced = users.select(
        "fid", user_section(users).alias("section"),
        F.left(drawn, F.lit(slice_digits)).alias("slice"), drawn.alias("draw"),
    )
    place = F.row_number().over(Window.partitionBy("slice").orderBy("draw", "fid")) - 1
    numbered = sliced.withColumn("place", place)
    batch = F.concat_ws("-", "slice", F.floor(F.col("place") / size).cast("string"))
    listed = F.sort_array(F.collect_list(F.struct("place", "fid", "section")))
    return (
        numbered.groupBy(batch.alias("batch"))
        .agg(listed.alias("rows"))
        .select(
            "batch",
            F.transform("rows", lambda r: r["fid"]).alias("fids"),
            F.concat_ws(
                f"\n{RULER}\n",
                F.lit(task),
                F.array_join(F.transform("rows", lambda r: r["section"]), f"\n{RULER}\n"),
            ).alias("prompt"),
        )
    )


def ask_in_batches(
    prompts: DataFrame, key: str, model: Callable[[list[str]], list[str]], size: int = BATCH_PER_CALL
) -> DataFrame:
    """``key, reply, error``: calls ``model`` on lists of prompts, batch after batch in each task.

    A call that raises leaves the replies of its batch null and the message in ``error``.
    """

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), size):
                part = frame.iloc[start : start + size]
                try:
                    replies, error = list(model(part["prompt"].tolist())), None
                except Exception as failure:
                    replies, error = [None] * len(part), str(failure)
                yield pd.DataFrame({key: part[key], "reply": replies, "error": error})

    kind = dict(prompts.dtypes)[key]
    return prompts.select(key, "prompt").mapInPandas(ask, f"{key} {kind}, reply string, error string")


def _last_line(lines: Column, kind: str) -> Column:
    return F.try_element_at(_lines_of(lines, kind), F.lit(-1))


def _lines_of(lines: Column, kind: str) -> Column:
    tag = f"{kind}:"
    return F.transform(
        F.filter(lines, lambda x: x.startswith(tag)),
        lambda x: strip(F.replace(x, F.lit(tag), F.lit(""))),
    )


def parse_replies(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Adds ``quality_score, category, content_themes, reasoning`` read from four-line replies.

    The last line of a kind counts. The category follows the score if there is one. A score line
    without a number makes the whole reply unusable, which gives the default record.
    """
    lines = F.transform(F.split(strip(F.col(reply)), "\n"), lambda x: strip(x))
    number = r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"

    def score_of(text: Column) -> Column:
        token = F.split_part(strip(F.split_part(text, F.lit("/"), F.lit(1))), F.lit(" "), F.lit(1))
        return F.when(token.rlike(number), token.try_cast("double"))

    marked = replies.withColumn("_lines", lines)
    marked = marked.withColumns(
        {
            "_scores": F.transform(_lines_of(F.col("_lines"), "SCORE"), score_of),
            "_category": _last_line(F.col("_lines"), "CATEGORY"),
            "_themes": _last_line(F.col("_lines"), "THEMES"),
            "_reason": _last_line(F.col("_lines"), "REASONING"),
        }
    )
    score = F.try_element_at("_scores", F.lit(-1))
    unusable = F.col(reply).isNull() | F.exists("_scores", lambda s: s.isNull())
    themes = F.transform(F.split("_themes", ","), lambda t: strip(t))

    def given(value: Column, default: Column) -> Column:
        return F.when(unusable, default).otherwise(F.coalesce(value, default))

    text = F.when(F.col("_category") != "", F.col("_category"))
    reason = F.coalesce(F.when(F.col("_reason") != "", F.col("_reason")), F.lit(NO_REASON))
    return marked.withColumns(
        {
            "quality_score": given(score, F.lit(DEFAULT_SCORE)),
            "category": given(F.coalesce(reply_category(score), text), F.lit(DEFAULT_CATEGORY)),
            "content_themes": given(themes, F.array(F.lit(DEFAULT_THEME))),
            "reasoning": F.when(unusable, F.lit(BAD_REPLY)).otherwise(reason),
        }
    ).drop("_lines", "_scores", "_category", "_themes", "_reason")


def parse_ratings(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """One row per rating of JSON replies; a reply with any invalid rating is left out whole."""
    parsed = F.from_json(F.col(reply), f"ratings array<struct<{_struct_fields(RATING)}>>")
    ratings = parsed["ratings"]
    valid = F.forall(
        ratings,
        lambda r: r["fid"].isNotNull()
        & r["quality_score"].between(0, 10)
        & r["category"].isNotNull()
        & r["reasoning"].isNotNull()
        & r["content_themes"].isNotNull(),
    )
    return replies.filter(F.coalesce(valid, F.lit(False))).select(F.inline(ratings))


def _struct_fields(ddl: str) -> str:
    return ddl.replace(", ", ",").replace(" ", ":")


def label_users(
    users: DataFrame, model: Callable[[list[str]], list[str]], size: int = BATCH_PER_CALL,
    drop_failed: bool = False,
) -> DataFrame:
    """Labelled authors. Failed calls give default records that name the error, or no rows."""
    answers = ask_in_batches(user_prompts(users), "fid", model, size)
    if drop_failed:
        answers = answers.filter(F.col("error").isNull())
    failed = F.concat(F.lit("Error during batch processing: "), F.col("error"))
    return parse_replies(answers).select(
        "fid", "quality_score", "category",
        F.coalesce(failed, "reasoning").alias("reasoning"), "content_themes",
    )


def category_counts(df: DataFrame, category: str = "category") -> DataFrame:
    """Rows and share per category; categories nobody has are listed with 0."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(category) == c).alias(c) for c in QUALITY_LABELS],
    )
    return counts.unpivot(["n"], QUALITY_LABELS, "category", "users").select(
        "category", "users", F.when(F.col("n") > 0, F.col("users") / F.col("n")).alias("share")
    )


def first_per_category(labeled: DataFrame, key: str = "fid") -> DataFrame:
    """One example per category, lowest id first."""
    return top_per_group(labeled, ["category"], [F.col(key).asc()], 1).orderBy(
        category_order(F.col("category"))
    )
