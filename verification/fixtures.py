"""The driver's tables seen as posts, reactions, scores, clustered posts and feedback.

Each view exists twice, once as a DataFrame and once as DuckDB SQL, from the same expressions.
Every view covers its whole source table and whole texts.
"""

from __future__ import annotations

from functools import lru_cache, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwell.operators.features import text_facts
from gleanwell.operators.ranking import numbered_by_time

# Parameters that fit these tables: order dates lie before 2021, engagement is lower.
RECENT_FROM = -700_000_000
LOOSE_REACTIONS = (3, 10_000)
LOOSE_REPLIES = (2, 5_000)
SESSION_ANSWERS = 7
N_CLUSTERS = 10


def planned_once(build):
    name = f"_{build.__name__}"

    @wraps(build)
    def view(self):
        if name not in self.__dict__:
            self.__dict__[name] = build(self)
        return self.__dict__[name]

    return view


class Fixtures:
    """One set of tables. Each view is planned once, however many operators of a query use it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.table = lru_cache(maxsize=None)(self._table)

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @planned_once
    def posts(self) -> DataFrame:
        """The posts with the id of their text's document."""
        key = F.col("o_orderkey")
        n_docs = self.table("documents").count()  # Parquet footers only
        seconds = F.timestamp_diff(
            "SECOND", F.expr("timestamp_ntz'2021-01-01 00:00:00'"), F.col("o_orderdate")
        )
        return self.table("orders").select(
            key.cast("string").alias("Hash"),
            F.col("o_custkey").cast("string").alias("Fid"),
            seconds.cast("string").alias("Timestamp"),
            F.when(key % 4 != 0, F.concat(F.lit("0:"), (key - key % 4).cast("string"))).alias(
                "ParentCastId"
            ),
            (key % n_docs).alias("doc_id"),
        )

    @planned_once
    def texts(self) -> DataFrame:
        return self.table("documents").select("doc_id", F.col("text").alias("Text"))

    @planned_once
    def casts(self) -> DataFrame:
        return self.posts().join(self.texts(), "doc_id").select(
            "Hash", "Fid", "Text", F.lit(None).cast("string").alias("Embeds"), "Timestamp",
            "ParentCastId",
        )

    @planned_once
    def measured_casts(self) -> DataFrame:
        """The posts with the facts of their texts; a text is measured once, not once a post."""
        return self.posts().join(text_facts(self.texts()), "doc_id").drop("doc_id")

    @planned_once
    def reactions(self) -> DataFrame:
        """Reactions keyed by hash only: the author part is a placeholder."""
        return self.table("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("Hash"),
            F.col("l_partkey").cast("string").alias("Fid"),
            F.concat(F.lit("0:"), F.col("l_orderkey").cast("string")).alias("TargetCastId"),
        )

    @planned_once
    def exact_reactions(self) -> DataFrame:
        """Reactions keyed by the post's real ``fid:hash``."""
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        return self.table("lineitem").join(orders, "l_orderkey").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("Hash"),
            F.col("l_partkey").cast("string").alias("Fid"),
            F.concat_ws(":", "o_custkey", "l_orderkey").alias("TargetCastId"),
        )

    @planned_once
    def scores(self) -> DataFrame:
        from gleanwell.functions.scalars import clip, is_quality_user, quality_category

        score = clip(F.round((F.col("c_acctbal") + 1000) / 1100, 4), 0.0, 10.0)
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("fid"),
            score.alias("quality_score"),
            is_quality_user(score).alias("is_quality_user"),
            quality_category(score).alias("quality_category"),
        )

    @planned_once
    def labeled(self) -> DataFrame:
        raw = F.col("quality") * 8 + 2 - F.col("toxic") * 2
        return self.table("labels").select(
            F.col("doc_id").alias("fid"),
            F.least(F.lit(10), F.greatest(F.lit(0), raw)).cast("double").alias("quality_score"),
        )

    @planned_once
    def clustered(self) -> DataFrame:
        """Posts with a vector and a given cluster."""
        docs = self.table("documents").select(F.col("doc_id").alias("vec_id"), F.col("text").alias("Text"), "n_chars")
        key = F.col("vec_id")
        reactions, replies = (key % 23).cast("bigint"), (key % 7).cast("bigint")
        quality = F.round((key % 101) / 10, 2)
        return self.table("embeddings").join(docs, "vec_id").select(
            key.cast("string").alias("Hash"),
            (key % 89).cast("string").alias("Fid"),
            "Text",
            "embedding",
            F.col("label").cast("int").alias("cluster_id"),
            quality.alias("quality_score"),
            reactions.alias("quality_reactions"),
            replies.alias("quality_replies"),
            F.round(quality * 0.3 + reactions * 0.3 + replies * 0.4, 4).alias("cast_score"),
        )

    @planned_once
    def feedback(self) -> DataFrame:
        """Clicks as likes and errors as dislikes, cut into sessions of at most seven answers."""
        answers = self.table("events").filter(F.col("event_type").isin("click", "error"))
        numbered = numbered_by_time(answers, ["user_id"], "ts", "event_id", "hour")
        turn = F.col("position") - 1
        return numbered.select(
            "user_id",
            F.expr(f"(position - 1) div {SESSION_ANSWERS}").alias("session"),
            (turn % SESSION_ANSWERS + 1).cast("int").alias("seq"),
            (F.col("event_id") % N_CLUSTERS).cast("int").alias("cluster_id"),
            (F.col("event_type") == "click").alias("liked"),
            (F.expr(f"event_id div {N_CLUSTERS}") % 10).cast("int").alias("post_idx"),
        )


# The same views for DuckDB, as common table expressions.
CTE = {
    "casts": """casts AS (
      SELECT CAST(o.o_orderkey AS VARCHAR) AS "Hash", CAST(o.o_custkey AS VARCHAR) AS "Fid",
             d.text AS "Text", CAST(NULL AS VARCHAR) AS "Embeds",
             CAST(date_diff('second', TIMESTAMP '2021-01-01', o.o_orderdate) AS VARCHAR) AS "Timestamp",
             CASE WHEN o.o_orderkey % 4 <> 0
                  THEN '0:' || CAST(o.o_orderkey - o.o_orderkey % 4 AS VARCHAR) END AS "ParentCastId"
      FROM orders o JOIN (SELECT doc_id, text || '' AS text FROM documents) d
        ON o.o_orderkey % (SELECT count(*) FROM documents) = d.doc_id)""",
    "reactions": """reactions AS (
      SELECT l_orderkey || '-' || l_linenumber AS "Hash", CAST(l_partkey AS VARCHAR) AS "Fid",
             '0:' || CAST(l_orderkey AS VARCHAR) AS "TargetCastId" FROM lineitem)""",
    "exact_reactions": """exact_reactions AS (
      SELECT l_orderkey || '-' || l_linenumber AS "Hash", CAST(l_partkey AS VARCHAR) AS "Fid",
             o_custkey || ':' || l_orderkey AS "TargetCastId"
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "scores": """scores AS (
      SELECT *, CAST(quality_score >= 5 AS INTEGER) AS is_quality_user,
        CASE WHEN quality_score <= 2.5 THEN 'Spammer' WHEN quality_score <= 4.5 THEN 'Low'
             WHEN quality_score <= 6.5 THEN 'Average' WHEN quality_score <= 8.5 THEN 'High'
             ELSE 'Leader' END AS quality_category
      FROM (SELECT CAST(c_custkey AS VARCHAR) AS fid,
                   least(10.0, greatest(0.0, round((c_acctbal + 1000) / 1100, 4))) AS quality_score
            FROM customer))""",
    "labeled": """labeled AS (
      SELECT doc_id AS fid, CAST(least(10, greatest(0, quality * 8 + 2 - toxic * 2)) AS DOUBLE) AS quality_score
      FROM labels)""",
    "clustered": """clustered AS (
      SELECT *, round(quality_score * 0.3 + quality_reactions * 0.3 + quality_replies * 0.4, 4) AS cast_score
      FROM (SELECT CAST(vec_id AS VARCHAR) AS "Hash", CAST(vec_id % 89 AS VARCHAR) AS "Fid",
             text AS "Text", embedding, CAST(label AS INTEGER) AS cluster_id,
             round(CAST(vec_id % 101 AS DOUBLE) / 10, 2) AS quality_score,
             CAST(vec_id % 23 AS BIGINT) AS quality_reactions, CAST(vec_id % 7 AS BIGINT) AS quality_replies
      FROM embeddings JOIN documents ON vec_id = doc_id))""",
    "feedback": f"""feedback AS (
      SELECT user_id, (p - 1) // {SESSION_ANSWERS} AS session,
             CAST((p - 1) % {SESSION_ANSWERS} + 1 AS INTEGER) AS seq,
             CAST(event_id % {N_CLUSTERS} AS INTEGER) AS cluster_id, event_type = 'click' AS liked,
             CAST((event_id // {N_CLUSTERS}) % 10 AS INTEGER) AS post_idx
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p
            FROM events WHERE event_type IN ('click', 'error')))""",
}


def with_views(*names: str, recursive: bool = False) -> str:
    """The head of a query over the named views; continue with ``SELECT`` or ``, more AS (...)``."""
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(CTE[n] for n in names) + "\n"
