"""Readers with the column types each table must have."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CASTS = "Hash string, Fid string, Text string, Embeds string, Timestamp string, ParentCastId string"
REACTIONS = "Hash string, Fid string, TargetCastId string"
SCORES = "fid string, quality_score double, is_quality_user int, quality_category string"
USERS_TO_LABEL = (
    "fid bigint, posts array<string>, post_count bigint, avg_text_length double, "
    "gm_ratio double, question_ratio double, sample_post string"
)
LABELED_USERS = (
    "fid bigint, quality_score double, category string, reasoning string, "
    "content_themes array<string>"
)
EMBEDDINGS = "hash_hex string, fid bigint, text string, embedding array<float>"
EMBEDDINGS_COUNTED = EMBEDDINGS + ", reaction_count bigint, reply_count bigint"
REPRESENTATIVE = (
    "struct<hash:string,fid:bigint,text:string,author_quality:double,"
    "quality_reactions:bigint,quality_replies:bigint,cast_score:double>"
)
CLUSTERS = (
    "cluster_id int, name string, size bigint, keywords array<struct<term:string,score:double>>, "
    "top_words array<string>, avg_quality_score double, avg_quality_reactions double, "
    f"avg_quality_replies double, avg_cast_score double, representatives array<{REPRESENTATIVE}>"
)


def read_parquet(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """A Parquet table; with ``view`` it can also be named in SQL text."""
    df = spark.read.parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records from files that each hold one JSON array.

    Such a file cannot be split, so big tables should be JSON lines or Parquet.
    """
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records from JSON lines or from array files, whichever the path holds.

    An array starts with a bracket, a line with a brace; the first line that is not blank tells.
    """
    opening = spark.read.text(path).select(F.ltrim("value").alias("line")).filter("line <> ''").head()
    read = read_json_array if opening and opening["line"].startswith("[") else read_json_lines
    return read(spark, path, schema)


def read_first_present(spark: SparkSession, paths: Sequence[str], schema: str) -> DataFrame:
    """The first of the paths that exists, for example local labels before bought ones."""
    for path in paths:
        try:
            return read_json(spark, path, schema)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError("none of these paths exists: " + ", ".join(paths))


def read_embeddings(spark: SparkSession, path: str, dimension: int | None = None) -> DataFrame:
    """An embedding table; with ``dimension`` every vector's length is checked while reading."""
    df = spark.read.parquet(path)
    if dimension is None:
        return df
    vector = F.col("embedding")
    checked = F.when(F.size(vector) == dimension, vector).otherwise(
        F.raise_error(F.concat(F.lit("vector length "), F.size(vector).cast("string")))
    )
    return df.withColumn("embedding", checked)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def only_of(df: DataFrame, ids: DataFrame, column: str, id_column: str = "fid") -> DataFrame:
    """Rows whose id is in the id set: one semi join, however long the list is."""
    wanted = ids.select(F.col(id_column).alias("_wanted")).distinct()
    return df.join(wanted, F.col(column) == F.col("_wanted"), "left_semi")
