"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of their input: rows
that a stage rejects are gone, rows that the mix repeats are there several times. The last writes
the token files of what is left and returns one row per document, read back from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanwell.llm import decontaminate, mixing, near_copies, rule_lists, token_files
from gleanwell.llm.common import dropped, saved
from gleanwell.llm.queries import TOKENIZER_END, table, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    return rule_lists.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8): that with the smallest id.

    SimHash fingerprints propose pairs, a prefix filter those that they miss; all are checked exactly.
    """
    return near_copies.one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' documents: doc_id, start, n_tokens, ids_crc32."""
    return token_files.read_tokens(token_files.write_tokens(docs, tokenizer_path(), TOKENIZER_END))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_leaks),
    ("source_mix", source_mix),
    ("token_output", token_output),
]

ORACLE_SQL = None  # learned rules, fingerprints, retrieval and a tokenizer have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
        if before is not None:
            dropped(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
