"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TOKENIZER_END = 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Copies and words that the mix of all sources takes of every document."""
    from gleanwell.llm.mixing import copies

    return copies(table(spark, folder, "documents")).drop("draw")


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secret spans of every document, with base counts and digest."""
    from gleanwell.llm.secret_scan import document_secrets

    return document_secrets(table(spark, folder, "documents"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item found in a document."""
    from gleanwell.llm.decontaminate import leaks

    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_cotraining(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document from the text and the metadata view."""
    from gleanwell.llm.cotraining import co_train

    return co_train(table(spark, folder, "documents"), table(spark, folder, "labels")).scored


def op5_unigram_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Unigram token counts of every document."""
    from gleanwell.llm.unigram import piece_vocabulary, token_counts

    vocabulary = piece_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    return token_counts(table(spark, folder, "documents"), vocabulary)


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of every document, the base rules and the learned list's verdict."""
    from gleanwell.llm.rule_lists import quality_table

    return quality_table(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without its repeated windows."""
    from gleanwell.llm.repeats import without_repeats

    return without_repeats(table(spark, folder, "documents"))


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    from gleanwell.llm.warc import archive, page_summary

    return page_summary(spark, archive(table(spark, folder, "pages")))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    from gleanwell.llm import simhash

    return simhash.components(table(spark, folder, "documents"))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents, written in ascending id order and read back."""
    from gleanwell.llm.token_files import read_tokens, write_tokens

    docs = table(spark, folder, "documents")
    return read_tokens(write_tokens(docs, tokenizer_path(), TOKENIZER_END))


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents with the more frequent words that they are slips of."""
    from gleanwell.llm.spelling import slipped, variants

    return variants(table(spark, folder, "documents"), spelled=slipped)


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every document, one in ten made periodic first."""
    from gleanwell.llm.periodic_runs import document_runs, tiled

    return document_runs(table(spark, folder, "documents"), rewrite=tiled)


def op13_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document, with base counts and digest."""
    from gleanwell.llm.personal_data import document_personal_data

    return document_personal_data(table(spark, folder, "documents"))


QUERIES = {
    "op1_mixture": op1_mixture,
    "op2_secrets": op2_secrets,
    "op3_decontamination": op3_decontamination,
    "op4_cotraining": op4_cotraining,
    "op5_unigram_counts": op5_unigram_counts,
    "op6_quality_rules": op6_quality_rules,
    "op7_repeats": op7_repeats,
    "op8_warc": op8_warc,
    "op9_simhash": op9_simhash,
    "op10_token_files": op10_token_files,
    "op11_spelling": op11_spelling,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_personal_data": op13_personal_data,
}
ORACLE: dict[str, str] = {
    "op8_warc": """
        WITH body AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        record AS (
            SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
                   min(page_id) OVER (PARTITION BY html) AS least
            FROM body)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> least THEN least END AS refers_to
        FROM record""",
}
