"""Near duplicates by SimHash, found with a multi-index over the two halves of a fingerprint."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwell.llm.common import parts, saved, text_key, texts_of
from gleanwell.llm.graph import smallest_reachable

SHINGLE = 3
MAX_BITS = 2
HALF = 32
SEED = 42


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """Bits set in more than half of the XXH64 values of the shingles; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(size))) if len(words) >= size else [words]
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED)), dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in more than half of the values; zero without any."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, text_key and the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found = np.array([fingerprint(t) for t in texts_of(batch, "text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(found.view(np.int64))],
                ["doc_id", "text_key", "fp"],
            )

    slim = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), text_key(text).alias("text_key"),
        F.col(text).alias("text"),
    )
    return slim.mapInArrow(run, "doc_id long, text_key long, fp long")


def halves(fp: Column) -> list[Column]:
    low = fp.bitwiseAND(F.lit((1 << HALF) - 1))
    return [F.struct(F.lit(0).alias("part"), low.alias("value")),
            F.struct(F.lit(1).alias("part"), F.shiftrightunsigned(fp, HALF).alias("value"))]


def links(prints: DataFrame) -> DataFrame:
    """Pairs (a, b) of different fingerprints, a < b, at most two bits apart.

    Two bits over two halves leave one half with at most one: each half's ball of radius one (33
    values) is looked up in the table of halves, and the whole distance is checked afterwards.
    Only different fingerprints are looked up, so copies add nothing.
    """
    part = F.explode(F.array(*halves(F.col("fp")))).alias("half")
    table = prints.select(F.col("fp").alias("b"), part).select("b", "half.part", "half.value")
    near = F.explode(F.concat(
        F.array(F.col("half.value")),
        F.transform(F.sequence(F.lit(0), F.lit(HALF - 1)),
                    lambda i: F.col("half.value").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))),
    ))
    probes = prints.select(F.col("fp").alias("a"), part).select("a", "half.part", near.alias("value"))
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    # estimates know nothing of the 66 rows a fingerprint becomes, so neither side may be broadcast
    hits = probes.hint("merge").join(table.hint("merge"), ["part", "value"]).filter((F.col("a") < F.col("b")) & (distance <= MAX_BITS))
    return hits.select("a", "b").distinct()


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (hex) and the smallest doc_id reachable over links of fingerprints.

    A null text is empty; rows without words share the fingerprint zero. Null ids never name a
    component unless it has no other id. Repeated rows give repeated rows.
    """
    rows = saved(fingerprints(docs, doc_id, text).drop("text_key"), "fingerprints")
    groups = _groups(rows)
    named = rows.join(groups, "fp")
    return named.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("least").alias("component_id"),
    )


def _groups(rows: DataFrame) -> DataFrame:
    """fp and the smallest doc_id of its component, one row per different fingerprint."""
    prints = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    pairs = saved(links(prints), "links")
    return smallest_reachable(prints, pairs, "fp", "least")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents' own columns, for one row of each component: that with the smallest id.

    Among rows of that id the one with the smallest text key stays, and one of equal rows.
    """
    rows = saved(fingerprints(docs, doc_id, text), "fingerprints")
    named = rows.join(_groups(rows.drop("text_key")).withColumnRenamed("least", "_c"), "fp")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    # fingerprints of one component share "_c"; without any id each different fingerprint keeps a row
    stay = named.groupBy("_c", F.when(F.col("_c").isNull(), F.col("fp")).alias("_f")).agg(first.alias("s"))
    stay = stay.select(F.col("s.doc_id").alias("_stay"), F.col("s.text_key").alias("_with"))
    keyed = docs.select(F.struct("*").alias("_row"), F.col(doc_id).cast("long").alias("_id"), text_key(text).alias("_key"))
    one = keyed.join(stay, F.expr("_id <=> _stay AND _key = _with"), "left_semi")
    return one.dropDuplicates(["_id", "_key"]).select("_row.*")
