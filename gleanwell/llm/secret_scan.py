"""Secrets in texts, and how many owners hold each one in the whole corpus."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwell.llm.common import parts, saved, texts_of

# The base kinds in their order, then the kinds that the method adds.
KINDS = ["assign", "access", "hex", "github", "slack", "jwt", "private_key", "opaque"]
BASE = 3
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
PROVIDERS = [
    ("github", "gh", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")),
    ("slack", "xox", re.compile(r"xox[abeoprs]-[A-Za-z0-9-]{10,}")),
    ("jwt", "eyJ", re.compile(r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}")),
    ("private_key", "-----BEGIN", re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s]+")),
]
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}")
OPAQUE_ENTROPY = 3.5  # bits a character
DIGIT = re.compile(r"[0-9]")

EXAMPLE_OWNERS = 3  # a value that this many owners hold is a copied example
SPAN = "struct<kind:int,start:int,end:int,value:binary>"


def entropy(value: str) -> float:
    return -sum(c / len(value) * math.log2(c / len(value)) for c in Counter(value).values())


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) by start and kind; offsets are code points, the end is exclusive.

    Base kinds are found leftmost and not overlapping, each by itself. The added ones leave out
    what touches a span found before.
    """
    found = []
    low = text.lower()
    if any(hint in low for hint in ASSIGN_HINTS):
        found += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    if DIGIT.search(text) or HEX.search(text):
        found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    more = []
    for name, hint, pattern in PROVIDERS:
        if hint in text:
            more += [(KINDS.index(name), m.start(), m.end(), m[0]) for m in pattern.finditer(text)]
    if DIGIT.search(text):
        opaque = KINDS.index("opaque")
        more += [(opaque, m.start(), m.end(), m[0]) for m in OPAQUE.finditer(text) if entropy(m[0]) >= OPAQUE_ENTROPY]
    if more:
        taken = bytearray(len(text))
        for _, start, end, _ in found:
            taken[start:end] = b"\x01" * (end - start)
        for kind, start, end, value in more:
            if 1 not in taken[start:end]:
                taken[start:end] = b"\x01" * (end - start)
                found.append((kind, start, end, value))
    return sorted(found, key=lambda f: (f[1], f[0]))


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source",
    repository: Column | None = None,
) -> DataFrame:
    """One row per document: row, doc_id, owner, repository and its candidate spans, saved.

    Values leave the texts only as 128-bit digests. Null and empty texts have no spans; a null
    owner counts as one owner. ``repository`` is a finer unit below the owner; by default the
    owner and the language, where there is one.
    """
    if repository is None:
        repository = F.struct(*[c for c in (owner, "lang") if c in docs.columns])
    slim = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(F.col(owner)).alias("owner"), F.xxhash64(repository).alias("repository"),
        F.col(text).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([
            ("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.binary())
        ]))
        for batch in parts(batches):
            spans, marks = [], []
            for data in texts_of(batch, "text"):
                found = candidates(data.decode())
                spans.append([
                    {"kind": k, "start": s, "end": e, "value": hashlib.blake2b(v.encode(), digest_size=16).digest()}
                    for k, s, e, v in found
                ])
                base = ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e, _ in found if k < BASE)
                marks.append(hashlib.sha256(base.encode()).hexdigest())
            kept = [batch.column(c) for c in ("row", "doc_id", "owner", "repository")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(spans, kinds), pa.array(marks, pa.string())],
                ["row", "doc_id", "owner", "repository", "spans", "base_sha256"],
            )

    schema = f"row long, doc_id long, owner long, repository long, spans array<{SPAN}>, base_sha256 string"
    return saved(slim.mapInArrow(run, schema), "secret-spans")


def ownership(scanned: DataFrame) -> DataFrame:
    """value, n_owners, n_repositories, n_spans and verdict for every candidate value.

    Counted in two steps, over (value, owner, repository) and (value, owner), so that a value
    which a third of all documents hold is combined in every task before it is exchanged.
    """
    each = scanned.select("owner", "repository", F.explode("spans.value").alias("value"))
    pairs = each.groupBy("value", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owners = pairs.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("r"), F.sum("n").alias("n"))
    known = owners.groupBy("value").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("r").alias("n_repositories"), F.sum("n").alias("n_spans")
    )
    verdict = (
        F.when(F.col("n_owners") >= EXAMPLE_OWNERS, "example")
        .when(F.col("n_owners") == 1, "owner_specific").otherwise("shared")
    )
    return known.withColumn("verdict", verdict)


def judged_spans(scanned: DataFrame) -> DataFrame:
    """Every candidate span with the figures of its value: row, doc_id, kind, start, end, ..."""
    spans = scanned.select("row", "doc_id", F.inline("spans"))
    return spans.join(ownership(scanned), "value")


def document_secrets(docs: DataFrame, **columns) -> DataFrame:
    """Per document: counts, the digest of the base spans, all spans, and verdict counts.

    n_repositories is the largest count of repositories that hold one of the document's values.
    Base spans always stay. A candidate of another kind is added if its value is no copied example.
    """
    scanned = scan(docs, **columns)
    judged = judged_spans(scanned)
    kinds = F.array(*map(F.lit, KINDS))
    name = F.concat_ws(":", F.element_at(kinds, F.col("kind") + 1), F.col("start"), F.col("end"))
    keep = (F.col("kind") < BASE) | (F.col("verdict") != "example")
    by_row = judged.groupBy("row").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{KINDS[k]}") for k in range(BASE)],
        F.count_if(keep & (F.col("kind") >= BASE)).alias("n_added"),
        F.count_if(F.col("verdict") == "owner_specific").alias("n_owner_specific"),
        F.count_if(F.col("verdict") == "example").alias("n_examples"),
        F.max("n_repositories").alias("n_repositories"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(keep, F.struct("start", "kind", name.alias("name"))))), lambda s: s["name"]), ",").alias("spans"),
    )
    counts = [c for c in by_row.columns if c.startswith("n_")]
    return scanned.drop("spans").join(by_row, "row", "left").select(
        "doc_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], "base_sha256",
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
