"""Sets of words as short byte strings, so that unions can be counted without moving the words.

The commonest words of all texts get numbers, the most frequent the smallest. A text's set is then the
sorted numbers, each as its distance from the one before, seven bits a byte; words without a
number stay words. Counts are exact whatever words have numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwell.session import dropped, materialized

# Words with a number at most; the driver and each task hold so many words.
NUMBERED = 1 << 20
BYTES = 3  # a distance is below NUMBERED, so its seven-bit parts are at most three


def numbered_words(sets: DataFrame, words: str, limit: int = NUMBERED) -> pa.Array:
    """The words of the largest counts, no more than ``limit``; of one count all or none."""
    counts = materialized(
        sets.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )
    held, least = 0, None
    for r in sorted(counts.groupBy("n").agg(F.count(F.lit(1)).alias("m")).collect(), reverse=True):  # one row per count
        held += r["m"]
        if held > limit:
            break
        least = r["n"]
    if least is None:
        dropped(counts)
        return pa.array([], pa.string())
    table = counts.filter(F.col("n") >= least).toArrow()
    dropped(counts)
    return table.sort_by([("n", "descending"), ("word", "ascending")]).column("word").combine_chunks().cast(pa.string())


def coded(sets: DataFrame, words: str, limit: int = NUMBERED) -> DataFrame:
    """The rows with ``words``, arrays without repeats, replaced by ``coded`` and ``rest``."""
    kept = [c for c in sets.columns if c != words]
    schema = sets.select(*kept, F.lit(b"").alias("coded"), F.col(words).alias("rest")).schema
    table = sets.sparkSession.sparkContext.broadcast(numbered_words(sets, words, limit))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(words)
            sizes = pc.list_value_length(own).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), sizes)
            flat = own.flatten()
            number = pc.fill_null(pc.index_in(flat, value_set=table.value), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            has = number >= 0
            data, ends = _packed(row[has], number[has], batch.num_rows)
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(data)])
            rest_ends = np.concatenate([[0], np.cumsum(np.bincount(row[~has], minlength=batch.num_rows))]).astype(np.int32)
            rest = pa.ListArray.from_arrays(pa.array(rest_ends), flat.filter(pa.array(~has)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], packed, rest], [*kept, "coded", "rest"])

    none = F.array().cast("array<string>")
    return sets.select(*kept, F.coalesce(words, none).alias(words)).mapInArrow(encoded, schema)


def _packed(row: np.ndarray, number: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows' sets, and the places where each row's begin and end."""
    key = np.sort(row * NUMBERED + number)
    row, number = key // NUMBERED, key % NUMBERED
    apart = np.diff(number, prepend=0)
    first = np.diff(row, prepend=-1) > 0
    apart[first] = number[first]
    size = 1 + (apart >= 1 << 7) + (apart >= 1 << 14)
    at = np.cumsum(size) - size
    data = np.zeros(int(size.sum()), dtype=np.uint8)
    for part in range(BYTES):
        here = size > part
        more = (size[here] > part + 1) << 7
        data[at[here] + part] = (apart[here] >> 7 * part & 127) | more
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, size, rows))])
    return data, ends.astype(np.int32)


def _union_sizes(sets: pa.Array) -> np.ndarray:
    """Per list of coded sets how many numbers are in one of them at least."""
    texts = sets.flatten()
    per_group = pc.fill_null(pc.list_value_length(sets), 0).to_numpy(zero_copy_only=False)
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b"".join(texts.drop_null().to_pylist()), dtype=np.uint8)
    last = np.flatnonzero(data < 128)
    if not len(last):
        return np.zeros(len(sets), dtype=np.int64)
    start = np.concatenate([[0], last[:-1] + 1])
    apart = np.zeros(len(last), dtype=np.int64)
    for part in range(BYTES):
        here = start + part <= last
        apart[here] |= (data[start[here] + part].astype(np.int64) & 127) << 7 * part
    text = np.searchsorted(np.cumsum(lengths), start, side="right")
    total = np.cumsum(apart)
    begins = np.flatnonzero(np.diff(text, prepend=-1) > 0)
    before = (total - apart)[begins]
    number = total - np.repeat(before, np.diff(np.append(begins, len(text))))
    group = np.repeat(np.arange(len(sets)), per_group)[text]
    key = np.sort(group * NUMBERED + number)
    new = np.concatenate([[True], key[1:] != key[:-1]])
    return np.bincount(key[new] // NUMBERED, minlength=len(sets))


def union_size(coded_sets: Column, rests: Column) -> Column:
    """Different words in lists of coded sets and of the words they left."""

    @F.arrow_udf("long")
    def numbers(sets: pa.Array) -> pa.Array:
        return pa.array(_union_sizes(sets), pa.int64())

    return numbers(coded_sets) + F.size(F.array_distinct(F.flatten(rests)))
