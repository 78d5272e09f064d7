"""Benchmark items in training texts: BM25 retrieval over an index of the items, then word overlap.

Every passage of every text is a query against an inverted index of the items. Scores are divided
by the score an item gives itself, so one threshold serves all items. As in block-max WAND, upper
bounds decide what is scored at all: first the sum of the terms' largest weights, then, per block
of items, the sum of the terms' block maxima; only (passage, block) pairs whose bound reaches the
threshold are scored. The bounds of a whole batch of passages are summed at once. Nothing that
reaches the threshold is lost, whatever its rank.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.llm.common import parts, saved, texts_of

K1, B = 1.2, 0.75
THRESHOLD = 0.6  # of the score that an item gives itself
SHINGLE = 5
OVERLAP = 0.8  # of the item's shingles
PART_OVERLAP = 0.5  # of those of the question and of the answer
FEW_WORDS = 3 * SHINGLE - 1  # below it one changed word can hit more than half of a part's runs
PASSAGE = 64  # words of a step; a passage is two steps, so an item up to one step lies in one whole
BLOCK = 8  # items whose weights share a maximum
SHARD_BYTES = 4 << 20  # item text of an index that is sent to the tasks at once
CELLS = 1 << 22  # bounds that are summed at once
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
SENTENCE = re.compile(r"(?<=[.?!])\s+")


def normal_words(text: bytes) -> list[bytes]:
    """Lower-case words without punctuation."""
    return WORD.findall(text.decode().lower().encode())


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer, the rest the question; one sentence is both."""
    sentences = [s for s in SENTENCE.split(text.strip()) if s]
    return (" ".join(sentences[:-1]), sentences[-1]) if len(sentences) > 1 else (text, text)


def shingles(words: list[bytes]) -> set[bytes]:
    """Runs of five words; a shorter text is one run."""
    size = min(SHINGLE, len(words))
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()


class ItemIndex:
    """Postings of a shard of items with weights, term maxima and block maxima."""

    def __init__(self, items: list[tuple], n_items: int, mean_words: float):
        """items: (item_id, text, {term: number of items with it})."""
        self.items = []
        term_of, postings = {}, []
        for item_id, text, df in items:
            words = normal_words(text.encode())
            counts = Counter(words)
            weights = {
                t: np.log1p((n_items - df[t] + 0.5) / (df[t] + 0.5))
                * c * (K1 + 1) / (c + K1 * (1 - B + B * len(words) / mean_words))
                for t, c in counts.items()
            }
            own = sum(weights.values())
            q, a = question_and_answer(text)
            split = [shingles(normal_words(p.encode())) for p in (text, q, a)]
            parted = [normal_words(p.encode()) for p in (q, a)]
            few = [set(), *[set(p) if len(p) < FEW_WORDS else set() for p in parted]]
            number = len(self.items)
            self.items.append((item_id, split, few, len(words)))
            postings += [(term_of.setdefault(t, len(term_of)), number, w / own) for t, w in weights.items()]
        self.terms = term_of
        n, blocks = len(term_of), -(-len(self.items) // BLOCK)
        self.block_max = np.zeros((n, blocks), dtype=np.float32)
        postings.sort()
        self.term = np.array([p[0] for p in postings], dtype=np.int64)
        self.item = np.array([p[1] for p in postings], dtype=np.int64)
        self.weight = np.array([p[2] for p in postings], dtype=np.float32)
        np.maximum.at(self.block_max, (self.term, self.item // BLOCK), self.weight)
        self.term_max = self.block_max.max(axis=1) if blocks else np.zeros(n, dtype=np.float32)
        self.first = np.searchsorted(self.term, np.arange(n + 1))
        self.step = max([PASSAGE, *(w for *_, w in self.items)])

    def search(self, texts: list[bytes]) -> list[tuple[int, int, float, float, float, float]]:
        """(text, item, score, overlap, question, answer) of all leaks, the best passage of each."""
        words = [normal_words(t) for t in texts]
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        steps = np.maximum(1, -(-lengths // self.step))
        origin = np.concatenate([[0], np.cumsum(steps)])
        ids = np.fromiter(map(self.terms.get, chain.from_iterable(words), repeat(-1)), dtype=np.int64, count=int(lengths.sum()))
        owner = np.repeat(np.arange(len(texts)), lengths)
        place = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        hit = ids >= 0
        ids, owner, step = ids[hit], owner[hit], origin[owner[hit]] + place[hit] // self.step
        back = step > origin[owner]  # a step belongs to its own passage and the one before
        pairs = np.unique(np.concatenate([step, step[back] - 1]) * len(self.terms) + np.concatenate([ids, ids[back]]))
        if not len(pairs):
            return []
        passage, term = pairs // len(self.terms), pairs % len(self.terms)
        starts = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
        ends = np.r_[starts[1:], len(passage)]
        bound = np.add.reduceat(self.term_max[term], starts)
        leaks: dict[tuple[int, int], tuple] = {}
        alive = np.flatnonzero(bound >= THRESHOLD - 1e-4)
        take = max(1, CELLS // max(1, self.block_max.shape[1] * 4 * int(np.max(ends - starts))))
        for at in range(0, len(alive), take * 4):
            some = alive[at : at + take * 4]
            sizes = ends[some] - starts[some]
            rows = np.concatenate([np.arange(starts[p], ends[p]) for p in some])
            cuts = np.cumsum(sizes) - sizes
            blocks = np.add.reduceat(self.block_max[term[rows]], cuts, axis=0) >= THRESHOLD - 1e-4
            for k in np.flatnonzero(blocks.any(axis=1)):
                self._score(term[rows[cuts[k] : cuts[k] + sizes[k]]], blocks[k], int(passage[starts[some[k]]]), origin, words, leaks)
        return [(t, i, *found) for (t, i), found in sorted(leaks.items())]

    def _score(self, terms, open_blocks, passage: int, origin, words, leaks) -> None:
        spans = [np.arange(self.first[t], self.first[t + 1]) for t in terms]
        at = np.concatenate(spans)
        at = at[open_blocks[self.item[at] // BLOCK]]
        scores = np.bincount(self.item[at], self.weight[at], minlength=len(self.items))
        found = np.flatnonzero(scores >= THRESHOLD - 1e-6)
        if not len(found):
            return
        text = int(np.searchsorted(origin, passage, side="right")) - 1
        begin = (passage - int(origin[text])) * self.step
        held = words[text][begin : begin + 2 * self.step]
        runs: dict[int, set[bytes]] = {}
        for i in found.tolist():
            shares = []
            for wanted, few in zip(*self.items[i][1:3]):
                size = len(next(iter(wanted)).split(b" ")) if wanted else 0
                if size not in runs:
                    runs[size] = {b" ".join(held[j : j + size]) for j in range(len(held) - size + 1)} if size else set()
                share = len(wanted & runs[size]) / len(wanted) if wanted else 1.0
                shares.append(max(share, len(few.intersection(held)) / len(few)) if few else share)
            if shares[0] >= OVERLAP and min(shares[1:]) >= PART_OVERLAP:
                leaks[text, i] = max(leaks.get((text, i), ()), (float(scores[i]), *shares))


def indexes(benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text") -> Iterator[ItemIndex]:
    """The index in shards of at most ``SHARD_BYTES`` of item text (or one item), one at a time.

    How many items hold a term is counted by Spark over all shards. Null and empty items are left
    out; repeated items are items each.
    """
    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            split = [normal_words(t) for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(s) for s in split], pa.int64()),
                 pa.array([sorted({w.decode("utf-8", "replace") for w in s}) for s in split], pa.list_(pa.string()))],
                [*batch.schema.names, "n", "terms"],
            )

    slim = benchmark.select(
        F.monotonically_increasing_id().alias("row"), F.col(item_id).cast("long").alias("item_id"),
        F.coalesce(F.col(item_text), F.lit("")).alias("text"),
    )
    split = saved(slim.mapInArrow(terms, "row long, item_id long, text string, n long, terms array<string>").filter("n > 0"), "items")
    total = split.agg(F.count(F.lit(1)), F.avg("n"), F.sum(F.octet_length("text"))).first()
    if not total[0]:
        return
    df = split.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    listed = split.select("row", F.explode("terms").alias("term")).join(df, "term").groupBy("row").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "df"))).alias("df")
    )
    shards = -(-total[2] // SHARD_BYTES)
    ready = saved(split.drop("terms").join(listed, "row").withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(2 * shards))), "index")
    for shard in range(2 * shards if shards > 1 else 1):
        rows = ready if shards <= 1 else ready.filter(F.col("shard") == shard)
        items = [(r["item_id"], r["text"], {t.encode(): d for t, d in r["df"].items()}) for r in rows.orderBy("row").toLocalIterator()]
        if items:
            yield ItemIndex(items, total[0], total[1])


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **item_columns) -> DataFrame:
    """One row per (document row, item) found: doc_id, item_id, score and the three overlaps.

    Each shard of the index is one pass over the documents, without a shuffle. Null texts hold
    nothing; clean documents have no row.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"
    found = spark.createDataFrame([], schema)
    for index in indexes(benchmark, **item_columns):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in parts(batches):
                ids = batch.column("doc_id").to_pylist()
                hits = index.search(texts_of(batch, "text"))
                columns = list(zip(*hits)) or [()] * 6
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[t] for t in columns[0]], pa.int64()),
                    pa.array([index.items[i][0] for i in columns[1]], pa.int64()),
                    *[pa.array(list(c), pa.float64()) for c in columns[2:]],
                ], ["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"])

        found = found.unionByName(slim.mapInArrow(run, schema))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **item_columns) -> DataFrame:
    """The documents' own columns, for those in which no item is found."""
    for index in indexes(benchmark, **item_columns):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in parts(batches):
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[hit[0] for hit in shared.value.search(texts_of(batch, text))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
