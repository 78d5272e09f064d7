"""Long repeated passages, by compaction of a de Bruijn graph over words.

Runs of ``window`` words are the edges of a graph whose nodes are the runs one word shorter. Edges
that occur twice or more anywhere are repeated; chains of them without a branch are one path, and a
path's occurrences are spans of source coordinates. As graph builders do with minimizers, texts
are first thinned: the smallest hash among the short runs of a window depends on the window alone,
so only windows whose smallest short run is found twice can be repeated, and only these become
edges. Equal texts are one text with a multiplicity throughout.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.llm.common import dropped, parts, saved, texts_of

WINDOW = 35
ANCHOR = 15  # words of the short runs
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd bases of the two run hashes


# ---------------------------------------------------------------- runs of words as numbers


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def run_hashes(words: np.ndarray, size: int, factor: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words, from hashes of runs of doubled lengths."""
    out, done, part, length = None, 0, words, 1
    while True:
        if size & length:
            if out is None:
                out, done = part, length
            else:  # the runs found so far, followed by runs of this length
                n = len(words) - done - length + 1
                out = out[: max(n, 0)] * np.uint64(pow(factor, length, 1 << 64)) + part[done : done + max(n, 0)]
                done += length
        if 2 * length > size:
            return mixed(out)
        n = max(len(part) - length, 0)
        part = part[:n] * np.uint64(pow(factor, length, 1 << 64)) + part[length : length + n]
        length *= 2


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """The smallest (or what ``pick`` takes) of every ``width`` neighbours."""
    length = 1
    while 2 * length <= width:
        x = pick(x[: len(x) - length], x[length:])
        length *= 2
    rest = width - length
    return pick(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window its smallest short-run hash, and the hashes at the places that are such smallest."""
    if len(words) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    short = run_hashes(words, min(ANCHOR, window), FACTORS[0])
    width = window - min(ANCHOR, window) + 1
    least = sliding(short, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    most = sliding(np.concatenate([edge, least, edge]), width, np.maximum)
    return least, short[most == short]


# ---------------------------------------------------------------- the graph's tables


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, a 128-bit digest of the text as two longs, and the text; null is empty."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("a"),
        F.xxhash64(F.lit("b"), body).alias("b"), body.alias("text"),
    )


def _anchored(texts: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            sizes, whole, found = [], [], []
            for data in texts_of(batch, "text"):
                words = data.split()
                sizes.append(len(words))
                whole.append(hashlib.sha256(b" ".join(words)).hexdigest())
                found.append(anchors(word_hashes(words), window)[1].view(np.int64))
            offsets = np.cumsum([0, *map(len, found)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "a", "b")], pa.array(sizes, pa.int64()), pa.array(whole), lists],
                ["doc_id", "a", "b", "n_words", "whole", "anchors"],
            )

    return texts.mapInArrow(run, "doc_id long, a long, b long, n_words long, whole string, anchors array<long>")


def _edges(held: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 64):
            for row, copies, wanted, data in zip(
                batch.column("row").to_pylist(), batch.column("copies").to_pylist(),
                batch.column("wanted"), texts_of(batch, "text"),
            ):
                words = word_hashes(data.split())
                least, _ = anchors(words, window)
                wanted = wanted.values.to_numpy(zero_copy_only=False).view(np.uint64)
                place = np.flatnonzero(np.isin(least, wanted))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(place), row)), pa.array(place.astype(np.int32)),
                    pa.array(np.full(len(place), copies)),
                    pa.array(run_hashes(words, window, FACTORS[0])[place].view(np.int64)),
                    pa.array((run_hashes(words, window, FACTORS[1])[place] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                ], ["row", "place", "copies", "edge", "proof"])

    return held.mapInArrow(run, "row long, place int, copies long, edge long, proof int")


class RepeatGraph:
    """The saved tables of one corpus.

    documents: doc_id, a, b, n_words, whole (digest of all words), one row per document;
    held: row, a, b, copies, text of the texts that may hold a repeat, each text once;
    spans: row, start, windows, path: compacted paths at their source coordinates.
    """

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW):
        self.window = window
        texts = _texts(docs, doc_id, text)
        self.documents = saved(_anchored(texts, window), "anchors")
        one = saved(
            self.documents.filter(F.col("n_words") >= window).groupBy("a", "b")
            .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first")), "texts",
        )
        self.held = self._held(texts, one)
        occurrences = saved(_edges(self.held, window), "edges")
        # what is counted is written before it is joined: both sides are bare exchanges then, which AQE splits
        repeated = saved(occurrences.groupBy("edge", "proof").agg(F.sum("copies").alias("n")).filter("n > 1").drop("n"), "repeated")
        hits = occurrences.join(repeated, ["edge", "proof"])
        runs = saved(
            hits.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("place", "edge"))).alias("run")), "runs"
        )
        dropped(occurrences)
        dropped(repeated)
        self.spans = saved(self._compacted(runs), "spans")
        dropped(runs)

    def _held(self, texts: DataFrame, one: DataFrame) -> DataFrame:
        first = F.expr("a = _a AND b = _b AND doc_id <=> first")
        key = one.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "first", "copies")
        mine = self.documents.join(key, first).select("a", "b", "copies", F.explode("anchors").alias("anchor"))
        again = saved(mine.groupBy("anchor").agg(F.sum("copies").alias("n")).filter("n > 1").drop("n"), "again")
        wanted = mine.join(again, "anchor").groupBy("a", "b", "copies").agg(F.collect_set("anchor").alias("wanted"))
        wanted = wanted.withColumnsRenamed({"a": "_a", "b": "_b"}).join(key.drop("copies"), ["_a", "_b"])
        held = texts.join(wanted, first).select("a", "b", "copies", "wanted", "text")
        held = saved(held.withColumn("row", F.monotonically_increasing_id()), "held")
        dropped(again)
        return held

    def _compacted(self, runs: DataFrame) -> DataFrame:
        """Runs of repeated edges cut where the graph branches.

        An edge whose followers differ ends its path; an edge whose predecessors differ starts
        one. Followers and predecessors are compared by aggregation over all places of an edge,
        and the cuts go back to the runs by joins, so a path that a third of all texts hold is
        combined in every task. A path is named by its first edge and length.
        """
        run, at = F.col("run"), F.posexplode("run").alias("i", "e")
        steps = runs.select("row", run, at).select(
            "row", F.col("e.place").alias("place"), F.col("e.edge").alias("edge"),
            F.get(run, F.col("i") + 1).alias("after"),
        )
        pairs = steps.filter(F.col("after.place") == F.col("place") + 1).select("edge", F.col("after.edge").alias("follower"))
        ends = pairs.groupBy("edge").agg(F.min("follower").alias("l"), F.max("follower").alias("h")).filter("l <> h").select("edge")
        starts = pairs.groupBy(F.col("follower").alias("edge")).agg(F.min("edge").alias("l"), F.max("edge").alias("h")).filter("l <> h").select("edge")
        places = steps.select("row", "place", "edge")
        cuts = places.join(ends, "edge").select("row", (F.col("place") + 1).alias("cut")).unionByName(
            places.join(starts, "edge").select("row", F.col("place").alias("cut")))
        cut = cuts.groupBy("row").agg(F.collect_set("cut").alias("cuts"))

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    run = batch.column("run")[i].values
                    place = run.field("place").to_numpy()
                    edge = run.field("edge").to_numpy()
                    cuts = batch.column("cuts")[i].values
                    fresh = np.r_[True, place[1:] != place[:-1] + 1]
                    if cuts is not None:
                        fresh |= np.isin(place, cuts.to_numpy())
                    first = np.flatnonzero(fresh)
                    size = np.diff(np.r_[first, len(place)])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(first), batch.column("row")[i].as_py())),
                        pa.array(place[first].astype(np.int64)), pa.array(size.astype(np.int64)), pa.array(edge[first]),
                    ], ["row", "start", "windows", "path"])

        return runs.join(cut, "row", "left").mapInArrow(split, "row long, start long, windows long, path long")

    def paths(self) -> DataFrame:
        """path, windows, n_words, n_places and n_copies of every compacted path."""
        copies = self.spans.join(self.held.select("row", "copies"), "row")
        return copies.groupBy("path", "windows").agg(
            (F.first("windows") + self.window - 1).alias("n_words"), F.count(F.lit(1)).alias("n_places"),
            F.sum("copies").alias("n_copies"),
        )

    def without_repeats(self) -> DataFrame:
        """doc_id, n_words, n_removed and kept_sha256 for every document row.

        Every word inside a span goes, the first place of a passage included.
        """
        window = self.window

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in parts(batches, 64):
                gone, marks = [], []
                for data, spans in zip(texts_of(batch, "text"), batch.column("spans").to_pylist()):
                    words = data.split()
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    for s in spans:
                        change[s["start"]] += 1
                        change[s["start"] + s["windows"] + window - 1] -= 1
                    kept = np.cumsum(change[:-1]) == 0
                    gone.append(len(words) - int(kept.sum()))
                    marks.append(hashlib.sha256(b" ".join(w for w, k in zip(words, kept.tolist()) if k)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a"), batch.column("b"), pa.array(gone, pa.int64()), pa.array(marks, pa.string())],
                    ["a", "b", "n_removed", "mark"],
                )

        spans = self.spans.groupBy("row").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
        changed = self.held.select("row", "a", "b", "text").join(spans, "row").drop("row")
        changed = changed.mapInArrow(cut, "a long, b long, n_removed long, mark string").dropDuplicates(["a", "b"])
        return self.documents.drop("anchors").join(changed, ["a", "b"], "left").select(
            "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
            F.coalesce("mark", "whole").alias("kept_sha256"),
        )


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document row what is left of it without repeated windows; see ``RepeatGraph``.

    Null and empty texts have no words; texts shorter than a window keep all. Equal rows count as
    two texts, so all their windows are repeated. Null ids are kept.
    """
    return RepeatGraph(docs, doc_id, text, window).without_repeats()
