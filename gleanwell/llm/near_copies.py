"""Near copies by the exact Jaccard similarity of word shingles, proposed by SimHash and a prefix filter.

Fingerprints of the shingles, looked up by multi-index hashing as in ``simhash``, propose texts that
are nearly the same. They cannot propose all: at a similarity of 0.8 one bit in seven differs. The
others come from a prefix filter. The shingles of all texts have one order, rare ones first; two texts
that are similar enough share a shingle among the first few of each (the prefix), so an equi-join on
those finds every pair, whatever the order is: it only sets how many are checked. Rarity is read from
counts per hash cell, so the order needs no table of shingles.

A pair is checked on parity bits first: every shingle flips one bit of its text's bits, so texts differ
in at least as many shingles as bits. That refuses most pairs for some bytes a text and no similar one.
What passes is checked on the texts.

What counts is which texts are connected. Proposals of SimHash come first. Then, in turns, each text is
checked against one drawn text per shingle that it shares, if that is not connected to it yet; so a large
group is joined in a few turns without its pairs. When a turn hardly links any, all pairs are met that
are still not connected; which turn is the last makes no difference to the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwell.llm import simhash
from gleanwell.llm.common import dropped, parts, saved, text_key, texts_of
from gleanwell.llm.graph import contracted, smallest_reachable

SHINGLE = 5
SIMILAR = (4, 5)  # Jaccard similarity from which texts are linked, as a fraction
CELLS = 1 << 22  # counts that tell rare shingles from frequent ones
SLICES = 64
PAYS = 1000  # a further turn is taken if one linked more than one text in so many,
FEW = 100  # and more than these
SEED = 42


def runs_of(text: bytes, size: int = SHINGLE) -> set[bytes]:
    """The different runs of so many lower-case words; a shorter text is one run."""
    words = text.lower().split()
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def shingle_hashes(text: bytes) -> np.ndarray:
    """The XXH64 values of the runs, sorted."""
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, runs_of(text), repeat(SEED)), dtype="<u8"))


def similar(a: bytes, b: bytes) -> bool:
    left, right = runs_of(a), runs_of(b)
    both = len(left & right)
    return both * SIMILAR[1] >= SIMILAR[0] * (len(left) + len(right) - both)


def set_keys(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per document: doc_id, text_key and a 128-bit digest of its set of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            keys = [xxhash.xxh3_128_digest(shingle_hashes(t).tobytes()) for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(keys, pa.binary())],
                ["doc_id", "text_key", "set_key"],
            )

    slim = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"),
    )
    return slim.mapInArrow(run, "doc_id long, text_key long, set_key binary")


def cell_counts(texts: DataFrame) -> np.ndarray:
    """How many texts hold a shingle of each cell; every task counts all cells, slices of them are summed.

    Tasks pass on the cells that they met. The sums, ``CELLS`` numbers whatever the input, go to the driver.
    """
    width, schema = CELLS // SLICES, "slice int, cells binary, counts binary"

    def rows(slices: dict[int, np.ndarray]) -> pa.RecordBatch:
        met = {i: np.flatnonzero(c) for i, c in slices.items()}
        return pa.RecordBatch.from_arrays([
            pa.array(list(met), pa.int32()), pa.array([m.astype("<u4").tobytes() for m in met.values()], pa.binary()),
            pa.array([slices[i][m].astype("<u4").tobytes() for i, m in met.items()], pa.binary()),
        ], ["slice", "cells", "counts"])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, dtype=np.int64)
        for batch in parts(batches):
            found = [shingle_hashes(t) for t in texts_of(batch, "text")]
            np.add.at(cells, (np.concatenate(found) % CELLS).astype(np.int64), 1)
        yield rows({i: c for i in range(SLICES) if (c := cells[i * width : (i + 1) * width]).any()})

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, met, counts in zip(*(batch.column(c).to_pylist() for c in ("slice", "cells", "counts"))):
                held = sums.setdefault(i, np.zeros(width, dtype=np.int64))
                held[np.frombuffer(met, dtype="<u4")] += np.frombuffer(counts, dtype="<u4")
        yield rows(sums)

    cells = np.zeros(CELLS, dtype=np.uint32)
    for row in texts.select("text").mapInArrow(tally, schema).repartition(SLICES, "slice").mapInArrow(total, schema).collect():
        at = row["slice"] * width + np.frombuffer(row["cells"], dtype="<u4")
        cells[at] = np.frombuffer(row["counts"], dtype="<u4")
    return cells


def prefixes(texts: DataFrame) -> DataFrame:
    """The rows (shingle, node, n, k) of every text's prefix: its first shingles in the order of all.

    n is the size of the set, k the place in its order. A partner as large as allowed shares at
    least ``SIMILAR`` of the n shingles, so one of the first n - SIMILAR n + 1 is shared.
    """
    shared = texts.sparkSession.sparkContext.broadcast(cell_counts(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            held, sizes, firsts = [], [], []
            for t in texts_of(batch, "text"):
                hashes = shingle_hashes(t)
                n = len(hashes)
                first = n + SIMILAR[0] * -n // SIMILAR[1] + 1 if n else 0
                held.append(hashes[np.lexsort((hashes, shared.value[(hashes % CELLS).astype(np.int64)]))[:first]])
                sizes.append(n)
                firsts.append(min(first, n))
            nodes = np.array(batch.column("node").to_pylist(), dtype=np.int64)
            places = [np.arange(f) for f in firsts]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(held).astype("<u8").view(np.int64)), pa.array(np.repeat(nodes, firsts)),
                pa.array(np.repeat(np.array(sizes, dtype=np.int32), firsts)), pa.array(np.concatenate(places).astype(np.int32)),
            ], ["shingle", "node", "n", "k"])

    return texts.mapInArrow(run, "shingle long, node long, n int, k int")


def possible(n: Column, k: Column, m: Column, l: Column) -> Column:
    """Whether sets of n and m shingles can be similar if they share the k-th and the l-th and none before both.

    Of a pair that is similar, the first shared shingle passes; further ones need not.
    """
    part, whole = SIMILAR
    n, k, m, l = (c.cast("long") for c in (n, k, m, l))
    return (F.least(n - k, m - l) * (part + whole) >= (n + m) * part) & (F.least(n, m) * whole >= F.greatest(n, m) * part)


def parity_bits(hashes: np.ndarray) -> bytes:
    """One bit for about each shingle, set if an odd number of shingles falls on it."""
    width = 64
    while width < len(hashes):
        width *= 2
    odd = np.bincount((hashes % width).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing(x: bytes, y: bytes) -> int:
    """A lower bound of the number of shingles that only one of two texts has. The wider bits are folded."""
    a, b = (np.frombuffer(v, dtype=np.uint8) for v in ((x, y) if len(x) >= len(y) else (y, x)))
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def described(texts: DataFrame) -> DataFrame:
    """(node, n, fp, bits) of every text: number of shingles, their fingerprint and parity bits; saved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found = [shingle_hashes(t) for t in texts_of(batch, "text")]
            prints = np.array([simhash.majority(h) for h in found], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([len(h) for h in found], pa.int32()), pa.array(prints), pa.array(map(parity_bits, found), pa.binary())],
                ["node", "n", "fp", "bits"])

    return saved(texts.select("node", "text").mapInArrow(run, "node long, n int, fp long, bits binary"), "described")


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of the different pairs (a, b) whose sizes and parity bits let them be similar, saved.

    Similar texts of n and m shingles differ in at most (n + m) / 9 of them.
    """
    part, whole = SIMILAR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, x, y = (batch.column(c).to_pylist() for c in ("n", "m", "x", "y"))
            keep = [differing(x[i], y[i]) * (part + whole) <= (n[i] + m[i]) * (whole - part) for i in range(len(n))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = saved(pairs.filter("a <> b").distinct(), "pairs")
    both = pairs.join(nodes.select(F.col("node").alias("a"), "n", F.col("bits").alias("x")), "a")
    both = both.join(nodes.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("bits").alias("y")), "b")
    both = both.filter(F.least("n", "m").cast("long") * whole >= F.greatest("n", "m").cast("long") * part)
    passed = saved(both.select("a", "b", "n", "m", "x", "y").mapInArrow(run, "a long, b long"), "likely")
    dropped(pairs)
    return passed


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the different saved pairs (a, b) whose texts are similar, saved. The pairs are dropped."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    held = saved(texts.join(wanted, "node", "left_semi"), "held")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            keep = [similar(x, y) for x, y in zip(texts_of(batch, "x"), texts_of(batch, "y"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(held.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
    both = both.join(held.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    links = saved(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "links")
    dropped(held)
    dropped(pairs)
    return links


def ordered(a: Column | str, b: Column | str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def same_prints(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) that SimHash proposes: texts of one fingerprint, and of two that few bits tell apart."""
    prints = saved(nodes.groupBy("fp").agg(F.min("node").alias("first")), "prints")
    one = nodes.join(prints, "fp").select(*ordered("node", "first"))
    near = simhash.links(prints)
    near = near.join(prints.select(F.col("fp").alias("a"), F.col("first").alias("x")), "a")
    near = near.join(prints.select(F.col("fp").alias("b"), F.col("first").alias("y")), "b")
    return one.unionByName(near.select(*ordered("x", "y")))


def shared_prefixes(texts: DataFrame) -> DataFrame:
    """Prefix rows of shingles that several texts have in their prefix; saved.

    Counts are written before they are joined, so that both sides are bare exchanges and a frequent
    shingle is split. Prefixes are read off the texts twice; written down they would lie beside their exchange.
    """
    rows = prefixes(texts)
    several = saved(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").drop("texts"), "several")
    table = saved(rows.join(several, "shingle"), "shared")
    dropped(several)
    return table


def rooted(table: DataFrame, roots: DataFrame) -> DataFrame:
    """Adds each node's component under the links found so far; an unlinked node is its own. Saved."""
    return saved(table.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")


def joined(roots: DataFrame, more: DataFrame) -> DataFrame:
    """(node, root) of the components with further links (a, b); both saved tables are dropped."""
    merged = contracted(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    dropped(roots)
    dropped(more)
    return merged


def met_leads(placed: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b), a text and the one text that this turn draws for a shared shingle, of two components; and the draw.

    The first draw goes by the node, so that the shingles of a group mostly draw one text. Later draws go
    by the shingle too, so that a text left over meets many others in a turn. Pairs are no more than rows.
    """
    drawn = F.xxhash64("node", "shingle", F.lit(turn)) if turn else F.xxhash64("node")
    draw = F.min(F.struct(drawn.alias("draw"), "node", "root")).alias("lead")
    leads = placed.groupBy("shingle").agg(draw).select("shingle", F.col("lead.node").alias("lead"), F.col("lead.root").alias("_root"))
    leads = saved(leads, "leads")
    return placed.join(leads, "shingle").filter("root <> _root").select(*ordered("node", "lead")), leads


def links(texts: DataFrame) -> DataFrame:
    """Pairs (a, b) that connect exactly the texts that are connected by similar texts, one or so per text.

    texts: node and text, one row per different set of shingles.
    """
    nodes = described(texts)
    near = confirmed(likely(same_prints(nodes), nodes), texts)
    roots = contracted(near)
    dropped(near)
    table = shared_prefixes(texts)
    total = texts.count()
    for turn in count():
        placed = rooted(table, roots)
        pairs, leads = met_leads(placed, turn)
        passed = likely(pairs, nodes)
        dropped(leads)
        found = confirmed(passed, texts)
        paid = found.count() > max(FEW, total // PAYS)
        roots = joined(roots, found)
        dropped(placed)
        if not paid:
            break
    placed = rooted(table, roots)
    dropped(table)
    # the smaller set of a pair shares more of its own, so its prefix is shorter: n - 2s/(1+s) n + 1
    part, of = SIMILAR
    less = placed.filter(F.col("k").cast("long") * (part + of) <= F.col("n").cast("long") * (of - part))
    less = less.select("shingle", *[F.col(c).alias(f"_{c}") for c in ("node", "n", "k", "root")])
    rest = less.hint("merge").join(placed.hint("merge"), "shingle").filter(
        (F.struct("_n", "_node") < F.struct("n", "node")) & (F.col("_root") != F.col("root"))
        & possible(F.col("_n"), F.col("_k"), F.col("n"), F.col("k"))
    )
    more = confirmed(likely(rest.select(*ordered("_node", "node")), nodes), texts)
    dropped(placed)
    dropped(nodes)
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)


def keyed(rows: DataFrame) -> DataFrame:
    """Adds ``_at``, null for no row, for _id and _key. Joined and grouped by it, wide rows are exchanged once."""
    return rows.withColumn("_at", F.concat_ws(":", "_key", "_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents' own columns, for one row of each group of connected texts: that with the smallest id.

    Among rows of that id the one with the smallest text key stays, and one of equal rows. Null ids
    come last. Texts without words are one group. Only the keys of the rows that stay are written
    for the result; every other table is deleted before it is returned.
    """
    keys = saved(set_keys(docs, doc_id, text), "set-keys")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    firsts = keys.groupBy("set_key").agg(first.alias("s")).select(F.col("s.doc_id").alias("_id"), F.col("s.text_key").alias("_key"))
    firsts = saved(firsts.withColumn("_node", F.monotonically_increasing_id()), "firsts")
    own = [F.col(doc_id).cast("long").alias("_id"), text_key(text).alias("_key")]
    of = keyed(firsts).select("_at", F.col("_node").alias("node"))
    texts = keyed(docs.select(*own, F.col(text).alias("text"))).join(of, "_at").dropDuplicates(["_at", "node"])
    texts = saved(texts.select("node", "text"), "different")
    dropped(keys)
    found = saved(links(texts), "links")
    dropped(texts)
    linked = found.select(F.explode(F.array("a", "b")).alias("_node")).distinct()
    order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_key", "_node").alias("least")
    least = smallest_reachable(firsts.join(linked, "_node", "left_semi").select(F.col("_node").alias("node"), order), found, "node", "least")
    gone = least.filter(F.col("least._node") != F.col("node")).select(F.col("node").alias("_node"))
    stay = saved(keyed(firsts.join(gone, "_node", "left_anti")).select("_at"), "stay")
    dropped(firsts)
    dropped(found)
    return keyed(docs.select(F.struct("*").alias("_row"), *own)).join(stay, "_at", "left_semi").dropDuplicates(["_at"]).select("_row.*")
