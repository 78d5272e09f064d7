"""Boosted trees that grow leaf by leaf, over features in quantile bins.

A tree always splits the leaf of the largest gain next, until it has its leaves. One job serves all
leaves that may be split next: it counts gradients per (node, feature, bin) for the smaller child of
each, and the larger child is the rest of its parent. Nodes of few rows go to one task each, which
returns the splits below them. A tree so takes at most about as many jobs as it is deep, and what
reaches the driver has the size of the bins, not of the rows. Gradients and losses are
added as integers, so that neither partitions nor their order show in a model.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwell.session import materialized

# Settings of the models.
LEAVES, LEARNING_RATE, FEATURE_SHARE, PATIENCE = 31, 0.05, 0.9, 10
BINS, LEAST_ROWS, LEAST_HESSIAN = 255, 20, 1e-3

LOCAL_CELLS = 10_000_000  # nodes of at most so many features times rows are split to the end in one task each
LOCAL_ROWS: int | None = None  # the same as a number of rows
SCALE = float(2**24)  # units of a gradient, curvature or loss of 1
REFRESH = 10  # trees after which the rows are written again with their sums
ACCURACY = 10_000  # of the quantiles: their ranks are off by at most one row in this many
LOGISTIC, SQUARED = "logistic", "squared"


@dataclass
class Tree:
    """Nodes by number; node 0 is the root, a leaf has no feature (-1)."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [-1])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, at: int, threshold: float, gain: float) -> tuple[int, int]:
        pair = len(self.feature), len(self.feature) + 1
        for column, empty in ((self.feature, -1), (self.bin, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.value, 0.0), (self.gain, 0.0)):
            column.extend([empty, empty])
        self.feature[node], self.bin[node], self.threshold[node], self.gain[node] = feature, at, threshold, gain
        self.left[node], self.right[node] = pair
        return pair

    def nodes_of(self, columns: np.ndarray, cuts: Sequence[float]) -> np.ndarray:
        """The leaf of each row; ``cuts`` are the nodes' bins or thresholds, as the columns are."""
        at = np.zeros(len(columns), dtype=np.int64)
        for node, feature in enumerate(self.feature):  # children come after their parent
            if feature >= 0:
                here = at == node
                at[here] = np.where(columns[here, feature] <= cuts[node], self.left[node], self.right[node])
        return at


class LeafwiseModel:
    """The trees, with the calls of an ML model."""

    def __init__(self, columns: list[str], objective: str, start: float, trees: list[Tree]):
        self.columns, self.objective, self.start, self.trees = columns, objective, start, trees

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``score``, a chance for the logistic form, and ``prediction``: the class or the score."""
        start, trees, logistic = self.start, self.trees, self.objective == LOGISTIC

        @F.pandas_udf("double")
        def scored(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype="float64")
            rows = np.stack(x.to_numpy()).astype(np.float64)
            margin = np.full(len(rows), start)
            for tree in trees:
                margin += np.array(tree.value)[tree.nodes_of(rows, tree.threshold)]
            return pd.Series(1 / (1 + np.exp(-margin)) if logistic else margin)

        out = df.withColumn("score", scored(F.array(*[_filled(c) for c in self.columns])))
        return out.withColumn("prediction", (F.col("score") > 0.5).cast("double") if logistic else F.col("score"))

    def importance(self) -> np.ndarray:
        """Each column's share of all gain, or 0 where no tree has split."""
        gain = np.zeros(len(self.columns))
        for tree in self.trees:
            for feature, g in zip(tree.feature, tree.gain):
                if feature >= 0:
                    gain[feature] += g
        return gain / gain.sum() if gain.sum() else gain

    def splits(self) -> bool:
        return any(len(t.feature) > 1 for t in self.trees)

    def save(self, path: str, spark: SparkSession) -> None:
        rows = [(i, n, *parts) for i, t in enumerate(self.trees)
                for n, parts in enumerate(zip(t.feature, t.bin, t.threshold, t.left, t.right, t.value, t.gain))]
        schema = "tree int, node int, feature int, bin int, threshold double, left int, right int, value double, gain double"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        facts = [(self.columns, self.objective, self.start)]
        spark.createDataFrame(facts, "columns array<string>, objective string, start double").coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")

    @staticmethod
    def load(path: str, spark: SparkSession) -> LeafwiseModel:
        facts = spark.read.parquet(f"{path}/facts").first()
        trees: dict[int, list] = {}
        for r in spark.read.parquet(f"{path}/trees").orderBy("tree", "node").collect():  # rounds times nodes of a tree
            trees.setdefault(r["tree"], []).append(tuple(r)[2:])
        return LeafwiseModel(list(facts["columns"]), facts["objective"], facts["start"], [Tree(*map(list, zip(*t))) for t in trees.values()])


def _filled(column: str):
    value = F.col(f"`{column}`").cast("double")
    return F.when(F.isnan(value), 0.0).otherwise(F.coalesce(value, F.lit(0.0)))


def quantile_cuts(rows: DataFrame, columns: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Per column the different quantiles below the largest value: upper ends of all bins but the last."""
    at = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(_filled(c), at, ACCURACY).alias(f"q{i}") for i, c in enumerate(columns)],
                     *[F.max(_filled(c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return [np.array(sorted(v for v in set(found[f"q{i}"] or []) if v < found[f"m{i}"])) for i in range(len(columns))]


def _binned(data: DataFrame, columns: list[str], cuts: list[np.ndarray], label: str, held_out: str | None, start: float) -> DataFrame:
    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            bins = np.stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)], axis=1).astype(np.int16)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * bins.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(offsets, pa.array(bins.ravel())), batch.column("y"), batch.column("out"), pa.array(np.full(len(x), start))],
                ["bins", "y", "out", "margin"])

    out = F.coalesce(F.col(held_out), F.lit(False)) if held_out else F.lit(False)
    rows = data.filter(F.col(label).isNotNull()).select(F.array(*[_filled(c) for c in columns]).alias("x"), F.col(label).cast("double").alias("y"), out.alias("out"))
    return materialized(rows.mapInArrow(binned, "bins array<smallint>, y double, out boolean, margin double"))


def _batch(batch: pa.RecordBatch, trees: list[Tree]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    bins = batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    y, out, margin = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "out", "margin"))
    margin = margin.copy()
    for tree in trees:
        margin += np.array(tree.value)[tree.nodes_of(bins, tree.bin)]
    return bins, y, out.astype(bool), margin


def _gradients(objective: str, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second derivative and the loss, in whole units."""
    if objective == LOGISTIC:
        p = 1 / (1 + np.exp(-margin))
        parts = p - y, p * (1 - p), np.logaddexp(0, margin) - y * margin
    else:
        parts = margin - y, np.ones(len(y)), (margin - y) ** 2
    return tuple(np.round(v * SCALE).astype(np.int64) for v in parts)


def _added(rows: DataFrame, trees: list[Tree]) -> DataFrame:
    """The rows with their sums over these trees, written again."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                margin = _batch(batch, trees)[3]
                yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("y"), batch.column("out"), pa.array(margin)], ["bins", "y", "out", "margin"])

    return materialized(rows.mapInArrow(add, rows.schema))


def _counted(rows: DataFrame, objective: str, done: list[Tree], tree: Tree, nodes: list[int], features: np.ndarray, width: int) -> tuple[dict[int, np.ndarray], float | None]:
    """Per node the sums (feature, bin, [gradient, curvature, rows]); and the held-out rows' mean loss."""
    place = {n: i for i, n in enumerate(nodes)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(nodes) * len(features) * width
        sums, loss, out_rows = np.zeros((3, size), dtype=np.int64), 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, y, out, margin = _batch(batch, done)
            g, h, units = _gradients(objective, y, margin)
            loss, out_rows = loss + int(units[out].sum()), out_rows + int(out.sum())
            at = np.array([place.get(n, -1) for n in range(len(tree.feature))])[tree.nodes_of(bins, tree.bin)]
            used = np.flatnonzero((at >= 0) & ~out)
            for f, feature in enumerate(features):
                key = (at[used] * len(features) + f) * width + bins[used, feature]
                for i, weights in enumerate((g, h, None)):  # sums of a batch are exact as doubles
                    sums[i] += np.bincount(key, weights[used] if weights is not None else None, size).astype(np.int64)
        cells = np.flatnonzero(sums[2])
        parts = [np.append(cells, -1), *[np.append(s[cells], v) for s, v in zip(sums, (loss, 0, out_rows))]]
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int64)) for p in parts], ["cell", "g", "h", "n"])

    found = rows.mapInArrow(count, "cell long, g long, h long, n long").groupBy("cell").agg(F.sum("g"), F.sum("h"), F.sum("n"))
    all_ = np.zeros((len(nodes) * len(features) * width, 3), dtype=np.int64)
    loss = None
    for cell, *sums in found.collect():  # at most nodes times features times bins
        if cell < 0:
            loss = sums[0] / SCALE / sums[2] if sums[2] else None
        else:
            all_[cell] = sums
    shaped = all_.reshape(len(nodes), len(features), width, 3)
    return {n: shaped[i] for n, i in place.items()}, loss


@dataclass
class _Split:
    gain: float
    feature: int
    bin: int
    left: np.ndarray  # gradient, curvature, rows
    right: np.ndarray


def _best_split(sums: np.ndarray, features: np.ndarray, cuts: list[np.ndarray], least_rows: int) -> _Split | None:
    """The largest gain; of equal ones the first feature and bin."""
    whole = sums[0].sum(axis=0)
    left = sums.cumsum(axis=1)
    right = whole - left
    real = np.arange(sums.shape[1])[None, :] < np.array([len(cuts[f]) for f in features])[:, None]
    fits = real & (left[..., 2] >= least_rows) & (right[..., 2] >= least_rows)
    fits &= (left[..., 1] >= LEAST_HESSIAN * SCALE) & (right[..., 1] >= LEAST_HESSIAN * SCALE)
    if not fits.any():
        return None
    worth = lambda s: (s[..., 0] / SCALE) ** 2 / np.maximum(s[..., 1] / SCALE, 1e-300)
    gain = np.where(fits, worth(left) + worth(right) - worth(whole), -np.inf)
    f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return _Split(float(gain[f, b]), int(features[f]), int(b), left[f, b], right[f, b]) if gain[f, b] > 1e-10 else None


SPLITS = "node int, step int, at int, feature int, bin int, gain double, lg long, lh long, ln long, rg long, rh long, rn long"


def _finished(rows: DataFrame, objective: str, done: list[Tree], tree: Tree, nodes: list[int], features: np.ndarray, cuts: list[np.ndarray], leaves: int, least_rows: int) -> dict[int, list[tuple[int, _Split]]]:
    """For each of the nodes the splits at and below it, in the order of its own best-first growth.

    A split names its node by number: 0 the given one, then the two children of each split in turn.
    """
    width = max(len(c) for c in cuts) + 1

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, y, out, margin = _batch(batch, done)
            g, h, _ = _gradients(objective, y, margin)
            at = tree.nodes_of(bins, tree.bin)
            used = np.flatnonzero(np.isin(at, nodes) & ~out)
            kept = np.ascontiguousarray(bins[used][:, features])
            offsets = pa.array(np.arange(len(used) + 1, dtype=np.int32) * len(features))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[used].astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(kept.ravel())), pa.array(g[used]), pa.array(h[used])],
                ["node", "bins", "g", "h"])

    def grow(key: tuple, table: pa.Table) -> pa.Table:
        flat = table.column("bins").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        columns = list(np.ascontiguousarray(flat.reshape(table.num_rows, -1).T))
        g, h = (table.column(c).to_numpy() for c in ("g", "h"))

        def sums_of(part: np.ndarray) -> np.ndarray:
            out = np.empty((len(features), width, 3), dtype=np.int64)
            for i, weights in enumerate((g[part], h[part], None)):  # sums of a node are exact as doubles
                for f, column in enumerate(columns):
                    out[f, :, i] = np.bincount(column[part], weights, width)
            return out

        def best_of(part: np.ndarray, sums: np.ndarray) -> _Split | None:
            return _best_split(sums, features, cuts, least_rows) if len(part) >= 2 * least_rows else None

        column = {f: i for i, f in enumerate(features)}
        parts = [np.arange(table.num_rows)]
        sums = [sums_of(parts[0])]
        best, ends, rows = [best_of(parts[0], sums[0])], [0], []
        while len(ends) < leaves and any(best[n] for n in ends):
            at = min((n for n in ends if best[n]), key=lambda n: (-best[n].gain, n))
            s = best[at]
            rows.append((key[0].as_py(), len(rows), at, s.feature, s.bin, s.gain, *map(int, s.left), *map(int, s.right)))
            left = columns[column[s.feature]][parts[at]] <= s.bin
            pair = [parts[at][left], parts[at][~left]]
            small = int(len(pair[1]) < len(pair[0]))
            counted = sums_of(pair[small])
            both = [counted, sums[at] - counted][:: -1 if small else 1]
            ends.remove(at)
            sums[at] = None
            for part, total in zip(pair, both):
                ends.append(len(parts))
                parts.append(part)
                sums.append(total)
                best.append(best_of(part, total))
        names = [c.split()[0] for c in SPLITS.split(", ")]
        types = [{"int": pa.int32(), "double": pa.float64(), "long": pa.int64()}[c.split()[1]] for c in SPLITS.split(", ")]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    moved = rows.mapInArrow(dealt, "node int, bins array<smallint>, g long, h long")
    found: dict[int, list[tuple[int, _Split]]] = {n: [] for n in nodes}
    for r in moved.groupBy("node").applyInArrow(grow, SPLITS).orderBy("node", "step").collect():  # fewer than leaves a node
        found[r["node"]].append((r["at"], _Split(r["gain"], r["feature"], r["bin"], np.array(r[6:9]), np.array(r[9:12]))))
    return found


def _grown(rows: DataFrame, objective: str, done: list[Tree], root: np.ndarray, features: np.ndarray, cuts: list[np.ndarray], leaves: int, rate: float, least_rows: int) -> Tree:
    """One tree from the sums of its root, split by split, always at the leaf of the largest gain.

    ``drawn`` has the nodes whose children are laid out and counted, ahead of their turn; those that
    never come to their turn are left out of the tree in the end.
    """
    width = root.shape[1]
    local = LOCAL_CELLS // len(features) if LOCAL_ROWS is None else LOCAL_ROWS
    drawn, totals = Tree(), {0: root[0].sum(axis=0)}
    sums, best, split = {0: root}, {0: _best_split(root, features, cuts, least_rows)}, set()
    ends = [0]
    while len(ends) < leaves:
        open_ = sorted((n for n in ends if best[n]), key=lambda n: (-best[n].gain, n))[: leaves - len(ends)]
        if not open_:
            break
        node = open_[0]
        if drawn.feature[node] < 0:
            wanted, new = [], [n for n in open_ if drawn.feature[n] < 0]
            few = [n for n in new if totals[n][2] <= local]
            for n, below in (_finished(rows, objective, done, drawn, few, features, cuts, leaves, least_rows) if few else {}).items():
                inner = [n]
                for at, s in below:
                    pair = drawn.split(inner[at], s.feature, s.bin, float(cuts[s.feature][s.bin]), s.gain)
                    totals.update(zip(pair, (s.left, s.right)))
                    best.update({inner[at]: s, pair[0]: None, pair[1]: None})
                    inner.extend(pair)
            for n in (n for n in new if n not in few):
                s = best[n]
                pair = drawn.split(n, s.feature, s.bin, float(cuts[s.feature][s.bin]), s.gain)
                totals.update(zip(pair, (s.left, s.right)))
                small, large = pair if s.left[2] <= s.right[2] else pair[::-1]
                best.update({small: None, large: None})
                if len(ends) + 1 < leaves and totals[large][2] >= 2 * least_rows:
                    wanted.append((n, small, large))
            if wanted:
                sums.update(_counted(rows, objective, done, drawn, [w[1] for w in wanted], features, width)[0])
            for n, small, large in wanted:
                sums[large] = sums[n] - sums[small]
                best.update({c: _best_split(sums[c], features, cuts, least_rows) for c in (small, large)})
        split.add(node)
        ends.remove(node)
        ends.extend((drawn.left[node], drawn.right[node]))
    tree, names = Tree(), {0: 0}
    for n in range(len(drawn.feature)):
        if n in split:
            pair = tree.split(names[n], drawn.feature[n], drawn.bin[n], drawn.threshold[n], drawn.gain[n])
            names.update(zip((drawn.left[n], drawn.right[n]), pair))
        elif n in names:
            g, h, _ = totals[n]
            tree.value[names[n]] = float(-rate * (g / SCALE) / max(h / SCALE, 1e-300))
    return tree


def fit(
    data: DataFrame, columns: list[str], label: str, objective: str, held_out: str | None = None, rounds: int = 100,
    leaves: int = LEAVES, rate: float = LEARNING_RATE, feature_share: float = FEATURE_SHARE, patience: int = PATIENCE,
    least_rows: int = LEAST_ROWS, bins: int = BINS, seed: int = 42,
) -> LeafwiseModel:
    """Trees over the rows that are not held out; the held-out ones say when to stop.

    Training ends when the held-out loss has not fallen for ``patience`` trees, and the trees up to
    its least value stay; without held-out rows all stay. It also ends when nothing can be split. Rows
    without a label are left out, missing features are 0. Equal gains go to the first feature and bin.
    """
    rows = data.filter(F.col(label).isNotNull())
    train = rows.filter(~F.coalesce(F.col(held_out), F.lit(False))) if held_out else rows
    mean = train.agg(F.avg(F.col(label).cast("double"))).first()[0]
    if mean is None or not columns:
        return LeafwiseModel(columns, objective, _started(objective, mean or 0.0), [])
    cuts, start = quantile_cuts(train, columns, bins), _started(objective, mean)
    binned = _binned(data, columns, cuts, label, held_out, start)
    draw, width = np.random.default_rng(seed), max(len(c) for c in cuts) + 1
    trees: list[Tree] = []
    written, least, best = 0, np.inf, 0
    for step in range(rounds + 1):
        if len(trees) - written >= REFRESH:
            binned, written = _added(binned, trees[written:]), len(trees)
        features = np.sort(draw.choice(len(columns), max(1, int(len(columns) * feature_share + 0.5)), replace=False))
        found, loss = _counted(binned, objective, trees[written:], Tree(), [0], features, width)
        if step and loss is not None:
            if loss < least:
                least, best = loss, step
            elif step - best >= patience:
                break
        if step == rounds:
            break
        tree = _grown(binned, objective, trees[written:], found[0], features, cuts, leaves, rate, least_rows)
        if len(tree.feature) == 1:
            break
        trees.append(tree)
    return LeafwiseModel(columns, objective, start, trees[:best] if best else trees)


def _started(objective: str, mean: float) -> float:
    if objective != LOGISTIC:
        return float(mean)
    p = min(max(mean, 1e-15), 1 - 1e-15)
    return float(np.log(p / (1 - p)))
