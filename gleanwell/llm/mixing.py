"""Mixing sources to target sizes by entropy balancing.

Each document gets a rate of copies, tilted by its size: ``rate = cap / (1 + (cap - 1) exp(-t x))``
with x its size over the mean size and one t per source. At t = 0 every rate is 1; large sources
get t < 0, small ones t > 0, and no rate passes the cap. These rates are the least change, in
relative entropy with the cap as an upper bound, whose words meet each source's target. The dual
is convex with one unknown per source, and Newton's steps solve it over a table of (source, size,
number of documents), in which a hot source is no larger than its number of different sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanwell.llm.common import dropped, saved, word_list

WEIGHTS = (5, 2, 1)
CAP = 3
PIECE = 1024  # documents of one source and size that are ranked together
TOLERANCE = 1e-7
MAX_STEPS = 100


def text_size(text: Column | str) -> Column:
    return F.size(word_list(text)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """source, source_size, weight and target from (source, source_size).

    Sources in code point order, null last, take the weights in turn. Each gets its share of the
    total, at most ``cap`` times its size; what is cut off is shared among the others by weight,
    until no target is above. Only sums come to the driver. One row per source is numbered in one
    place; documents never are.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("weight", F.element_at(turn, (F.row_number().over(order) - 1) % len(weights) + 1))
    ranked = saved(ranked, "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    limit, level, last = F.col("source_size") * F.lit(float(cap)), 0.0, -1
    while True:
        full = limit < F.col("weight") * F.lit(level)
        row = ranked.agg(
            F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)
        ).first()
        if row[2] == last or not row[1]:
            break
        last, level = row[2], (total - (row[0] or 0.0)) / row[1]
    return ranked.withColumn("target", F.least(limit, F.col("weight") * F.lit(level)))


def tilted(cells: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """source and its tilt t, by Newton's steps in a bracket, all sources at once.

    ``cells`` has source, size and n. Sums are decimals, so that no order of addition shows and
    reruns agree. A source whose target is its cap gets the tilt null: every rate is the cap.
    Each step's table is saved; only the largest miss comes to the driver.
    """
    state = goals.select(
        "source", "target", "source_size", (F.col("source_size") / F.col("n_documents")).alias("mean"),
        F.lit(0.0).alias("t"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"),
        (F.col("target") >= F.col("source_size") * F.lit(cap * (1 - 1e-12))).alias("full"),
    )
    state = saved(state, "tilt")
    tilt = F.col("t") * F.col("size") / F.col("mean")
    exact = lambda c: F.sum(c.cast("decimal(38,9)")).cast("double")
    for _ in range(MAX_STEPS):
        open_ = state.filter(~F.col("full") & (F.col("source_size") > 0))
        rate = rate_of(tilt, cap)
        words = F.col("n") * F.col("size")
        slope = words * (F.col("size") / F.col("mean")) * rate * (1 - rate / F.lit(float(cap)))
        sums = (
            cells.join(open_.withColumnRenamed("source", "_s"), F.expr("source <=> _s"))
            .groupBy("source").agg(exact(words * rate).alias("got"), exact(slope).alias("slope"))
        )
        step = state.join(sums.withColumnRenamed("source", "_s"), F.expr("source <=> _s"), "left").drop("_s")
        miss = F.col("got") - F.col("target")
        done = F.col("got").isNull() | (F.abs(miss) <= F.col("target") * F.lit(TOLERANCE))
        low, high = F.when(miss < 0, F.col("t")).otherwise(F.col("low")), F.when(miss > 0, F.col("t")).otherwise(F.col("high"))
        newton = F.col("t") - miss / F.nullif("slope", F.lit(0.0))
        inside = (newton > low) & (newton < high)
        middle = (F.greatest(low, F.col("t") - 8) + F.least(high, F.col("t") + 8)) / 2
        moved = F.when(done, F.col("t")).when(inside & (F.abs(newton - F.col("t")) < 8), newton).otherwise(middle)
        step = saved(step.select(
            "source", "target", "source_size", "mean", moved.alias("t"),
            low.alias("low"), high.alias("high"), "full", done.alias("done"),
        ), "tilt")
        dropped(state)
        state = step
        if not state.filter("NOT done").limit(1).count():
            break
    return state.select("source", F.when(~F.col("full"), F.col("t")).alias("t"), "mean")


def rate_of(tilt: Column, cap: float) -> Column:
    """The rate for a tilt times a size; an empty tilt is the cap."""
    soft = F.lit(float(cap)) / (1 + F.lit(float(cap - 1)) * F.exp(-F.greatest(F.least(tilt, F.lit(700.0)), F.lit(-700.0))))
    return F.coalesce(soft, F.lit(float(cap)))


def row_draw(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id).cast("long"), F.col(text))


def copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, cap: int = CAP,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, rate, copies and taken.

    Rates become whole copies by systematic rounding: within a source, in the order of size, the
    fractions are added up and a document gets the extra copy where the sum passes a whole number.
    Sums are over (source, size, piece), a piece being at most about ``PIECE`` documents by hash of
    the id; in a piece the lowest hashes get the extra copies. What a source then misses, about
    one large document, is filled from its smallest ones. Null texts have size zero and, like all
    of that size, one copy. Equal rows get equal copies. Null sources are one source, the last.
    """
    rows = saved(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"),
        text_size(text).alias("size"), row_draw(doc_id, text).alias("draw"),
    ), "sizes")
    cells = saved(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    sources = cells.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("n_documents")
    )
    goals = saved(targets(sources, weights, cap), "targets")
    tilts = tilted(cells, goals, cap)
    known = goals.join(tilts.withColumnRenamed("source", "_s"), F.expr("source <=> _s")).drop("_s", "n_documents", "weight")
    rate = rate_of(F.col("t") * F.col("size") / F.col("mean"), cap)
    rated = saved(
        cells.withColumnRenamed("source", "_c").join(known, F.expr("_c <=> source")).drop("_c")
        .withColumn("rate", F.when(F.col("size") == 0, F.lit(1.0)).otherwise(rate))
        .withColumn("pieces", F.ceil(F.col("n") / F.lit(PIECE))).drop("t", "mean"), "rates",
    )
    r = rated.select(F.col("source").alias("_s"), F.col("size").alias("_z"), "source_size", "target", "rate", "pieces")
    placed = rows.join(r, F.expr("source <=> _s AND size = _z")).drop("_s", "_z").withColumn(
        "piece", F.pmod(F.col("draw"), F.col("pieces"))
    )
    part = F.col("rate") - F.floor("rate")
    before = Window.partitionBy("source").orderBy("size", "piece").rowsBetween(Window.unboundedPreceding, 0)
    mine = (F.col("m") * F.col("part")).cast("decimal(38,12)")
    half = F.lit("0.5").cast("decimal(2,1)")
    rounded = (
        placed.groupBy("source", "size", "piece")
        .agg(F.count(F.lit(1)).alias("m"), F.max(part).alias("part"), F.max(F.floor("rate")).alias("whole"), F.max("target").alias("target"))
        .withColumn("upto", F.sum(mine).over(before))
        .withColumn("extra", F.floor(F.col("upto") + half) - F.floor(F.col("upto") - mine + half))
    )
    extras = _filled(rounded, cap).select(
        F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("piece").alias("_p"), "whole", "extra"
    )
    inner = Window.partitionBy("source", "size", "piece").orderBy("draw", "doc_id")
    ranked = placed.withColumn("rank", F.rank().over(inner))
    done = ranked.join(extras, F.expr("source <=> _s AND size = _z AND piece = _p"))
    n = (F.col("whole") + F.when(F.col("rank") <= F.col("extra"), 1).otherwise(0)).cast("long")
    return done.select(
        "doc_id", "size", "source_size", "target", "rate", n.alias("copies"),
        (n * F.col("size")).alias("taken"), "draw",
    )


def _filled(rounded: DataFrame, cap: int) -> DataFrame:
    """The extra copies, with what a source is still off filled by its smallest documents.

    Words that are missing are added, and words too many taken back, from the smallest size
    upwards, as whole documents; what stays is less than the first size that no longer fits.
    """
    all_of = Window.partitionBy("source")
    earlier = all_of.orderBy("size", "piece").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.sum(F.col("size") * (F.col("m") * F.col("whole") + F.col("extra"))).over(all_of)
    off = rounded.withColumn("off", F.round("target").cast("long") - taken)
    more = F.when((F.col("size") > 0) & (F.col("whole") < cap), F.col("m") - F.col("extra")).otherwise(0)
    less = F.when(F.col("size") > 0, F.col("extra") + F.when(F.col("whole") > 0, F.col("m")).otherwise(0)).otherwise(0)
    free = off.withColumn("free", F.when(F.col("off") > 0, more).otherwise(less).cast("long"))
    used = F.coalesce(F.sum(F.col("free") * F.col("size")).over(earlier), F.lit(0))
    fits = F.floor((F.abs("off") - F.col("used")) / F.greatest("size", F.lit(1)))
    change = F.greatest(F.least(fits, F.col("free")), F.lit(0)) * F.signum("off").cast("long")
    changed = free.withColumn("used", used).withColumn("extra", F.col("extra").cast("long") + change)
    below = F.col("extra") < 0  # then all get a copy less, and the extra ones count from there
    return changed.select(
        "source", "size", "piece", (F.col("whole").cast("long") - below.cast("long")).alias("whole"),
        (F.col("extra") + F.when(below, F.col("m")).otherwise(0)).alias("extra"),
    )


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents' own columns, each row as often as the mix takes it."""
    taken = copies(docs, doc_id, text, **options).filter("copies > 0")
    taken = taken.select(F.col("doc_id").alias("_id"), F.col("draw").alias("_draw"), F.col("copies").cast("int").alias("_n")).distinct()
    keyed = docs.select(
        F.struct("*").alias("_row"), F.col(doc_id).cast("long").alias("_of"), row_draw(doc_id, text).alias("_key")
    )
    placed = keyed.join(taken, F.expr("_of <=> _id AND _key = _draw"))
    return placed.select("_row", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_i")).select("_row.*")
