"""Top-k, positions and quantiles that stay spread over the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanwell.session import materialized

SLICES = 64


def newest_first(seconds: str = "timestamp", tie: str = "Hash") -> list[Column]:
    return [F.col(seconds).desc_nulls_last(), F.col(tie).asc()]


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None
) -> DataFrame:
    """The first n rows of every group.

    Spark cuts each group in every task before the exchange, for n up to a setting of the session.
    Beyond that a group is cut in slices first, and only what is left of it meets.
    """
    name = rank or "_rank"
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        slices = df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(SLICES)))
        inner = Window.partitionBy(*group, "_part").orderBy(*order)
        df = slices.withColumn(name, F.row_number().over(inner)).filter(F.col(name) <= n).drop("_part", name)
    window = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def ranged(df: DataFrame, *order: Column) -> tuple[DataFrame, DataFrame]:
    """The rows dealt to ranges of ``order`` from sampled bounds, saved with their range's number
    (``_range``), and the count of rows (``_n``) per range. Equal leading values are split by
    the later ones, so no range gets more than its share."""
    dealt = materialized(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    return dealt, dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))


def top_k(df: DataFrame, score: str, tie: str, k: int | None) -> DataFrame:
    """The k rows with the highest score in order: NaN and null last, equal scores by ``tie``.

    ``k`` None keeps all rows. The k-th (score, tie) pair is looked up on those two columns in
    ranges of them, one range being ranked, and the wide rows are filtered against it and sorted;
    for any k the same way. ``tie`` must be unique. The input is read twice.
    """
    value = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    order = [value.desc_nulls_last(), F.col(tie).asc()]
    if k is None:
        return df.orderBy(*order)
    last = kth_pair(df.select(value.alias("_score"), F.col(tie).alias("_tie")), k)
    if last is None:
        return df.orderBy(*order).limit(k)
    number, key = F.lit(last["_score"]).cast("double"), F.lit(last["_tie"])
    above = (value > number) | (value.isNotNull() & number.isNull())
    return df.filter(F.coalesce(above, F.lit(False)) | (value.eqNullSafe(number) & (F.col(tie) <= key))).orderBy(*order)


def kth_pair(slim: DataFrame, k: int):
    """The k-th (score, tie) pair, or None when there are fewer rows. The driver gets one count
    per range and one row."""
    order = [F.col("_score").desc_nulls_last(), F.col("_tie").asc()]
    dealt, counts = ranged(slim, *order)
    before = 0
    for row in sorted(counts.collect()):
        if before + row["_n"] >= k > 0:
            inside = dealt.filter(F.col("_range") == row["_range"])
            return inside.orderBy(*order).offset(k - before - 1).limit(1).first()
        before += row["_n"]
    return None


def numbered_by_time(
    df: DataFrame, group: Sequence[str], moment: str, tie: str, slice_unit: str = "hour",
    name: str = "position",
) -> DataFrame:
    """Number the rows of each group by time, from 1, without sorting a whole group in one task.

    Rows are numbered inside (group, time slice) and shifted by the count of all earlier slices.
    """
    sliced = df.withColumn("_slice", F.date_trunc(slice_unit, F.col(moment)))
    keys = [*group, "_slice"]
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        sliced.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inner = Window.partitionBy(*keys).orderBy(moment, tie)
    return (
        sliced.withColumn("_pos", F.row_number().over(inner))
        .join(shifts, keys)
        .withColumn(name, F.col("_shift") + F.col("_pos"))
        .drop("_slice", "_shift", "_pos")
    )


def exact_quantiles(df: DataFrame, column: str, probabilities: dict[str, float]) -> DataFrame:
    """One row with linearly interpolated quantiles, nulls and NaN ignored; names are the keys.

    Different values are counted first, then ranked range by range from sampled bounds, so neither
    one frequent value nor one far value fills a task. The shifts between ranges are one row per
    range.
    """
    value = F.col("_v")
    counted = (
        df.select(F.col(column).cast("double").alias("_v"))
        .filter(value.isNotNull() & ~F.isnan(value))
        .groupBy("_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    sliced, _ = ranged(counted, value.asc())
    sliced = sliced.withColumnRenamed("_range", "_slice")
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sliced.groupBy("_slice").agg(F.sum("_n").alias("_m"))
    total = sums.agg(F.sum("_m")).scalar()
    shifts = sums.withColumn("_shift", F.coalesce(F.sum("_m").over(earlier), F.lit(0))).select("_slice", "_shift")
    upto = F.sum("_n").over(
        Window.partitionBy("_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = (
        sliced.join(shifts, "_slice")
        .withColumn("_end", F.col("_shift") + upto)
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumn("_total", total)
    )

    def at(position: Column) -> Column:
        inside = (F.col("_start") <= position) & (position < F.col("_end"))
        return F.max(F.when(inside, value))

    parts = []
    for name, p in probabilities.items():
        exact = (F.col("_total") - 1) * F.lit(p)
        below, above = at(F.floor(exact)), at(F.ceil(exact))
        weight = F.max(exact - F.floor(exact))
        parts.append((below + weight * (above - below)).alias(name))
    return ranked.agg(*parts)
