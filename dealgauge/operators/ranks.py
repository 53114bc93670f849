"""Global order without a single-task window: running totals, quantiles, percentage ranks."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealgauge.sources.stages import measured

# Up to this many rows one task sorts or one aggregation buffer holds the values.
SINGLE_TASK_ROWS = 1_000_000


def running_total(
    rows: DataFrame, order: Sequence[Column], measure: str, limit: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Adds ``running``: the sum of ``measure`` over all rows up to and including this one.

    The order must be unique over the rows. Beyond ``limit`` rows the data is range-partitioned
    into slices of about that size and written with its slice number; the totals of the slices
    (one row each) give every slice its starting value, and the window runs inside the slices only.
    """
    size = rows.count()
    if size <= limit:
        whole = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.withColumn("running", F.sum(measure).over(whole))
    slices = math.ceil(size / limit)
    sliced = measured(rows.repartitionByRange(slices, *order).withColumn("slice", F.spark_partition_id()))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = measured(
        sliced.groupBy("slice").agg(F.sum(measure).alias("slice_total"))
        .select("slice", F.coalesce(F.sum("slice_total").over(earlier), F.lit(0)).alias("slice_start"))
    )
    inside = Window.partitionBy("slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        sliced.withColumn("inside", F.sum(measure).over(inside))
        .join(starts, "slice")
        .withColumn("running", F.col("inside") + F.col("slice_start"))
        .drop("slice", "slice_start", "inside")
    )


def quantiles(
    rows: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = (), limit: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per name in ``probs``.

    Small inputs use ``percentile``. Its buffer holds every distinct value, so larger inputs are
    reduced to counts per value and the values at the wanted positions are found by running total.
    """
    known = rows.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("v"))
    if known.count() <= limit:
        return known.groupBy(*by).agg(*[F.percentile("v", p).alias(name) for name, p in probs.items()])
    counts = measured(known.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("n")))
    placed = running_total(counts, [F.col(c) for c in [*by, "v"]], "n", limit)
    first = F.col("running") - F.col("n")
    if by:
        spans = measured(placed.groupBy(*by).agg(F.min(first).alias("start"), F.sum("n").alias("total")))
        placed = placed.join(spans, [placed[c].eqNullSafe(spans[c]) for c in by]).drop(*[spans[c] for c in by])
    else:
        placed = placed.withColumn("start", F.lit(0)).withColumn("total", counts.agg(F.sum("n")).scalar())

    def at(index: Column) -> Column:
        index = index + F.col("start")
        return F.max(F.when((first <= index) & (index < F.col("running")), F.col("v")))

    parts, columns = [], []
    for name, p in probs.items():
        position = F.lit(float(p)) * (F.col("total") - 1)
        parts += [
            at(F.floor(position)).alias(f"{name}_low"),
            at(F.ceil(position)).alias(f"{name}_high"),
            F.max(position - F.floor(position)).alias(f"{name}_part"),
        ]
        low, high, part = (F.col(f"{name}_{end}") for end in ("low", "high", "part"))
        columns.append(F.when(low == high, low).otherwise((1 - part) * low + part * high).alias(name))
    return placed.groupBy(*by).agg(*parts).select(*by, *columns)


def percent_rank_average(rows: DataFrame, value: str, out: str, limit: int = SINGLE_TASK_ROWS) -> DataFrame:
    """Adds the rank as a part of all rows: ties share their average, nulls come last.

    With at most one distinct value every row gets 0.5. Ranks are found on counts per distinct
    value and joined back, so the rows themselves are never globally sorted.
    """
    counts = measured(rows.groupBy(F.col(value).alias("rank_value")).agg(F.count(F.lit(1)).alias("n")))
    placed = running_total(counts, [F.col("rank_value").asc_nulls_last()], "n", limit)
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("rank_value").alias("values")).alias("t"))
    total = totals.scalar()
    rank = (F.col("running") - F.col("n") + (F.col("n") + 1) / 2) / total["rows"]
    ranks = measured(placed.select("rank_value", F.when(total["values"] <= 1, 0.5).otherwise(rank).alias(out)))
    return rows.join(ranks, rows[value].eqNullSafe(ranks["rank_value"]), "left").drop("rank_value")
