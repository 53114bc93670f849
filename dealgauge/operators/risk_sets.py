"""Derivatives of the Cox partial likelihood by a distributed scan of risk sets.

Rows are weighted by exp(x'b). Three written or collected steps give one Newton step:

1. *Moments per day*: sums of weights and of weighted columns per (day, column), all rows and those with an event. A row
   adds its few columns that are not 0, so a category of any size costs one entry per row.
2. *Scan*: days are cut into slices of consecutive days. The totals of all later slices (one row per slice and column) are
   where a slice starts; inside it, days are added from the last to the first, which makes the risk set of each day. The
   scan sums the Efron terms and the products of first moments, and gives each day its sum of 1 / risk.
3. *Pairs*: the second moments do not need a matrix per day: a row counts in the risk sets of all days up to its own, so its
   pairs of columns are summed once, with the running total of 1 / risk at its day.

What reaches the driver is the sum over all slices and tasks: one number per pair of columns, whatever the days and rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealgauge.sources.stages import measured

#: Days of a slice, and days and deaths that the scan takes at a time.
SLICE_DAYS = 4096
SCAN_DAYS = 512
SCAN_DEATHS = 1 << 20
DAY, EVENT, ROWS, SLICE = "duration_days", "event_converted", "n", "slice"
SCANNED = "slice int, day double, a int, b int, value double, inverse double, inverse_part double, hazard double"


def sliced(rows: DataFrame) -> DataFrame:
    """Rows with the slice of their day; slices are ranges of consecutive days, none of which is cut."""
    days = rows.select(DAY).distinct()
    slices = -(-days.count() // SLICE_DAYS)
    if slices <= 1:
        return rows.withColumn(SLICE, F.lit(0))
    placed = measured(days.repartitionByRange(slices, DAY).withColumn(SLICE, F.spark_partition_id()))
    return rows.join(placed, DAY)


def tie_sums(total: np.ndarray, dying: np.ndarray, deaths: np.ndarray) -> np.ndarray:
    """For each day, sums over its Efron steps l of log r, 1/r, f/r, 1/r^2, f/r^2, f^2/r^2 with f = l / deaths and
    r = total - f * dying. Step by step at every number of deaths, a bounded number of steps at a time."""
    out = np.zeros((6, len(deaths)))
    upto = np.cumsum(deaths)
    for start in range(0, int(upto[-1]) if len(upto) else 0, SCAN_DEATHS):
        step = np.arange(start, min(start + SCAN_DEATHS, int(upto[-1])))
        day = np.searchsorted(upto, step, "right")
        part = (step - (upto[day] - deaths[day])) / deaths[day]
        risk = total[day] - part * dying[day]
        for k, term in enumerate((np.log(risk), 1 / risk, part / risk, risk**-2, part * risk**-2, part**2 * risk**-2)):
            out[k] += np.bincount(day, term, len(deaths))
    return out


def _design(batch: pa.RecordBatch, factors: int, numbers: int) -> tuple[np.ndarray, np.ndarray]:
    """Column of each factor (-1: none), and the numbers, of a batch of prepared rows."""
    code = [batch.column(f"f{k}").to_numpy() for k in range(factors)]
    x = [batch.column(f"x{k}").to_numpy() for k in range(numbers)]
    size = batch.num_rows
    return (np.stack(code) if code else np.zeros((0, size), int)), (np.stack(x) if x else np.zeros((0, size)))


def _weights(code: np.ndarray, x: np.ndarray, n: np.ndarray, beta: np.ndarray, centre: float) -> np.ndarray:
    reach = np.append(beta, 0.0)
    eta = reach[code].sum(0) + beta[: len(x)] @ x - centre
    return n * np.exp(eta)


def _moments(batches: Iterator[pa.RecordBatch], beta: np.ndarray, centre: float, factors: int, numbers: int) -> Iterator[pa.RecordBatch]:
    """Rows (slice, day, column, all, events, deaths); the column behind the last stands for 1."""
    p = len(beta)
    for batch in batches:
        if not batch.num_rows:
            continue
        code, x = _design(batch, factors, numbers)
        n, event = batch.column(ROWS).to_numpy(), batch.column(EVENT).to_numpy()
        w = _weights(code, x, n, beta, centre)
        size = batch.num_rows
        column = np.concatenate([code, np.repeat(np.arange(numbers)[:, None], size, 1), np.full((1, size), p)]).ravel()
        value = np.concatenate([np.broadcast_to(w, code.shape), w * x, w[None]]).ravel()
        copies = len(column) // size
        days, day = np.unique(batch.column(DAY).to_numpy(), return_inverse=True)
        slices = np.zeros(len(days), np.int32)
        slices[day] = batch.column(SLICE).to_numpy()
        key = np.tile(day, copies) * (p + 1) + column
        kept = column >= 0
        met, place = np.unique(key[kept], return_inverse=True)
        died = np.tile(event, copies)[kept] == 1
        alone = np.where(column == p, np.tile(n * event, copies), 0)[kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array(slices[met // (p + 1)]), pa.array(days[met // (p + 1)]), pa.array((met % (p + 1)).astype(np.int32)),
             pa.array(np.bincount(place, value[kept], len(met))), pa.array(np.bincount(place, value[kept] * died, len(met))),
             pa.array(np.bincount(place, alone, len(met)))], names=["slice", "day", "col", "value", "dying", "deaths"])


class _Slice:
    """The scan of one slice, from its last day to its first."""

    def __init__(self, number: int, p: int):
        self.number, self.p = number, p
        self.risk = np.zeros(p + 1)
        self.cross = np.zeros((p, p))
        self.logs = 0.0

    def days(self, day: np.ndarray, value: np.ndarray, dying: np.ndarray, deaths: np.ndarray) -> pa.RecordBatch:
        """Later days first; value and dying have a row per day and p + 1 columns."""
        risk = np.cumsum(value, 0) + self.risk
        self.risk = risk[-1].copy()
        inverse, part, hazard = np.zeros(len(day)), np.zeros(len(day)), np.zeros(len(day))
        at = np.flatnonzero(deaths > 0)
        if len(at):
            d = np.rint(deaths[at]).astype(np.int64)
            logs, inv, inv_part, square, mixed, both = tie_sums(risk[at, -1], dying[at, -1], d)
            self.logs += logs.sum()
            inverse[at], part[at], hazard[at] = inv, inv_part, d / risk[at, -1]
            r1, d1 = risk[at, :-1], dying[at, :-1]
            half = (mixed[:, None] * r1).T @ d1
            self.cross += (square[:, None] * r1).T @ r1 - half - half.T + (both[:, None] * d1).T @ d1
        return _rows(self.number, day=day, inverse=inverse, inverse_part=part, hazard=hazard)

    def sums(self) -> pa.RecordBatch:
        a, b = np.triu_indices(self.p)
        return _rows(self.number, a=np.append(a, self.p), b=np.append(b, self.p), value=np.append(self.cross[a, b], self.logs))


def _rows(number: int, **columns: np.ndarray) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    kinds = {"slice": pa.int32(), "day": pa.float64(), "a": pa.int32(), "b": pa.int32()}
    columns = {"slice": np.full(size, number)} | columns
    names = [c.strip().split(" ")[0] for c in SCANNED.split(",")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], kinds.get(c, pa.float64())) if c in columns else pa.nulls(size, kinds.get(c, pa.float64())) for c in names],
        names=names)


def _scan(batches: Iterator[pa.RecordBatch], p: int) -> Iterator[pa.RecordBatch]:
    """Sorted by slice, then starts, then days from the last on; a day's rows may go on in the next batch."""
    open_slice: _Slice | None = None
    held: list[tuple[np.ndarray, ...]] = []

    def flush(all_days: bool) -> Iterator[pa.RecordBatch]:
        """Whole days of what is held; the last day only if nothing of it can follow."""
        nonlocal held
        if not held:
            return
        day, col, value, dying, deaths = (np.concatenate(c) for c in zip(*held))
        cut = len(day) if all_days else int(np.flatnonzero(day == day[-1])[0])
        held = [] if cut == len(day) else [(day[cut:], col[cut:], value[cut:], dying[cut:], deaths[cut:])]
        first = np.flatnonzero(np.concatenate([[True], day[1:cut] != day[:cut - 1]])) if cut else np.zeros(0, int)
        for at in range(0, len(first), SCAN_DAYS):
            low = first[at]
            high = first[at + SCAN_DAYS] if at + SCAN_DAYS < len(first) else cut
            starts = first[at:at + SCAN_DAYS]
            place = np.searchsorted(starts, np.arange(low, high), "right") - 1
            dense = np.zeros((3, len(starts), p + 1))
            for k, c in enumerate((value, dying, deaths)):
                dense[k, place, col[low:high]] = c[low:high]
            yield open_slice.days(day[starts], dense[0], dense[1], dense[2, :, -1])

    for batch in batches:
        if not batch.num_rows:
            continue
        number, is_start, day, col, value, dying, deaths = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(7))
        edges = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
        for low, high in zip(edges, [*edges[1:], len(number)]):
            if open_slice is None or open_slice.number != number[low]:
                if open_slice is not None:
                    yield from flush(True)
                    yield open_slice.sums()
                open_slice = _Slice(int(number[low]), p)
            given = is_start[low:high]
            open_slice.risk[col[low:high][given]] += value[low:high][given]
            held.append(tuple(c[low:high][~given] for c in (day, col, value, dying, deaths)))
        if sum(len(h[0]) for h in held) > SCAN_DAYS * (p + 1):
            held = [h for h in held if len(h[0])]
            yield from flush(False)
    if open_slice is not None:
        held = [h for h in held if len(h[0])]
        yield from flush(True)
        yield open_slice.sums()


def _pairs(batches: Iterator[pa.RecordBatch], beta: np.ndarray, centre: float, factors: int, numbers: int) -> Iterator[pa.RecordBatch]:
    """Sums of weight * share over the rows of a task, per pair of columns; column p stands for 1."""
    p = len(beta)
    sums = np.zeros((p + 1) * (p + 1))
    for batch in batches:
        if not batch.num_rows:
            continue
        code, x = _design(batch, factors, numbers)
        event = batch.column(EVENT).to_numpy()
        w = _weights(code, x, batch.column(ROWS).to_numpy(), beta, centre)
        w = w * (batch.column("running").to_numpy() - event * batch.column("inverse_part").to_numpy())
        columns = [(c, np.ones(len(c))) for c in code] + [(np.full(len(w), k), v) for k, v in enumerate(x)] + [(np.full(len(w), p), np.ones(len(w)))]
        for i, (a, u) in enumerate(columns):
            for b, v in columns[i:]:
                kept = (a >= 0) & (b >= 0)
                low, high = np.minimum(a, b)[kept], np.maximum(a, b)[kept]
                sums += np.bincount(low * (p + 1) + high, (w * u * v)[kept], len(sums))
    at = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays(
        [pa.array((at // (p + 1)).astype(np.int32)), pa.array((at % (p + 1)).astype(np.int32)), pa.array(sums[at])], names=["a", "b", "value"])


def scan_risk_sets(prepared: DataFrame, beta: np.ndarray, centre: float, factors: int, numbers: int) -> DataFrame:
    """The written scan: rows of days (inverse, inverse_part, hazard) and rows of sums (a, b, value) per slice.

    ``prepared``: slice, day, event, n, f0.. (column of each factor, -1 for none) and x0.. (numbers, the first columns)."""
    p = len(beta)
    moments = measured(
        prepared.mapInArrow(
            partial(_moments, beta=beta, centre=centre, factors=factors, numbers=numbers),
            "slice int, day double, col int, value double, dying double, deaths double")
        .groupBy("slice", "day", "col").agg(*[F.sum(c).alias(c) for c in ("value", "dying", "deaths")]))
    later = Window.partitionBy("col").orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    # a column that no row of a slice has still has its risk set from later slices
    grid = moments.select("slice").distinct().withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(p))))
    totals = moments.groupBy("slice", "col").agg(F.sum("value").alias("total"))
    starts = grid.join(totals, ["slice", "col"], "left").select(
        "slice", F.lit(True).alias("is_start"), F.lit(0.0).alias("day"), "col",
        F.coalesce(F.sum("total").over(later), F.lit(0.0)).alias("value"), F.lit(0.0).alias("dying"), F.lit(0.0).alias("deaths"))
    both = moments.select("slice", F.lit(False).alias("is_start"), "day", "col", "value", "dying", "deaths").unionByName(starts)
    ordered = both.repartition("slice").sortWithinPartitions("slice", F.desc("is_start"), F.desc("day"))
    return measured(ordered.mapInArrow(partial(_scan, p=p), SCANNED))


def running_by_day(scanned: DataFrame, column: str) -> DataFrame:
    """slice, day, inverse_part, and ``running``: the total of ``column`` over all days up to this one."""
    days = scanned.filter("day is not null")
    inside = Window.partitionBy("slice").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    starts = days.groupBy("slice").agg(F.sum(column).alias("total")).select(
        "slice", F.coalesce(F.sum("total").over(earlier), F.lit(0.0)).alias("start"))
    # written, so that a join with the rows broadcasts the days or nothing, never the rows
    return measured(days.select("slice", "day", "inverse_part", F.sum(column).over(inside).alias("inside")).join(starts, "slice").select(
        "slice", F.col("day").alias(DAY), "inverse_part", (F.col("inside") + F.col("start")).alias("running")))


def second_sums(prepared: DataFrame, scanned: DataFrame, beta: np.ndarray, centre: float, factors: int, numbers: int) -> DataFrame:
    """One row per pair of columns: (a, b, second, cross); b = p is the first moment, a = b = p has the sum of logs."""
    by_row = prepared.join(running_by_day(scanned, "inverse"), [SLICE, DAY]).mapInArrow(
        partial(_pairs, beta=beta, centre=centre, factors=factors, numbers=numbers), "a int, b int, value double")
    zero = F.lit(0.0)
    both = by_row.select("a", "b", F.col("value").alias("second"), zero.alias("cross")).unionByName(
        scanned.filter("day is null").select("a", "b", zero.alias("second"), F.col("value").alias("cross")))
    return both.groupBy("a", "b").agg(F.sum("second").alias("second"), F.sum("cross").alias("cross"))


def derivatives(pairs: pa.Table, event_sum: np.ndarray, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log partial likelihood, gradient and Hessian from the sums over pairs of columns."""
    p = len(beta)
    second, cross = np.zeros((p + 1, p + 1)), np.zeros((p + 1, p + 1))
    a, b = pairs.column("a").to_numpy(), pairs.column("b").to_numpy()
    second[a, b], cross[a, b] = pairs.column("second").to_numpy(), pairs.column("cross").to_numpy()
    hessian = np.triu(cross[:p, :p] - second[:p, :p])
    hessian = hessian + np.triu(hessian, 1).T
    return float(event_sum @ beta - cross[p, p]), event_sum - second[:p, p], hessian


# The tasks' functions travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
