"""Logistic regression by relational Newton steps, with its own preprocessing and persistence.

Numbers are filled with their exact median and standardised with the population deviation; categories get one 0/1 column
each. Equal rows are counted once and written. A Newton step is one aggregate: sums over pairs of columns of
weight * p * (1 - p), and over columns of weight * (y - p). A row adds only its columns that are not 0. One number
per pair of columns reaches the driver, which solves for the step. The intercept has no penalty.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealgauge.operators.ranks import quantiles
from dealgauge.sources.stages import measured

UNKNOWN = "Unknown"


class LogisticModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (of class 0 and 1) from the columns of the fit, as plain expressions."""

    fitted = Param(Params._dummy(), "fitted", "intercept, numbers and categories as JSON", TypeConverters.toString)

    def __init__(self, fitted: dict | None = None):
        super().__init__()
        if fitted is not None:
            self._set(fitted=json.dumps(fitted))

    def told(self) -> dict:
        return json.loads(self.getOrDefault(self.fitted))

    def positive(self) -> Column:
        told = self.told()
        terms = [F.lit(told["intercept"])]
        for x in told["numbers"]:
            filled = F.coalesce(F.col(f"`{x['name']}`").cast("double"), F.lit(x["fill"]))
            terms.append(F.lit(x["weight"]) * ((filled - F.lit(x["mean"])) / F.lit(x["sd"])))
        for c in told["categories"]:
            if c["weights"]:
                table = F.create_map(*[F.lit(part) for pair in c["weights"].items() for part in pair])
                known = F.coalesce(F.col(f"`{c['name']}`"), F.lit(UNKNOWN))
                terms.append(F.coalesce(F.element_at(table, known), F.lit(0.0)))
        return 1 / (1 + F.exp(-sum(terms[1:], terms[0])))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        positive = self.positive()
        return dataset.withColumn("probability", array_to_vector(F.array(1 - positive, positive)))

    def coefficients(self) -> list[tuple[str, float]]:
        told = self.told()
        return [
            ("intercept", told["intercept"]), *[(x["name"], x["weight"]) for x in told["numbers"]],
            *[(f"{c['name']}_{v}", w) for c in told["categories"] for v, w in c["weights"].items()]]


def _sums(batches: Iterator[pa.RecordBatch], beta: np.ndarray, factors: int, numbers: int) -> Iterator[pa.RecordBatch]:
    """(a, b, value) summed over a task: a <= b second derivatives; a = -1 the gradient; a = b = -1 the log-likelihood."""
    p = len(beta)
    second, gradient, likelihood = np.zeros(p * p), np.zeros(p), 0.0
    reach = np.append(beta, 0.0)
    for batch in batches:
        size = batch.num_rows
        if not size:
            continue
        y, w = (batch.column(c).to_numpy() for c in ("target", "weight"))
        columns = [(np.zeros(size, int), np.ones(size))]
        columns += [(np.full(size, k + 1), batch.column(f"x{k}").to_numpy()) for k in range(numbers)]
        columns += [(batch.column(f"f{k}").to_numpy(), np.ones(size)) for k in range(factors)]
        eta = sum(reach[a] * x for a, x in columns)
        positive = 1 / (1 + np.exp(-eta))
        # log(1 + e^eta) without overflow
        likelihood += float((w * (y * eta - np.logaddexp(0, eta))).sum())
        rest, bend = w * (y - positive), w * positive * (1 - positive)
        for i, (a, u) in enumerate(columns):
            gradient += np.bincount(a[a >= 0], (rest * u)[a >= 0], p)
            for b, v in columns[i:]:
                kept = (a >= 0) & (b >= 0)
                second += np.bincount((a * p + b)[kept], (bend * u * v)[kept], p * p)
    at = np.flatnonzero(second)
    yield pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([at // p, np.full(p + 1, -1)]).astype(np.int32)),
        pa.array(np.concatenate([at % p, np.arange(p), [-1]]).astype(np.int32)),
        pa.array(np.concatenate([second[at], gradient, [likelihood]]))], names=["a", "b", "value"])


def fit_logistic(
    rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, weight: Column | None = None,
    penalty: float = 1.0, tolerance: float = 1e-10, max_steps: int = 1000,
) -> LogisticModel:
    """Most likely coefficients less penalty / 2 times their squares. Rows without a target are left out."""
    rows = rows.filter(F.col(target).isNotNull())
    numbers = []
    for c in numeric:
        # a column without any value is 0 throughout
        fill = quantiles(rows, c, {"m": 0.5}).first()["m"]
        numbers.append({"name": c, "fill": 0.0 if fill is None else fill})
    filled = [F.coalesce(F.col(x["name"]).cast("double"), F.lit(x["fill"])) for x in numbers]
    known = [F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in categorical]
    told = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(filled)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(filled)],
        *[F.array_sort(F.collect_set(c)).alias(f"l{i}") for i, c in enumerate(known)]).first()
    if not told["n"]:
        raise ValueError("no rows to fit")
    for i, x in enumerate(numbers):
        x |= {"mean": told[f"m{i}"], "sd": told[f"s{i}"] or 1.0}
    levels = [list(told[f"l{i}"]) for i in range(len(categorical))]
    firsts = np.cumsum([1 + len(numbers), *map(len, levels)]).tolist()
    p = firsts[-1]
    prepared = rows.select(
        F.col(target).cast("double").alias("target"), (F.lit(1.0) if weight is None else weight.cast("double")).alias("weight"),
        *[((c - F.lit(x["mean"])) / F.lit(x["sd"])).alias(f"x{i}") for i, (c, x) in enumerate(zip(filled, numbers))],
        *[(F.array_position(F.array(*[F.lit(v) for v in vs]), c).cast("int") - 1 + firsts[i]).alias(f"f{i}")
          for i, (c, vs) in enumerate(zip(known, levels))])
    keys = [c for c in prepared.columns if c != "weight"]
    prepared = measured(prepared.groupBy(*keys).agg(F.sum("weight").alias("weight")))
    shrink = np.where(np.arange(p) == 0, 0.0, penalty)

    def evaluate(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        sums = prepared.mapInArrow(
            partial(_sums, beta=beta, factors=len(levels), numbers=len(numbers)), "a int, b int, value double"
        ).groupBy("a", "b").agg(F.sum("value").alias("value")).toArrow()
        a, b, v = (sums.column(c).to_numpy() for c in ("a", "b", "value"))
        second, gradient = np.zeros((p, p)), np.zeros(p)
        second[a[a >= 0], b[a >= 0]] = v[a >= 0]
        second = second + np.triu(second, 1).T + np.diag(shrink)
        gradient[b[(a < 0) & (b >= 0)]] = v[(a < 0) & (b >= 0)]
        return float(v[b < 0].sum() - (shrink * beta * beta).sum() / 2), gradient - shrink * beta, second

    beta = np.zeros(p)
    value, gradient, second = evaluate(beta)
    for _ in range(max_steps):
        # without a penalty the columns of a category may have one direction too many
        move = np.linalg.lstsq(second, gradient, rcond=None)[0]
        for _ in range(30):
            candidate, gradient, second = evaluate(beta + move)
            if candidate >= value - 1e-12 * abs(value):
                break
            move = move / 2
        beta, value = beta + move, candidate
        if np.abs(move).max() < tolerance:
            break
    weights = beta.tolist()
    return LogisticModel({
        "intercept": weights[0], "numbers": [x | {"weight": w} for x, w in zip(numbers, weights[1:])],
        "categories": [
            {"name": c, "weights": dict(zip(vs, weights[first:first + len(vs)]))} for c, vs, first in zip(categorical, levels, firsts)]})


def coefficient_table(model: LogisticModel, rows: DataFrame) -> DataFrame:
    return rows.sparkSession.createDataFrame([(n, float(w)) for n, w in model.coefficients()], "feature string, coefficient double")


# The tasks' functions travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
