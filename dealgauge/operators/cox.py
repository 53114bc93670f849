"""Cox proportional hazards with Efron ties and an L2 penalty on standardised columns.

Equal rows (columns, day, event) are counted once and written. Each Newton step sums derivatives over
risk sets in Spark (see ``risk_sets``); value, gradient and the matrix of second derivatives reach the
driver, whose size follows from the columns of the model, not from rows or days.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealgauge.operators import risk_sets
from dealgauge.operators.ranks import quantiles
from dealgauge.sources.stages import measured

NUMERIC = ["company_size", "total_activities", "received_campaign"]
CATEGORICAL = ["lead_source", "industry", "region"]
DAY, EVENT = risk_sets.DAY, risk_sets.EVENT

# The time grid of the median prediction.
GRID_FIRST, GRID_LAST, GRID_POINTS = 1.0, 6500.0, 500


@dataclass(frozen=True)
class CoxModel:
    numeric: list[str]
    levels: dict[str, list[str]]
    fill: dict[str, float]
    means: np.ndarray
    sds: np.ndarray
    beta: np.ndarray
    se: np.ndarray
    log_likelihood: float
    steps: int
    days: np.ndarray = field(repr=False)
    cumulative_hazard: np.ndarray = field(repr=False)

    @property
    def columns(self) -> list[str]:
        return [*self.numeric, *[f"{c}_{v}" for c, vs in self.levels.items() for v in vs]]

    def log_hazard(self) -> Column:
        """x'beta around the column means, as a plain column expression."""
        terms = [F.lit(float(b)) * v for b, v in zip(self.beta, _numbers(self.numeric, self.fill))]
        reach = dict(zip(self.columns, self.beta))
        terms += [_looked_up(c, {v: float(reach[f"{c}_{v}"]) for v in vs}, 0.0) for c, vs in self.levels.items()]
        return sum(terms, F.lit(-float(self.beta @ self.means)))


def _looked_up(column: str, values: Mapping[str, object], default: object) -> Column:
    if not values:
        return F.lit(default)
    table = F.create_map(*[F.lit(part) for pair in values.items() for part in pair])
    return F.coalesce(F.element_at(table, F.col(column).cast("string")), F.lit(default))


def category_levels(rows: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted categories without the first one, which is the baseline. The model has a column for each."""
    found = rows.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in columns]).first()
    return {c: list(found[c])[1:] for c in columns}


def _numbers(numeric: Sequence[str], fill: dict[str, float]) -> list[Column]:
    return [F.coalesce(F.col(c).cast("double"), F.lit(fill[c])) if c in fill else F.col(c).cast("double") for c in numeric]


def _design_columns(numeric: Sequence[str], levels: dict[str, list[str]], fill: dict[str, float]) -> list[Column]:
    columns = _numbers(numeric, fill)
    for c, values in levels.items():
        columns += [F.when(F.col(c) == v, 1.0).otherwise(0.0) for v in values]
    return columns


def design(
    rows: DataFrame, numeric: Sequence[str] = tuple(NUMERIC), categorical: Sequence[str] = tuple(CATEGORICAL),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Median-filled sizes and 0/1 columns, one per category except the first."""
    levels = category_levels(rows, categorical)
    fill = {"company_size": quantiles(rows, "company_size", {"m": 0.5}).first()["m"]} if "company_size" in numeric else {}
    names = [*numeric, *[f"{c}_{v}" for c, vs in levels.items() for v in vs]]
    columns = _design_columns(numeric, levels, fill)
    return rows.select(*keep, DAY, EVENT, *[c.alias(n) for c, n in zip(columns, names)])


def fit(
    rows: DataFrame, numeric: Sequence[str] = tuple(NUMERIC), categorical: Sequence[str] = tuple(CATEGORICAL),
    penalty: float = 0.01, tolerance: float = 1e-8, max_steps: int = 30,
) -> CoxModel:
    """Newton's method with step halving; ``rows`` should be a written table, it is read every step."""
    numeric, categorical = list(numeric), list(categorical)
    levels = category_levels(rows, categorical)
    fill = {}
    if "company_size" in numeric:
        fill["company_size"] = quantiles(rows, "company_size", {"m": 0.5}).first()["m"]
    q, p = len(numeric), len(numeric) + sum(map(len, levels.values()))
    n, events, means, sds, event_sum = _column_stats(rows, numeric, levels, fill)
    # The numeric columns are standardised in Spark, the 0/1 columns on the sums.
    scale = np.where(np.arange(p) < q, 1.0, sds)
    centres = np.where(np.arange(p) < q, 0.0, means)
    at = np.cumsum([q, *map(len, levels.values())])
    prepared = rows.select(
        F.col(DAY).cast("double").alias(DAY), F.col(EVENT).cast("int").alias(EVENT),
        *[_looked_up(c, {v: int(at[k]) + i for i, v in enumerate(vs)}, -1).alias(f"f{k}") for k, (c, vs) in enumerate(levels.items())],
        *[((c - float(means[i])) / float(sds[i])).alias(f"x{i}") for i, c in enumerate(_numbers(numeric, fill))])
    prepared = measured(risk_sets.sliced(measured(
        prepared.groupBy(*prepared.columns).agg(F.count(F.lit(1)).alias(risk_sets.ROWS)))))

    def evaluate(beta: np.ndarray):
        b = beta / scale
        centre = float(b @ centres)
        scanned = risk_sets.scan_risk_sets(prepared, b, centre, len(levels), q)
        pairs = risk_sets.second_sums(prepared, scanned, b, centre, len(levels), q).toArrow()
        value, gradient, hessian = risk_sets.derivatives(pairs, event_sum, b)
        # the centre was taken out of every weight
        value -= events * centre + n * penalty / 2 * float(beta @ beta)
        return scanned, value, gradient / scale - n * penalty * beta, hessian / np.outer(scale, scale) - n * penalty * np.eye(p)

    beta = np.zeros(p)
    scanned, value, gradient, hessian = evaluate(beta)
    for step in range(1, max_steps + 1):
        move = np.linalg.solve(-hessian, gradient)
        for _ in range(20):
            scanned, candidate, gradient, hessian = evaluate(beta + move)
            if candidate >= value - 1e-9 * abs(value):
                break
            move = move / 2
        beta, value = beta + move, candidate
        if np.max(np.abs(move)) < tolerance:
            break
    se = np.sqrt(np.diag(np.linalg.inv(-hessian))) / sds
    days, hazard = _hazard_around_grid(scanned)
    return CoxModel(
        numeric, levels, fill, means, sds, beta / sds, se,
        value + n * penalty / 2 * float(beta @ beta), step, days, hazard)


def _column_stats(
    rows: DataFrame, numeric: Sequence[str], levels: dict[str, list[str]], fill: dict[str, float],
) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, events, and per design column its mean, sample deviation and sum over the events (numbers standardised)."""
    numbers = _numbers(numeric, fill)
    died = F.col(EVENT) == 1
    told = rows.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(died, 1).otherwise(0)).alias("events"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(numbers)],
        *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(numbers)],
        *[F.sum(F.when(died, c).otherwise(0.0)).alias(f"e{i}") for i, c in enumerate(numbers)],
    ).first()
    n, events = told["n"], told["events"]
    means = [told[f"m{i}"] for i in range(len(numbers))]
    sds = [told[f"s{i}"] or 1.0 for i in range(len(numbers))]
    event_sum = [(told[f"e{i}"] - events * m) / s for i, (m, s) in enumerate(zip(means, sds))]
    for c, values in levels.items():
        by_level = {r[c]: r for r in rows.groupBy(c).agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.when(died, 1).otherwise(0)).alias("events")).collect()}
        for v in values:
            mean = by_level[v]["rows"] / n
            means.append(mean)
            sds.append(math.sqrt(mean * (1 - mean) * n / (n - 1)) or 1.0)
            event_sum.append(float(by_level[v]["events"]))
    return n, events, np.array(means), np.array(sds), np.array(event_sum)


def _hazard_around_grid(scanned: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Cumulative Breslow hazard on the last day up to each grid day and the first from it on. Between two
    days it is read off the line between them, so these days are all that the grid needs."""
    running = risk_sets.running_by_day(scanned, "hazard")
    width = (GRID_LAST - GRID_FIRST) / (GRID_POINTS - 1)
    # days between two grid days share a place; one on a grid day has it to itself
    place = F.greatest(F.least((F.col(DAY) - GRID_FIRST) / width, F.lit(float(GRID_POINTS))), F.lit(-1.0))
    around = running.groupBy(F.floor(place * 2).alias("place")).agg(
        F.min(F.struct(DAY, "running")).alias("first"), F.max(F.struct(DAY, "running")).alias("last")).collect()
    points = sorted({tuple(r[end]) for r in around for end in ("first", "last")})
    return np.array([d for d, _ in points]), np.array([h for _, h in points])


def save_model(spark: SparkSession, model: CoxModel, path: str) -> None:
    """As one JSON line, in any store that Spark writes."""
    told = {f.name: getattr(model, f.name) for f in fields(CoxModel)}
    told = {k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in told.items()}
    spark.createDataFrame([(json.dumps(told),)], "model string").coalesce(1).write.mode("overwrite").text(path)


def load_model(spark: SparkSession, path: str) -> CoxModel:
    told = json.loads(spark.read.text(path, wholetext=True).first()[0])
    arrays = ("means", "sds", "beta", "se", "days", "cumulative_hazard")
    return CoxModel(**{k: np.array(v) if k in arrays else v for k, v in told.items()})


def hazard_ratios(rows: DataFrame, model: CoxModel) -> DataFrame:
    """exp(beta), its 95 % bounds and two-sided p-value, largest ratio first."""
    z95 = 1.959963984540054
    entries = [
        (
            name, float(math.exp(b)), float(math.exp(b - z95 * s)), float(math.exp(b + z95 * s)),
            math.erfc(abs(b / s) / math.sqrt(2)),
        ) for name, b, s in zip(model.columns, model.beta, model.se)
    ]
    return rows.sparkSession.createDataFrame(
        entries, "feature string, hazard_ratio double, hr_lower_95 double, hr_upper_95 double, p_value double"
    ).orderBy(F.desc("hazard_ratio"))


_BUCKETS = 4096


def predicted_medians(rows: DataFrame, model: CoxModel) -> DataFrame:
    """First grid day on which the lead's survival is at most one half, null if there is none.

    That is the first day whose cumulative baseline hazard reaches ln 2 / exp(x'beta), so each
    grid day answers one interval of x'beta. The at most 500 intervals are cut at equal-width
    buckets; leads find theirs by equality on the bucket plus a bound check. The lookup has a
    fixed size, so it is broadcast.
    """
    grid = np.linspace(GRID_FIRST, GRID_LAST, GRID_POINTS)
    hazard = np.interp(grid, model.days, model.cumulative_hazard)
    pieces, upper = [], math.inf
    with np.errstate(divide="ignore"):
        needed = math.log(math.log(2)) - np.log(hazard)
    finite = needed[np.isfinite(needed)]
    scored = rows.withColumn("log_hazard", model.log_hazard())
    low, high = (float(finite.min()), float(finite.max())) if len(finite) else (0.0, 0.0)
    width = (high - low) / _BUCKETS or 1.0

    def bucket_of(v: float) -> int:
        return math.floor(min(max((v - low) / width, -1.0), float(_BUCKETS)))

    for day, start in zip(grid, needed):
        if start < upper:
            # One spare bucket on each side absorbs rounding; the bounds decide.
            for b in range(max(bucket_of(start) - 1, -1), min(bucket_of(upper) + 1, _BUCKETS) + 1):
                pieces.append((b, float(start), float(upper), float(day)))
            upper = start
    lookup = rows.sparkSession.createDataFrame(
        pieces, "lookup_bucket int, from_value double, to_value double, predicted_median_days double")
    place = F.floor((F.col("log_hazard") - low) / width)
    bucket = F.greatest(F.least(place, F.lit(_BUCKETS)), F.lit(-1)).cast("int")
    inside = (
        (bucket == F.col("lookup_bucket"))
        & (F.col("log_hazard") >= F.col("from_value")) & (F.col("log_hazard") < F.col("to_value"))
    )
    return scored.join(F.broadcast(lookup), inside, "left").select("lead_id", "log_hazard", "predicted_median_days")


def report(ratios: DataFrame, alpha: float = 0.05, low: float = 0.98, high: float = 1.02) -> DataFrame:
    """Significant ratios with a visible effect, readable labels and error bars of at least 0."""
    part = F.regexp_extract("feature", "^(lead_source|industry|region)_(.*)$", 1)
    value = F.regexp_extract("feature", "^(lead_source|industry|region)_(.*)$", 2)
    label = (
        F.when(part == "lead_source", F.concat(F.lit("Lead source: "), value))
        .when(part == "industry", F.concat(F.lit("Industry: "), value))
        .when(part == "region", F.concat(F.lit("Region: "), value))
        .when(F.col("feature") == "received_campaign", "Received campaign")
        .otherwise(F.col("feature"))
    )
    ratio = F.col("hazard_ratio")
    return ratios.filter((F.col("p_value") < alpha) & ((ratio > high) | (ratio < low))).select(
        "feature", label.alias("label"), "hazard_ratio",
        F.greatest(F.col("hr_upper_95") - ratio, F.lit(0.0)).alias("error_plus"),
        F.greatest(ratio - F.col("hr_lower_95"), F.lit(0.0)).alias("error_minus"),
        "p_value",
    ).orderBy("hazard_ratio")


def prediction_stats(predictions: DataFrame) -> DataFrame:
    """Share of leads that reach the median; its median and fastest tenth in years.

    The predictions are grid days, so ``percentile`` holds at most 500 values.
    """
    years = F.col("predicted_median_days") / 365.25
    return predictions.agg(
        F.count(F.lit(1)).alias("leads"),
        F.count("predicted_median_days").alias("reached"),
        F.avg(F.when(F.col("predicted_median_days").isNotNull(), 1.0).otherwise(0.0)).alias("share_reached"),
        F.percentile(years, 0.5).alias("median_years"),
        F.percentile(years, 0.1).alias("fastest_tenth_years"),
    )
