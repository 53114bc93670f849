"""Lead scoring and two-arm uplift with Spark ML pipelines."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealgauge.operators.boosting import BoostSettings, Fit, fit_boosters
from dealgauge.operators.forest import ForestModel, ForestSettings, fit_forest
from dealgauge.operators.logistic import fit_logistic
from dealgauge.operators.ranks import quantiles
from dealgauge.operators.scoring import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET, class_report, confusion_metrics
from dealgauge.operators.uplift import ARMS, with_uplift
from dealgauge.session import shared_dir
from dealgauge.sources.stages import measured

UPLIFT_NUMERIC = ["total_activities", "company_size"]
UPLIFT_CATEGORICAL = ["industry", "lead_source", "region", "job_title"]
#: Rows of a block of the forest, first up to as many blocks as given, then beyond them.
ROWS_PER_TASK, SMALL_TASKS, ROWS_PER_LARGE_TASK = 2000, 12, 64_000
METRICS = ["auc", "accuracy", "f1", "precision", "recall"]


@dataclass(frozen=True)
class ModelSettings:
    """Sizes of the models; the defaults are the full ones."""

    linear_steps: int = 1000
    forest_trees: int = 200
    forest_depth: int = 12
    boost_rounds: int = 300
    boost_depth: int = 5
    arm_rounds: int = 200
    arm_depth: int = 4
    step: float = 0.1
    test_part: float = 0.2
    seed: int = 42


def fit_together(spark: SparkSession, fits: Sequence[Callable[[], object]]) -> list[object]:
    """Runs independent fits at the same time; their jobs share the cluster.

    A boosted model is a long chain of short jobs, one chain alone leaves most executors idle.
    """
    with ThreadPoolExecutor(max_workers=len(fits)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(fit)) for fit in fits]]


def preprocessing(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """Median fill and standardisation; null categories as 'Unknown'; one-hot with unseen as all 0.

    The indexer keeps unseen values in a last slot, and the encoder drops that slot, so every
    known category has its own column.
    """
    known = ", ".join(f"coalesce(`{c}`, 'Unknown') AS `{c}_known`" for c in categorical)
    return [
        SQLTransformer(statement=f"SELECT *, {known} FROM __THIS__"),
        Imputer(strategy="median", relativeError=0.0001, inputCols=list(numeric), outputCols=[f"{c}_full" for c in numeric]),
        VectorAssembler(inputCols=[f"{c}_full" for c in numeric], outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        StringIndexer(
            inputCols=[f"{c}_known" for c in categorical], outputCols=[f"{c}_index" for c in categorical],
            handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(
            inputCols=[f"{c}_index" for c in categorical], outputCols=[f"{c}_hot" for c in categorical], dropLast=True),
        VectorAssembler(inputCols=["scaled", *[f"{c}_hot" for c in categorical]], outputCol="features"),
    ]


def with_held_out(rows: DataFrame, part: float, seed: int, strata: Sequence[str] = (TARGET,)) -> DataFrame:
    """Adds ``held_out``: a part of each stratum, repeatable for the same ids and seed.

    Each id hashes to a number in [0, 1). The cut of each stratum is the quantile of its numbers,
    which makes the counts exact at every size.
    """
    spread = F.pmod(F.xxhash64("lead_id", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    drawn = rows.withColumn("draw", spread)
    cuts = measured(quantiles(drawn, "draw", {"cut": part}, by=list(strata)))
    cuts = cuts.withColumnsRenamed({c: f"of_{c}" for c in strata})
    same = [F.col(c) == F.col(f"of_{c}") for c in strata]
    return drawn.join(cuts, same).withColumn("held_out", F.col("draw") <= F.col("cut")).drop(
        "draw", "cut", *[f"of_{c}" for c in strata])


def stratified_split(
    rows: DataFrame, part: float, seed: int, target: str = TARGET,
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows with the same class shares."""
    marked = with_held_out(rows, part, seed, [target])
    return marked.filter("not held_out").drop("held_out"), marked.filter("held_out").drop("held_out")


def _weighted(rows: DataFrame) -> tuple[DataFrame, int]:
    """Adds the balanced weight and the boosting weight; returns the row count too."""
    counts = {r[TARGET]: r["count"] for r in rows.groupBy(TARGET).count().collect()}
    total, positives = sum(counts.values()), counts.get(1, 0)
    balanced = F.when(F.col(TARGET) == 1, total / (2 * max(positives, 1))).otherwise(total / (2 * max(total - positives, 1)))
    boosting = F.when(F.col(TARGET) == 1, (total - positives) / max(positives, 1)).otherwise(1.0)
    return rows.withColumn("balanced_weight", balanced).withColumn("boosting_weight", boosting), total


def forest_tasks(n: int) -> int:
    return max(min(n // ROWS_PER_TASK + 1, SMALL_TASKS), n // ROWS_PER_LARGE_TASK + 1)


def _with_probability(model: PipelineModel, rows: DataFrame, name: str) -> DataFrame:
    *before, last = model.stages
    prepared = PipelineModel(stages=before).transform(rows)
    if isinstance(last, ForestModel):
        # its rows go to Python: only the columns that are needed
        prepared = prepared.select(*rows.columns, *[c for c in last.inputs() if c not in rows.columns])
    scored = last.transform(prepared)
    return scored.select(*rows.columns, vector_to_array("probability")[1].alias(name))


def auc(scored: DataFrame, probability: str = "conversion_probability") -> float:
    evaluator = BinaryClassificationEvaluator(rawPredictionCol=probability, labelCol=TARGET, metricName="areaUnderROC", numBins=0)
    return evaluator.evaluate(scored)


@dataclass(frozen=True)
class ScoringRun:
    best_name: str
    best_model: PipelineModel
    metrics: DataFrame
    report: DataFrame


def train_scoring(
    features: DataFrame, settings: ModelSettings = ModelSettings(),
    numeric: Sequence[str] = tuple(NUMERIC_FEATURES), categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES),
) -> ScoringRun:
    """Fits three models on the training part and keeps the one with the highest AUC on the rest."""
    spark = features.sparkSession
    shared_dir(spark)
    train, test = stratified_split(features, settings.test_part, settings.seed)
    train, n = _weighted(measured(train))
    prepared = Pipeline(stages=preprocessing(numeric, categorical)).fit(train)
    indexes = [f"{c}_index" for c in categorical]
    held = prepared.transform(test).select("lead_id", "scaled", *indexes, TARGET, *numeric, *categorical).persist()

    def regress() -> PipelineModel:
        return PipelineModel(stages=[fit_logistic(
            train, numeric, categorical, TARGET, F.col("balanced_weight"), max_steps=settings.linear_steps)])

    def forest() -> PipelineModel:
        # a tree splits the scaled numbers, and each value of a category's index as a 0/1 column
        sizes = ForestSettings(settings.forest_trees, settings.forest_depth, settings.seed)
        return PipelineModel(stages=[*prepared.stages, fit_forest(
            prepared.transform(train), "scaled", len(numeric), indexes, TARGET, F.col("balanced_weight"), "lead_id", sizes, forest_tasks(n))])

    def boost() -> PipelineModel:
        # trees take the columns as they are: missing values and bins are a matter of their fit
        whole = [Fit("scoring", F.lit(True), F.col("boosting_weight"))]
        sizes = BoostSettings(settings.boost_rounds, settings.boost_depth, settings.step)
        return PipelineModel(stages=fit_boosters(train, whole, numeric, categorical, TARGET, sizes))

    learners = {"Logistic Regression": regress, "Random Forest": forest, "Boosted Trees": boost}
    rows, best, reports = [], None, {}
    try:
        models = fit_together(spark, list(learners.values()))
        for name, fitted in zip(learners, models):
            # written, so that both measures take one pass through the model
            scored = measured(_with_probability(PipelineModel(stages=fitted.stages[-1:]), held, "conversion_probability").select(
                TARGET, "conversion_probability"))
            counts = confusion_metrics(scored).first()
            area = auc(scored)
            quality = {
                "auc": round(area, 4), "accuracy": counts["accuracy"], "f1": counts["f1"],
                "precision": counts["precision"], "recall": counts["recall"],
            }
            rows.append((name, *[float(quality[m]) for m in METRICS]))
            reports[name] = tuple(counts[c] for c in ("tp", "fp", "fn", "tn"))
            if best is None or area > best[1]:
                best = (name, area, fitted)
    finally:
        held.unpersist()
    schema = "model string, " + ", ".join(f"{m} double" for m in METRICS)
    metrics = spark.createDataFrame(rows, schema).withColumn("selected", F.col("model") == best[0])
    report = class_report(spark.createDataFrame([reports[best[0]]], "tp long, fp long, fn long, tn long"))
    return ScoringRun(best[0], best[2], metrics, report)


def score_all(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Conversion probability of every lead, the training rows included."""
    return _with_probability(model, features, "conversion_probability").select(
        "lead_id", "conversion_probability", "deal_value", TARGET)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def model_comparison(metrics: DataFrame) -> DataFrame:
    return metrics.unpivot(["model"], METRICS, "metric", "score")


@dataclass(frozen=True)
class UpliftRun:
    arms: dict[str, PipelineModel]
    metrics: DataFrame


def train_two_arms(
    cohort: DataFrame, settings: ModelSettings = ModelSettings(),
    numeric: Sequence[str] = tuple(UPLIFT_NUMERIC), categorical: Sequence[str] = tuple(UPLIFT_CATEGORICAL),
) -> UpliftRun:
    """One boosted model per arm, each with its own preprocessing: AUC on held-out rows, then a full refit.

    The trial and the full fit of both arms are four fits of one pass."""
    shared_dir(cohort.sparkSession)
    numbers = cohort.filter(F.col("treatment_group").isin(*ARMS)).select(
        "lead_id", "treatment_group", *categorical, F.col(TARGET).cast("int").alias(TARGET),
        *[F.col(c).cast("double").alias(c) for c in numeric])
    marked = measured(with_held_out(numbers, settings.test_part, settings.seed, ["treatment_group", TARGET]))
    of_arm = {arm: F.col("treatment_group") == arm for arm in ARMS}
    fits = [Fit(f"{arm} trial", of_arm[arm] & ~F.col("held_out"), F.lit(1.0)) for arm in ARMS]
    fits += [Fit(arm, of_arm[arm], F.lit(1.0)) for arm in ARMS]
    fitted = [PipelineModel(stages=[m]) for m in fit_boosters(
        marked, fits, numeric, categorical, TARGET, BoostSettings(settings.arm_rounds, settings.arm_depth, settings.step))]
    rows = []
    for arm, trial in zip(ARMS, fitted):
        scored = _with_probability(trial, marked.filter(of_arm[arm] & F.col("held_out")), "conversion_probability")
        rows.append((arm, float(auc(scored)), scored.count()))
    metrics = cohort.sparkSession.createDataFrame(rows, "treatment_group string, auc double, holdout long")
    return UpliftRun(dict(zip(ARMS, fitted[len(ARMS):])), metrics)


def score_two_arms(run: UpliftRun, cohort: DataFrame) -> DataFrame:
    numbers = cohort.withColumns({c: F.col(c).cast("double") for c in UPLIFT_NUMERIC})
    scored = _with_probability(run.arms["Treatment"], numbers, "p_treatment")
    return with_uplift(_with_probability(run.arms["Control"], scored, "p_control"))
