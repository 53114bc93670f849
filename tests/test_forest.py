"""The histogram forest against trees grown by a search over all rows."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from dealgauge.operators import forest
from dealgauge.operators.forest import ForestSettings, fit_forest

SETTINGS = ForestSettings(trees=6, depth=4, seed=7, max_bins=2000)


def gini(w):
    return 1 - ((w / w.sum()) ** 2).sum() if w.sum() else 0.0


def plain_tree(x, sizes, is_number, y, w, count, t):
    """x: codes. Returns the share of class 1 of the leaf of each row."""
    columns = [(k, c) for k, n in enumerate(sizes) for c in ([None] if is_number[k] else range(n))]
    share, opened = np.zeros(len(y)), [np.arange(len(y))]
    weight = w * count

    def classes(rows):
        return np.array([weight[rows][y[rows] == c].sum() for c in (0, 1)])

    share[:] = classes(opened[0])[1] / classes(opened[0]).sum()
    for level in range(SETTINGS.depth):
        drawn = forest.drawn_columns(SETTINGS.seed, t, level, len(opened), len(columns))
        assert (drawn.sum(1) == math.ceil(math.sqrt(len(columns)))).all()
        following = []
        for rows, may in zip(opened, drawn):
            whole, best = classes(rows), (0, None)
            for (k, c), allowed in zip(columns, may):
                for cut in (np.unique(x[:, k]) if c is None else [c]) if allowed else []:
                    right = x[rows, k] > cut if c is None else x[rows, k] == cut
                    sides = [classes(rows[~right]), classes(rows[right])]
                    if min(s.sum() for s in sides) > 0:
                        fall = gini(whole) - sum(s.sum() * gini(s) for s in sides) / whole.sum()
                        if fall > best[0] + 1e-10:
                            best = (fall, right)
            if best[1] is not None:
                for side in (rows[~best[1]], rows[best[1]]):
                    share[side] = classes(side)[1] / classes(side).sum()
                    if classes(side).min() > 0:
                        following.append(side)
        opened = following
    return share


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    rng = np.random.default_rng(4)
    n = 700
    a, kind, arm = rng.integers(0, 9, n), rng.integers(0, 4, n), rng.integers(0, 3, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.5 * (a - 4) * (kind == 1) + 1.1 * (kind == 2) - 0.6 * (arm == 0))))).astype(int)
    rows = [(f"L{i}", float(a[i]), float(kind[i]), float(arm[i]), int(y[i])) for i in range(n)]
    frame = spark.createDataFrame(rows, "lead_id string, a double, kind_index double, arm_index double, y int")
    path = str(tmp_path_factory.mktemp("forest") / "rows")
    VectorAssembler(inputCols=["a"], outputCol="scaled").transform(frame).write.parquet(path)
    return spark.read.parquet(path), np.column_stack([a, kind, arm]), y


def fitted(frame, blocks, settings=SETTINGS):
    weight = F.when(F.col("y") == 1, 1.7).otherwise(0.8)
    return fit_forest(frame, "scaled", 1, ["kind_index", "arm_index"], "y", weight, "lead_id", settings, blocks)


def shares(model, frame):
    found = {r[0]: r[1] for r in model.transform(frame).select("lead_id", vector_to_array("probability")[1]).collect()}
    return np.array([found[f"L{i}"] for i in range(len(found))])


@pytest.mark.parametrize("blocks", [1, 5])
def test_equals_trees_grown_by_search(data, monkeypatch, blocks):
    monkeypatch.setattr(forest, "NODES_PER_SUM", 3)
    frame, x, y = data
    model = fitted(frame, blocks)
    keys = np.array([r[0] for r in frame.select(F.xxhash64("lead_id"), F.substring("lead_id", 2, 9).cast("int").alias("i")).orderBy("i").collect()])
    w = np.where(y == 1, 1.7, 0.8)
    expected = [
        plain_tree(x, [9, 4, 3], [True, False, False], y, w, forest.bag(keys.view(np.uint64), SETTINGS.seed, t), t) for t in range(SETTINGS.trees)]
    assert np.allclose(shares(model, frame), np.mean(expected, 0))


def test_bags_are_poisson_and_follow_the_row():
    drawn = np.random.default_rng(1).integers(0, 2 ** 63, 200_000).astype(np.uint64)
    counts = forest.bag(drawn, 42, 0)
    for k in range(5):
        assert abs((counts == k).mean() - math.exp(-1) / math.factorial(k)) < 0.005
    assert (forest.bag(drawn[:50], 42, 0) == counts[:50]).all()
    assert abs(np.corrcoef(counts, forest.bag(drawn, 42, 1))[0, 1]) < 0.02


def test_saved_model_scores_alike_and_unseen_values_are_no_value(data, tmp_path):
    frame, _, _ = data
    model = PipelineModel(stages=[fitted(frame, 2)])
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert np.allclose(shares(loaded, frame), shares(model, frame))
    unseen = frame.limit(3).withColumn("kind_index", F.lit(4.0))
    assert loaded.transform(unseen).filter("probability is not null").count() == 3


def test_one_class_and_no_rows(data):
    frame, _, _ = data
    only = fitted(frame.filter("y = 1"), 2)
    assert {r[0] for r in only.transform(frame).select(vector_to_array("probability")[1]).collect()} == {1.0}
    with pytest.raises(ValueError):
        fitted(frame.limit(0), 1)


def test_jobs_follow_the_depth_not_the_trees(data):
    frame, _, _ = data
    context = frame.sparkSession.sparkContext

    def jobs(trees):
        context.setJobGroup(f"forest {trees}", "")
        try:
            fitted(frame, 4, ForestSettings(trees=trees, depth=3, seed=1))
            return len(context.statusTracker().getJobIdsForGroup(f"forest {trees}"))
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)

    assert abs(jobs(3) - jobs(30)) <= 1
