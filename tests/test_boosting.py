"""Histogram boosting against a plain second-order boosting of the same rows."""

import pickle

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from dealgauge.operators import boosting
from dealgauge.operators.boosting import BoostSettings, Fit, fit_boosters

SETTINGS = BoostSettings(rounds=12, depth=3, step=0.3)


def plain_boosting(x, is_number, y, w, settings):
    """x: bin codes. Returns the margins after all rounds, growing each node by a search over all rows."""
    margin = np.zeros(len(y))

    def value(rows, g, h):
        return -settings.step * g[rows].sum() / (h[rows].sum() + settings.penalty)

    def grow(rows, depth, g, h):
        best = (1e-9, None)
        if depth:
            whole = g[rows].sum() ** 2 / (h[rows].sum() + settings.penalty)
            for k in range(x.shape[1]):
                for c in np.unique(x[:, k]):
                    right = x[rows, k] > c if is_number[k] else x[rows, k] == c
                    a, b = rows[~right], rows[right]
                    if h[a].sum() < settings.least_hessian or h[b].sum() < settings.least_hessian:
                        continue
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + settings.penalty) for s in (a, b)) - whole
                    if gain > best[0] + 1e-9:
                        best = (gain, (a, b))
        if best[1] is None:
            margin[rows] += value(rows, g, h)
        else:
            for side in best[1]:
                grow(side, depth - 1, g, h)

    for _ in range(settings.rounds):
        p = 1 / (1 + np.exp(-margin))
        grow(np.arange(len(y)), settings.depth, w * (p - y), w * p * (1 - p))
    return margin


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    rng = np.random.default_rng(2)
    n = 600
    a, b = rng.integers(0, 12, n), rng.normal(size=n).round(1)
    kind, arm = rng.choice(["x", "y", "z"], n), rng.choice(["Treatment", "Control"], n)
    reach = 0.8 * (kind == "y") + 0.25 * (a - 6) * (kind == "x") - b + 0.9 * (arm == "Treatment") * (kind == "z")
    y = (rng.random(n) < 1 / (1 + np.exp(-reach))).astype(int)
    rows = [(f"L{i}", int(a[i]) if i % 20 else None, float(b[i]), str(kind[i]) if i % 31 else None, str(arm[i]), int(y[i])) for i in range(n)]
    path = str(tmp_path_factory.mktemp("boost") / "rows")
    spark.createDataFrame(rows, "lead_id string, a int, b double, kind string, arm string, y int").write.parquet(path)
    return spark.read.parquet(path), rows


def codes(rows, keep):
    """Codes with the median of the kept rows for a missing number."""
    a = np.array([np.nan if r[1] is None else r[1] for r in rows])
    a[np.isnan(a)] = np.nanmedian(a[keep])
    kinds = sorted({r[3] or "Unknown" for r in rows})
    return np.column_stack([a, [r[2] for r in rows], [kinds.index(r[3] or "Unknown") for r in rows]])


def margins(model, frame):
    scored = model.transform(frame).select("lead_id", F.col("probability").cast("string").alias("p"), "probability").collect()
    p = {r.lead_id: r.probability[1] for r in scored}
    return np.array([np.log(p[f"L{i}"] / (1 - p[f"L{i}"])) for i in range(len(p))])


def test_fits_of_one_pass_equal_plain_boosting(data, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ENTRIES", 150)
    monkeypatch.setattr(boosting, "KEPT_TREES", 5)
    frame, rows = data
    arm = np.array([r[4] for r in rows])
    weight = F.when(F.col("y") == 1, 3.0).otherwise(1.0)
    fits = [Fit("all", F.lit(True), weight), *[Fit(a, F.col("arm") == a, F.lit(1.0)) for a in ("Treatment", "Control")]]
    models = fit_boosters(frame, fits, ["a", "b"], ["kind"], "y", SETTINGS, max_bins=3000)
    y = np.array([r[5] for r in rows], float)
    for model, keep, w in zip(models, (arm != "", arm == "Treatment", arm == "Control"), (np.where(y == 1, 3.0, 1.0), np.ones(len(y)), np.ones(len(y)))):
        x = codes(rows, keep)
        expected = plain_boosting(x[keep], [True, True, False], y[keep], w[keep], SETTINGS)
        assert np.allclose(margins(model, frame)[keep], expected, atol=1e-6)


def test_saved_model_scores_alike(data, tmp_path):
    frame, _ = data
    model = PipelineModel(stages=fit_boosters(frame, [Fit("all", F.lit(True), F.lit(1.0))], ["a", "b"], ["kind", "arm"], "y", SETTINGS))
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert np.allclose(margins(loaded, frame), margins(model, frame))
    unseen = frame.limit(3).withColumn("kind", F.lit("new kind")).withColumn("a", F.lit(None).cast("int"))
    assert loaded.transform(unseen).filter("probability is not null").count() == 3


def test_one_class_and_no_rows(data):
    frame, _ = data
    model = fit_boosters(frame.filter("y = 1"), [Fit("all", F.lit(True), F.lit(1.0))], ["b"], ["kind"], "y", BoostSettings(rounds=3, depth=2))[0]
    assert min(r.probability[1] for r in model.transform(frame).collect()) > 0.5
    with pytest.raises(ValueError):
        fit_boosters(frame.limit(0), [Fit("all", F.lit(True), F.lit(1.0))], ["b"], ["kind"], "y")


def test_what_reaches_the_driver_does_not_grow_with_the_blocks(data, monkeypatch):
    from pyspark import RDD

    plain, sent = RDD.collect, []

    def collect(self):
        found = plain(self)
        sent[-1] += len(pickle.dumps(found))
        return found

    monkeypatch.setattr(RDD, "collect", collect)
    frame, _ = data
    told = []
    for entries in (300, 20):
        monkeypatch.setattr(boosting, "BLOCK_ENTRIES", entries)
        sent.append(0)
        told.append(fit_boosters(frame, [Fit("all", F.lit(True), F.lit(1.0))], ["a", "b"], ["kind"], "y", BoostSettings(rounds=2, depth=3))[0])
    assert sent[1] < 1.2 * sent[0]
    assert np.allclose(margins(told[0], frame), margins(told[1], frame))


def test_features_are_counted_jointly():
    sizes = [15, 256, 2, 5, 6, 5, 6, 3, 6]
    groups = boosting._joints(sizes)
    assert sorted(k for group in groups for k in group) == list(range(9)) and len(groups) <= 4
    assert max(np.prod([sizes[k] for k in group]) for group in groups) <= boosting.JOINT_CELLS
    assert boosting._joints([5000, 2]) == [[0], [1]]
    rng = np.random.default_rng(5)
    codes = [rng.integers(0, size, 3000) for size in sizes]
    block = {
        "fit": rng.integers(0, 2, 3000).astype(np.uint8), "codes": np.stack(codes).astype(np.uint8),
        "joint": np.stack([np.ravel_multi_index([codes[k] for k in g], [sizes[k] for k in g]).astype(np.int16) for g in groups]),
        "target": rng.integers(0, 2, 3000).astype(np.int8), "weight": rng.random(3000), "margin": rng.normal(size=3000)}
    tree = {"feature": np.full((2, 3), -1), "cut": np.zeros((2, 3), int), "value": np.zeros((2, 3))}
    tree["feature"][:, 0], tree["cut"][:, 0] = (1, 4), (100, 2)
    found = dict(boosting._histograms(0, iter([block]), tree, 1, sizes, np.array([True] * 3 + [False] * 6)))
    node = np.where(block["fit"] == 0, codes[1] > 100, codes[4] == 2).astype(int)
    p = 1 / (1 + np.exp(-block["margin"]))
    for k, size in enumerate(sizes):
        for i, value in enumerate((block["weight"] * (p - block["target"]), block["weight"] * p * (1 - p))):
            for fit in range(2):
                for side in range(2):
                    here = (block["fit"] == fit) & (node == side)
                    plain = np.bincount(codes[k][here], value[here], size)
                    assert np.allclose(found[k][1][i, fit, side], [*plain, plain.sum()])


@pytest.mark.parametrize("by_mask", [0, 64])
def test_leaves_of_deep_and_of_wide_levels(monkeypatch, by_mask):
    monkeypatch.setattr(boosting, "SPLITS_BY_MASK", by_mask)
    rng = np.random.default_rng(6)
    codes, fit, is_number = rng.integers(-1, 6, (3, 500)), rng.integers(0, 2, 500), np.array([True, False, True])
    tree = {"feature": rng.integers(-1, 3, (2, 511)), "cut": rng.integers(0, 5, (2, 511))}
    expected = np.zeros(500, int)
    for e in range(500):
        for _ in range(7):
            k, cut = tree["feature"][fit[e], expected[e]], tree["cut"][fit[e], expected[e]]
            if k >= 0:
                expected[e] = 2 * expected[e] + 1 + (codes[k, e] > cut if is_number[k] else codes[k, e] == cut)
    assert (boosting._leaf(tree, fit, codes.astype(np.int8), is_number, 7) == expected).all()
