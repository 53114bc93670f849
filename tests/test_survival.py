import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealgauge.operators import concordance, cox, kaplan_meier, risk_sets


def test_kaplan_meier_by_hand(spark):
    rows = spark.createDataFrame(
        [("a", 1.0, 1), ("a", 2.0, 0), ("a", 3.0, 1), ("b", 1.0, 1), ("b", 1.0, 1)],
        "seg string, duration_days double, event_converted int")
    curve = kaplan_meier.curve(rows, "seg")
    got = [(r["seg"], r["duration_days"], round(r["survival"], 9)) for r in curve.orderBy("seg", "duration_days").collect()]
    assert got == [("a", 1.0, 0.666666667), ("a", 2.0, 0.666666667), ("a", 3.0, 0.0), ("b", 1.0, 0.0)]
    medians = {r["seg"]: r["median_days"] for r in kaplan_meier.medians(curve, "seg").collect()}
    assert medians == {"a": 3.0, "b": 1.0}


def test_constant_hazard_median(spark):
    rows = spark.createDataFrame(
        [("1", "a", 10, 1), ("2", "a", 30, 0), ("3", "b", 5, 0), ("4", None, 8, 1)],
        "lead_id string, seg string, duration_days int, event_converted int")
    got = {r["lead_id"]: r["predicted_median_days"] for r in kaplan_meier.constant_hazard_medians(rows, ["seg"]).collect()}
    assert got == {"1": round(math.log(2) * 40, 6), "2": round(math.log(2) * 40, 6), "3": None, "4": round(math.log(2) * 8, 6)}


def test_median_not_reached_and_top_segments(spark):
    rows = spark.createDataFrame(
        [("a", 1.0, 0), ("a", 2.0, 0), ("b", 1.0, 1), (None, 1.0, 1)],
        "seg string, duration_days double, event_converted int")
    got = kaplan_meier.by_segment(rows, "seg", 1).collect()
    assert [(r["seg"], r["median_days"], r["n"], r["events"]) for r in got] == [("a", None, 2, 0)]


def test_curves_never_rise(given):
    curve = kaplan_meier.curve(given.survival, "lead_source").toPandas().sort_values(["lead_source", "duration_days"])
    for _, part in curve.groupby("lead_source"):
        assert (np.diff(part["survival"]) <= 0).all()


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    rng = np.random.default_rng(1)
    n = 300
    source, industry = rng.choice(["A", "B", "C"], n), rng.choice(["X", "Y"], n)
    size, campaign = rng.integers(1, 100, n).astype(float), rng.integers(0, 2, n)
    pull = 0.8 * (source == "B") - 0.5 * (source == "C") + 0.4 * campaign + 0.01 * size
    life = np.ceil(rng.exponential(20 * np.exp(-pull))).clip(1, None)
    censor = rng.integers(1, 30, n)
    days, events = np.minimum(life, censor), (life <= censor).astype(int)
    rows = [
        (str(i), float(days[i]), int(events[i]), str(source[i]), str(industry[i]), float(size[i]) if i % 17 else None, int(campaign[i]))
        for i in range(n)
    ]
    path = str(tmp_path_factory.mktemp("cox") / "rows")
    spark.createDataFrame(
        rows, "lead_id string, duration_days double, event_converted int, lead_source string, industry string, "
        "company_size double, received_campaign int").write.parquet(path)
    size = np.array([r[5] if r[5] is not None else np.nan for r in rows])
    size[np.isnan(size)] = np.nanmedian(size)
    x = np.column_stack([size, campaign, source == "B", source == "C", industry == "Y"]).astype(float)
    return spark.read.parquet(path), x, days, events


def brute_force(x, days, events, penalty=0.01):
    n, p = x.shape
    means, sds = x.mean(0), x.std(0, ddof=1)
    z, beta = (x - means) / sds, np.zeros(p)
    for _ in range(50):
        theta, gradient, hessian = np.exp(z @ beta), np.zeros(p), np.zeros((p, p))
        for t in np.unique(days[events == 1]):
            at_risk, dying = days >= t, (days == t) & (events == 1)
            gradient += z[dying].sum(0)
            for step in range(dying.sum()):
                w = theta * (at_risk - step / dying.sum() * dying)
                s0, s1, s2 = w.sum(), w @ z, (z * w[:, None]).T @ z
                gradient -= s1 / s0
                hessian -= s2 / s0 - np.outer(s1, s1) / s0**2
        gradient -= n * penalty * beta
        hessian -= n * penalty * np.eye(p)
        move = np.linalg.solve(-hessian, gradient)
        beta += move
        if np.abs(move).max() < 1e-11:
            break
    return beta / sds, np.sqrt(np.diag(np.linalg.inv(-hessian))) / sds, means


@pytest.fixture(scope="module")
def fitted(sample):
    return cox.fit(sample[0], ["company_size", "received_campaign"], ["lead_source", "industry"])


def test_cox_equals_brute_force(sample, fitted):
    _, x, days, events = sample
    beta, se, _ = brute_force(x, days, events)
    assert fitted.columns == ["company_size", "received_campaign", "lead_source_B", "lead_source_C", "industry_Y"]
    assert np.allclose(fitted.beta, beta, rtol=1e-7, atol=1e-9) and np.allclose(fitted.se, se, rtol=1e-6)


def test_cox_median_days(spark, sample, fitted):
    rows, x, days, events = sample
    beta, _, means = brute_force(x, days, events)
    theta = np.exp((x - means) @ beta)
    seen = np.unique(days)
    hazard = np.cumsum([events[days == t].sum() / theta[days >= t].sum() for t in seen])
    grid = np.linspace(1, 6500, 500)
    survival = np.exp(-np.outer(np.interp(grid, seen, hazard), theta))
    expected = [grid[c.argmax()] if c.any() else None for c in (survival <= 0.5).T]
    got = {r["lead_id"]: r["predicted_median_days"] for r in cox.predicted_medians(rows, fitted).collect()}
    assert [got[str(i)] for i in range(len(x))] == expected


def test_unreached_medians_are_null(sample, fitted):
    import dataclasses

    flat = dataclasses.replace(fitted, cumulative_hazard=np.minimum(fitted.cumulative_hazard, 0.9))
    rows = cox.predicted_medians(sample[0], flat)
    stats = cox.prediction_stats(rows).first()
    wanted = rows.filter(F.exp("log_hazard") * flat.cumulative_hazard.max() >= math.log(2)).count()
    assert rows.count() == 300 and 0 < stats["reached"] < 300 and stats["reached"] == wanted


def test_hazard_report(spark, sample, fitted):
    ratios = cox.hazard_ratios(sample[0], fitted)
    rows = ratios.collect()
    assert [r["hazard_ratio"] for r in rows] == sorted((r["hazard_ratio"] for r in rows), reverse=True)
    assert all(r["hr_lower_95"] < r["hazard_ratio"] < r["hr_upper_95"] for r in rows)
    report = cox.report(ratios).collect()
    assert {r["label"] for r in report} >= {"Lead source: B", "Received campaign"} and all(r["error_minus"] >= 0 for r in report)


def test_tie_sums_step_by_step(monkeypatch):
    monkeypatch.setattr(risk_sets, "SCAN_DEATHS", 700)
    deaths = np.array([1, 10, 3, 5000, 1])
    total, dying = deaths * 3.0, deaths * np.array([1.2, 3.0, 0.5, 2.9, 3.0])
    got = risk_sets.tie_sums(total, dying, deaths)
    for k, d in enumerate(deaths):
        f = np.arange(d) / d
        r = total[k] - dying[k] * f
        expected = np.log(r).sum(), (1 / r).sum(), (f / r).sum(), (1 / r**2).sum(), (f / r**2).sum(), (f**2 / r**2).sum()
        assert np.allclose(got[:, k], expected, rtol=1e-12)


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """150 categories and days far apart, many with ties, one with a third of all rows."""
    rng = np.random.default_rng(8)
    n, kinds = 1200, 150
    kind = np.concatenate([np.arange(kinds), rng.integers(0, kinds, n - kinds)])
    days = np.where(rng.random(n) < 0.33, 150_000, rng.choice(np.sort(rng.choice(300_000, 500, replace=False)) + 1, n)).astype(float)
    events, size = (rng.random(n) < 0.6).astype(int), rng.normal(50, 10, n)
    path = str(tmp_path_factory.mktemp("wide") / "rows")
    spark.createDataFrame(
        [(str(i), float(days[i]), int(events[i]), f"c{kind[i]:03d}", float(size[i])) for i in range(n)],
        "lead_id string, duration_days double, event_converted int, lead_source string, company_size double").repartition(7).write.parquet(path)
    x = np.column_stack([size, *[(kind == k).astype(float) for k in range(1, kinds)]])
    return spark.read.parquet(path), x, days, events


def risk_set_newton(x, days, events, penalty=0.01):
    """As brute_force, with the sums of the risk set carried from the last day to the first."""
    n, p = x.shape
    sds = x.std(0, ddof=1)
    z, beta = (x - x.mean(0)) / sds, np.zeros(x.shape[1])
    for _ in range(50):
        theta, gradient, hessian = np.exp(z @ beta), -n * penalty * beta, -n * penalty * np.eye(p)
        r0, r1, r2 = 0.0, np.zeros(p), np.zeros((p, p))
        for t in np.unique(days)[::-1]:
            here, dying = days == t, (days == t) & (events == 1)
            r0, r1, r2 = r0 + theta[here].sum(), r1 + theta[here] @ z[here], r2 + (z[here] * theta[here, None]).T @ z[here]
            d0, d1, d2 = theta[dying].sum(), theta[dying] @ z[dying], (z[dying] * theta[dying, None]).T @ z[dying]
            gradient = gradient + z[dying].sum(0)
            for step in np.arange(dying.sum()) / max(dying.sum(), 1):
                s0, s1 = r0 - step * d0, r1 - step * d1
                gradient = gradient - s1 / s0
                hessian = hessian - (r2 - step * d2) / s0 + np.outer(s1, s1) / s0**2
        move = np.linalg.solve(-hessian, gradient)
        beta = beta + move
        if np.abs(move).max() < 1e-11:
            break
    return beta / sds, np.sqrt(np.diag(np.linalg.inv(-hessian))) / sds


def test_many_categories_days_and_slices(spark, wide, monkeypatch):
    monkeypatch.setattr(risk_sets, "SLICE_DAYS", 60)
    monkeypatch.setattr(risk_sets, "SCAN_DAYS", 7)
    rows, x, days, events = wide
    collected, inner = [], risk_sets.derivatives
    monkeypatch.setattr(risk_sets, "derivatives", lambda pairs, *rest: collected.append(pairs.num_rows) or inner(pairs, *rest))
    model = cox.fit(rows, ["company_size"], ["lead_source"])
    beta, se = risk_set_newton(x, days, events)
    assert np.allclose(model.beta, beta, rtol=1e-6, atol=1e-8) and np.allclose(model.se, se, rtol=1e-6)
    # what a step brings to the driver follows from the columns alone: one number per pair
    p = x.shape[1]
    assert set(collected) <= set(range(p, (p + 1) * (p + 2) // 2 + 1)) and len(model.days) <= 2 * 1003
    score = rows.select("lead_id", model.log_hazard().alias("v")).collect()
    expected = (x - x.mean(0)) @ beta
    assert np.allclose([r["v"] for r in score], [expected[int(r["lead_id"])] for r in score], atol=1e-6)


def test_one_slice_and_many_give_one_fit(sample, fitted, monkeypatch):
    monkeypatch.setattr(risk_sets, "SLICE_DAYS", 3)
    again = cox.fit(sample[0], ["company_size", "received_campaign"], ["lead_source", "industry"])
    assert np.allclose(again.beta, fitted.beta, rtol=1e-9) and abs(again.log_likelihood - fitted.log_likelihood) < 1e-7
    assert np.allclose(again.cumulative_hazard, fitted.cumulative_hazard)


def test_concordance_equals_all_pairs(sample):
    rows = sample[0].na.fill(3.0, ["company_size"])
    got = concordance.concordance_index(concordance.concordance_pairs(rows, "company_size")).first()
    data = rows.toPandas()
    s, t, e = (data[c].to_numpy() for c in ("company_size", "duration_days", "event_converted"))
    lower = tied = comparable = 0
    for i in np.flatnonzero(e == 1):
        later = (t > t[i]) | ((t == t[i]) & (e == 0))
        comparable += later.sum()
        lower += (later & (s < s[i])).sum()
        tied += (later & (s == s[i])).sum()
    assert (got["concordant"], got["tied"], got["comparable"]) == (lower, tied, comparable)
    assert abs(got["c_index"] - (lower + tied / 2) / comparable) < 1e-12


def test_concordance_is_exact_with_an_outlier(spark):
    import random

    from dealgauge.operators import concordance

    rng = random.Random(4)
    data = [(rng.randrange(60), rng.randrange(2), 1e12 if i == 0 else rng.choice([rng.random(), 0.5])) for i in range(200)]
    rows = spark.createDataFrame(data, "duration_days int, event_converted int, s double")
    found = concordance.concordance_pairs(rows, "s").first()
    comparable = concordant = tied = 0
    for d1, e1, s1 in data:
        for d2, e2, s2 in data:
            if e1 and (d2 > d1 or d2 == d1 and not e2):
                comparable += 1
                concordant += s1 > s2
                tied += s1 == s2
    assert (found["comparable"], found["concordant"], found["tied"]) == (comparable, concordant, tied)


def test_running_totals_of_days_are_a_written_table(spark, tmp_path):
    """Within a Newton step the rows join them; Catalyst broadcasts the smaller side if it knows the size of both."""
    path = str(tmp_path / "prepared")
    spark.range(20000).selectExpr(
        "cast(id % 1500 as double) duration_days", "cast(id % 3 = 0 as int) event_converted", "cast(id % 2 as int) f0",
        "id / 20000.0D x0", "1L n", "0 slice").write.parquet(path)
    prepared, beta = spark.read.parquet(path), np.zeros(3)
    scanned = risk_sets.scan_risk_sets(prepared, beta, 0.0, 1, 1)
    days = risk_sets.running_by_day(scanned, "inverse")
    assert days.count() == 1500 and set(days.inputFiles()).isdisjoint(scanned.inputFiles())
