import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dealgauge.operators.ranks import percent_rank_average, quantiles, running_total


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(5)
    values = [None if i % 50 == 0 else float(np.round(v, 2)) for i, v in enumerate(rng.normal(size=2000))]
    # one value and one group hold about a third of the rows
    values = [0.25 if i % 3 == 0 else v for i, v in enumerate(values)]
    groups = ["hot" if i % 3 else "cold" for i in range(2000)]
    data = pd.DataFrame({"id": range(2000), "g": groups, "v": pd.array(values, dtype="Float64")})
    rows = spark.createDataFrame([(i, g, v) for i, g, v in zip(range(2000), groups, values)], "id int, g string, v double")
    return data, rows.repartition(5).cache()


@pytest.mark.parametrize("limit", [10**6, 10])
def test_running_total(numbers, limit):
    data, rows = numbers
    got = running_total(rows.select("id", F.col("id").alias("m")), [F.desc("id")], "m", limit).toPandas()
    got = got.sort_values("id", ascending=False)
    assert len(got) == 2000 and (got["running"].to_numpy() == np.cumsum(got["m"].to_numpy())).all()


@pytest.mark.parametrize("limit", [10**6, 10])
def test_quantiles(numbers, limit):
    data, rows = numbers
    known = data.dropna()
    row = quantiles(rows, "v", {"a": 0.2, "b": 0.5, "c": 0.8, "d": 1.0}, limit=limit).first()
    assert np.allclose([row[c] for c in "abcd"], np.quantile(known["v"].astype(float), [0.2, 0.5, 0.8, 1.0]), atol=1e-12)
    by = {r["g"]: r["m"] for r in quantiles(rows, "v", {"m": 0.3}, by=["g"], limit=limit).collect()}
    for g, part in known.groupby("g"):
        assert abs(by[g] - np.quantile(part["v"].astype(float), 0.3)) < 1e-12


@pytest.mark.parametrize("limit", [10**6, 10])
def test_percent_rank(numbers, limit):
    data, rows = numbers
    got = percent_rank_average(rows, "v", "r", limit).toPandas().sort_values("id")
    expected = data["v"].astype(float).rank(pct=True, na_option="bottom")
    assert np.allclose(got["r"].to_numpy(), expected.to_numpy())


def test_percent_rank_of_one_value(spark):
    rows = spark.createDataFrame([(1, 7.0), (2, 7.0), (3, None)], "id int, v double")
    assert {r["r"] for r in percent_rank_average(rows, "v", "r").collect()} == {0.5}


def test_large_path_orders_nothing_in_one_task(numbers):
    _, rows = numbers
    placed = running_total(rows.select("id", F.lit(1).alias("m")), [F.asc("id")], "m", limit=10)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    # the only single-partition step is the one over the slice totals
    assert plan.count("SinglePartition") <= 1
