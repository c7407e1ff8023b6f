"""The regression from sums against plain least squares, MLlib and optimality conditions."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from permitry.operators import forecast
from permitry.operators.least_squares import _matrices, fit_from_sums, rmse, solve, sums_of


def made_up(seed, n=300, width=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) * [1, 10, 0.1, 3, 1][:width] + [0, 5, 100, 0, 1][:width]
    x[:, 1] += x[:, 0]
    return x, x @ [3, -0.2, 20, 0, 0.5][:width] + rng.normal(size=n) + 50


def matrix(x, y):
    rows = np.column_stack([np.ones(len(y)), x, y])
    return rows.T @ rows


def test_without_penalty_like_plain_least_squares():
    x, y = made_up(1)
    wanted = np.linalg.lstsq(np.column_stack([np.ones(len(y)), x]), y, rcond=None)[0]
    intercept, weights = solve(matrix(x, y), 0.0, 0.0)
    assert [intercept, *weights] == pytest.approx(wanted, rel=1e-6)
    assert rmse(matrix(x, y), intercept, weights) == pytest.approx(np.sqrt(np.mean((y - intercept - x @ weights) ** 2)))


@pytest.mark.parametrize("reg, elastic", [(0.3, 0.8), (2.0, 1.0), (0.5, 0.0), (5.0, 0.5)])
def test_like_mllib_at_convergence(spark, reg, elastic):
    x, y = made_up(2)
    rows = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y)], "v array<double>, y double")
    model = LinearRegression(featuresCol="x", labelCol="y", regParam=reg, elasticNetParam=elastic, maxIter=2000, tol=1e-13).fit(
        rows.select(array_to_vector("v").alias("x"), "y"))
    intercept, weights = solve(matrix(x, y), reg, elastic)
    assert weights == pytest.approx(model.coefficients.toArray(), rel=1e-4, abs=1e-5)
    assert intercept == pytest.approx(model.intercept, rel=1e-4)


def test_features_that_do_not_vary():
    x, y = made_up(3)
    x[:, 2] = 7.0
    intercept, weights = solve(matrix(x, y), 0.3, 0.8)
    assert weights[2] == 0 and np.isfinite(intercept)
    intercept, weights = solve(matrix(x, np.full(len(y), 4.0)), 0.3, 0.8)
    assert intercept == pytest.approx(4.0) and not weights.any()
    intercept, weights = solve(matrix(x[:1], y[:1]), 0.3, 0.8)
    assert intercept == pytest.approx(y[0]) and not weights.any()


def test_sums_of_folds(spark):
    x, y = made_up(4, 200, 3)
    rows = spark.createDataFrame([(v.tolist(), float(t), i) for i, (v, t) in enumerate(zip(x, y))], "v array<double>, y double, i int")
    found = _matrices(sums_of(rows.repartition(5), "v", "y", F.col("i") % 3), 3)
    for fold in range(3):
        assert found[fold] == pytest.approx(matrix(x[fold::3], y[fold::3]))


@pytest.fixture(scope="module")
def history(spark):
    rng = np.random.default_rng(5)
    rows = [(city, kind, year, int(rng.integers(1, 60)), float(500 + 90 * (year - 2000) + 40 * len(kind) + rng.normal() * 20))
            for city in ("Van", "Tor") for kind in ("Spa", "Bar", "Bakery", "Lawyer") for year in range(2000, 2012)]
    return spark.createDataFrame(rows, "DataSetOrigin string, BusinessType string, year int, NumBusiness int, AvgLongevity double").cache()


def test_whole_regression(history):
    model = fit_from_sums(history, reg_params=(0.3, 100.0), elastic_nets=(0.0, 0.8), folds=3)
    assert set(model.errors) == {(r, e) for r in (0.3, 100.0) for e in (0.0, 0.8)}
    assert model.errors[model.settings] == min(model.errors.values())
    table = forecast.error_table(model.transform(history)).first()
    assert table["rmse"] == pytest.approx(model.metrics["rmse"], rel=1e-6)
    again = fit_from_sums(history.repartition(7), reg_params=(0.3, 100.0), elastic_nets=(0.0, 0.8), folds=3)
    assert again.weights == pytest.approx(model.weights, rel=1e-6) and again.errors == pytest.approx(model.errors, rel=1e-6)
    trends = forecast.predict_trends(history, model, (2012, 2013))
    assert trends.count() == 2 * 4 * 2 and trends.where("prediction IS NULL").count() == 0


def test_options_and_one_row(history):
    wide = fit_from_sums(history, one_hot_city=True, degree=2)
    assert len(wide.weights) > 10 and wide.metrics["rmse"] < forecast.fit_stability(history).metrics["rmse"]
    single = fit_from_sums(history.limit(1).union(history.limit(1).withColumn("BusinessType", F.lit("Other"))), folds=1)
    assert np.isnan(single.errors[single.settings]) and np.isfinite(single.intercept)
