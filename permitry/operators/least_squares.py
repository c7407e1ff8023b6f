"""Linear regression from sums of products: one pass over the rows gives every fold and every setting of the grid.

A task adds up x x', x y and y y of its rows for each fold in numpy, and Spark adds the tasks' sums. The sums of the rows
outside a fold are all sums less the fold's, and errors on a fold follow from its sums, so neither cross-validation nor
the grid reads the rows again. What reaches the driver has the size of the features squared, not of the rows.

The objective is the one of MLlib's normal-equation solver, with features scaled to unit deviation: squares / 2n +
``reg`` (``elastic`` |w| + (1 - ``elastic``) w^2 / 2), where the second weight counts in units of the label's deviation. Without
the first weight it is a linear system, else coordinate descent to the only minimum: the result does not depend on a
number of iterations, a seed or the partitions, but for the last bits of the sums.
"""

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from permitry.operators.forecast import ELASTIC_NET, FOLDS, LABEL, REG_PARAM, feature_stages

SUMS = "fold int, row int, column int, value double"
#: Changes of scaled weights, in units of the label's deviation, at which the descent has arrived, and the most rounds.
ARRIVED, ROUNDS = 1e-12, 200_000


def _products(batches):
    """Sums of products by fold of the rows (1, x, y)."""
    sums = {}
    for batch in batches:
        folds, labels = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        width = len(batch.column(1).flatten()) // max(1, batch.num_rows)
        rows = np.column_stack([np.ones(batch.num_rows), batch.column(1).flatten().to_numpy().reshape(batch.num_rows, width), labels])
        for fold in np.unique(folds):
            own = rows[folds == fold]
            sums[fold] = sums.get(fold, 0) + own.T @ own
    for fold, matrix in sums.items():
        i, j = np.nonzero(matrix)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(i), fold), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(matrix[i, j])],
            ["fold", "row", "column", "value"])


def fold_of(folds, *keys):
    """A fixed fold of a row, by the MD5 sum of its keys."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(folds)).cast("int")


def sums_of(df, features, label, fold):
    """Rows (fold, row, column, value): sums of products of 1, the features of an array column, and the label."""
    rows = df.select(fold.alias("fold"), F.col(features).cast("array<double>"), F.col(label).cast("double"))
    return rows.mapInArrow(_products, SUMS).groupBy("fold", "row", "column").agg(F.sum("value").alias("value"))


def _descend(matrix, target, first, second):
    """Minimum of w S w / 2 - r w + first |w| + second w^2 / 2."""
    w, residual = np.zeros(len(target)), target.copy()
    diagonal = np.diag(matrix)
    for _ in range(ROUNDS):
        largest = 0.0
        for k in range(len(w)):
            if diagonal[k] == 0:
                continue
            aim = residual[k] + diagonal[k] * w[k]
            new = np.sign(aim) * max(0.0, abs(aim) - first) / (diagonal[k] + second)
            if new != w[k]:
                residual -= matrix[k] * (new - w[k])
                largest = max(largest, abs(new - w[k]))
                w[k] = new
        if largest <= ARRIVED * max(1e-300, abs(target).max(initial=0)):
            break
    return w


def solve(sums, reg, elastic):
    """Intercept and weights from a matrix of sums of products of (1, x, y)."""
    n = sums[0, 0]
    means = sums[0] / n
    spread = sums / n - np.outer(means, means)
    scale = np.sqrt(np.maximum(np.diag(spread), 0))
    # a feature that does not vary but for rounding has no weight
    used = np.flatnonzero(scale[1:-1] > 1e-9 * np.abs(means[1:-1])) + 1
    weights = np.zeros(len(sums) - 2)
    if len(used) and scale[-1] > 0:
        matrix = spread[np.ix_(used, used)] / np.outer(scale[used], scale[used])
        target = spread[used, -1] / scale[used]
        second = reg * (1 - elastic) / scale[-1]
        if reg * elastic == 0:
            scaled = np.linalg.lstsq(matrix + second * np.eye(len(used)), target, rcond=None)[0]
        else:
            scaled = _descend(matrix, target, reg * elastic, second)
        weights[used - 1] = scaled / scale[used]
    return means[-1] - means[1:-1] @ weights, weights


def rmse(sums, intercept, weights):
    """Root of the mean square error on the rows of the sums."""
    w = np.concatenate([[intercept], weights, [-1.0]])
    return float(np.sqrt(max(0.0, w @ sums @ w) / sums[0, 0])) if sums[0, 0] else float("nan")


@dataclass
class SumsModel:
    features: PipelineModel
    column: str
    intercept: float
    weights: np.ndarray
    settings: tuple
    #: (reg, elastic) -> mean RMSE on the rows left out
    errors: dict
    metrics: dict

    def transform(self, df):
        scored = self.features.transform(df)
        weights = F.lit([float(w) for w in self.weights])
        products = F.zip_with(vector_to_array(self.column), weights, lambda x, w: x * w)
        return scored.withColumn("prediction", F.aggregate(products, F.lit(float(self.intercept)), lambda total, x: total + x))


def _matrices(sums, folds):
    """One matrix for each fold from rows of sums."""
    rows = sums.toPandas()
    width = int(rows["row"].max()) + 1
    found = np.zeros((folds, width, width))
    found[rows["fold"], rows["row"], rows["column"]] = rows["value"]
    return found


def fit_from_sums(df, reg_params=(REG_PARAM,), elastic_nets=(ELASTIC_NET,), folds=FOLDS, one_hot_city=False, degree=None):
    """As ``forecast.fit_stability`` with the regression from sums: features, the best settings by the mean error on the
    rows left out (the first of equal ones), and weights from all rows.
    """
    features = Pipeline(stages=feature_stages(one_hot_city, degree)).fit(df)
    column = "features" if degree is not None else "norm_features"
    rows = features.transform(df).withColumn("__features", vector_to_array(column))
    own = _matrices(sums_of(rows, "__features", LABEL, fold_of(folds, "DataSetOrigin", "BusinessType", "year")), folds)
    everything = own.sum(axis=0)
    left_out = [fold for fold in range(folds) if 0 < own[fold][0, 0] < everything[0, 0]]
    errors = {}
    for settings in itertools.product(reg_params, elastic_nets):
        found = [rmse(own[fold], *solve(everything - own[fold], *settings)) for fold in left_out]
        errors[settings] = float(np.mean(found)) if found else float("nan")
    best = min(errors, key=lambda s: (errors[s] != errors[s], errors[s]))
    intercept, weights = solve(everything, *best)
    return SumsModel(features, column, float(intercept), weights, best, errors, {"rmse": rmse(everything, intercept, weights)})
