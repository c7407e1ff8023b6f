"""Regression of longevity on city, type, year and number of businesses, and its use on future years."""

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Normalizer, OneHotEncoder, PolynomialExpansion, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from permitry.schemas import FORECAST_YEARS
from permitry.session import cut

LABEL = "AvgLongevity"
DEALS = 64

# Settings of the regression.
MAX_ITER, REG_PARAM, ELASTIC_NET, FOLDS = 1, 0.3, 0.8, 2


@dataclass
class StabilityModel:
    features: PipelineModel
    regression: object
    metrics: dict

    def transform(self, df):
        return self.regression.transform(self.features.transform(df))

    @property
    def summary(self):
        """Training summary of the best linear model."""
        return self.regression.bestModel.stages[-1].summary


def feature_stages(one_hot_city=False, degree=None, handle_invalid="error"):
    """Indexed city and type, one-hot type, year and count in one vector, each row scaled to length one."""
    city, kind = "DataSetOriginIndex", "BusinessTypeIndex"
    stages = [
        StringIndexer(inputCol="DataSetOrigin", outputCol=city, handleInvalid=handle_invalid),
        StringIndexer(inputCol="BusinessType", outputCol=kind, handleInvalid=handle_invalid),
        OneHotEncoder(inputCol=kind, outputCol="BusinessTypeHot"),
    ]
    city_feature = city
    if one_hot_city:
        city_feature = "DataSetOriginHot"
        stages.append(OneHotEncoder(inputCol=city, outputCol=city_feature))
    stages += [
        VectorAssembler(inputCols=[city_feature, "BusinessTypeHot", "year", "NumBusiness"], outputCol="VectorFeatures"),
        Normalizer(inputCol="VectorFeatures", outputCol="norm_features", p=2.0),
    ]
    if degree is not None:
        stages.append(PolynomialExpansion(inputCol="norm_features", outputCol="features", degree=degree))
    return stages


def evaluate(predictions, label=LABEL, prediction="prediction"):
    """RMSE and MAE of a table of predictions."""
    def of(metric):
        return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName=metric).evaluate(predictions)

    return {"rmse": of("rmse"), "mae": of("mae")}


def error_table(predictions, label=LABEL, prediction="prediction", by=(), weight=None):
    """RMSE and MAE as a table, overall or for each group of ``by``; ``weight`` tells how many rows a row stands for."""
    error = F.col(prediction) - F.col(label)
    times = F.lit(1) if weight is None else F.col(weight)
    n = F.sum(times)
    return predictions.groupBy(*by).agg(
        n.alias("n"), F.sqrt(F.sum(error * error * times) / n).alias("rmse"), (F.sum(F.abs(error) * times) / n).alias("mae"),
    )


def fit_stability(df, max_iter=MAX_ITER, reg_params=(REG_PARAM,), elastic_nets=(ELASTIC_NET,), folds=FOLDS, seed=42,
                  one_hot_city=False, degree=None):
    """Fit the features and the cross-validated regression, with errors on the training rows.

    ``df`` is read several times: give a written table, as ``session.cut`` returns it.
    """
    features = Pipeline(stages=feature_stages(one_hot_city, degree)).fit(df)
    transformed = features.transform(df)
    column = "features" if degree is not None else "norm_features"
    linear = LinearRegression(maxIter=max_iter, featuresCol=column, labelCol=LABEL)
    grid = (
        ParamGridBuilder().addGrid(linear.regParam, list(reg_params))
        .addGrid(linear.elasticNetParam, list(elastic_nets)).build()
    )
    search = CrossValidator(
        estimator=Pipeline(stages=[linear]), estimatorParamMaps=grid, numFolds=folds, seed=seed,
        evaluator=RegressionEvaluator(metricName="rmse", labelCol=LABEL),
    )
    model = search.fit(transformed.select(column, LABEL))
    return StabilityModel(features, model, evaluate(model.transform(transformed)))


def future_grid(df, years=FORECAST_YEARS):
    """One row per type, city and future year: every distinct type with every distinct city.

    The table is read once, for its distinct pairs of type and city; both lists come from the written pairs. The
    types are dealt to ``DEALS`` parts, each of which gets all cities.
    """
    first, last = years
    pairs = cut(df.select("BusinessType", "DataSetOrigin").distinct())
    types = pairs.select("BusinessType").distinct()
    types = types.withColumn("__deal", F.pmod(F.xxhash64("BusinessType"), F.lit(DEALS)).cast("int"))
    deals = F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1))).alias("__deal")
    with_city = types.join(pairs.select("DataSetOrigin").distinct().select("DataSetOrigin", deals), "__deal")
    years_of = F.explode(F.sequence(F.lit(first), F.lit(last)))
    return with_city.select("BusinessType", "DataSetOrigin", years_of.alias("year"))


def with_last_count(grid, history):
    """Adds ``NumBusiness``: the last observed one of the city and type, else the city's mean."""
    last = history.groupBy("DataSetOrigin", "BusinessType").agg(F.max_by("NumBusiness", "year").alias("__last"))
    means = history.groupBy("DataSetOrigin").agg(F.avg("NumBusiness").alias("__mean"))
    joined = grid.join(last, ["DataSetOrigin", "BusinessType"], "left").join(means, "DataSetOrigin", "left")
    count = F.coalesce(F.col("__last").cast("double"), "__mean")
    return joined.select("year", "BusinessType", "DataSetOrigin", count.alias("NumBusiness"))


def predict_trends(history, model, years=FORECAST_YEARS):
    """Predicted longevity for every type, city and future year."""
    scored = model.transform(with_last_count(future_grid(history, years), history))
    return scored.select("year", "BusinessType", "DataSetOrigin", "NumBusiness", "prediction")
