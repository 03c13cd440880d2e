"""Model work on Spark ML: encoding, comparison, search, calibration, scoring."""

from __future__ import annotations

import math
import random
import uuid
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightloom.operators.metrics import class_weight
from brightloom.operators.ordering import quantiles
from brightloom.session import cut, shared_dir

#: Fits that run side by side.
PARALLEL = 8
#: Training rows of one partition, on average.
PART_ROWS = 20_000


class _FlagParams(HasInputCol, HasOutputCol):
    share = Param(Params._dummy(), "share", "quantile above which the flag is set", TypeConverters.toFloat)
    threshold = Param(Params._dummy(), "threshold", "fitted quantile", TypeConverters.toFloat)


class HighValueFlag(Estimator, _FlagParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the 80th percentile of a column; the model flags rows strictly above it."""

    @keyword_only
    def __init__(self, *, inputCol: str = None, outputCol: str = None, share: float = 0.80):
        super().__init__()
        self._setDefault(share=0.80)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> HighValueFlagModel:
        row = quantiles(dataset, self.getInputCol(), {"q": self.getOrDefault(self.share)}).first()
        model = HighValueFlagModel()
        return self._copyValues(model)._set(threshold=float(row["q"]))


class HighValueFlagModel(Model, _FlagParams, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        above = F.col(self.getInputCol()) > self.getOrDefault(self.threshold)
        return dataset.withColumn(self.getOutputCol(), F.coalesce(above.cast("int"), F.lit(0)))


class PopulationScaler(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Centres a vector and divides by the population deviation; the model is two stages of
    Spark's own, so it can be saved."""

    @keyword_only
    def __init__(self, *, inputCol: str = None, outputCol: str = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        halfway = f"{self.getOutputCol()}_sample"
        scaler = StandardScaler(inputCol=self.getInputCol(), outputCol=halfway, withMean=True, withStd=True).fit(dataset)
        n = dataset.count()
        up = Vectors.dense([(n / max(n - 1, 1)) ** 0.5] * len(scaler.mean))
        return PipelineModel([scaler, ElementwiseProduct(scalingVec=up, inputCol=halfway, outputCol=self.getOutputCol())])


def encoder(numeric: Sequence[str], categorical: Sequence[str]) -> Pipeline:
    """Standardised numbers and one-hot categories in one vector; a category not seen in
    training is all zeros (the indexer's extra last index, which the encoder drops)."""
    indexed = [f"{c}_idx" for c in categorical]
    hot = [f"{c}_hot" for c in categorical]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True, handleInvalid="error"),
        VectorAssembler(inputCols=list(numeric), outputCol="numeric"),
        PopulationScaler(inputCol="numeric", outputCol="scaled"),
        VectorAssembler(inputCols=["scaled", *hot], outputCol="features"),
    ])


def feature_names(model: PipelineModel, numeric: Sequence[str], categorical: Sequence[str]) -> list[str]:
    """Names of the vector's slots, in order."""
    labels = model.stages[0].labelsArray
    return [*numeric, *[f"{c}_{v}" for c, values in zip(categorical, labels) for v in values]]


def with_class_weight(df: DataFrame, label: str) -> DataFrame:
    """Positives weigh as much as negatives in sum; a label of one class weighs 1."""
    ratio = class_weight(df, label).select(
        F.when((F.col("negatives") > 0) & (F.col("positives") > 0), F.col("pos_weight")).otherwise(1.0)).scalar()
    return df.withColumn("weight", F.when(F.col(label) == 1, ratio).otherwise(1.0))


def training_rows(df: DataFrame, *columns: str) -> DataFrame:
    """The columns that learners read, frozen in partitions of a bounded number of rows. A
    learner holds about 1 KB a row (encoded, with its count in each tree), much more than the
    bytes by which Spark sizes partitions, and a task reads all of its partition."""
    parts = math.ceil(df.count() / PART_ROWS)
    slim = df.select(*columns)
    return cut(slim.repartition(parts) if parts > 1 else slim)


def candidates(label: str) -> dict[str, Estimator]:
    common = {"featuresCol": "features", "labelCol": label, "weightCol": "weight"}
    return {
        "logistic_regression": LogisticRegression(maxIter=1000, regParam=0.01, **common),
        "random_forest": RandomForestClassifier(numTrees=100, maxDepth=6, seed=42, **common),
        "gradient_boosting": GBTClassifier(maxIter=20, maxDepth=5, seed=42, **common),
    }


def _auc(label: str) -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")


def compare_models(df: DataFrame, label: str, fold: str, k: int = 5) -> DataFrame:
    """Mean and deviation of the cross-validated area under the curve per learner; the fits
    of all learners and folds run side by side."""
    def score(job: tuple[str, int]) -> float:
        name, i = job
        model = reloaded(candidates(label)[name].fit(df.filter(F.col(fold) != i)), df.sparkSession)
        return _auc(label).evaluate(model.transform(df.filter(F.col(fold) == i)))

    learners = list(candidates(label))
    with ThreadPool(PARALLEL) as pool:
        found = pool.map(inheritable_thread_target(df.sparkSession)(score), [(name, i) for name in reversed(learners) for i in range(k)])
    areas = {name: found[j * k : (j + 1) * k] for j, name in enumerate(reversed(learners))}
    rows = [(name, fmean(areas[name]), pstdev(areas[name])) for name in learners]
    return df.sparkSession.createDataFrame(rows, "model string, auc_mean double, auc_std double")


def search(df: DataFrame, label: str, trials: int = 30, seed: int = 42) -> DataFrame:
    """Seeded random sample of settings, each scored on a held-out part."""
    rng = random.Random(seed)
    est = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol="weight", seed=seed)
    maps = [
        {est.numTrees: rng.randint(10, 40), est.maxDepth: rng.randint(3, 8),
         est.minInstancesPerNode: rng.randint(1, 10), est.subsamplingRate: rng.uniform(0.6, 1.0)}
        for _ in range(trials)
    ]
    fitted = TrainValidationSplit(estimator=est, estimatorParamMaps=maps, evaluator=_auc(label), trainRatio=0.8,
                                  parallelism=PARALLEL, seed=seed).fit(df)
    rows = [
        (i + 1, int(m[est.numTrees]), int(m[est.maxDepth]), int(m[est.minInstancesPerNode]), float(m[est.subsamplingRate]), float(v))
        for i, (m, v) in enumerate(zip(maps, fitted.validationMetrics))
    ]
    out = df.sparkSession.createDataFrame(
        rows, "trial int, num_trees int, max_depth int, min_instances int, subsampling double, validation_auc double")
    best = out.agg(F.max("validation_auc")).scalar()
    return out.withColumn("is_best", F.col("validation_auc") == best)


def probability(column: str = "probability") -> Column:
    """Probability of the positive class; 0 from a model that saw no positive."""
    return F.coalesce(F.get(vector_to_array(F.col(column)), F.lit(1)), F.lit(0.0))


def calibrate(validation: DataFrame, label: str, score: str, method: str = "sigmoid") -> Model:
    """Fit on validation scores; ``transform`` through ``apply_calibration``."""
    if method == "isotonic":
        fitted = IsotonicRegression(featuresCol=score, labelCol=label, predictionCol="calibrated").fit(validation)
        return reloaded(fitted, validation.sparkSession)
    clipped = F.least(F.greatest(F.col(score), F.lit(1e-9)), F.lit(1 - 1e-9))
    logit = validation.withColumn("_z", F.log(clipped / (1 - clipped)))
    return Pipeline(stages=[
        VectorAssembler(inputCols=["_z"], outputCol="_zv"),
        LogisticRegression(featuresCol="_zv", labelCol=label, regParam=0.0, probabilityCol="_zp", rawPredictionCol="_zr", predictionCol="_zc"),
    ]).fit(logit)


def apply_calibration(model: Model, df: DataFrame, score: str) -> DataFrame:
    if not isinstance(model, PipelineModel):
        return model.transform(df)
    fitted = model.stages[-1]  # two numbers, so the curve is an expression
    clipped = F.least(F.greatest(F.col(score), F.lit(1e-9)), F.lit(1 - 1e-9))
    z = F.log(clipped / (1 - clipped)) * float(fitted.coefficients[0]) + float(fitted.intercept)
    return df.withColumn("calibrated", 1 / (1 + F.exp(-z)))


def tree_importance(model, names: Sequence[str], spark, top_n: int = 5, lowering: Sequence[str] = ()) -> DataFrame:
    """Largest importances as shares of their sum, with the side they push to. The
    vector of importances is one number per feature."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    top = spark.createDataFrame(rows, "feature string, raw double").orderBy(F.desc("raw"), "feature").limit(top_n)
    total = F.sum("raw").over(Window.partitionBy())
    down = F.lit(False)
    for word in lowering:
        down = down | F.lower("feature").contains(word)
    return top.select(
        "feature", F.round(F.col("raw") / F.nullif(total, F.lit(0.0)), 3).alias("importance"),
        F.when(down, "down").otherwise("up").alias("direction"))


def fit_classifier(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], learner: str = "logistic_regression") -> tuple[PipelineModel, Model]:
    enc = reloaded(encoder(numeric, categorical).fit(df), df.sparkSession)
    ready = training_rows(with_class_weight(enc.transform(df), label), "features", label, "weight")
    return enc, reloaded(candidates(label)[learner].fit(ready), df.sparkSession)


def reloaded(model: Model, spark: SparkSession) -> Model:
    """The model saved to the shared folder and read again: it scores without anything that
    fitting left in it (training summary, parent, their tables), which would travel with
    every task."""
    path = f"{shared_dir(spark)}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    return type(model).load(path)


def score_batch(df: DataFrame, enc: PipelineModel, model: Model) -> DataFrame:
    return model.transform(enc.transform(df)).withColumn("churn_probability", F.round(probability(), 4))
