"""Model fits with Spark ML, and regularised regression paths from cross products.

A fit reads its data on the cluster; what reaches the driver is a model or a k x k matrix.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.gram import collect_gram, grams_by
from millrace.functions.hashing import hash32
from millrace.operators.quality import label_columns, require_columns
from millrace.operators.trees import CrossValidator, DecisionTreeClassifier, RandomForestClassifier
from millrace.operators.waves import LinearSVC

# Seed, iterations, trees, tree grid, alpha ranges
SEED = 42
MAX_ITER = 1000
TREES = 300
DEEPEST = 30  # Spark's limit, for an unlimited depth
GRID = {"impurity": ["gini", "entropy"], "maxDepth": [3, 5, 7, DEEPEST], "minInstancesPerNode": [1, 2, 4]}
RIDGE_ALPHAS = np.logspace(-3, 3, 100)
LASSO_ALPHAS = np.logspace(-4, 2, 50)
FINE_STEPS = 30
LEAST_ALPHA = 1e-4
MEDIAN_ERROR = 0.001
KEPT = 2 << 30  # bytes of random features that a fit may keep; more are made anew in every pass
ROWS_PER_TASK = 500_000  # training rows of one task; a forest keeps 4 bytes a row and tree with them


def features_target(df: DataFrame, y: str = "fm_target", key: str = "fm_client_id", leaks: Sequence[str] = ()) -> DataFrame:
    """Feature columns and the target: without the key, other labels and leaking columns."""
    require_columns(df, [y, key])
    dropped = {key, *leaks, *[c for c in label_columns(df.columns) if c != y]}
    return df.select(*[c for c in df.columns if c not in dropped])


def with_weights(df: DataFrame, y: str) -> tuple[DataFrame, int]:
    """Balanced class weights n / (classes * class rows), and n. Rows without a label are left out."""
    clean = df.filter(F.col(y).isNotNull())
    sizes = {r[y]: r["count"] for r in clean.groupBy(y).count().collect()}  # one row per class
    total = sum(sizes.values())
    weight: Column = F.lit(None).cast("double")
    for label, rows in sizes.items():
        weight = F.when(F.col(y) == label, F.lit(total / (len(sizes) * rows))).otherwise(weight)
    return clean.withColumn("weight_", weight), total


def _prepared(features: Sequence[str], impute: bool, scale: bool) -> tuple[list, str]:
    filled = [f"{c}_filled" for c in features] if impute else list(features)
    stages: list = []
    if impute:
        stages.append(
            Imputer(strategy="median", inputCols=list(features), outputCols=filled, relativeError=MEDIAN_ERROR)
        )
    stages.append(VectorAssembler(inputCols=filled, outputCol="assembled", handleInvalid="keep"))
    if scale:
        stages.append(StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True, withStd=True))
    return stages, "scaled" if scale else "assembled"


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` dealt out evenly: to every core, and further while a part would hold more than ROWS_PER_TASK of the ``rows``.

    A small file is one task however many cores there are, and a fit goes over its rows hundreds of times. More parts than
    that only cost: each has its own sums, which are added up after every pass.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil((rows or 0) / ROWS_PER_TASK)))


def _fit(stages: list, df: DataFrame, rows: int | None = None) -> PipelineModel:
    """Fits the stages one after another, from the first classifier on with rows that are dealt out evenly; models keep
    no training summary.

    A summary holds the session and the training data's plan, which would go into every task that scores, and a session
    that has observed metrics cannot be sent at all.
    """
    fitted: list = []
    rows = df.count() if rows is None else rows
    for stage in stages:
        if hasattr(stage, "getLabelCol") and not any(hasattr(f, "getLabelCol") for f in fitted):
            df = spread(df.select(*_inputs(stage)), rows)
        model = stage.fit(df) if isinstance(stage, Estimator) else stage
        if getattr(model, "hasSummary", False):
            model._java_obj.setSummary(df.sparkSession._jvm.scala.Option.empty())
        fitted.append(model)
        if len(fitted) < len(stages):
            df = model.transform(df)
    return PipelineModel(fitted)


def _inputs(stage: Estimator) -> list[str]:
    """The columns that a classifier reads."""
    weight = [stage.getWeightCol()] if stage.isDefined("weightCol") else []
    return [stage.getFeaturesCol(), stage.getLabelCol(), *weight]


def as_doubles(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in features})


def fit_logistic(df: DataFrame, features: Sequence[str], y: str, c: float = 1.0) -> PipelineModel:
    """Median imputation, scaling and a balanced logistic regression with penalty 1 / (C * n)."""
    weighted, rows = with_weights(as_doubles(df, features), y)
    stages, column = _prepared(features, True, True)
    model = LogisticRegression(
        featuresCol=column, labelCol=y, weightCol="weight_", maxIter=MAX_ITER, regParam=1.0 / (c * rows), standardization=False
    )
    return _fit([*stages, model], weighted, rows)


def fit_forest(df: DataFrame, features: Sequence[str], y: str, trees: int = TREES, depth: int = 10) -> PipelineModel:
    weighted, rows = with_weights(as_doubles(df, features), y)
    stages, column = _prepared(features, True, False)
    model = RandomForestClassifier(
        featuresCol=column, labelCol=y, weightCol="weight_", numTrees=trees, maxDepth=depth, seed=SEED
    )
    return _fit([*stages, model], weighted, rows)


def fit_svm(df: DataFrame, features: Sequence[str], y: str, reg: float = 1e-3, max_iter: int = 100) -> PipelineModel:
    """Linear SVM whose margin a one-dimensional logistic regression turns into a probability."""
    stages, column = _prepared(features, False, True)
    clean = as_doubles(df, features).dropna(subset=[*features, y])
    return _fit([*stages, *_margin_stages(column, y, reg, max_iter)], clean)


def _margin_stages(column: str, y: str, reg: float, max_iter: int) -> list:
    return [
        LinearSVC(
            featuresCol=column, labelCol=y, regParam=reg, maxIter=max_iter, tol=1e-4,
            rawPredictionCol="margins", predictionCol="side",
        ),
        VectorSlicer(inputCol="margins", outputCol="margin", indices=[1]),
        LogisticRegression(featuresCol="margin", labelCol=y, maxIter=max_iter),
    ]


@dataclass(frozen=True)
class FourierSvm:
    """Linear SVM on random Fourier features of an RBF kernel: every row takes part, none is subsampled."""

    features: tuple[str, ...]
    weights: np.ndarray
    offsets: np.ndarray
    model: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(fourier_features(df, self.features, self.weights, self.offsets))


def fourier_features(df: DataFrame, features: Sequence[str], weights: np.ndarray, offsets: np.ndarray) -> DataFrame:
    """sqrt(2/d) * cos(w·x + b) as one matrix product per Arrow batch: as columns, d times k terms exceed
    what one generated method may hold."""
    scale = math.sqrt(2.0 / len(offsets))

    @F.pandas_udf("array<double>")
    def waves(rows: pd.Series) -> pd.Series:
        x = np.stack(rows.to_numpy()) if len(rows) else np.zeros((0, weights.shape[1]))
        return pd.Series(list(scale * np.cos(x @ weights.T + offsets)))

    inputs = F.array(*[F.col(f).cast("double") for f in features])
    return df.withColumn("waves", array_to_vector(waves(inputs)))


def fit_rff_svm(
    df: DataFrame, features: Sequence[str], y: str, gamma: float | None = None, d: int = 64, reg: float = 1e-4,
    max_iter: int = 100,
) -> FourierSvm:
    """``gamma`` applies to standardised features; without it, it is 1 / features (their variance is one).

    Mean and deviation are folded into the frequencies and offsets, so fitting and scoring read the raw columns; the
    features themselves are not kept beyond KEPT bytes.
    """
    clean = as_doubles(df, features).dropna(subset=[*features, y])
    stats = [F.avg(f).alias(f"m{i}") for i, f in enumerate(features)]
    stats += [F.stddev_pop(f).alias(f"s{i}") for i, f in enumerate(features)]
    row = clean.agg(F.count(F.lit(1)).alias("n"), *stats).first()
    mean = np.array([row[f"m{i}"] for i in range(len(features))])
    width = np.array([row[f"s{i}"] or 1.0 for i in range(len(features))])
    gamma = 1.0 / len(features) if gamma is None else gamma
    rng = np.random.default_rng(SEED)
    weights = rng.normal(0.0, math.sqrt(2.0 * gamma), (d, len(features))) / width
    offsets = rng.uniform(0.0, 2.0 * math.pi, d) - weights @ mean
    if row["n"] * d * 8 <= KEPT:
        model = _fit(_margin_stages("waves", y, reg, max_iter), fourier_features(clean, features, weights, offsets), row["n"])
        return FourierSvm(tuple(features), weights, offsets, model)
    svm, *stages = _margin_stages("waves", y, reg, max_iter)
    rows = clean.select(*features, y)
    sides = svm.fit_waves(spread(rows, row["n"]), features, weights, offsets)
    margins = sides.transform(fourier_features(rows, features, weights, offsets)).select("margins", y)
    rest = _fit(stages, margins, row["n"])
    return FourierSvm(tuple(features), weights, offsets, PipelineModel([sides, *rest.stages]))


def fit_tree(df: DataFrame, features: Sequence[str], y: str, depth: int = DEEPEST) -> PipelineModel:
    stages, column = _prepared(features, False, False)
    model = DecisionTreeClassifier(featuresCol=column, labelCol=y, maxDepth=depth, seed=SEED)
    return _fit([*stages, model], as_doubles(df, features))


def importances(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Feature importance of a fitted tree or forest, largest first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def grid_tree(
    df: DataFrame, features: Sequence[str], y: str, key: Sequence[str], grid: dict | None = None, folds: int = 3
) -> tuple[PipelineModel, DataFrame]:
    """Grid search of a tree on the recall of class 1: the best model, and the mean recall of every point.

    A row's fold follows from the hash of its key, so scores do not depend on how rows are partitioned. Spark's tree has
    no minimum split size; that dimension is left out.
    """
    grid = GRID if grid is None else grid
    tree = DecisionTreeClassifier(featuresCol="assembled", labelCol=y, seed=SEED)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(getattr(tree, name), values)
    points = builder.build()
    recall = MulticlassClassificationEvaluator(labelCol=y, metricName="recallByLabel", metricLabel=1.0)
    assembled = VectorAssembler(inputCols=list(features), outputCol="assembled", handleInvalid="keep")
    search = CrossValidator(
        estimator=tree, estimatorParamMaps=points, evaluator=recall, numFolds=folds, foldCol="fold_", seed=SEED, parallelism=4
    )
    dealt = as_doubles(df, features).withColumn("fold_", (hash32(SEED, key) % folds).cast("int"))
    fitted = search.fit(spread(assembled.transform(dealt).select("assembled", y, "fold_"), df.count()))
    rows = [
        (*[str({p.name: v for p, v in point.items()}[name]) for name in grid], float(score))
        for point, score in zip(points, fitted.avgMetrics, strict=True)
    ]
    table = df.sparkSession.createDataFrame(rows, ", ".join(f"{n} string" for n in grid) + ", recall double")
    return PipelineModel([assembled, fitted.bestModel]), table


def with_probability(model: PipelineModel | FourierSvm, df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Kept columns, probability of class 1 and predicted class."""
    scored = model.transform(as_doubles(df, features))
    return scored.select(*keep, vector_to_array("probability")[1].alias("p"), F.col("prediction").cast("int").alias("predicted"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# linear models


def fit_ols(df: DataFrame, features: Sequence[str], y: str) -> LinearRegressionModel:
    rows = VectorAssembler(inputCols=list(features), outputCol="assembled", handleInvalid="skip").transform(as_doubles(df, features))
    return LinearRegression(featuresCol="assembled", labelCol=y, solver="normal").fit(rows)


def coefficients(spark: SparkSession, model: LinearRegressionModel, features: Sequence[str]) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(features, model.coefficients.toArray(), strict=True)]
    return spark.createDataFrame([("intercept", float(model.intercept)), *rows], "feature string, coefficient double")


def linear_prediction(features: Sequence[str], weights: Sequence[float], intercept: float) -> Column:
    return sum((F.col(f) * float(w) for f, w in zip(features, weights, strict=True)), F.lit(float(intercept)))


@dataclass(frozen=True)
class Moments:
    """What a Gram matrix over (1, features, y) says about a linear model."""

    gram: np.ndarray

    def solve(self, alpha: float, kind: str, start: np.ndarray | None = None) -> tuple[np.ndarray, float]:
        n = self.gram[0, 0]
        mean = self.gram[0, 1:] / n
        centred = self.gram[1:, 1:] - n * np.outer(mean, mean)
        xx, xy = centred[:-1, :-1], centred[:-1, -1]
        if kind == "ridge":
            weights = np.linalg.solve(xx + alpha * np.eye(len(xx)), xy)
        else:
            weights = lasso_weights(xx / n, xy / n, alpha, start)
        return weights, float(mean[-1] - mean[:-1] @ weights)

    def r2(self, weights: np.ndarray, intercept: float) -> float:
        error = np.concatenate([[-intercept], -weights, [1.0]])
        n, total = self.gram[0, 0], self.gram[-1, -1] - self.gram[0, -1] ** 2 / self.gram[0, 0]
        return float(1.0 - error @ self.gram @ error / total) if n and total else float("nan")


def lasso_weights(xx: np.ndarray, xy: np.ndarray, alpha: float, start: np.ndarray | None = None) -> np.ndarray:
    """Coordinate descent for ½·wᵀAw − bᵀw + α·|w|₁ on k x k moments."""
    w = np.zeros(len(xy)) if start is None else start.copy()
    for _ in range(10_000):
        largest = 0.0
        for j in range(len(w)):
            if xx[j, j] <= 0:
                continue
            pull = xy[j] - xx[j] @ w + xx[j, j] * w[j]
            moved = math.copysign(max(abs(pull) - alpha, 0.0), pull) / xx[j, j]
            largest, w[j] = max(largest, abs(moved - w[j])), moved
        if largest < 1e-10:
            return w
    raise ArithmeticError(f"coordinate descent did not settle for alpha {alpha}")


@dataclass(frozen=True)
class Path:
    """Scores of all alphas and the chosen model on standardised features."""

    table: DataFrame
    alpha: float
    features: tuple[str, ...]
    weights: np.ndarray
    intercept: float
    scaled_train: DataFrame
    scaled_test: DataFrame

    def coefficients(self) -> DataFrame:
        rows = [(f, float(w)) for f, w in zip(self.features, self.weights, strict=True)]
        return self.table.sparkSession.createDataFrame(rows, "feature string, coefficient double")

    def predict(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", linear_prediction(self.features, self.weights, self.intercept))


def _standardised(train: DataFrame, test: DataFrame, features: Sequence[str], y: str) -> tuple[DataFrame, DataFrame]:
    from millrace.operators.features import standard_scale

    both = [as_doubles(d, [*features, y]).dropna(subset=[*features, y]) for d in (train, test)]
    return standard_scale(*both, features)


def fold_of(key: Sequence[str], folds: int) -> Column:
    return (hash32(SEED, key) % folds).cast("int")


def fold_moments(df: DataFrame, features: Sequence[str], y: str, key: Sequence[str], folds: int) -> dict[int, Moments]:
    """Moments of the training part of every fold, all from one pass: total minus the held-out part."""
    cols = ["one_", *features, y]
    held = grams_by(df.withColumns({"one_": F.lit(1.0), "fold_": fold_of(key, folds)}), cols, "fold_")
    total = sum(held.values())
    return {fold: Moments(total - gram) for fold, gram in held.items()}


def regression_path(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    y: str,
    key: Sequence[str],
    kind: str = "ridge",
    alphas: Sequence[float] | None = None,
    select_on: str = "cv",
    folds: int = 5,
) -> Path:
    """R² of every alpha, then of a finer range around the best one.

    One pass over each set gives the cross products; all alphas, fine steps and folds are solved on them.
    ``select_on``: 'cv' (mean R² of the folds) or 'test'.
    """
    broad = (RIDGE_ALPHAS if kind == "ridge" else LASSO_ALPHAS) if alphas is None else np.asarray(alphas, float)
    scaled_train, scaled_test = _standardised(train, test, features, y)
    cols = ["one_", *features, y]
    parts = grams_by(scaled_train.withColumns({"one_": F.lit(1.0), "fold_": fold_of(key, folds)}), cols, "fold_")
    total = sum(parts.values())
    learn, judge = Moments(total), Moments(collect_gram(scaled_test.withColumn("one_", F.lit(1.0)), cols))

    def score(alpha: float) -> tuple[float, float, float]:
        weights, intercept = learn.solve(alpha, kind)
        held = []
        for gram in parts.values():
            held.append(Moments(gram).r2(*Moments(total - gram).solve(alpha, kind)))
        return learn.r2(weights, intercept), judge.r2(weights, intercept), float(np.mean(held))

    def best(rows: list[tuple]) -> float:
        index = {"test": 3, "cv": 4}[select_on]
        return max(rows, key=lambda row: row[index])[1]

    rows = [("broad", float(a), *score(a)) for a in broad]
    near = best(rows)
    fine = np.linspace(max(near * 0.8, LEAST_ALPHA), near * 1.2, FINE_STEPS)
    fine_rows = [("fine", float(a), *score(a)) for a in fine]
    chosen = best(fine_rows)
    weights, intercept = learn.solve(chosen, kind)
    table = train.sparkSession.createDataFrame(
        rows + fine_rows, "stage string, alpha double, train_r2 double, test_r2 double, cv_r2 double"
    )
    return Path(table, chosen, tuple(features), weights, intercept, scaled_train, scaled_test)


def ridge_path(train: DataFrame, test: DataFrame, features: Sequence[str], y: str, key: Sequence[str], **options) -> Path:
    return regression_path(train, test, features, y, key, "ridge", **options)


def lasso_path(train: DataFrame, test: DataFrame, features: Sequence[str], y: str, key: Sequence[str], **options) -> Path:
    return regression_path(train, test, features, y, key, "lasso", **options)


def cv_mae(df: DataFrame, features: Sequence[str], y: str, key: Sequence[str], alpha: float, kind: str = "ridge", k: int = 5) -> DataFrame:
    """Mean over k folds of the held-out mean absolute error: one pass to fit all folds, one to judge."""
    df = df.na.drop(subset=[*features, y])
    fits = {fold: m.solve(alpha, kind) for fold, m in fold_moments(df, features, y, key, k).items()}
    predicted: Column = F.lit(None).cast("double")
    for fold, (weights, intercept) in fits.items():
        predicted = F.when(F.col("fold_") == fold, linear_prediction(features, weights, intercept)).otherwise(predicted)
    judged = df.withColumn("fold_", fold_of(key, k)).withColumn("error_", F.abs(F.col(y) - predicted))
    per_fold = judged.groupBy("fold_").agg(F.avg("error_").alias("mae"))
    return per_fold.agg(F.count(F.lit(1)).alias("folds"), F.avg("mae").alias("mae"))
