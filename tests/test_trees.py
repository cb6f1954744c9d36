"""Trees grown from histograms against Spark's own learners."""

import numpy as np
import pytest
from pyspark.ml import classification as ml
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler

from millrace.operators import models as md
from millrace.operators import trees as tr


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(3000, 3)), 2)
    y = (x[:, 0] * x[:, 1] + 0.3 * x[:, 2] + rng.normal(0, 0.4, 3000) > 0.4).astype(int)
    rows = [(i, *map(float, r), int(t), 1.0 + int(t), i % 7 / 7 + 0.5) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, y int, w double, v double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="f").transform(df).repartition(4).cache()


def refuse(*_):
    raise AssertionError("Spark's learner goes over all rows for every few nodes")


@pytest.mark.parametrize("options", [
    {"maxDepth": 4}, {"maxDepth": 5, "impurity": "entropy", "minInstancesPerNode": 4}, {"maxDepth": 4, "weightCol": "w"},
    {"maxDepth": 4, "weightCol": "v"}, {"maxDepth": 6, "minInfoGain": 0.01, "minWeightFractionPerNode": 0.02}, {"maxDepth": 0},
])
@pytest.mark.parametrize("handed", [50, 10_000])
def test_tree_is_sparks(noisy, monkeypatch, options, handed):
    want = ml.DecisionTreeClassifier(featuresCol="f", labelCol="y", **options).fit(noisy)
    monkeypatch.setattr(tr, "LEAST_HANDED", handed)
    monkeypatch.setattr(ml.DecisionTreeClassifier, "_fit", refuse)
    got = md.DecisionTreeClassifier(featuresCol="f", labelCol="y", **options).fit(noisy)
    assert got.toDebugString.split("\n", 1)[1] == want.toDebugString.split("\n", 1)[1]
    assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray())


def test_forest_is_grown_level_by_level(noisy, monkeypatch):
    options = {"featuresCol": "f", "labelCol": "y", "weightCol": "w", "numTrees": 30, "maxDepth": 6, "seed": 3}
    want = ml.RandomForestClassifier(**options).fit(noisy)
    monkeypatch.setattr(ml.RandomForestClassifier, "_fit", refuse)
    levels, known = [], tr._level
    monkeypatch.setattr(tr, "_level", lambda *a: levels.append(len(a[3])) or known(*a))
    got = md.RandomForestClassifier(**options).fit(noisy)
    assert levels == [30] * 6
    area = BinaryClassificationEvaluator(labelCol="y")
    assert area.evaluate(got.transform(noisy)) == pytest.approx(area.evaluate(want.transform(noisy)), abs=0.01)
    assert got.getNumTrees == 30 and got.numFeatures == 3 and abs(got.totalNumNodes / want.totalNumNodes - 1) < 0.1
    assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray(), atol=0.05)
    again = md.RandomForestClassifier(**options).fit(noisy)
    assert again.toDebugString.split("\n", 1)[1] == got.toDebugString.split("\n", 1)[1]


def test_draws_are_poisson():
    often = tr._poisson(1.0)
    assert often.mean() == pytest.approx(1.0, abs=1e-3) and often.var() == pytest.approx(1.0, abs=2e-3)


def test_thresholds_of_many_values_come_from_all_rows(spark):
    rows = spark.range(50_000, numPartitions=5).selectExpr("array(cast(id as double), cast(id % 3 as double), 1e0) x", "1e0 w")
    many, few, one = tr.thresholds(rows, 3, 32)
    assert np.abs(many - np.arange(1, 32) * 50_000 / 32).max() < 50_000 / 500
    assert few.tolist() == [0.5, 1.5] and len(one) == 0


@pytest.mark.parametrize("handed", [50, 10_000])
def test_grid_is_sparks(noisy, monkeypatch, handed):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    folds = noisy.selectExpr("f", "y", "cast(id % 3 as int) fold")

    def search(kind, learner):
        tree = learner(featuresCol="f", labelCol="y")
        grid = ParamGridBuilder().addGrid(tree.impurity, ["gini", "entropy"]).addGrid(tree.maxDepth, [1, 3, 6]).addGrid(tree.minInstancesPerNode, [1, 20]).build()
        recall = MulticlassClassificationEvaluator(labelCol="y", metricName="recallByLabel", metricLabel=1.0)
        return kind(estimator=tree, estimatorParamMaps=grid, evaluator=recall, numFolds=3, foldCol="fold").fit(folds)

    want = search(CrossValidator, ml.DecisionTreeClassifier)
    monkeypatch.setattr(tr, "LEAST_HANDED", handed)
    monkeypatch.setattr(ml.DecisionTreeClassifier, "_fit", refuse)
    fits, known = [], tr.grow
    monkeypatch.setattr(tr, "grow", lambda data, trees, **o: fits.append(len(trees)) or known(data, trees, **o))
    got = search(md.CrossValidator, md.DecisionTreeClassifier)
    assert np.allclose(got.avgMetrics, want.avgMetrics) and np.allclose(got.stdMetrics, want.stdMetrics)
    assert got.bestModel.toDebugString.split("\n", 1)[1] == want.bestModel.toDebugString.split("\n", 1)[1]
    assert fits == [4, 4, 4, 1]
