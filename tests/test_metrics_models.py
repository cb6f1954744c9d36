import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from millrace.operators import metrics as mt
from millrace.operators import models as md
from millrace.session import fresh_dir

SCORES = [(1, 0.9), (0, 0.8), (1, 0.8), (1, 0.5), (0, 0.5), (0, 0.1), (None, 0.3), (1, None)]


@pytest.fixture
def scores(frame):
    return frame(SCORES, "y int, p double")


@pytest.fixture(scope="module")
def classes(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.3 * rng.normal(size=600) > 0.4).astype(int)
    rows = [(i, float(a), float(b), None if i % 50 == 0 else float(c), int(t)) for i, ((a, b, c), t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y int")


def test_bands(frame):
    df = frame([(0.0,), (0.33,), (0.65999,), (0.66,), (float("nan"),), (None,)], "p double")
    assert [r["risk_band"] for r in mt.risk_band(df, "p").collect()] == ["low", "medium", "medium", "high", "high", None]


def test_threshold_metrics(scores):
    row = mt.threshold_metrics(scores, "y", "p").first().asDict()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (3, 2, 0, 1)
    assert (row["precision"], row["recall"], row["accuracy"]) == (0.6, 1.0, pytest.approx(4 / 6))
    assert mt.threshold_metrics(scores, "y", "p", 2.0).first()["precision"] == 0.0


def test_report_means(scores):
    rows = {r["class"]: r for r in mt.classification_report(scores, "y", "p").collect()}
    assert rows["0"]["recall"] == pytest.approx(1 / 3) and rows["1"]["f1"] == 0.75 and rows["macro avg"]["precision"] == pytest.approx(0.8)
    assert rows["weighted avg"]["support"] == 6


def brute_auc(rows):
    pos, neg = [p for y, p in rows if y == 1], [p for y, p in rows if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_with_ties_equals_pair_count(scores, spark):
    assert mt.roc_auc(scores, "y", "p").first()[0] == pytest.approx(brute_auc([s for s in SCORES if None not in s]))
    rng = np.random.default_rng(2)
    rows = [(int(rng.random() < 0.3), float(np.round(rng.random(), 2))) for _ in range(800)]
    df = spark.createDataFrame(rows, "y int, p double")
    assert mt.roc_auc(df, "y", "p").first()[0] == pytest.approx(brute_auc(rows))
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    raw = df.withColumn("y", F.col("y").cast("double"))
    assert mt.roc_auc(df, "y", "p").first()[0] == pytest.approx(BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0).evaluate(raw))


def test_auc_of_one_class_is_null(frame):
    assert mt.roc_auc(frame([(1, 0.5)], "y int, p double"), "y", "p").first()[0] is None


def test_curves(scores):
    roc = [(r["threshold"], r["fpr"], r["tpr"]) for r in mt.roc_curve(scores, "y", "p").orderBy(F.desc("threshold")).collect()]
    third = pytest.approx(1 / 3)
    assert roc == [(0.9, 0.0, third), (0.8, third, pytest.approx(2 / 3)), (0.5, pytest.approx(2 / 3), 1.0), (0.1, 1.0, 1.0)]
    pr = [(r["precision"], r["recall"]) for r in mt.pr_curve(scores, "y", "p").orderBy(F.desc("threshold")).collect()]
    assert pr[0] == (1.0, third) and pr[-1] == (0.5, 1.0)


def test_sweep_equals_comparing_every_row(spark):
    rng = np.random.default_rng(4)
    p = np.concatenate([rng.random(300), np.arange(0, 101) / 100, [0.29, 0.57, 0.58, 1.0, 0.0, 1.2, -0.1, np.nan]])
    y = (rng.random(len(p)) < 0.5).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p, strict=True) if not np.isnan(b)], "y int, p double")
    df = df.unionAll(spark.createDataFrame([(1, float("nan"))], "y int, p double"))
    y = np.append(y[~np.isnan(p)], 1)
    p = np.append(p[~np.isnan(p)], np.nan)
    # rows with a NaN score are left out of the evaluation like nulls
    keep = ~np.isnan(p)
    got = mt.cutoff_sweep(df, "y", "p").orderBy("cutoff").collect()
    assert len(got) == 101
    for i, row in enumerate(got):
        hit = p[keep] >= i / 100
        assert row["sensitivity"] == pytest.approx((hit & (y[keep] == 1)).sum() / (y[keep] == 1).sum())
        assert row["specificity"] == pytest.approx((~hit & (y[keep] == 0)).sum() / (y[keep] == 0).sum())


def test_best_cutoff_ties(frame):
    sweep = frame([(0.1, 0.5, 0.6, 0.4), (0.2, 0.5, 0.5, 0.5), (0.3, 0.5, 0.6, 0.4)], "cutoff double, accuracy double, sensitivity double, specificity double")
    assert mt.best_cutoff(sweep).first()["cutoff"] == 0.1


def test_first_model_wins_a_tie(scores):
    table = mt.compare_models([("one", scores), ("two", scores)], "y", "p")
    assert mt.select_best(table).first()["model"] == "one"


def test_regression_metrics(frame):
    row = mt.regression_metrics(frame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, p double"), "y", "p").first()
    assert (row["mse"], row["mae"], row["r2"]) == (pytest.approx(2 / 3), pytest.approx(2 / 3), pytest.approx(0.75))


def test_coefficient_tables(frame):
    df = frame([("a", -3.0), ("b", 1.0), ("c", 0.0), ("d", 3.0)], "feature string, coefficient double")
    assert [r["feature"] for r in mt.coef_table(df, 3).collect()] == ["a", "d", "b"]
    assert [r["feature"] for r in mt.zero_coefs(df).collect()] == ["c"]


def test_features_target_uses_the_strict_label_rule(frame):
    df = frame([(1, 0, 1, 2, 3)], "fm_client_id int, fm_target int, fm_set int, fm_asset int, leak int")
    assert md.features_target(df, leaks=["leak"]).columns == ["fm_target", "fm_asset"]
    with pytest.raises(ValueError):
        md.features_target(df.drop("fm_target"))


def test_weights_are_balanced(frame):
    df, n = md.with_weights(frame([(0,), (0,), (0,), (1,), (None,)], "y int"), "y")
    assert n == 4 and {r["y"]: r["weight_"] for r in df.collect()} == {0: pytest.approx(2 / 3), 1: 2.0}


def test_classifiers_learn_and_survive_storage(spark, classes):
    features = ["a", "b", "c"]
    logistic = md.fit_logistic(classes, features, "y")
    forest = md.fit_forest(classes, features, "y", trees=15, depth=4)
    for model in (logistic, forest):
        scored = md.with_probability(model, classes, features, ["y"])
        assert mt.roc_auc(scored, "y", "p").first()[0] > 0.93
    path = fresh_dir(spark, "model")
    md.save_model(logistic, path)
    before, after = (sorted(r["p"] for r in md.with_probability(m, classes, features, ["y"]).collect()) for m in (logistic, md.load_model(path)))
    assert before == after
    table = md.importances(spark, forest, features).collect()
    assert table[0]["feature"] == "a" and sum(r["importance"] for r in table) == pytest.approx(1.0)


def test_margin_models_give_probabilities(classes):
    whole = classes.dropna()
    for model in (md.fit_svm(whole, ["a", "b"], "y", max_iter=20), md.fit_rff_svm(whole, ["a", "b"], "y", d=40, max_iter=20)):
        scored = md.with_probability(model, whole, ["a", "b"], ["y"])
        assert mt.roc_auc(scored, "y", "p").first()[0] > 0.9
        assert scored.filter("p < 0 OR p > 1").count() == 0


def test_tree_grid(classes):
    model, table = md.grid_tree(classes.dropna(), ["a", "b", "c"], "y", ["a", "b", "c"], {"impurity": ["gini"], "maxDepth": [1, 4], "minInstancesPerNode": [1]})
    assert table.count() == 2 and model.stages[-1].depth in (1, 4)


@pytest.fixture(scope="module")
def line(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(3, 2, (300, 3))
    y = 4 + 2 * x[:, 0] - x[:, 1] + rng.normal(0, 0.1, 300)
    return spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))], "id int, a double, b double, c double, y double"), x, y


def test_ols_coefficients(spark, line):
    df, x, y = line
    got = {r["feature"]: r["coefficient"] for r in md.coefficients(spark, md.fit_ols(df, list("abc"), "y"), list("abc")).collect()}
    want = np.linalg.lstsq(np.column_stack([np.ones(300), x]), y, rcond=None)[0]
    assert np.allclose([got[k] for k in ("intercept", "a", "b", "c")], want)


def test_paths_match_closed_form_and_spark(spark, line):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    df, x, y = line
    for kind, alpha in [("ridge", 5.0), ("lasso", 0.3)]:
        path = md.regression_path(df, df, list("abc"), "y", ["id"], kind, alphas=[alpha], select_on="test")
        assert path.table.count() == 1 + md.FINE_STEPS
        scaled = path.scaled_train
        z = (x - x.mean(0)) / x.std(0)
        best = path.alpha
        if kind == "ridge":
            want = np.linalg.solve(z.T @ z + best * np.eye(3), z.T @ (y - y.mean()))
            reg = best * y.std() / len(y)
        else:
            want, reg = path.weights, best
        rows = VectorAssembler(inputCols=list("abc"), outputCol="v").transform(scaled)
        fitted = LinearRegression(featuresCol="v", labelCol="y", elasticNetParam=float(kind == "lasso"), standardization=False, regParam=reg, tol=1e-12, maxIter=1000).fit(rows)
        assert np.allclose(path.weights, want, atol=1e-8)
        assert np.allclose(path.weights, fitted.coefficients.toArray(), atol=1e-4)
        assert path.intercept == pytest.approx(fitted.intercept, abs=1e-4)
        r2 = path.table.filter("stage = 'broad'").first()
        assert 0 < r2["cv_r2"] <= 1 and r2["train_r2"] == pytest.approx(r2["test_r2"])
        judged = mt.regression_metrics(path.predict(scaled), "y", "prediction").first()["r2"]
        assert judged == pytest.approx(fitted.summary.r2, abs=1e-4)


def test_large_lasso_alpha_eliminates(line):
    path = md.lasso_path(line[0], line[0], list("abc"), "y", ["id"], alphas=[1000.0])
    assert mt.zero_coefs(path.coefficients()).count() == 3


def test_cv_mae_equals_brute_force(line):
    df, x, y = line
    folds = np.array([r["f"] for r in df.orderBy("id").select(md.fold_of(["id"], 5).alias("f")).collect()])
    errors = []
    for k in range(5):
        tx, ty = x[folds != k], y[folds != k]
        w = np.linalg.solve((tx - tx.mean(0)).T @ (tx - tx.mean(0)) + 2.0 * np.eye(3), (tx - tx.mean(0)).T @ (ty - ty.mean()))
        errors.append(np.abs(y[folds == k] - (ty.mean() + (x[folds == k] - tx.mean(0)) @ w)).mean())
    assert md.cv_mae(df, list("abc"), "y", ["id"], 2.0).first()["mae"] == pytest.approx(np.mean(errors))


def test_grams_leave_incomplete_rows_out_at_any_width(frame):
    from millrace.functions.gram import collect_gram

    for width in (3, 20):
        rows = [tuple(float(r * (c + 1) % 5) for c in range(width)) for r in range(40)]
        holes = [(None, *rows[0][1:]), (*rows[1][:-1], float("nan"))]
        kind = ", ".join(f"c{i} double" for i in range(width))
        names = [f"c{i}" for i in range(width)]
        whole = collect_gram(frame(rows, kind), names)
        assert (collect_gram(frame(rows + holes, kind).repartition(5), names) == whole).all()


@pytest.mark.parametrize("query, learner, settings", [
    ("credit_models", "RandomForestClassifier", {"numTrees": 300, "maxDepth": 10}),
    ("forest_metrics", "RandomForestClassifier", {"numTrees": 300, "maxDepth": 10}),
    ("tree_importances", "DecisionTreeClassifier", {"maxDepth": 30}),
    ("svm_metrics", "LinearSVC", {"maxIter": 100}),
    ("fourier_svm_metrics", "LinearSVC", {"maxIter": 100}),
    ("grid_tree", "CrossValidator", {"estimatorParamMaps": 24}),
])
def test_queries_fit_the_whole_model(tables, monkeypatch, query, learner, settings):
    from millrace.plans.all_queries import REGISTRY

    class Asked(Exception):
        pass

    def ask(**options):
        raise Asked({k: len(v) if isinstance(v, list) else v for k, v in options.items() if k in settings})

    monkeypatch.setattr(md, learner, ask)
    with pytest.raises(Asked) as asked:
        REGISTRY.queries()[query](tables.spark, SF)
    assert asked.value.args[0] == settings


@pytest.mark.parametrize("fit, kind", [(md.fit_forest, "RandomForestClassifier"), (md.fit_svm, "LinearSVC"), (md.fit_tree, "DecisionTreeClassifier")])
def test_fits_use_every_core_on_rows_of_one_file(spark, monkeypatch, fit, kind):
    rows = spark.range(400, numPartitions=1).selectExpr("id AS x", "CAST(id % 2 AS INT) AS y")
    seen = []
    known = getattr(md, kind).fit
    monkeypatch.setattr(getattr(md, kind), "fit", lambda self, df, *a: seen.append(df.rdd.getNumPartitions()) or known(self, df, *a))
    fit(rows, ["x"], "y", **({"trees": 2, "depth": 2} if fit is md.fit_forest else {}))
    assert seen == [spark.sparkContext.defaultParallelism] and seen[0] > 1


def test_spread_bounds_the_rows_of_a_task(spark):
    assert md.spread(spark.range(10), 40 * md.ROWS_PER_TASK).rdd.getNumPartitions() == 40
