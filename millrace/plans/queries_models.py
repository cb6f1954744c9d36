"""Queries that fit models on the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import metrics as mt
from millrace.operators import models as md
from millrace.operators import quality as q
from millrace.operators import sampling as s
from millrace.operators.filters import health_units
from millrace.plans.queries_profile import rounded
from millrace.plans.queries_quality import hash_sql
from millrace.plans.registry import Registry
from millrace.plans.views import Tables
from millrace.session import fresh_dir, settle

VITALS = ["age_days", "height_cm", "weight_kg", "ap_hi", "ap_lo", "cholesterol", "smoke"]
MATRIX = ["fm_amt_income", "fm_region", "fm_percentile_target", "case_id"]
LINE = ["price", "l_discount", "l_tax", "l_quantity"]


def sides(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return marked.filter("NOT is_test").drop("is_test"), marked.filter("is_test").drop("is_test")


def vital_sets(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Is the body mass index above 28? The split is written once: a fit reads its training set many times."""
    rows = health_units(t.vitals).withColumn("heavy", (F.col("bmi") > 28).cast("int"))
    return sides(settle(md.spread(s.stratified_split(rows, "heavy", ["id"], 0.3)), "vitals"))


def matrix_sets(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = q.drop_unlabeled(t.matrix)
    return sides(settle(md.spread(s.stratified_split(rows, "fm_target", ["fm_client_id"], 0.2)), "matrix"))


def line_sets(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Order means of the charge with its parts as features."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    rows = t.lineitem.withColumn("price", F.col("l_extendedprice")).groupBy("l_orderkey").agg(
        *[F.avg(c).alias(c) for c in LINE], F.avg(charge).alias("y")
    )
    return sides(settle(s.split(rows, ["l_orderkey"]), "lines"))


def judged(model, test: DataFrame, features: list[str], y: str, name: str) -> DataFrame:
    scored = settle(md.with_probability(model, test, features, [y]), "scores")
    cols = ["roc_auc", "accuracy", "precision", "recall"]
    return rounded(mt.model_metrics(scored, name, 0, y, "p"), cols, 4)


def credit_models(t: Tables) -> DataFrame:
    """Both candidates judged on the test set; the best one is marked."""
    train, test = matrix_sets(t)
    fits = {
        "logistic_regression": md.fit_logistic(train, MATRIX, "fm_target"),
        "random_forest": md.fit_forest(train, MATRIX, "fm_target"),
    }
    frames = [(n, settle(md.with_probability(m, test, MATRIX, ["fm_target"]), "scores")) for n, m in fits.items()]
    table = mt.compare_models(frames, "fm_target", "p")
    best = mt.select_best(table).select("model").scalar()
    return table.withColumn("best", F.col("model") == best)


def vital_fit(fit, name: str):
    def run(t: Tables) -> DataFrame:
        train, test = vital_sets(t)
        return judged(fit(train, VITALS, "heavy"), test, VITALS, "heavy", name)

    return run


def tree_table(t: Tables) -> DataFrame:
    train, _ = vital_sets(t)
    return md.importances(t.spark, md.fit_tree(train, VITALS, "heavy"), VITALS)


def grid_table(t: Tables) -> DataFrame:
    train, _ = vital_sets(t)
    return md.grid_tree(train, VITALS, "heavy", ["id"])[1]


def path_table(kind: str):
    def run(t: Tables) -> DataFrame:
        train, test = line_sets(t)
        return md.regression_path(train, test, LINE, "y", ["l_orderkey"], kind).table

    return run


def single_path(kind: str, alphas: list[float]):
    """The broad stage of a path over one feature, which has a closed form."""

    def run(t: Tables) -> DataFrame:
        train, test = line_sets(t)
        found = md.regression_path(train, test, ["price"], "y", ["l_orderkey"], kind, alphas=alphas)
        table = found.table.filter("stage = 'broad'").select("alpha", "train_r2", "test_r2")
        return rounded(table, ["train_r2", "test_r2"])

    return run


ORDERS = f"""o AS (SELECT l_orderkey, avg(l_extendedprice) AS x, avg(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS y
FROM lineitem GROUP BY l_orderkey), m AS (SELECT *, {hash_sql("l_orderkey")} < CAST(floor(0.2e0 * 4294967296) AS BIGINT) AS t,
{hash_sql("l_orderkey")} % 5 AS fold FROM o)"""
WEIGHTS = {"ridge": "n * c / (n + alpha)", "lasso": "sign(c) * greatest(abs(c) - alpha, 0)"}


def single_sql(kind: str, alphas: list[float]) -> str:
    return f"""WITH {ORDERS}, k AS (SELECT avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, var_pop(y) AS vy,
    covar_pop(x, y) / stddev_pop(x) AS c, CAST(count(*) AS DOUBLE) AS n FROM m WHERE NOT t),
    w AS (SELECT *, {WEIGHTS[kind]} AS w FROM k, (SELECT unnest([{", ".join(f"{a!r}e0" for a in alphas)}]) AS alpha))
    SELECT alpha, round((2 * w * c - w * w) / vy, 6) AS train_r2, round(1 - avg((y - my - w * (x - mx) / sx) *
    (y - my - w * (x - mx) / sx)) / var_pop(y), 6) AS test_r2 FROM m, w WHERE t GROUP BY alpha, w, c, vy"""


def single_mae(t: Tables) -> DataFrame:
    train, _ = line_sets(t)
    return rounded(md.cv_mae(train, ["price"], "y", ["l_orderkey"], 1000.0), ["mae"], 4)


MAE_SQL = f"""WITH {ORDERS}, f AS (SELECT k, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) * count(*) /
(var_pop(x) * count(*) + 1000e0) AS w FROM m, (SELECT unnest(range(5)) AS k) WHERE NOT t AND fold <> k GROUP BY k)
SELECT count(*) AS folds, round(avg(mae), 4) AS mae FROM (SELECT k, avg(abs(y - my - w * (x - mx))) AS mae FROM m JOIN f
ON fold = k WHERE NOT t GROUP BY k)"""


def eliminated(t: Tables) -> DataFrame:
    train, test = line_sets(t)
    found = md.lasso_path(train, test, LINE, "y", ["l_orderkey"], alphas=[1e6, 2e6])
    return mt.zero_coefs(found.coefficients())


def mae_table(t: Tables) -> DataFrame:
    train, _ = line_sets(t)
    return rounded(md.cv_mae(train, LINE, "y", ["l_orderkey"], 1.0), ["mae"], 4)


def saved_model(t: Tables) -> DataFrame:
    """Scores of a model that went through storage."""
    train, test = matrix_sets(t)
    path = fresh_dir(t.spark, "model")
    md.save_model(md.fit_logistic(train, MATRIX, "fm_target"), path)
    return judged(md.load_model(path), test, MATRIX, "fm_target", "reloaded")


def single_feature(t: Tables) -> DataFrame:
    model = md.fit_ols(t.lineitem, ["l_quantity"], "l_extendedprice")
    return rounded(md.coefficients(t.spark, model, ["l_quantity"]), ["coefficient"], 4)


# Fits whose result has a closed form: one binary feature, or classes that the features part without doubt.


def tally(model, rows: DataFrame, features: list[str]) -> DataFrame:
    """How many rows of each class the model gives each class. Equal rows are counted first and scored once."""
    alike = rows.groupBy(*features, "y").agg(F.count(F.lit(1)).alias("rows"))
    scored = md.with_probability(model, alike, features, ["y", "rows"])
    return scored.groupBy("y", "predicted").agg(F.sum("rows").alias("rows"))


def binary_odds(t: Tables) -> DataFrame:
    """Almost without penalty, a balanced logistic regression on one 0/1 feature gives the balanced shares of its classes."""
    rows = t.lineitem.select((F.col("l_quantity") > 25).cast("int").alias("x"), (F.col("l_extendedprice") > 40000).cast("int").alias("y"))
    model = md.fit_logistic(rows, ["x"], "y", c=1e9)
    scored = md.with_probability(model, rows.select("x").distinct(), ["x"], ["x"])
    return scored.select("x", F.round("p", 3).alias("p"))


ODDS_SQL = """WITH k AS (SELECT CAST(l_quantity > 25 AS INT) AS x, CAST(l_extendedprice > 40000 AS INT) AS y FROM lineitem),
n AS (SELECT x, sum(y) / (SELECT CAST(sum(y) AS DOUBLE) FROM k) AS one, sum(1 - y) / (SELECT CAST(sum(1 - y) AS DOUBLE) FROM k) AS zero
FROM k GROUP BY x) SELECT x, round(one / (one + zero), 3) AS p FROM n"""


def inner_nations(t: Tables) -> DataFrame:
    """Every tree of the forest can part an interval from what is outside it."""
    rows = t.customer.select("c_nationkey", F.col("c_nationkey").between(10, 19).cast("int").alias("y"))
    return tally(md.fit_forest(rows, ["c_nationkey"], "y"), rows, ["c_nationkey"])


def poor_and_rich(t: Tables) -> DataFrame:
    rows = t.customer.filter("c_acctbal < 2000 OR c_acctbal > 7000").select("c_acctbal", (F.col("c_acctbal") > 7000).cast("int").alias("y"))
    return tally(md.fit_svm(rows, ["c_acctbal"], "y"), rows, ["c_acctbal"])


def middle_and_ends(t: Tables) -> DataFrame:
    """No line parts these classes; the kernel does."""
    rows = t.customer.filter("c_acctbal < 0 OR c_acctbal BETWEEN 3500 AND 5500 OR c_acctbal > 9000")
    rows = rows.select("c_acctbal", F.col("c_acctbal").between(3500, 5500).cast("int").alias("y"))
    return tally(md.fit_rff_svm(rows, ["c_acctbal"], "y"), rows, ["c_acctbal"])


PARTED = "SELECT y, y AS predicted, count(*) AS \"rows\" FROM (SELECT CAST({label} AS INT) AS y FROM customer WHERE {kept}) GROUP BY y"
HALVES = "SELECT CAST(c_acctbal > 5000 AS INT) AS a, CAST(c_nationkey < 12 AS INT) AS b, CAST(c_acctbal > 3500 AND c_nationkey < 20 AS INT) AS y"


def halves(t: Tables) -> DataFrame:
    wealthy, low = F.col("c_acctbal") > 5000, F.col("c_nationkey") < 12
    y = (F.col("c_acctbal") > 3500) & (F.col("c_nationkey") < 20)
    return t.customer.select("c_custkey", wealthy.cast("int").alias("a"), low.cast("int").alias("b"), y.cast("int").alias("y"))


def one_split(t: Tables) -> DataFrame:
    """A tree of one split takes the feature with the greater fall of the Gini impurity, and all importance is its."""
    return md.importances(t.spark, md.fit_tree(halves(t), ["a", "b"], "y", depth=1), ["a", "b"])


GINI = "sum(n * 2 * p * (1 - p))"
SPLIT_SQL = f"""WITH k AS ({HALVES} FROM customer), g AS (
SELECT 'a' AS feature, {GINI} AS left_over FROM (SELECT a, count(*) AS n, avg(y) AS p FROM k GROUP BY a)
UNION ALL SELECT 'b', {GINI} FROM (SELECT b, count(*) AS n, avg(y) AS p FROM k GROUP BY b))
SELECT feature, CAST(left_over = (SELECT min(left_over) FROM g) AS DOUBLE) AS importance FROM g"""


def fold_recall(t: Tables) -> DataFrame:
    return rounded(md.grid_tree(halves(t), ["a"], "y", ["c_custkey"], {"impurity": ["gini", "entropy"], "maxDepth": [1]})[1], ["recall"])


FOLD_SQL = f"""WITH k AS ({HALVES}, {hash_sql("c_custkey")} % 3 AS fold FROM customer),
m AS (SELECT f, a, CAST(avg(y) > 0.5 AS INT) AS guess FROM k, (SELECT unnest(range(3)) AS f) WHERE fold <> f GROUP BY f, a),
r AS (SELECT f, sum(guess * y) / CAST(sum(y) AS DOUBLE) AS recall FROM k JOIN m ON fold = f AND k.a = m.a GROUP BY f)
SELECT impurity, '1' AS "maxDepth", round(avg(recall), 6) AS recall FROM r, (SELECT unnest(['gini', 'entropy']) AS impurity) GROUP BY impurity"""


def reloaded(t: Tables) -> DataFrame:
    """Test rows, and those that a saved and loaded model scores otherwise than the fitted one."""
    train, test = matrix_sets(t)
    path = fresh_dir(t.spark, "model")
    model = md.fit_logistic(train, MATRIX, "fm_target")
    md.save_model(model, path)
    score = lambda m, p: md.with_probability(m, test, MATRIX, ["fm_client_id"]).select("fm_client_id", F.col("p").alias(p))
    both = score(model, "before").join(score(md.load_model(path), "after"), "fm_client_id")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("differing"))


RELOADED_SQL = """SELECT CAST(sum(ceil(0.2e0 * n)) AS BIGINT) AS "rows", 0 AS differing FROM (SELECT count(*) AS n FROM v_matrix
WHERE fm_target IS NOT NULL AND fm_target <> -999 GROUP BY fm_target)"""


def register(r: Registry) -> None:
    r.add("logistic_odds", "ML2", binary_odds, ODDS_SQL)
    r.add("forest_interval", "ML3", inner_nations, PARTED.format(label="c_nationkey BETWEEN 10 AND 19", kept="true"))
    r.add("svm_parted", "ML4", poor_and_rich, PARTED.format(label="c_acctbal > 7000", kept="c_acctbal < 2000 OR c_acctbal > 7000"))
    r.add("fourier_svm_parted", "ML5", middle_and_ends, PARTED.format(
        label="c_acctbal BETWEEN 3500 AND 5500", kept="c_acctbal < 0 OR c_acctbal BETWEEN 3500 AND 5500 OR c_acctbal > 9000"))
    r.add("tree_split", "ML6", one_split, SPLIT_SQL)
    r.add("grid_folds", "ML7", fold_recall, FOLD_SQL)
    r.add("model_reloaded", "ML22", reloaded, RELOADED_SQL)
    r.add("features_target", "ML1", lambda t: md.features_target(t.matrix, leaks=["fm_sparse"]),
          "SELECT fm_target, fm_amt_income, fm_name_segment, fm_region, fm_percentile_target, case_id FROM v_matrix")
    r.add("credit_models", "ML2,ML3,ML14", credit_models)
    r.add("forest_metrics", "ML3", vital_fit(md.fit_forest, "random_forest"))
    r.add("svm_metrics", "ML4", vital_fit(md.fit_svm, "linear_svm"))
    r.add("fourier_svm_metrics", "ML5", vital_fit(md.fit_rff_svm, "fourier_svm"))
    r.add("tree_importances", "ML6", tree_table)
    r.add("grid_tree", "ML7", grid_table)
    r.add("ols_single", "ML15", single_feature,
          """SELECT 'intercept' AS feature, round(regr_intercept(l_extendedprice, l_quantity), 4) AS coefficient FROM lineitem
          UNION ALL SELECT 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 4) FROM lineitem""")
    r.add("ridge_path", "ML16", path_table("ridge"))
    r.add("lasso_path", "ML17", path_table("lasso"))
    r.add("lasso_eliminated", "ML17,ML20", eliminated,
          "SELECT unnest(['price', 'l_discount', 'l_tax', 'l_quantity']) AS feature FROM (SELECT count(*) FROM lineitem)")
    for kind, alphas in [("ridge", [0.001, 1.0, 1000.0]), ("lasso", [0.0001, 100.0, 10000.0])]:
        r.add(f"{kind}_single", "ML16" if kind == "ridge" else "ML17", single_path(kind, alphas), single_sql(kind, alphas))
    r.add("cv_mae", "ML18", mae_table)
    r.add("cv_mae_single", "ML18", single_mae, MAE_SQL)
    r.add("model_round_trip", "ML22", saved_model)
