"""The training job: target check, split, candidate fits, choice by AUC, and what is kept of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import metrics as mt
from millrace.operators import models as md
from millrace.operators import profile
from millrace.operators import quality as q
from millrace.operators.sampling import stratified_split
from millrace.session import settle

# Share of the test set, names of the candidates
TEST_SHARE = 0.2
CANDIDATES = {"logistic_regression": md.fit_logistic, "random_forest": md.fit_forest}


def check_target(df: DataFrame, y: str) -> None:
    """A target with one class, or with a class of a single row, cannot be trained on."""
    row = profile.validate_target(df, y).first()
    if not row["valid"]:
        raise ValueError(f"{y} has {row['classes']} classes, the smallest of {row['smallest']} rows; two classes of two rows are needed")


def train(df: DataFrame, out: str, y: str = "fm_target", key: str = "fm_client_id", test: float = TEST_SHARE) -> DataFrame:
    """Fits the candidates on all numeric features and saves the one with the greatest AUC of the test set below ``out``.

    ``out`` gets model, metrics (a row per candidate), card (one row, which is returned: chosen model, rows and feature
    columns of both sides and the rows of class 1) and test (the test set, so that the saved model can be judged again).
    """
    check_target(df, y)
    rows = md.features_target(df, y, key)
    features = [c for c in q.split_columns(rows).numeric if c != y]
    marked = settle(md.spread(stratified_split(df.select(key, y, *features), y, [key], test)), "split")
    sides = {False: marked.filter("NOT is_test").drop("is_test"), True: marked.filter("is_test").drop("is_test")}
    models = {name: fit(sides[False], features, y) for name, fit in CANDIDATES.items()}
    scored = [(name, settle(md.with_probability(model, sides[True], features, [y]), "scores")) for name, model in models.items()]
    table = settle(mt.compare_models(scored, y, "p"), "metrics")
    chosen = mt.select_best(table).select("model").first()[0]
    md.save_model(models[chosen], f"{out}/model")
    table.coalesce(1).write.mode("overwrite").json(f"{out}/metrics")
    sides[True].write.mode("overwrite").parquet(f"{out}/test")
    counts = marked.agg(
        *[F.count_if(F.col("is_test") == side).alias(f"{name}_rows") for name, side in (("train", False), ("test", True))],
        *[F.count_if((F.col("is_test") == side) & (F.col(y) == 1)).alias(f"{name}_ones") for name, side in (("train", False), ("test", True))],
    )
    card = counts.select(F.lit(chosen).alias("selected_model"), "*", F.lit(len(features)).alias("train_cols"), F.lit(len(features)).alias("test_cols"))
    card.coalesce(1).write.mode("overwrite").json(f"{out}/card")
    return card


def score_saved(spark: SparkSession, out: str, y: str = "fm_target", key: str = "fm_client_id") -> float:
    """AUC of the saved model on the saved test set."""
    test = spark.read.parquet(f"{out}/test")
    features = [c for c in test.columns if c not in (y, key)]
    scored = md.with_probability(md.load_model(f"{out}/model"), test, features, [y])
    return mt.roc_auc(scored, y, "p").first()[0]
