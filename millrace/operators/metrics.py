"""Evaluation of scores and predictions as tables. Nulls in label or score are not rows of the evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.expressions import ratio
from millrace.functions.order_stats import running_totals
from millrace.operators.reports import top_k

# Band limits, sweep steps
LOW_BAND, MEDIUM_BAND = 0.33, 0.66
STEPS = 100


def band_of(p: Column) -> Column:
    """< 0.33 low, < 0.66 medium, else high; NaN sorts above all numbers and is high, null is null."""
    return F.when(p < LOW_BAND, "low").when(p < MEDIUM_BAND, "medium").when(p.isNotNull(), "high")


def risk_band(df: DataFrame, p: str) -> DataFrame:
    return df.withColumn("risk_band", band_of(F.col(p)))


def or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(ratio(a, b), F.lit(0.0))


def scored(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.select(F.col(y).cast("int").alias("y"), F.col(p).cast("double").alias("p")).dropna()


def confusion(df: DataFrame, y: str, p: str, t: float = 0.5) -> DataFrame:
    """One row: true and false positives and negatives at the threshold."""
    hit, positive = F.col("p") >= t, F.col("y") == 1
    return scored(df, y, p).agg(
        F.count_if(hit & positive).alias("tp"),
        F.count_if(hit & ~positive).alias("fp"),
        F.count_if(~hit & positive).alias("fn"),
        F.count_if(~hit & ~positive).alias("tn"),
    )


def threshold_metrics(df: DataFrame, y: str, p: str, t: float = 0.5) -> DataFrame:
    """Accuracy, precision and recall (0 when undefined), confusion and predicted-class counts."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion(df, y, p, t).select(
        "tp",
        "fp",
        "fn",
        "tn",
        (tp + fp).alias("predicted_1"),
        (fn + tn).alias("predicted_0"),
        or_zero(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        or_zero(tp, tp + fp).alias("precision"),
        or_zero(tp, tp + fn).alias("recall"),
    )


def classification_report(df: DataFrame, y: str, p: str, t: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class with macro and weighted means."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def line(name: str, hit: Column, wrong: Column, lost: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            or_zero(hit, hit + wrong).alias("precision"),
            or_zero(hit, hit + lost).alias("recall"),
            or_zero(2 * hit, 2 * hit + wrong + lost).alias("f1"),
            (hit + lost).alias("support"),
        )

    classes = confusion(df, y, p, t).select(F.inline(F.array(line("0", tn, fn, fp), line("1", tp, fp, fn))))
    measures = ("precision", "recall", "f1")
    means = classes.agg(
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}") for m in measures],
        F.sum("support").alias("support"),
    )
    rows = [
        F.struct(F.lit(f"{kind} avg").alias("class"), *[F.col(f"{kind}_{m}").alias(m) for m in measures], "support")
        for kind in ("macro", "weighted")
    ]
    return classes.unionByName(means.select(F.inline(F.array(*rows))))


def by_score(df: DataFrame, y: str, p: str) -> DataFrame:
    """Positives and negatives per distinct score; a score shared by many rows combines before the shuffle."""
    positive = F.col("y") == 1
    counts = scored(df, y, p).groupBy("p").agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    return counts.withColumn("down_", -F.col("p"))


def ranked_scores(df: DataFrame, y: str, p: str) -> DataFrame:
    """Per distinct score the positives and negatives at or above it, by ranges of the score."""
    return running_totals(by_score(df, y, p), ["down_"], {"tp": F.col("pos"), "fp": F.col("neg")})


def roc_auc(df: DataFrame, y: str, p: str) -> DataFrame:
    """Area under the ROC curve: negatives below each positive, ties counting half."""
    points = ranked_scores(df, y, p)
    won = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return points.agg(ratio(won, pairs).alias("roc_auc"))


def _class_sizes(df: DataFrame, y: str, p: str) -> Column:
    positive = F.col("y") == 1
    counts = F.struct(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    return scored(df, y, p).agg(counts.alias("s")).scalar()


def roc_curve(df: DataFrame, y: str, p: str) -> DataFrame:
    """threshold, fpr, tpr for every distinct score."""
    sizes = _class_sizes(df, y, p)
    return ranked_scores(df, y, p).select(
        F.col("p").alias("threshold"),
        or_zero(F.col("fp"), sizes.getField("neg")).alias("fpr"),
        or_zero(F.col("tp"), sizes.getField("pos")).alias("tpr"),
    )


def pr_curve(df: DataFrame, y: str, p: str) -> DataFrame:
    """threshold, precision, recall for every distinct score."""
    sizes = _class_sizes(df, y, p)
    return ranked_scores(df, y, p).select(
        F.col("p").alias("threshold"),
        or_zero(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        or_zero(F.col("tp"), sizes.getField("pos")).alias("recall"),
    )


def cutoff_sweep(df: DataFrame, y: str, p: str) -> DataFrame:
    """Accuracy, sensitivity and specificity at 0.00, 0.01 … 1.00.

    Every row falls into the last step it reaches, so the sweep adds up 102 counts instead of comparing
    each row with each cutoff.
    """
    near = F.floor(F.col("p") * STEPS)
    step = (
        F.when(F.isnan("p") | (F.col("p") < 0), -1)
        .when(F.col("p") >= 1, STEPS)
        .when((near + 1) / STEPS <= F.col("p"), near + 1)
        .when(near / STEPS > F.col("p"), near - 1)
        .otherwise(near)
    )
    positive = F.col("y") == 1
    counts = (
        scored(df, y, p)
        .groupBy(step.cast("bigint").alias("step"))
        .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    )
    grid = df.sparkSession.range(-1, STEPS + 1).select(F.col("id").alias("step"))
    filled = grid.join(counts, "step", "left").fillna(0, ["pos", "neg"])
    above = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)  # 102 rows
    every = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = filled.select(
        "step",
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        F.sum("pos").over(every).alias("p_all"),
        F.sum("neg").over(every).alias("n_all"),
    ).filter("step >= 0")
    tn = F.col("n_all") - F.col("fp")
    return sums.select(
        (F.col("step") / STEPS).alias("cutoff"),
        or_zero(F.col("tp") + tn, F.col("p_all") + F.col("n_all")).alias("accuracy"),
        or_zero(F.col("tp"), F.col("p_all")).alias("sensitivity"),
        or_zero(tn, F.col("n_all")).alias("specificity"),
    )


def best_cutoff(sweep: DataFrame) -> DataFrame:
    """Largest sensitivity + specificity; ties: larger sensitivity, then smaller cutoff."""
    total = F.desc(F.col("sensitivity") + F.col("specificity"))
    return top_k(sweep, total, 1, [F.desc("sensitivity"), F.col("cutoff")])


def model_metrics(df: DataFrame, name: str, position: int, y: str, p: str, t: float = 0.5) -> DataFrame:
    """One comparison row of a model: position, model, ROC-AUC, accuracy, precision, recall."""
    auc = roc_auc(df, y, p).scalar()
    row = threshold_metrics(df, y, p, t)
    return row.select(
        F.lit(position).alias("position"), F.lit(name).alias("model"), auc.alias("roc_auc"), "accuracy", "precision", "recall"
    )


def compare_models(frames: Sequence[tuple[str, DataFrame]], y: str, p: str) -> DataFrame:
    rows = [model_metrics(df, name, i, y, p) for i, (name, df) in enumerate(frames)]
    return reduce(DataFrame.unionByName, rows)


def select_best(metrics: DataFrame) -> DataFrame:
    """Largest ROC-AUC; the first model wins a tie."""
    return top_k(metrics, F.desc("roc_auc"), 1, ["position"])


def regression_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """R², RMSE, MAE, MSE in one pass."""
    error = F.col(y) - F.col(p)
    mse = F.avg(error * error)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        (1 - ratio(mse, F.var_pop(y))).alias("r2"),
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        mse.alias("mse"),
    )


def residuals(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.withColumn("residual", F.col(y) - F.col(p))


def coef_table(pairs: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` coefficients largest by absolute value (feature, coefficient)."""
    return top_k(pairs, F.abs("coefficient").desc_nulls_last(), k, ["feature"])


def zero_coefs(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("coefficient") == 0).select("feature")


def training_card(train: DataFrame, test: DataFrame, y: str) -> DataFrame:
    """Rows per set and class with the number of feature columns."""
    parts = [("train", train), ("test", test)]
    frames = [
        df.groupBy(F.lit(name).alias("part"), F.col(y).alias("class"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("features", F.lit(len(df.columns) - 1))
        for name, df in parts
    ]
    return frames[0].unionByName(frames[1])
