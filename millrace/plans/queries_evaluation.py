"""Queries over evaluation metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import metrics as m
from millrace.operators import profile as pf
from millrace.operators import sampling as s
from millrace.plans.queries_profile import rounded, union_all
from millrace.plans.queries_quality import hash_sql
from millrace.plans.registry import Registry
from millrace.plans.views import Tables

# Running counts per distinct score, from the highest score down
RANKED = """r AS (SELECT p, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS np,
sum(neg) OVER () AS nn FROM (SELECT p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg
FROM {0} GROUP BY p) WINDOW w AS (ORDER BY p DESC))"""
SWEEP = """sweep AS (SELECT c / 100e0 AS cutoff, coalesce(count(*) FILTER (WHERE (p >= c / 100e0) = (y = 1)) /
CAST(count(*) AS DOUBLE), 0) AS accuracy,
coalesce(count(*) FILTER (WHERE p >= c / 100e0 AND y = 1) / CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE), 0) AS sensitivity,
coalesce(count(*) FILTER (WHERE p < c / 100e0 AND y <> 1) / CAST(count(*) FILTER (WHERE y <> 1) AS DOUBLE), 0) AS specificity
FROM v_scores, (SELECT unnest(range(0, 101)) AS c) GROUP BY c)"""
CONFUSION = """SELECT count(*) FILTER (WHERE p >= 0.5e0 AND y = 1) AS tp, count(*) FILTER (WHERE p >= 0.5e0 AND y <> 1) AS fp,
count(*) FILTER (WHERE p < 0.5e0 AND y = 1) AS fn, count(*) FILTER (WHERE p < 0.5e0 AND y <> 1) AS tn FROM {0}"""


def rivals(t: Tables) -> list[tuple[str, DataFrame]]:
    """The given scores against a coarser and a reversed variant."""
    base = t.scores
    return [
        ("coarse", base.withColumn("p", F.floor(F.col("p") * 4) / 4)),
        ("given", base),
        ("reversed", base.withColumn("p", 1 - F.col("p"))),
    ]


RIVALS = {"coarse": "floor(p * 4) / 4", "given": "p", "reversed": "1 - p"}
COMPARED = "WITH " + ", ".join(
    f"s{i} AS (SELECT y, {e} AS p FROM v_scores), r{i} AS (SELECT * FROM ({RANKED.format(f's{i}')[6:-1]})), c{i} AS ({CONFUSION.format(f's{i}')})"
    for i, e in enumerate(RIVALS.values())
) + " " + union_all(
    f"""SELECT {i} AS position, '{n}' AS model, round((SELECT sum(neg * (tp - pos / 2e0)) / (max(np) * CAST(max(nn) AS DOUBLE))
    FROM r{i}), 6) AS roc_auc, round((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS accuracy,
    round(coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0), 6) AS precision,
    round(coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0), 6) AS recall FROM c{i}"""
    for i, n in enumerate(RIVALS)
)


def price_lines(t: Tables) -> DataFrame:
    """Extended price with a naive prediction from quantity."""
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * F.lit(2000.0)).alias("p"))


LINES = "(SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS y, l_quantity * 2000e0 AS p FROM lineitem)"


def slopes(t: Tables) -> DataFrame:
    """Single-feature slopes of the extended price as a coefficient table."""
    names = ["l_quantity", "l_discount", "l_tax", "l_suppkey", "l_linenumber"]
    row = t.lineitem.agg(*[F.regr_slope("l_extendedprice", n).alias(n) for n in names])
    return rounded(row.unpivot([], names, "feature", "coefficient"), ["coefficient"], 4)


SLOPES = union_all(
    f"SELECT '{n}' AS feature, round(regr_slope(l_extendedprice, {n}), 4) AS coefficient FROM lineitem"
    for n in ["l_quantity", "l_discount", "l_tax", "l_suppkey", "l_linenumber"]
)


def card(t: Tables) -> DataFrame:
    marked = s.stratified_split(t.vitals, "cardio", ["id"], 0.2)
    return m.training_card(marked.filter("NOT is_test").drop("is_test"), marked.filter("is_test").drop("is_test"), "cardio")


def register(r: Registry) -> None:
    r.add("risk_band", "ML8", lambda t: m.risk_band(t.scores, "p"),
          """SELECT *, CASE WHEN p < 0.33e0 THEN 'low' WHEN p < 0.66e0 THEN 'medium' ELSE 'high' END AS risk_band
          FROM v_scores""")
    r.add("threshold_metrics", "ML9",
          lambda t: rounded(m.threshold_metrics(t.scores, "y", "p"), ["accuracy", "precision", "recall"]),
          f"""SELECT tp, fp, fn, tn, tp + fp AS predicted_1, fn + tn AS predicted_0,
          round((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS accuracy,
          round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision, round(tp / CAST(tp + fn AS DOUBLE), 6) AS recall
          FROM ({CONFUSION.format("v_scores")})""")
    measures = ["precision", "recall", "f1"]
    r.add("classification_report", "ML9",
          lambda t: rounded(m.classification_report(t.scores, "y", "p"), measures),
          f"""WITH c AS ({CONFUSION.format("v_scores")}), k AS (
          SELECT '0' AS class, tn / CAST(tn + fn AS DOUBLE) AS precision, tn / CAST(tn + fp AS DOUBLE) AS recall,
          2e0 * tn / (2 * tn + fn + fp) AS f1, tn + fp AS support FROM c
          UNION ALL SELECT '1', tp / CAST(tp + fp AS DOUBLE), tp / CAST(tp + fn AS DOUBLE), 2e0 * tp / (2 * tp + fn + fp),
          tp + fn FROM c)
          SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM k
          UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
          CAST(sum(support) AS BIGINT) FROM k
          UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
          round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
          CAST(sum(support) AS BIGINT) FROM k""")
    ranked = RANKED.format("v_scores")
    r.add("roc_auc", "ML10", lambda t: rounded(m.roc_auc(t.scores, "y", "p"), ["roc_auc"]),
          f"""WITH {ranked} SELECT round(sum(neg * (tp - pos / 2e0)) / (max(np) * CAST(max(nn) AS DOUBLE)), 6) AS roc_auc
          FROM r""")
    r.add("roc_curve", "ML11", lambda t: rounded(m.roc_curve(t.scores, "y", "p"), ["threshold", "fpr", "tpr"]),
          f"""WITH {ranked} SELECT round(p, 6) AS threshold, round(fp / CAST(nn AS DOUBLE), 6) AS fpr,
          round(tp / CAST(np AS DOUBLE), 6) AS tpr FROM r""")
    r.add("pr_curve", "ML11", lambda t: rounded(m.pr_curve(t.scores, "y", "p"), ["threshold", "precision", "recall"]),
          f"""WITH {ranked} SELECT round(p, 6) AS threshold, round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision,
          round(tp / CAST(np AS DOUBLE), 6) AS recall FROM r""")
    r.add("cutoff_sweep", "ML12",
          lambda t: rounded(m.cutoff_sweep(t.scores, "y", "p"), ["accuracy", "sensitivity", "specificity"]),
          f"""WITH {SWEEP} SELECT cutoff, round(accuracy, 6) AS accuracy, round(sensitivity, 6) AS sensitivity,
          round(specificity, 6) AS specificity FROM sweep""")
    r.add("best_cutoff", "ML13",
          lambda t: rounded(m.best_cutoff(m.cutoff_sweep(t.scores, "y", "p")), ["accuracy", "sensitivity", "specificity"]),
          f"""WITH {SWEEP} SELECT cutoff, round(accuracy, 6) AS accuracy, round(sensitivity, 6) AS sensitivity,
          round(specificity, 6) AS specificity FROM sweep
          ORDER BY sensitivity + specificity DESC, sweep.sensitivity DESC, cutoff LIMIT 1""")
    cols = ["roc_auc", "accuracy", "precision", "recall"]
    r.add("compare_models", "ML14", lambda t: rounded(m.compare_models(rivals(t), "y", "p"), cols), COMPARED)
    r.add("select_best", "ML14", lambda t: rounded(m.select_best(m.compare_models(rivals(t), "y", "p")), cols),
          f"SELECT * FROM ({COMPARED}) ORDER BY roc_auc DESC, position LIMIT 1")
    r.add("regression_metrics", "ML15",
          lambda t: rounded(m.regression_metrics(price_lines(t), "y", "p"), ["r2", "rmse", "mae", "mse"], 2),
          f"""SELECT count(*) AS "rows", round(1 - avg((y - p) * (y - p)) / var_pop(y), 2) AS r2,
          round(sqrt(avg((y - p) * (y - p))), 2) AS rmse, round(avg(abs(y - p)), 2) AS mae,
          round(avg((y - p) * (y - p)), 2) AS mse FROM {LINES}""")
    r.add("residuals", "ML19", lambda t: rounded(m.residuals(price_lines(t), "y", "p"), ["residual"], 4),
          f"SELECT *, round(y - p, 4) AS residual FROM {LINES}")
    r.add("residual_shape", "ML19",
          lambda t: rounded(pf.shape_stats(m.residuals(price_lines(t), "y", "p"), ["residual"]),
                            ["skewness", "kurtosis", "lowest", "highest"], 4),
          f"""SELECT 'residual' AS "column", round(skewness(y - p), 4) AS skewness, round(kurtosis(y - p), 4) AS kurtosis,
          round(min(y - p), 4) AS lowest, round(max(y - p), 4) AS highest,
          CASE WHEN skewness(y - p) > 0.5 THEN 'right' WHEN skewness(y - p) < -0.5 THEN 'left' ELSE 'symmetric' END AS shape
          FROM {LINES}""")
    r.add("residual_histogram", "ML19",
          lambda t: rounded(pf.histogram(m.residuals(price_lines(t), "y", "p"), "residual", 30), ["lower_edge"], 4),
          f"""WITH s AS (SELECT min(y - p) AS lo, (max(y - p) - min(y - p)) / 30 AS w FROM {LINES}),
          b AS (SELECT least(floor((y - p - lo) / w), 29) AS bin, lo, w FROM {LINES}, s)
          SELECT CAST(bin AS INT) AS bin, round(any_value(lo) + any_value(w) * bin, 4) AS lower_edge, count(*) AS "rows"
          FROM b GROUP BY b.bin""")
    r.add("coef_table", "ML20,T2", lambda t: m.coef_table(slopes(t), 3),
          f"SELECT * FROM ({SLOPES}) ORDER BY abs(coefficient) DESC, feature LIMIT 3")
    r.add("zero_coefs", "ML20",
          lambda t: m.zero_coefs(slopes(t).withColumn("coefficient", F.when(F.abs("coefficient") > 500, F.col("coefficient")).otherwise(0.0))),
          f"SELECT feature FROM ({SLOPES}) WHERE NOT abs(coefficient) > 500")
    r.add("training_card", "ML21", card,
          f"""SELECT CASE WHEN t THEN 'test' ELSE 'train' END AS part, cardio AS class, count(*) AS "rows", 8 AS features
          FROM (SELECT cardio, row_number() OVER (PARTITION BY cardio ORDER BY {hash_sql("id")}, id)
          <= ceil(count(*) OVER (PARTITION BY cardio) * 0.2e0) AS t FROM v_vitals) GROUP BY 1, 2""")
