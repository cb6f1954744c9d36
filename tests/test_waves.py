"""The SVM on waves that are made anew in every pass, against Spark's on kept vectors."""

import numpy as np
import pytest
from pyspark.ml import classification as ml

from millrace.operators import models as md
from millrace.operators import waves as wv


@pytest.fixture(scope="module")
def ring(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 3))
    y = (x[:, 0] ** 2 + x[:, 1] + rng.normal(0, 0.3, 1500) > 0.7).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y, strict=True)], "a double, b double, c double, y int")
    return df.repartition(3).cache(), x, y, rng.normal(0, 0.8, (24, 3)), rng.uniform(0, 6.28, 24)


def test_least_loss_is_sparks(ring):
    df, x, y, weights, offsets = ring
    options = {"featuresCol": "waves", "labelCol": "y", "regParam": 0.01, "maxIter": 60, "tol": 1e-4, "rawPredictionCol": "margins"}
    kept = md.fourier_features(df, ["a", "b", "c"], weights, offsets).cache()
    z, side = np.sqrt(2 / 24) * np.cos(x @ weights.T + offsets), 2 * y - 1

    def loss(model):
        w = model.coefficients.toArray()
        return np.maximum(0, 1 - side * (z @ w + model.intercept)).mean() + 0.005 * ((w * z.std(0, ddof=1)) ** 2).sum()

    want, got = ml.LinearSVC(**options).fit(kept), md.LinearSVC(**options).fit_waves(df, ["a", "b", "c"], weights, offsets)
    assert loss(got) == pytest.approx(loss(want), rel=2e-3)
    both = [np.array([r["margins"][1] for r in m.transform(kept).select("margins").collect()]) for m in (want, got)]
    assert np.corrcoef(*both)[0, 1] > 0.999 and np.mean(np.sign(both[0]) == np.sign(both[1])) > 0.99


def test_no_vector_is_kept(ring, monkeypatch):
    """Spark's fit would keep 8 bytes a wave and row; the fit writes blocks of the raw columns and nothing else."""
    df, written, settle = ring[0], [], wv.settle
    monkeypatch.setattr(md, "KEPT", 0)
    monkeypatch.setattr(ml.LinearSVC, "_fit", lambda *_: pytest.fail("the vectors would be kept"))
    monkeypatch.setattr(wv, "settle", lambda d, *a: written.append(settle(d, *a)) or written[-1])
    model = md.fit_rff_svm(df, ["a", "b"], "y", d=24, max_iter=5)
    blocks = [(len(r["x"]), len(r["y"])) for r in written[0].collect()]
    assert len(written) == 1 and (sum(b[0] for b in blocks), sum(b[1] for b in blocks)) == (1500 * 2 * 8, 1500 * 8)
    assert model.transform(df).filter("prediction = y").count() > 1200
    assert [type(s).__name__ for s in model.model.stages] == ["LinearSVCModel", "VectorSlicer", "LogisticRegressionModel"]


def test_minimum_of_a_bowl():
    scale = np.array([1.0, 10.0, 100.0])
    found = wv.minimum(lambda x: (float(scale @ (x - 3) ** 2 + 1), 2 * scale * (x - 3)), np.zeros(3), 100, 1e-8)
    assert np.allclose(found, 3, atol=1e-3)


def test_labels_are_checked(ring):
    df, _, _, weights, offsets = ring
    with pytest.raises(ValueError, match="0 or 1"):
        md.LinearSVC(labelCol="y").fit_waves(df.withColumn("y", df["y"] + 1), ["a", "b", "c"], weights, offsets)
