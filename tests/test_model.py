"""J1-J5 properties: temporal split, penalised-loss gradient ~ 0 at the fitted solution, unseen state."""

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vigil.operators import model as M
from vigil.plans.features import FeaturePlan
from vigil.sources.catalog import Catalog


def test_fit_split_and_optimality(spark):
    data = FeaturePlan(Catalog(spark, "/root/testdata/sf0.01")).features()
    model, split, levels, n_train = M.fit(data)
    # split: no date on both sides, boundary is a distinct date
    b = split.groupBy("split").agg(F.min("prediction_date").alias("lo"), F.max("prediction_date").alias("hi")).collect()
    r = {x["split"]: x for x in b}
    assert r["train"]["hi"] < r["test"]["lo"]

    lr = model.stages[-1]
    assert lr.summary.totalIterations < M.MAX_ITER
    train = model.transform(split.where(F.col("split") == "train"))
    rows = train.select(vector_to_array("features").alias("x"), "label").collect()  # test-sized data only
    X = np.array([r["x"] for r in rows])
    y = np.array([r["label"] for r in rows])
    w = lr.coefficients.toArray()
    b0 = lr.intercept
    p = 1.0 / (1.0 + np.exp(-(X @ w + b0)))
    grad_w = M.C * X.T @ (p - y) + w
    grad_b = M.C * np.sum(p - y)
    scale = M.C * len(y)
    assert np.max(np.abs(grad_w)) / scale < 1e-4
    assert abs(grad_b) / scale < 1e-4
    assert len(w) == len(M.feature_names(levels))


def test_unknown_state_scores_like_reference_level(spark):
    data = FeaturePlan(Catalog(spark, "/root/testdata/sf0.001")).features()
    model, split, levels, _ = M.fit(data)
    one = split.where(F.col("split") == "test").limit(1)
    ref = one.withColumn("state", F.lit(levels[0]))
    unseen = one.withColumn("state", F.lit("NOWHERE"))
    s_ref = M.score(model, ref).first()["score"]
    s_new = M.score(model, unseen).first()["score"]
    assert abs(s_ref - s_new) < 1e-12
