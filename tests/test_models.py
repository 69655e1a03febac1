from pyspark.sql import functions as F

from strata.operators import evaluate, models, split


def _data(spark, planted):
    df = spark.range(600).selectExpr("id AS k", "rand(1) AS x1", "rand(2) AS x2", "rand(3) AS x3")
    lab = (F.col("x1") + 0.5 * F.col("x2") > 0.75) if planted else (F.rand(9) > 0.5)
    df = df.withColumn("label", lab.cast("int"))
    df = split.assign_split(df, "k", "label", exact=True)
    tr = split.assign_folds(df.where("split = 'train'"), "k", "label", k=3)
    return tr, df.where("split != 'train'")


def test_planted_signal_and_random_label(spark):
    feats = ["x1", "x2", "x3"]
    for planted, lo, hi in ((True, 0.8, 1.01), (False, 0.3, 0.7)):
        tr, te = _data(spark, planted)
        est = models.base_models(3, fast=True)["logistic_regression"]
        auc = evaluate.roc_auc(models.score(models.fit(est, tr, feats), te, keep=["label"])).first()["roc_auc"]
        assert lo <= auc <= hi


def test_cv_same_seed_same_metrics(spark):
    tr, _ = _data(spark, True)
    est = models.base_models(3, fast=True)["random_forest"]
    _, m1, _ = models.cross_validate(est, tr, ["x1", "x2", "x3"])
    _, m2, _ = models.cross_validate(est, tr, ["x1", "x2", "x3"])
    assert m1 == m2 and m1[0] > 0.8


def test_search_space_sizes(spark):
    ms = models.base_models(10, 1000)
    sizes = {n: len(models.param_grid(n, ms[n], 1000, 10)) for n in
             ("random_forest", "gradient_boosting", "xgboost", "logistic_regression", "svm", "neural_network",
              "naive_bayes")}
    assert sizes == {"random_forest": 36, "gradient_boosting": 81, "xgboost": 243, "logistic_regression": 8,
                     "svm": 3, "neural_network": 12, "naive_bayes": 0}
    lr = models.param_grid("logistic_regression", ms["logistic_regression"], 1000, 10)
    regs = sorted({pm[ms["logistic_regression"].regParam] for pm in lr})
    assert regs == sorted(1.0 / (c * 1000) for c in (0.1, 1.0, 10.0, 100.0))


def test_rbf_features_approximate_kernel(spark):
    import math

    import numpy as np
    df = spark.createDataFrame([(0, 0.1, 0.2), (1, 0.3, -0.1), (2, 1.0, 0.5)], "k int, a double, b double")
    fmap = models.rbf_feature_map(df, ["a", "b"], n_components=4000, gamma=0.5, seed=3)
    rows = sorted(models.apply_rbf_map(df, fmap, keep=["k"]).collect(), key=lambda r: r["k"])
    z = np.array([[r[n] for n in fmap["names"]] for r in rows])
    pts = [(0.1, 0.2), (0.3, -0.1), (1.0, 0.5)]
    for i in range(3):
        for j in range(3):
            d2 = sum((x - y) ** 2 for x, y in zip(pts[i], pts[j]))
            assert abs(z[i] @ z[j] - math.exp(-0.5 * d2)) < 0.06


def test_mlp_early_stopping_stops_and_scores(spark):
    tr, te = _data(spark, True)
    pm, iters, best = models.fit_mlp_early_stopping(tr, ["x1", "x2", "x3"], "k", hidden=(8,), max_iter=200,
                                                    step=5, patience=10)
    assert iters < 200 and 0.5 < best <= 1.0
    auc = evaluate.roc_auc(models.score(pm, te, keep=["label"])).first()["roc_auc"]
    assert auc > 0.8


def test_no_query_makes_the_session_unserializable():
    """Once a session has observed a metric, MLlib models that keep a training summary can't be applied in it."""
    from pathlib import Path
    root = Path(models.__file__).resolve().parents[1]
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and ".observe(" in p.read_text()]


def test_training_rows_are_shared_out_to_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    assert models.right_size(spark.range(0, 50_000, 1, 1), 29).rdd.getNumPartitions() == cores
    assert models.right_size(spark.range(0, 2_000, 1, 6), 29).rdd.getNumPartitions() == 1
    assert models.right_size(spark.range(0, 50_000, 1, 40), 29).rdd.getNumPartitions() == cores
