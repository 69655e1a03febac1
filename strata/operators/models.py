"""Binary classifiers on MLlib (M1-M9), their cross-validation and search spaces, feature importance (E10) and the
model registry (S8-S10). The search over many candidates (N1-N6) is in :mod:`strata.operators.search`.

Training data stays a DataFrame ``(key, label, features..., fold)``; MLlib
distributes the fits.  Scores are ``probability[1]`` when the model has one,
else the raw margin (``rawPrediction[1]``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = 42
PARTITION_BYTES = 32 << 20  # training data (rows x features as doubles) per partition, at most
SPREAD_BYTES = 1 << 20  # from so many per partition on, an iteration's work outweighs its tasks: all cores share it


def right_size(df: DataFrame, n_features: int, n_rows: int | None = None) -> DataFrame:
    """Partitions of at most ``PARTITION_BYTES`` of training data, and one per core as long as each has ``SPREAD_BYTES``.

    Iterative solvers run a job per iteration or tree level; on small inputs the
    per-task overhead dominates, so partitions are merged.  Larger inputs that lie in
    few partitions are dealt out once (Spark orders the rows first, so the deal is
    the same each time), or most cores would be idle in every iteration.
    """
    import math
    n = df.count() if n_rows is None else n_rows
    size = n * (n_features + 1) * 8
    want = max(1, math.ceil(size / PARTITION_BYTES), min(df.sparkSession.sparkContext.defaultParallelism, size // SPREAD_BYTES))
    have = df.rdd.getNumPartitions()
    return df.coalesce(want) if want < have else df.repartition(want) if want > have else df


# Fixed values (source models): logistic regression C = 1, max_iter 1000; random forest 100 trees,
# depth 10; boosting 100 rounds, learning rate .1, depth 6; extra trees 100 trees, depth 10;
# SVC C = 1; perceptron hidden (100, 50), max_iter 500; seed 42.
def base_models(n_features: int, n_rows: int | None = None, fast: bool = False) -> dict:
    """M1-M8 as MLlib estimators (``fast`` shrinks iteration counts for smoke runs)."""
    trees = 20 if fast else 100
    it = 20 if fast else 100
    c = 1.0
    reg = 1.0 / (c * n_rows) if n_rows else 0.0
    models = {
        # tol 1e-4 (the liblinear default): same AUC as 1e-6 in ~half the L-BFGS passes
        "logistic_regression": LogisticRegression(maxIter=100 if fast else 1000, regParam=reg, tol=1e-4,
                                                  elasticNetParam=0.0, standardization=False),
        "random_forest": RandomForestClassifier(numTrees=trees, maxDepth=10, seed=SEED),
        "gradient_boosting": GBTClassifier(maxIter=it, stepSize=0.1, maxDepth=6 if not fast else 4, seed=SEED),
        # MLlib has no random-threshold splitter: no bootstrap + sqrt features + coarse bins approximates it
        "extra_trees": RandomForestClassifier(numTrees=trees, maxDepth=10, bootstrap=False,
                                              featureSubsetStrategy="sqrt", maxBins=8, seed=SEED),
        # linear SVM on scaled features, C = 1; kernels: svm_search; scores are margins, calibrated for votes
        "svm": LinearSVC(regParam=reg, maxIter=100, tol=1e-4),
        "naive_bayes": NaiveBayes(modelType="gaussian"),
        "neural_network": MultilayerPerceptronClassifier(layers=[n_features, 100, 50, 2],
                                                         maxIter=50 if fast else 500, seed=SEED, tol=1e-4),
        # stands in for the optional external booster: boosted trees with row and column sampling and a least gain
        "xgboost": GBTClassifier(maxIter=it, stepSize=0.1, maxDepth=6 if not fast else 4, subsamplingRate=0.8,
                                 featureSubsetStrategy="0.8", minInfoGain=1e-4, seed=SEED),
    }
    return models


def rbf_feature_map(df: DataFrame, features: Sequence[str], n_components: int = 100,
                    gamma: float | str = "scale", seed: int = SEED) -> dict:
    """M5 kernel: random Fourier features approximating the RBF kernel (Rahimi & Recht, 2007).

    ``z(x) = sqrt(2/D) * cos(x W + b)`` with ``W ~ N(0, 2 gamma)`` (p x D), ``b ~ U(0, 2 pi)``.
    ``gamma='scale'`` is ``1 / (p * var(X))`` (variance over all feature values), one aggregate.
    The p x D projection is bounded by the schema (not the data) and drawn from a
    seeded generator; applying it is a matrix product per Arrow batch (see :func:`apply_rbf_map`).
    """
    import math

    import numpy as np
    p = len(features)
    if gamma == "scale":
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(features)],
                     *[F.avg(F.col(c).cast("double") ** 2).alias(f"q{i}") for i, c in enumerate(features)]).first()
        mean = sum(row[f"m{i}"] or 0.0 for i in range(p)) / p
        var = sum(row[f"q{i}"] or 0.0 for i in range(p)) / p - mean * mean
        gamma = 1.0 / (p * var) if var > 0 else 1.0
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * float(gamma)), size=(p, n_components))
    b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)
    return {"features": list(features), "w": w, "b": b, "names": [f"rff_{k}" for k in range(n_components)]}


def apply_rbf_map(df: DataFrame, fmap: dict, keep: Sequence[str] = ()) -> DataFrame:
    """Random Fourier features per Arrow batch: ``sqrt(2/D) cos(X W + b)`` (vectorised numpy)."""
    import numpy as np
    feats, w, b, names = fmap["features"], fmap["w"], fmap["b"], fmap["names"]
    scale = float(np.sqrt(2.0 / len(names)))
    keep = list(keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in keep]
                       + [f"{n} double" for n in names])

    def project(batches):
        import pandas as pd
        for pdf in batches:
            x = pdf[feats].to_numpy(dtype="float64")
            z = scale * np.cos(x @ w + b)
            out = pd.DataFrame(z, columns=names, index=pdf.index)
            yield pd.concat([pdf[keep], out], axis=1) if keep else out

    return df.select(*keep, *feats).mapInPandas(project, schema)


def fit_rbf_svm(train: DataFrame, features: Sequence[str], n_components: int = 100, reg: float = 0.01,
                label: str = "label", seed: int = SEED):
    """M5 (rbf): LinearSVC on random Fourier features; returns (model, feature map)."""
    fmap = rbf_feature_map(train, features, n_components, seed=seed)
    mapped = apply_rbf_map(train, fmap, keep=[label])
    model = fit(LinearSVC(regParam=reg, maxIter=100, tol=1e-4), mapped, fmap["names"], label)
    return model, fmap


def score_rbf_svm(model, fmap: dict, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return score(model, apply_rbf_map(df, fmap, keep=keep), keep=keep)


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def fit(estimator, df: DataFrame, features: Sequence[str], label: str = "label") -> PipelineModel:
    """Assemble once, persist the (features, label) pairs for the iterative solver, fit, release."""
    est = estimator.copy().setFeaturesCol("features").setLabelCol(label)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    data = assembler.transform(right_size(df, len(features))).select("features", F.col(label).cast("double").alias(label))
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = est.fit(data)
    finally:
        data.unpersist()
    return PipelineModel(stages=[assembler, model])


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., score, pred)``: probability of class 1, else the raw margin."""
    out = model.transform(df)
    cols = out.columns
    if "probability" in cols:
        s = vector_to_array("probability")[1]
    else:
        s = vector_to_array("rawPrediction")[1]
    return out.select(*keep, s.alias("score"), F.col("prediction").cast("int").alias("pred"))


def fit_mlp_early_stopping(train: DataFrame, features: Sequence[str], key: str, hidden: Sequence[int] = (100, 50),
                           label: str = "label", max_iter: int = 500, step: int = 5, patience: int = 10,
                           tol: float = 1e-4, validation_fraction: float = 0.1, seed: int = SEED):
    """M7 with early stopping: hold out a hashed ``validation_fraction`` of the training rows,
    train in chunks of ``step`` iterations continuing from the previous weights
    (``initialWeights``), score validation accuracy after each chunk, stop once it has
    not improved by ``tol`` for ``patience`` iterations, and keep the best weights.
    Returns ``(PipelineModel, iterations_run, best_validation_accuracy)``.
    """
    from strata.functions.hashing import md5_uniform
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    u = md5_uniform(key, seed, "early_stop")
    data = assembler.transform(right_size(train, len(features)).withColumn("_u", u)).select(
        "features", F.col(label).cast("double").alias(label), "_u")
    fit_part = data.where(F.col("_u") >= validation_fraction).drop("_u").persist(StorageLevel.MEMORY_AND_DISK)
    val_part = data.where(F.col("_u") < validation_fraction).drop("_u").persist(StorageLevel.MEMORY_AND_DISK)
    layers = [len(features), *hidden, 2]
    best, best_model, stale, done, weights = -1.0, None, 0, 0, None
    try:
        while done < max_iter:
            est = MultilayerPerceptronClassifier(layers=layers, maxIter=step, seed=seed, labelCol=label)
            if weights is not None:
                est = est.setInitialWeights(weights)
            m = est.fit(fit_part)
            done += step
            acc = m.transform(val_part).agg(F.avg((F.col("prediction") == F.col(label)).cast("double"))).first()[0]
            if acc is not None and acc > best + tol:
                best, best_model, stale = acc, m, 0
            else:
                stale += step
                if stale >= patience:
                    break
            weights = m.weights
    finally:
        fit_part.unpersist()
        val_part.unpersist()
    return PipelineModel(stages=[assembler, best_model]), done, best


def dummy_most_frequent(train: DataFrame, df: DataFrame, label: str = "label",
                        keep: Sequence[str] = ()) -> DataFrame:
    """M9: constant prediction = the training mode (ties -> smaller class); constant score."""
    mode = (train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), label).first()[label])
    return df.select(*keep, F.lit(float(mode)).alias("score"), F.lit(int(mode)).alias("pred"))


def gaussian_nb_fit(train: DataFrame, features: Sequence[str], label: str = "label",
                    var_smoothing: float = 1e-9) -> DataFrame:
    """M6 in SQL form: per-class prior, mean and variance (+ smoothing * max variance).

    Output long ``(label, feature, mean, var, prior)`` -- (classes x features) rows.
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(features):
        aggs += [F.avg(c).alias(f"_m{i}"), F.var_pop(c).alias(f"_v{i}")]
    per = train.groupBy(label).agg(*aggs)
    body = ", ".join(f"'{c}', _m{i}, _v{i}" for i, c in enumerate(features))
    long = per.selectExpr(label, "_n", f"stack({len(features)}, {body}) as (feature, mean, var)")
    overall = train.agg(*[F.var_pop(c).alias(f"_v{i}") for i, c in enumerate(features)]).first()
    eps = var_smoothing * max([overall[f"_v{i}"] or 0.0 for i in range(len(features))] + [0.0])
    n_all = train.count()
    return long.select(label, "feature", "mean", (F.col("var") + F.lit(eps)).alias("var"),
                       (F.col("_n") / F.lit(float(n_all))).alias("prior"))


def gaussian_nb_score(df: DataFrame, params: DataFrame, key: str, features: Sequence[str],
                      label: str = "label") -> DataFrame:
    """Posterior P(class 1 | x) from the fitted table; parameters are inlined (bounded: classes x features)."""
    import math
    rows = params.collect()
    by = {}
    for r in rows:
        by.setdefault(r[label], {})[r["feature"]] = (r["mean"], r["var"], r["prior"])
    jll = {}
    for cls, fe in by.items():
        prior = next(iter(fe.values()))[2]
        e = F.lit(math.log(prior))
        for c in features:
            m, v, _ = fe[c]
            e = e - F.lit(0.5 * math.log(2 * math.pi * v)) - (F.col(c) - F.lit(m)) ** 2 / F.lit(2 * v)
        jll[cls] = e
    j0, j1 = jll[0], jll[1]
    mx = F.greatest(j0, j1)
    p1 = F.exp(j1 - mx) / (F.exp(j0 - mx) + F.exp(j1 - mx))
    return df.select(key, p1.alias("score"), (j1 > j0).cast("int").alias("pred"))


def cross_validate(estimator, train: DataFrame, features: Sequence[str], label: str = "label",
                   fold_col: str = "fold", grid=None, parallelism: int = 4, num_folds: int | None = None):
    """K-fold AUC via ``CrossValidator(foldCol=...)``; returns (cv_model, mean, std).

    Folds are the precomputed stratified ``fold_col`` (0..k-1); k is read from it if not given.
    """
    if num_folds is None:
        num_folds = int(train.agg(F.max(fold_col)).first()[0]) + 1
    est = estimator.copy().setFeaturesCol("features").setLabelCol(label)
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC",
                                              rawPredictionCol="rawPrediction", numBins=0)
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid or [{}], evaluator=evaluator,
                        foldCol=fold_col, numFolds=num_folds, parallelism=parallelism, seed=SEED,
                        collectSubModels=False)
    data = assemble(right_size(train, len(features)), features).withColumn(fold_col, F.col(fold_col).cast("int"))
    m = cv.fit(data)
    return m, list(m.avgMetrics), list(m.stdMetrics)


# The source's search spaces, mapped onto MLlib parameters.
#   random forest: n_estimators 50/100/200, max_depth 5/10/15/None, min_samples_leaf 1/2/4
#   boosting: n_estimators 50/100/200, learning_rate .05/.1/.2, max_depth 3/5/7, subsample .8/.9/1
#   (the optional booster adds colsample_bytree .8/.9/1)
#   logistic regression: C .1/1/10/100, penalty l1/l2;  SVM: C .1/1/10
#   neural network: hidden (50), (100), (100, 50), (150, 75); learning_rate_init .001/.01/.1
# No MLlib counterpart: min_samples_split, solver, alpha, kernels (search.SPACES has these axes).
UNLIMITED_DEPTH = 30  # MLlib's maximum tree depth stands for "no limit"


def param_grid(name: str, est, n_rows: int | None = None, n_features: int | None = None):
    """The search space of a model as MLlib ParamMaps (C -> regParam = 1 / (C * n))."""
    b = ParamGridBuilder()
    n = float(n_rows or 1)
    if name in ("random_forest", "extra_trees"):
        b = (b.addGrid(est.numTrees, [50, 100, 200]).addGrid(est.maxDepth, [5, 10, 15, UNLIMITED_DEPTH])
             .addGrid(est.minInstancesPerNode, [1, 2, 4]))
    elif name in ("gradient_boosting", "xgboost"):
        b = (b.addGrid(est.maxIter, [50, 100, 200]).addGrid(est.stepSize, [0.05, 0.1, 0.2])
             .addGrid(est.maxDepth, [3, 5, 7]).addGrid(est.subsamplingRate, [0.8, 0.9, 1.0]))
        if name == "xgboost":
            b = b.addGrid(est.featureSubsetStrategy, ["0.8", "0.9", "1.0"])
    elif name == "logistic_regression":
        b = (b.addGrid(est.regParam, [1.0 / (c * n) for c in (0.1, 1.0, 10.0, 100.0)])
             .addGrid(est.elasticNetParam, [1.0, 0.0]))
    elif name == "svm":
        b = b.addGrid(est.regParam, [1.0 / (c * n) for c in (0.1, 1.0, 10.0)])
    elif name == "neural_network":
        p = n_features or est.getLayers()[0]
        # only gradient descent has a step size; the default L-BFGS would ignore that axis
        b = (b.addGrid(est.layers, [[p, 50, 2], [p, 100, 2], [p, 100, 50, 2], [p, 150, 75, 2]])
             .addGrid(est.stepSize, [0.001, 0.01, 0.1]).addGrid(est.solver, ["gd"]))
    else:
        return []
    return b.build()


def importances(model: PipelineModel, features: Sequence[str], top: int = 15, spark=None) -> DataFrame:
    """Tree importances or |coefficients|; top n. Unsupported models give an empty frame."""
    est = model.stages[-1]
    vals = None
    if hasattr(est, "featureImportances"):
        vals = list(est.featureImportances.toArray())
    elif hasattr(est, "coefficients"):
        vals = [abs(x) for x in est.coefficients.toArray()]
    spark = spark or SparkSession.getActiveSession()
    rows = [] if vals is None else [(f, float(v)) for f, v in zip(features, vals)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(top)


# ---- registry (S8-S10) ------------------------------------------------------------------------

def save_model(model: PipelineModel, path: str, registry: str, name: str, n_features: int, spark) -> None:
    """Save the pipeline model and append one metadata row to the registry table."""
    model.write().overwrite().save(path)
    meta = spark.createDataFrame([(name, type(model.stages[-1]).__name__, n_features,
                                   _dt.datetime.now(_dt.timezone.utc).isoformat(), path)],
                                 "model_name string, model_type string, features_count int, "
                                 "training_date string, path string")
    meta.write.mode("append").json(registry)


def load_model(spark, path: str | None = None, registry: str | None = None) -> PipelineModel:
    """Explicit path, else the newest registry entry (``max_by(path, training_date)``)."""
    if path is None:
        if registry is None:
            raise ValueError("need a model path or a registry")
        path = spark.read.json(registry).agg(F.max_by("path", "training_date").alias("p")).first()["p"]
    return PipelineModel.load(path)
