"""Queries over fitted models: fits are iterative, so their oracles check what SQL can say of the result.

Each trains on the train split of the processed model matrix (derived from the
driver tables, materialised once per session) and scores the test split, with the
source's model parameters, by MLlib or by the joint engines (trees, linear models, perceptrons)
that the search uses.  The cross-validated baseline of all models is computed once per session
and input; the queries that rank, tune and combine models start from it.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F

from pyspark.ml.classification import LogisticRegression

from strata.functions.exprs import rounded
from strata.operators import evaluate, leakage, models, search, select, split
from strata.operators.linear import LinearFit, fit_linear
from strata.operators.trees import Matrix
from strata.plans import fixture as fx
from strata.plans.pipeline import model_matrix, run_pipeline
from strata.plans.queries import _split
from strata.session import scratch_path, shared_dir
from strata.sources import io
from strata.sources.tables import PROFILE_COUNTERS, input_state, read_table

ML_QUERIES: dict = {}


def _reg(name):
    def deco(fn):
        ML_QUERIES[name] = fn
        return fn
    return deco


def _data(spark, sf):
    df, feats = model_matrix(spark, sf)
    return df.where(F.col("split") == "train"), df.where(F.col("split") == "val"), \
        df.where(F.col("split") == "test"), feats


def _fit_score(spark, sf, name):
    train, _, test, feats = _data(spark, sf)
    est = models.base_models(len(feats), train.count())[name]
    pm = models.fit(est, train, feats)
    return models.score(pm, test, keep=[fx.KEY, "label"])


for _q, _m in (("logreg", "logistic_regression"), ("random_forest", "random_forest"),
               ("gbt", "gradient_boosting"), ("svm", "svm"), ("mlp", "neural_network"),
               ("naive_bayes", "naive_bayes")):
    ML_QUERIES[_q] = (lambda m: (lambda spark, sf: _fit_score(spark, sf, m)))(_m)

_BASELINE: dict = {}
_MATRICES: dict = {}


def _matrix(spark, sf):
    """The training rows as blocks, once per session and input."""
    key = input_state(spark, sf)
    if key not in _MATRICES:
        train, _, _, feats = _data(spark, sf)
        _MATRICES[key] = Matrix.build(train, feats, fx.KEY)
    return _MATRICES[key]


def _baseline(spark, sf):
    """(rows of the baseline table, best first; fitted models) of all models; the same whatever ran before."""
    key = input_state(spark, sf)
    if key not in _BASELINE:
        table, fitted = search.baseline(_matrix(spark, sf), _data(spark, sf)[1])
        _BASELINE[key] = table.collect(), fitted
    return _BASELINE[key]


def _top(spark, sf):
    return [r["model"] for r in _baseline(spark, sf)[0] if r["cv_auc_mean"] is not None][:search.TUNED]


def _fit_joint(spark, sf, name):
    """The source's parameters, fitted by the engines that also serve the search."""
    model = search.fitted(_matrix(spark, sf), {name: search.MODELS[name]})[name]
    return search.scored_rows(model, _data(spark, sf)[2], [fx.KEY, "label"])


for _q, _m in (("extra_trees", "extra_trees"), ("xgboost", "xgboost")):
    ML_QUERIES[_q] = (lambda m: (lambda spark, sf: _fit_joint(spark, sf, m)))(_m)


@_reg("svm_poly")
def q_svm_poly(spark, sf):
    """M5 with a polynomial kernel, and probabilities by cross-fitted calibration."""
    model = search.fitted(_matrix(spark, sf), {"svm": {"C": 1.0, "kernel": "poly", "gamma": "scale"}})["svm"]
    return search.scored_rows(model, _data(spark, sf)[2], [fx.KEY, "label"])


@_reg("mlp_adam")
def q_mlp_adam(spark, sf):
    """M7 by mini-batch Adam with early stopping."""
    return _fit_joint(spark, sf, "neural_network")


@_reg("mlp_early_stop")
def q_mlp_early_stop(spark, sf):
    """M7 as configured by the source: (100, 50) hidden units, early stopping on a 10 % hold-out."""
    train, _, test, feats = _data(spark, sf)
    pm, _, _ = models.fit_mlp_early_stopping(train, feats, fx.KEY)
    return models.score(pm, test, keep=[fx.KEY, "label"])


@_reg("svm_rbf")
def q_svm_rbf(spark, sf):
    """M5 with an approximate RBF kernel (random Fourier features + linear SVM)."""
    train, _, test, feats = _data(spark, sf)
    model, fmap = models.fit_rbf_svm(train, feats, n_components=100)
    return models.score_rbf_svm(model, fmap, test, keep=[fx.KEY, "label"])


@_reg("svm_search")
def q_svm_search(spark, sf):
    """N4 for M5: all points of its space, best first."""
    cv = search.cross_validated(_matrix(spark, sf), [("svm", p) for p in search.grid("svm")])
    rows = [(p["kernel"], str(p["gamma"]), p["C"], sum(a) / len(a)) for p, a in ((json.loads(k[1]), a) for k, a in cv.items())]
    return spark.createDataFrame(sorted(rows, key=lambda r: -r[3]), "kernel string, gamma string, c double, cv_auc double")


@_reg("baseline_cv")
def q_baseline_cv(spark, sf):
    return spark.createDataFrame(_baseline(spark, sf)[0], "model string, cv_auc_mean double, cv_auc_std double, val_accuracy double, "
                                                          "val_auc double, val_f1 double")


@_reg("model_checks")
def q_model_checks(spark, sf):
    """Every model scores each test row once, its prediction follows its score (probability above
    one half), and it ranks better than chance."""
    _, _, test, _ = _data(spark, sf)
    out = None
    for name, model in sorted(search.fitted(_matrix(spark, sf), search.MODELS).items()):
        scored = search.scored_rows(model, test, [fx.KEY, "label"])
        follows = (F.abs(F.col("score") - 0.5) < 1e-12) | ((F.col("score") > 0.5) == (F.col("pred") == 1))
        in_range = F.col("score").between(0, 1)
        row = scored.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_test"), F.count_distinct(fx.KEY).alias("n_keys"),
                         F.every(follows).alias("pred_follows"), F.every(in_range).alias("in_range"))
        better = evaluate.roc_auc(scored).select((F.col("roc_auc") > 0.6).alias("better_than_chance"))
        row = row.withColumn("better_than_chance", F.lit(bool(better.first()[0])))
        out = row if out is None else out.unionByName(row)
    return out


def _searched(spark, sf):
    """Random search of the best models of the baseline. The journal lies in the shared folder, by input, so a search
    that was cut off goes on where it stood."""
    journal = f"{shared_dir(spark).rstrip('/')}/strata/journal-{hashlib.md5(repr(input_state(spark, sf)).encode()).hexdigest()}"
    return search.search(_matrix(spark, sf), _top(spark, sf), journal=journal)


@_reg("tune")
def q_tune(spark, sf):
    rows = [(name, param, str(value), auc) for name, (params, auc) in _searched(spark, sf).items() for param, value in (params or {}).items()]
    return spark.createDataFrame(rows, "model string, param string, value string, cv_auc double")


@_reg("best_model")
def q_best_model(spark, sf):
    """The tuned models on the validation rows."""
    models = search.tuned(_matrix(spark, sf), _searched(spark, sf), _baseline(spark, sf)[1])
    best, metrics = search.select_best(models, _data(spark, sf)[1])
    return metrics.withColumn("is_best", F.col("model") == F.lit(best))


@_reg("soft_vote")
def q_soft_vote(spark, sf):
    models = _baseline(spark, sf)[1]
    return search.soft_vote({n: models[n] for n in _top(spark, sf)}, _data(spark, sf)[2], fx.KEY)


@_reg("importance")
def q_importance(spark, sf):
    train, _, _, feats = _data(spark, sf)
    pm = models.fit(models.base_models(len(feats), train.count())["random_forest"], train, feats)
    return models.importances(pm, feats, top=15, spark=spark)


@_reg("leakage_check")
def q_leakage_check(spark, sf):
    train, _, _, feats = _data(spark, sf)
    return leakage.validate_no_leakage(train, feats, fx.KEY)


@_reg("pca")
def q_pca(spark, sf):
    emb = read_table(spark, sf, "embeddings")
    bundle, _ = select.pca_fit(emb, vector_col="embedding", variance=0.95)
    return select.pca_apply(emb, bundle, keep=["vec_id", "label"])


@_reg("pca_explained")
def q_pca_explained(spark, sf):
    _, explained = select.pca_fit(read_table(spark, sf, "embeddings"), vector_col="embedding", variance=0.95)
    return explained


@_reg("model_registry")
def q_model_registry(spark, sf):
    train, _, test, feats = _data(spark, sf)
    pm = models.fit(models.base_models(len(feats), train.count())["logistic_regression"], train, feats)
    base = scratch_path(spark, "registry")
    models.save_model(pm, f"{base}/m1", f"{base}/registry", "logistic_regression", len(feats), spark)
    loaded = models.load_model(spark, registry=f"{base}/registry")
    return models.score(loaded, test, keep=[fx.KEY, "label"])


# ---- fits that SQL can check -------------------------------------------------------------------

def _scaled(spark, sf):
    """The profile's split with SCALE_COLS standardised by the train rows."""
    df = _split(spark, sf)
    return split.apply_standard(df, split.fit_standard(df.where("split = 'train'"), fx.SCALE_COLS))


@_reg("logreg_optimum")
def q_logreg_optimum(spark, sf):
    """M1: at the optimum the mean of each feature times the score, plus the penalty's slope, is the mean of the feature
    times the label; so it is for the offset, which has no penalty."""
    train = _scaled(spark, sf).where("split = 'train'").select(fx.KEY, "label", *fx.SCALE_COLS)
    n = train.count()
    est = LogisticRegression(maxIter=1000, regParam=1.0 / n, tol=1e-10, elasticNetParam=0.0, standardization=False)
    mllib = models.fit(est, train, fx.SCALE_COLS)
    joint = fit_linear(Matrix.build(train, fx.SCALE_COLS, fx.KEY, fold=None), [LinearFit("logistic", 1.0)])[0]
    both = {"mllib": (models.score(mllib, train, keep=fx.SCALE_COLS), list(mllib.stages[-1].coefficients.toArray())),
            "joint": (search.scored_rows(joint, train, fx.SCALE_COLS), joint.weights)}
    out = None
    for engine, (scored, weights) in both.items():
        terms = [("offset", F.lit(1.0), 0.0), *((c, F.col(c), float(w)) for c, w in zip(fx.SCALE_COLS, weights))]
        moments = scored.agg(*((F.avg(x * F.col("score")) + w / n).alias(c) for c, x, w in terms))
        rows = moments.unpivot([], [c for c, _, _ in terms], "term", "moment").select(F.lit(engine).alias("engine"), "term", F.round("moment", 4).alias("moment"))
        out = rows if out is None else out.unionByName(rows)
    return out


@_reg("naive_bayes_joint")
def q_naive_bayes_joint(spark, sf):
    """M6 by the joint engine's sums."""
    df = _split(spark, sf)
    model = search.fit_bayes(Matrix.build(df.where("split = 'train'"), fx.NB_FEATURES, fx.KEY, fold=None), [-1])[0]
    return rounded(search.scored_rows(model, df.where("split = 'test'"), [fx.KEY]))


@_reg("leakage_parts")
def q_leakage_parts(spark, sf):
    """V1 on the profile's counters: the label is made of some of them, so the check finds it; the forest's AUC as a yes."""
    found = leakage.validate_no_leakage(_split(spark, sf).where("split = 'train'"), PROFILE_COUNTERS, fx.KEY)
    return found.select("dummy_auc", F.round("max_correlation", 6).alias("max_correlation"), "top_feature",
                        F.col("rf_auc").between(0.6, 1).alias("better_than_chance"),
                        (F.col("leakage_suspected") == ((F.col("rf_auc") > 0.95) | (F.col("max_correlation") > 0.9))).alias("flag_follows"))


@_reg("pca_checks")
def q_pca_checks(spark, sf):
    """the components' variances add up to the columns', their squares to the squared covariances; the ratios are
    theirs, the components are uncorrelated, and the kept ones are the fewest that reach 95 %."""
    emb = read_table(spark, sf, "embeddings")
    bundle, explained = select.pca_fit(emb, vector_col="embedding", variance=0.95)
    table = explained.orderBy(F.substring("component", 3, 9).cast("int")).collect()  # a row per column
    p, k = len(table), bundle["k"]
    scored = select.pca_apply(emb, bundle | {"k": p}, keep=["vec_id"])
    row = scored.agg(F.count(F.lit(1)), *(F.var_samp(f"PC{i + 1}") for i in range(p)), *(F.covar_samp(f"PC{i}", f"PC{i + 1}") for i in range(1, p))).first()
    variances, total = row[1:p + 1], sum(row[1:p + 1])
    ratios = [r["explained_ratio"] for r in table]
    result = (row[0], p, round(total, 4), round(sum(v * v for v in variances), 4),
              all(abs(v / total - r) < 1e-6 for v, r in zip(variances, ratios)), all(abs(c) < 1e-6 * total for c in row[p + 1:]),
              sum(ratios[:k]) >= 0.95 - 1e-9 and sum(ratios[:k - 1]) < 0.95, [r["kept"] for r in table] == [i < k for i in range(p)])
    return spark.createDataFrame([result], "n bigint, n_components int, total_variance double, squared_variance double, ratios_follow boolean, "
                                           "uncorrelated boolean, fewest boolean, kept_first boolean")


@_reg("registry_checks")
def q_registry_checks(spark, sf):
    """Of two models saved the newer one is loaded, and it gives every test row the score of the model saved."""
    df = _scaled(spark, sf)
    train, test = df.where("split = 'train'"), df.where("split = 'test'")
    base, cols = scratch_path(spark, "registry"), fx.SCALE_COLS
    older = models.fit(models.base_models(len(cols), fast=True)["naive_bayes"], train, cols)
    newer = models.fit(models.base_models(len(cols), train.count())["logistic_regression"], train, cols)
    for i, (name, model) in enumerate((("naive_bayes", older), ("logistic_regression", newer))):
        models.save_model(model, f"{base}/m{i}", f"{base}/registry", name, len(cols), spark)
    matrix = Matrix.build(train, cols, fx.KEY, fold=None)
    joint = [fit_linear(matrix, [LinearFit("logistic", 1.0)])[0], search.fit_bayes(matrix, [-1])[0]]
    for name, model in zip(("logistic_regression", "naive_bayes"), joint):
        search.save(model, f"{base}/joint-{name}", f"{base}/joint", name, spark)
    scores = {"mllib": [models.score(m, test, keep=[fx.KEY]) for m in (newer, models.load_model(spark, registry=f"{base}/registry"))],
              "joint": [search.scored_rows(m, test, [fx.KEY]) for m in (joint[-1], search.load(spark, f"{base}/joint"))]}
    out = None
    for engine, registry in (("mllib", "registry"), ("joint", "joint")):
        saved, loaded = scores[engine]
        same = saved.join(loaded.select(fx.KEY, F.col("score").alias("again")), fx.KEY).agg(
            F.count(F.lit(1)).alias("n_test"), F.count_if(F.col("score") == F.col("again")).alias("n_same"))
        newest = spark.read.json(f"{base}/{registry}").groupBy().agg(
            F.max_by("model_name", "training_date").alias("model_name"), F.max_by("features_count", "training_date").cast("int").alias("features_count"),
            F.count(F.lit(1)).alias("n_models")).first()
        row = same.select(F.lit(engine).alias("engine"), *(F.lit(newest[c]).alias(c) for c in ("model_name", "features_count")),
                          F.lit(newest["n_models"]).cast("bigint").alias("n_models"), "n_test", "n_same")
        out = row if out is None else out.unionByName(row)
    return out


@_reg("eda_json")
def q_eda_json(spark, sf):
    from strata.plans import eda_report
    from strata.plans.queries import _hybrid
    summary = eda_report.summary_nested(_hybrid(spark, sf).drop("score"), "label", fx.OUTLIER_VARS)
    path = io.write_json_row(summary, "eda_summary")
    back = spark.read.schema(summary.schema).json(path)
    return rounded(back.select(*[c for c in back.columns if c != "recommendations"], "recommendations.*"))


@_reg("stage_report")
def q_stage_report(spark, sf):
    return run_pipeline(spark, sf, steps=("collect", "preprocess", "features", "model", "evaluate"))
