"""Model selection (N1-N6, V1's forest): cross-validation of many candidates on shared passes.

A candidate is a model's name and its parameters.  All folds of all candidates of a family are fitted together
(:mod:`trees`, :mod:`linear`, :mod:`perceptron`), and candidates that are views of one fit share it: forests that
differ in the number of trees, depth or smallest split, boosted ensembles that differ in the number of rounds.  Their
AUCs come from one table of held-out scores.  With a ``journal`` every (model, parameters, fold) that is done is added
to a table in the shared folder, family by family; a search that starts again reads it and fits what is missing.
"""

from __future__ import annotations

import json
import random
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.evaluate import binary_metrics, grouped_auc, roc_auc
from strata.operators.linear import Kernel, LinearFit, LinearModel, fit_linear, fit_sigmoid
from strata.operators.perceptron import Net, Perceptron, fit_perceptrons
from strata.operators.trees import Ensemble, Growth, Matrix, View, grow_boosted, grow_forests, held_out_scores

SEED = 42

# The source's models and their search spaces.
MODELS = {
    "logistic_regression": {"C": 1.0, "penalty": "l2"},
    "random_forest": {"n_estimators": 100, "max_depth": 10, "min_samples_split": 2, "min_samples_leaf": 1},
    "gradient_boosting": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 6, "subsample": 1.0},
    "extra_trees": {"n_estimators": 100, "max_depth": 10, "min_samples_split": 2, "min_samples_leaf": 1},
    "svm": {"C": 1.0, "kernel": "rbf", "gamma": "scale"},
    "naive_bayes": {},
    "neural_network": {"hidden_layer_sizes": (100, 50), "learning_rate_init": 0.001, "alpha": 0.0001},
    "xgboost": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 6, "subsample": 1.0, "colsample_bytree": 1.0},
}
SPACES = {
    "random_forest": {"n_estimators": [50, 100, 200], "max_depth": [5, 10, 15, None], "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4]},
    "gradient_boosting": {"n_estimators": [50, 100, 200], "learning_rate": [0.05, 0.1, 0.2], "max_depth": [3, 5, 7], "subsample": [0.8, 0.9, 1.0]},
    "logistic_regression": {"C": [0.1, 1.0, 10.0, 100.0], "penalty": ["l1", "l2"]},  # both of its solvers have one optimum
    "svm": {"C": [0.1, 1.0, 10.0], "kernel": ["rbf", "poly"], "gamma": ["scale", "auto", 0.001, 0.01]},
    "neural_network": {"hidden_layer_sizes": [(50,), (100,), (100, 50), (150, 75)], "learning_rate_init": [0.001, 0.01, 0.1], "alpha": [0.0001, 0.001, 0.01]},
    "xgboost": {"n_estimators": [50, 100, 200], "learning_rate": [0.05, 0.1, 0.2], "max_depth": [3, 5, 7], "subsample": [0.8, 0.9, 1.0],
                "colsample_bytree": [0.8, 0.9, 1.0]},
}
TUNED, DRAWS, FOLDS = 3, 20, 5
BOOSTED = ("gradient_boosting", "xgboost")

Point = tuple[str, dict]


def grid(name: str) -> list[dict]:
    """All points of a model's space."""
    points: list[dict] = [{}] if name in SPACES else []
    for axis, values in SPACES.get(name, {}).items():
        points = [p | {axis: v} for p in points for v in values]
    return points


def draws(name: str, n: int = DRAWS, seed: int = SEED) -> list[dict]:
    """``n`` distinct points, or all."""
    points = grid(name)
    return points if len(points) <= n else random.Random(f"{seed}:{name}").sample(points, n)


class GaussianBayes:
    """M6 from sums: per class the share of rows and each feature's mean and variance."""

    probabilities = True

    def __init__(self, features: list[str], fold: int, prior: np.ndarray, mean: np.ndarray, variance: np.ndarray):
        self.features, self.fold, self.prior, self.mean, self.variance = list(features), fold, prior, mean, variance

    def scores(self, x: np.ndarray, view=None) -> np.ndarray:
        with np.errstate(divide="ignore"):
            joint = [np.log(p) - 0.5 * (np.log(2 * np.pi * v) + (np.nan_to_num(x) - m) ** 2 / v).sum(1) for p, m, v in zip(self.prior, self.mean, self.variance)]
        return 1 / (1 + np.exp(np.clip(joint[0] - joint[1], -700, 700)))

    def score(self) -> Column:
        model = self

        @F.pandas_udf("double")
        def scored(rows: pd.DataFrame) -> pd.Series:
            return pd.Series(model.scores(rows.to_numpy(np.float64)))

        return scored(F.struct(*(F.col(f"`{c}`").cast("double") for c in self.features)))

    def importances(self) -> None:
        return None

    def save(self, spark: SparkSession, path: str) -> None:
        about = json.dumps({"features": self.features, "fold": self.fold, "numbers": [v.tolist() for v in (self.prior, self.mean, self.variance)]})
        spark.createDataFrame([(about,)], "about string").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> GaussianBayes:
        about = json.loads(spark.read.parquet(path).first()["about"])
        return cls(about["features"], about["fold"], *(np.array(v) for v in about["numbers"]))


def fit_bayes(matrix: Matrix, folds: Sequence[int], smoothing: float = 1e-9) -> list[GaussianBayes]:
    """One pass: counts, sums and sums of squares by fold and class; a fit leaves its fold's out."""
    def sums(b):
        x = np.nan_to_num(b.x)
        for f in np.unique(b.fold):
            for y in (0, 1):
                rows = (b.fold == f) & (b.y == y)
                yield (int(f), y), np.array([np.full(x.shape[1], rows.sum()), x[rows].sum(0), (x[rows] ** 2).sum(0)], float)

    by = matrix.blocks.flatMap(sums).reduceByKey(np.add).collectAsMap()  # 3 numbers a feature for each fold and class
    out = []
    for fold in folds:
        n, first, second = (np.array([sum((v[i] for (f, y), v in by.items() if y == c and (f != fold or fold < 0)), np.zeros(len(matrix.features)))
                                      for c in (0, 1)]) for i in range(3))
        count = np.maximum(n, 1)
        mean, total = first / count, np.maximum(n.sum(0), 1)
        variance = np.maximum(second / count - mean ** 2, 0)
        spread = (second.sum(0) / total - (first.sum(0) / total) ** 2).max(initial=0.0)
        out.append(GaussianBayes(matrix.features, fold, n[:, 0] / total[0] if n.shape[1] else np.full(2, 0.5), mean, variance + smoothing * max(spread, 1e-12)))
    return out


def fit_points(matrix: Matrix, points: Sequence[tuple[str, dict, int]], state: str | None = None) -> tuple[list, list[tuple[int, View | None]]]:
    """``points``: (model, parameters, fold). The fits, and for each point its fit and view. Parameters that aren't given
    are the model's own (``MODELS``)."""
    points = [(name, MODELS[name] | params, fold) for name, params, fold in points]
    fits: dict[tuple, list] = {}
    for at, (name, p, fold) in enumerate(points):
        if name in ("random_forest", "extra_trees"):
            key: tuple = ("forest" if name == "random_forest" else "extra", fold, p["min_samples_leaf"])
        elif name in BOOSTED:
            key = ("boosting" if name == "gradient_boosting" else "second_order", fold, p["learning_rate"], p["max_depth"], p["subsample"], p.get("colsample_bytree", 1.0))
        else:
            key = (name, fold, *sorted(p.items()))
        fits.setdefault(key, []).append(at)
    made: dict[tuple, object] = {}

    def part(kinds: Sequence[str]) -> list[tuple]:
        return [k for k in fits if k[0] in kinds]

    forests = part(("forest", "extra"))
    growths = []
    for key in forests:
        depths = [points[at][1]["max_depth"] for at in fits[key]]
        growths.append(Growth(key[0], max(points[at][1]["n_estimators"] for at in fits[key]), None if None in depths else max(depths), key[1], key[2], seed=SEED))
    made.update(zip(forests, grow_forests(matrix, growths) if forests else ()))
    boosted = part(("boosting", "second_order"))
    growths = [Growth(k[0], max(points[at][1]["n_estimators"] for at in fits[k]), k[3], k[1], rate=k[2], rows=k[4], columns=k[5], seed=SEED) for k in boosted]
    made.update(zip(boosted, grow_boosted(matrix, growths) if boosted else ()))
    first = lambda key: points[fits[key][0]][1]
    lines = part(("logistic_regression", "svm"))
    linear = [LinearFit("logistic", first(k)["C"], first(k)["penalty"], k[1]) if k[0] == "logistic_regression" else
              LinearFit("hinge", first(k)["C"], "l2", k[1], Kernel(first(k)["kernel"], first(k)["gamma"])) for k in lines]
    made.update(zip(lines, fit_linear(matrix, linear) if lines else ()))
    nets = part(("neural_network",))
    made.update(zip(nets, fit_perceptrons(matrix, [Net(tuple(first(k)["hidden_layer_sizes"]), first(k)["learning_rate_init"], first(k)["alpha"], fold=k[1])
                                                   for k in nets], state) if nets else ()))
    bayes = part(("naive_bayes",))
    made.update(zip(bayes, fit_bayes(matrix, [k[1] for k in bayes]) if bayes else ()))
    number = {key: i for i, key in enumerate(made)}
    views: list = [None] * len(points)
    for key, own in fits.items():
        for at in own:
            p = points[at][1]
            if key[0] in ("forest", "extra"):
                view: View | None = View(p["n_estimators"], p["max_depth"], p["min_samples_split"])
            else:
                view = View(p["n_estimators"]) if key[0] in ("boosting", "second_order") else None
            views[at] = (number[key], view)
    return list(made.values()), views


def _written(params: dict) -> str:
    return json.dumps(params, sort_keys=True)


def _journalled(spark: SparkSession, journal: str | None) -> dict[tuple[str, str, int], float]:
    from strata.sources.io import _exists
    if not journal or not _exists(spark, journal):
        return {}
    return {(r.model, r.params, r.fold): r.auc for r in spark.read.schema("model string, params string, fold int, auc double").json(journal).collect()}


def cross_validated(matrix: Matrix, points: Sequence[Point], folds: int = FOLDS, journal: str | None = None,
                    on_error: str = "raise", whole: dict | None = None) -> dict[tuple[str, str], list[float]]:
    """AUC by fold of every point, keyed by (model, parameters as JSON). A family whose parameters or data it can't handle
    (ValueError) is left out with ``on_error="skip"``; what fails in the engine is raised. ``whole`` gets by name, as from
    :func:`fitted`, the first point of each family none of whose folds the journal has: these fits share the folds' passes."""
    spark, done = matrix.spark, _journalled(matrix.spark, journal)
    by_name: dict[str, list[dict]] = {}
    for name, params in points:
        if params not in by_name.setdefault(name, []):
            by_name[name].append(params)
    skipped = set()

    def fold_aucs(names: Sequence[str]) -> None:
        """What the journal lacks of these families, and their fits on all rows."""
        missing = {name: [(name, p, f) for p in by_name[name] for f in range(folds) if (name, _written(p), f) not in done] for name in names}
        both = [n for n in names if whole is not None and len(missing[n]) == folds * len(by_name[n])]
        wanted = [row for name in names for row in missing[name]]
        if not wanted:
            return
        models, views = fit_points(matrix, wanted + [(n, by_name[n][0], -1) for n in both], f"{journal}-states" if journal else None)
        auc = {r.view: r.roc_auc for r in grouped_auc(held_out_scores(matrix, models, views[:len(wanted)]), "view").collect()}
        for name, own in zip(both, views[len(wanted):]):
            first = wanted.index((name, by_name[name][0], 0))
            whole[name] = _finished(matrix, models, own, views[first:first + folds])
        found = [(n, _written(p), f, auc.get(i)) for i, (n, p, f) in enumerate(wanted)]
        done.update({row[:3]: row[3] for row in found})
        if journal:
            spark.createDataFrame(found, "model string, params string, fold int, auc double").coalesce(1).write.mode("append").json(journal)

    joined = [n for n in by_name if n in BOOSTED]  # each of their rounds is a pass for every level: they share them
    for names in [*([n] for n in by_name if n not in joined), *([joined] if joined else [])]:
        try:
            fold_aucs(names)
        except ValueError:
            if on_error != "skip":
                raise
            for name in names:
                try:
                    fold_aucs([name])
                except ValueError as error:
                    print(f"[strata] {name} left out: {error}")
                    skipped.add(name)
    return {(name, _written(p)): [done[name, _written(p), f] for f in range(folds)] for name, own in by_name.items() if name not in skipped for p in own}


def _mean(values: list) -> float | None:
    return None if any(v is None for v in values) else float(np.mean(values))


def val_metrics(model, rows: DataFrame, label: str = "label") -> dict[str, float]:
    scored = scored_rows(model, rows, [label]).cache()
    try:
        row = binary_metrics(scored, label).first().asDict()
        return row | {"roc_auc": roc_auc(scored, label).first()["roc_auc"]}
    finally:
        scored.unpersist()


def scored_rows(model, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, ``score`` (probability of class 1, or a margin) and ``pred``."""
    cut = 0.5 if model.probabilities else 0.0
    return df.select(*keep, model.score().alias("score")).withColumn("pred", (F.col("score") > cut).cast("int"))


def _finished(matrix: Matrix, models: list, own: tuple[int, View | None], outside: Sequence[tuple[int, View | None]]):
    """A fit's view as a model of its own; a hinge model gets a sigmoid fitted on the margins of the ``outside`` views."""
    model = models[own[0]].at(own[1]) if isinstance(models[own[0]], Ensemble) else models[own[0]]
    if isinstance(model, LinearModel) and not model.probabilities:
        model.sigmoid = fit_sigmoid(held_out_scores(matrix, models, outside).cache())
    return model


def fitted(matrix: Matrix, points: dict[str, dict], folds: int = FOLDS) -> dict:
    """Each named point fitted on all training rows; a hinge model gets a sigmoid fitted on the margins that its fits
    on the other folds give to each row."""
    names = list(points)
    wanted = [(n, points[n], -1) for n in names] + [(n, points[n], f) for n in names if n == "svm" for f in range(folds)]
    models, views = fit_points(matrix, wanted)
    return {name: _finished(matrix, models, views[i], [v for v, (n, _, f) in zip(views, wanted) if n == name and f >= 0]) for i, name in enumerate(names)}


def baseline(matrix: Matrix, val: DataFrame, names: Sequence[str] | None = None, label: str = "label", folds: int = FOLDS,
             journal: str | None = None) -> tuple[DataFrame, dict]:
    """Per model mean and deviation of the folds' AUCs, and accuracy, AUC and F1 on ``val`` of the fit on all
    training rows; best first. Also these fits."""
    names = [n for n in MODELS if names is None or n in names]
    whole: dict = {}
    cv = cross_validated(matrix, [(n, MODELS[n]) for n in names], folds, journal, on_error="skip", whole=whole)
    whole |= fitted(matrix, {n: MODELS[n] for n, _ in cv if n not in whole}, folds)
    models = {n: whole[n] for n, _ in cv}
    rows = []
    for name, aucs in ((n, cv.get((n, _written(MODELS[n])))) for n in names):
        if aucs is None:
            rows.append((name, None, None, None, None, None))
            continue
        m = val_metrics(models[name], val, label)
        rows.append((name, _mean(aucs), None if _mean(aucs) is None else float(np.std(aucs)), *(float(m[c]) for c in ("accuracy", "roc_auc", "f1"))))
    df = matrix.spark.createDataFrame(rows, "model string, cv_auc_mean double, cv_auc_std double, val_accuracy double, val_auc double, val_f1 double")
    return df.orderBy(F.desc_nulls_last("cv_auc_mean"), "model"), models


def search(matrix: Matrix, names: Sequence[str], n: int = DRAWS, folds: int = FOLDS, seed: int = SEED,
           journal: str | None = None) -> dict[str, tuple[dict | None, float | None]]:
    """Per model the drawn point with the best mean AUC (the first drawn of equal ones), and that mean. A model
    without a space passes through."""
    drawn = {name: draws(name, n, seed) for name in names}
    cv = cross_validated(matrix, [(name, p) for name in names for p in drawn[name]], folds, journal, on_error="skip")
    out: dict[str, tuple[dict | None, float | None]] = {}
    for name in names:
        means = [(_mean(cv[name, _written(p)]), p) for p in drawn[name] if (name, _written(p)) in cv]
        means = [(m, p) for m, p in means if m is not None]
        best = max(means, key=lambda x: x[0], default=(None, None))
        out[name] = (best[1], best[0])
    return out


def tuned(matrix: Matrix, found: dict[str, tuple[dict | None, float | None]], models: dict, folds: int = FOLDS) -> dict:
    """The best points refitted on all training rows; a model without one stays as it is."""
    better = fitted(matrix, {n: p for n, (p, _) in found.items() if p is not None}, folds)
    return {n: better.get(n, models[n]) for n in found}


def select_best(models: dict, val: DataFrame, label: str = "label") -> tuple[str, DataFrame]:
    """Validation metrics of each model; the best has the highest AUC (the first name of equal ones)."""
    rows = [(name, metric, float(value)) for name, model in models.items() for metric, value in val_metrics(model, val, label).items()]
    best = min((-value, name) for name, metric, value in rows if metric == "roc_auc")[1]
    return best, val.sparkSession.createDataFrame(rows, "model string, metric string, value double")


def soft_vote(models: dict, df: DataFrame, key: str) -> DataFrame:
    """The mean of the models' probabilities; every model is a column over the same rows, so there is no join."""
    if bad := [n for n, m in models.items() if not m.probabilities]:
        raise ValueError(f"{bad} have margins only")
    votes = df.select(key, *(m.score().alias(f"_s{i}") for i, m in enumerate(models.values())))
    mean = sum((F.col(f"_s{i}") for i in range(len(models))), F.lit(0.0)) / F.lit(float(len(models)))
    return votes.select(key, mean.alias("score")).withColumn("pred", (F.col("score") >= 0.5).cast("int"))


def importances(model, spark: SparkSession, top: int = 15) -> DataFrame:
    """The model's importances or absolute weights; none give an empty table."""
    values = model.importances()
    rows = [] if values is None else [(f, float(v)) for f, v in zip(model.features, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(top)


KINDS = {"Ensemble": Ensemble, "LinearModel": LinearModel, "Perceptron": Perceptron, "GaussianBayes": GaussianBayes}


def save(model, path: str, registry: str, name: str, spark: SparkSession) -> None:
    """The model's table, and a row in the registry."""
    model.save(spark, path)
    row = spark.createDataFrame([(name, type(model).__name__, len(model.features), path)], "model_name string, model_type string, features_count int, path string")
    row.withColumn("training_date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).write.mode("append").json(registry)


def load(spark: SparkSession, registry: str):
    """The newest model of the registry."""
    row = spark.read.json(registry).agg(F.max_by(F.struct("model_type", "path"), "training_date").alias("m")).first()["m"]
    return KINDS[row["model_type"]].load(spark, row["path"])
