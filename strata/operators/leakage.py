"""Leakage validation (V1): dummy AUC, max |corr| with the label, forest AUC.

Returns a one-row DataFrame; the heavy parts are a single correlation
aggregation pass and an MLlib cross-validation on precomputed folds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import eda
from strata.operators.evaluate import roc_auc
from strata.operators.models import cross_validate, dummy_most_frequent
from strata.operators.split import assign_folds


def validate_no_leakage(train: DataFrame, features: Sequence[str], key: str, label: str = "label",
                        rf_trees: int = 50, rf_folds: int = 3, corr_alert: float = 0.9,
                        rf_alert: float = 0.95, dummy_alert: float = 0.6, seed: int = 42) -> DataFrame:
    """``dummy_auc, max_correlation, top_feature, rf_auc, leakage_suspected`` (one row).

    The dummy AUC is the mean over the folds of a most-frequent predictor fitted on the
    other folds; above ``dummy_alert`` something is wrong with the folds or the metric.
    """
    lc = eda.label_correlations(train, label, list(features)).where(F.col("r").isNotNull())
    top = lc.orderBy(F.desc("abs_r"), "feature").first()
    max_corr = float(top["abs_r"]) if top else 0.0
    top_feature = top["feature"] if top else None
    folded = assign_folds(train, key, label, k=rf_folds, seed=seed, out="_fold")
    aucs = []
    for i in range(rf_folds):
        rest, own = folded.where(F.col("_fold") != i), folded.where(F.col("_fold") == i)
        aucs.append(roc_auc(dummy_most_frequent(rest, own, label, keep=[label]), label).first()["roc_auc"])
    dummy_auc = sum(aucs) / len(aucs) if all(a is not None for a in aucs) else None
    rf = RandomForestClassifier(numTrees=rf_trees, seed=seed)
    _, mean, _ = cross_validate(rf, folded, features, label, fold_col="_fold")
    rf_auc = float(mean[0])
    row = (dummy_auc, max_corr, top_feature, rf_auc,
           bool(rf_auc > rf_alert or max_corr > corr_alert or (dummy_auc or 0.0) > dummy_alert))
    return train.sparkSession.createDataFrame(
        [row], "dummy_auc double, max_correlation double, top_feature string, rf_auc double, "
               "leakage_suspected boolean")
