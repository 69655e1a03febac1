"""EDA summary and recommendations (A12, S11) assembled from the EDA operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.exprs import numeric_columns
from strata.operators import clean, eda


def summary_row(df: DataFrame, label: str, outlier_vars: Sequence[str], strong: float = 0.3) -> dict:
    """dataset_size, n_features (all columns), target_balance, outlier_percentage
    (IQR outliers over ``outlier_vars`` / rows * 100), strong_correlations (|r| > strong
    with the label among numeric columns), and the four recommendation flags."""
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("bal")).first()
    n, bal = agg["n"], agg["bal"]
    vars_ = [v for v in outlier_vars if v in df.columns]
    fences = clean.fit_iqr_fences(df, vars_)
    total_out = clean.outlier_counts(df, fences).agg(F.sum("n_outliers")).first()[0] or 0
    nums = numeric_columns(df, exclude=[label])
    n_strong = (eda.label_correlations(df, label, nums).where(F.col("abs_r") > strong).count())
    return {
        "dataset_size": n, "n_features": len(df.columns), "target_balance": bal,
        "outlier_percentage": total_out * 100.0 / n, "strong_correlations": n_strong,
        "scaling_needed": True, "outlier_treatment": bool(total_out > n * 0.05),
        "feature_engineering": True, "class_balancing": bool(abs(bal - 0.5) > 0.15),
    }


_SCHEMA = ("dataset_size bigint, n_features bigint, target_balance double, outlier_percentage double, "
           "strong_correlations bigint, scaling_needed boolean, outlier_treatment boolean, "
           "feature_engineering boolean, class_balancing boolean")


def summary_flat(df: DataFrame, label: str, outlier_vars: Sequence[str]) -> DataFrame:
    r = summary_row(df, label, outlier_vars)
    return df.sparkSession.createDataFrame([tuple(r.values())], _SCHEMA)


def summary_nested(df: DataFrame, label: str, outlier_vars: Sequence[str]) -> DataFrame:
    """The JSON-shaped summary: recommendations as a nested struct."""
    flat = summary_flat(df, label, outlier_vars)
    return flat.select("dataset_size", "n_features", "target_balance", "outlier_percentage",
                       "strong_correlations",
                       F.struct("scaling_needed", "outlier_treatment", "feature_engineering",
                                "class_balancing").alias("recommendations"))
