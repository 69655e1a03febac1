"""Staged pipeline (V2) with a per-stage report (V3).

Stages: collect -> preprocess -> [features] -> model -> evaluate.  Every stage
is one lazy plan ending in a Parquet write below the shared folder; the next
stage reads that table (stage edges are tables, so a lost executor never
forces recomputation of earlier stages, and lineage stays short).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.exprs import numeric_columns
from strata.operators import clean, derive, evaluate, labels, rank, search, select, split
from strata.operators.models_common import staged_table
from strata.operators.trees import Matrix
from strata.plans import fixture as fx
from strata.session import scratch_path
from strata.sources import io
from strata.sources.tables import PROFILE_COUNTERS, QTY_PARTS, input_state, profile_table

STEPS = ("collect", "preprocess", "features", "model", "evaluate")
DEFAULT_STEPS = ("collect", "preprocess", "model", "evaluate")


def validate_steps(steps: Sequence[str]) -> list[str]:
    bad = [s for s in steps if s not in STEPS]
    if bad:
        raise ValueError(f"unknown step(s) {bad}; valid: {STEPS}")
    return [s for s in STEPS if s in steps]


def collect_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw entity table + independent target (T7): ingredients of the label are removed."""
    raw = profile_table(spark, sf_dir)
    fixed, _ = labels.independent_target(raw, fx.HYBRID, fx.KEY, fx.FORBIDDEN, q=fx.HYBRID_Q, seed=fx.SEED)
    return fixed


def preprocess_stage(fixed: DataFrame, fit_on: str = "train",
                     quantile_method: str = "exact") -> tuple[DataFrame, list[str]]:
    """Clean -> impute -> derive -> select -> split -> scale.

    ``fit_on='train'`` fits fences, medians and scaling on the training split only
    (``'all'`` reproduces fitting before the split).  ``quantile_method='approx'``
    swaps the exact distributed quantiles for the one-pass sketch (very large inputs).
    """
    df, _ = clean.drop_columns(fixed, fx.LEAKY)
    # the fits below pass over the rows several times each, so what they read is a table
    df = staged_table(split.assign_split(df, fx.KEY, "label", exact=True, seed=fx.SEED), "split_rows")
    fit_rows = df.where(F.col("split") == "train") if fit_on == "train" else df
    counters = [c for c in PROFILE_COUNTERS if c in df.columns]
    df = clean.apply_iqr_cap(df, clean.fit_iqr_fences(fit_rows, counters, method=quantile_method))
    df = clean.consistency_fix(df, floor_col="n_returned", floor=1, parts=QTY_PARTS, total_col="qty",
                               cap_col="n_urgent", cap_by="n_orders").drop("fix_floor", "fix_parts", "fix_cap", "n_fixes")
    df = staged_table(df, "consistent")
    fit_rows = df.where(F.col("split") == "train") if fit_on == "train" else df
    df = clean.apply_impute(df, clean.fit_medians(fit_rows, counters, method=quantile_method))
    df = derive.derived_ratios(df, fx.RATIOS, fx.SUMS)
    df = derive.diversity(df, [c for c in df.columns if c.startswith("qty_") and len(c) == 6])
    df = staged_table(df, "derived")
    feats = numeric_columns(df, exclude=[fx.KEY, "label"])
    fit_rows = df.where(F.col("split") == "train") if fit_on == "train" else df
    df = split.apply_standard(df, split.fit_standard(fit_rows, feats))
    return df.select(fx.KEY, "label", "split", *feats), feats


def advanced_features(df: DataFrame) -> DataFrame:
    """D12-D20 and W1 on whatever roles the processed table still has; percentiles rank within each split, and a value
    that can't be computed gets the training median."""
    before = set(df.columns)
    if fx.ROLES["hours"] in df.columns:
        df = derive.experience_tier(df, fx.ROLES["hours"])
    df = derive.advanced_indices(df, fx.ROLES)
    if {fx.ROLES["kills"], fx.ROLES["deaths"]} <= set(df.columns):
        df = df.withColumn("kd", F.try_divide(F.col(fx.ROLES["kills"]), F.col(fx.ROLES["deaths"]) + F.lit(1)))
        df = rank.percent_rank_avg(df, "kd", ["split"], "kd_percentile").drop("kd")
    new = [c for c in df.columns if c not in before]
    return clean.apply_impute(df, clean.fit_medians(df.where(F.col("split") == "train"), new)) if new else df


def features_stage(df: DataFrame, feats: list[str], k: int = 40, quick: bool = False) -> tuple[DataFrame, list[str]]:
    """Advanced features, interactions (skipped in quick mode) and ANOVA k-best fitted on train."""
    df = advanced_features(df)
    if not quick:
        df = derive.interactions(df, derive.interaction_columns(feats, fx.INTERACTION_PREFERRED))
    feats = numeric_columns(df, exclude=[fx.KEY, "label"])
    train = df.where(F.col("split") == "train")
    best = [r["feature"] for r in select.select_k_best(select.anova_f(train, "label", feats), k).collect()]
    return df.select(fx.KEY, "label", "split", *best), best


def model_matrix(spark: SparkSession, sf_dir: str, folds: int = 5) -> tuple[DataFrame, list[str]]:
    """The processed matrix with CV folds on the train split, materialised once per session."""
    key = (*input_state(spark, sf_dir), folds)
    if key not in _MATRIX or not io._exists(spark, _MATRIX[key][0]):
        df, feats = preprocess_stage(staged_table(collect_stage(spark, sf_dir), "fixed"))
        train = split.assign_folds(df.where(F.col("split") == "train"), fx.KEY, "label", k=folds, seed=fx.SEED)
        rest = df.where(F.col("split") != "train").withColumn("fold", F.lit(-1))
        path = io.write_dataset(train.unionByName(rest), "model_matrix")
        _MATRIX[key] = (path, feats)
    path, feats = _MATRIX[key]
    return spark.read.parquet(path), feats


_MATRIX: dict = {}


def run_pipeline(spark: SparkSession, sf_dir: str, steps: Sequence[str] = DEFAULT_STEPS, quick: bool = False,
                 model_names: Sequence[str] | None = None, tune_top: int | None = None,
                 draws: int = 20, base: str | None = None) -> DataFrame:
    """V2: execute the chosen steps; returns the V3 stage report ``(stage, metric, value)``.

    ``base`` is the folder of the stage tables: a step reads what an earlier step, of this call or of an earlier
    one with the same ``base``, has written there, and raises ``FileNotFoundError`` if that is missing.  Without
    ``base`` a fresh folder is taken.  ``quick`` skips interactions and selects and tunes less.
    """
    steps = validate_steps(steps)
    report: list[tuple[str, str, float]] = []
    base = base or scratch_path(spark, "pipeline")

    def stored(*names):
        """The first of the stage tables that exists, and its features."""
        df = spark.read.parquet(io.resolve_source(spark, [f"{base}/{n}" for n in names]))
        return df, numeric_columns(df, exclude=[fx.KEY, "label"])

    if "collect" in steps:
        io.write_dataset(collect_stage(spark, sf_dir), "fixed", path=f"{base}/fixed")
        fixed, _ = stored("fixed")
        report += [("collect", "rows", float(fixed.count())), ("collect", "columns", float(len(fixed.columns)))]
    if "preprocess" in steps:
        proc, feats = preprocess_stage(stored("fixed")[0])
        io.write_dataset(proc, "processed", path=f"{base}/processed")
        counts = {r["split"]: r["n"] for r in stored("processed")[0].groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
        report += [("preprocess", f"rows_{s}", float(counts.get(s, 0))) for s in ("train", "val", "test")]
        report.append(("preprocess", "features", float(len(feats))))
    if "features" in steps:
        eng, feats = features_stage(*stored("processed"), k=30 if quick else 40, quick=quick)
        io.write_dataset(eng, "engineered", path=f"{base}/engineered")
        report.append(("features", "selected", float(len(feats))))
    if "model" in steps:
        report += _model_stage(spark, base, *stored("engineered", "processed"), quick, model_names, tune_top, draws)
    if "evaluate" in steps:
        data, _ = stored("engineered", "processed")
        io.resolve_source(spark, [f"{base}/registry"])
        model = search.load(spark, f"{base}/registry")
        bundle = evaluate.evaluate(search.scored_rows(model, data.where(F.col("split") == "test"), ["label"]))
        m, a = bundle["weighted"].first(), bundle["auc"].first()
        report += [("evaluate", "accuracy", float(m["accuracy"])), ("evaluate", "f1_weighted", float(m["f1"])),
                   ("evaluate", "roc_auc", float(a["roc_auc"])), ("evaluate", "pr_auc", float(a["pr_auc"]))]
    return spark.createDataFrame(report, "stage string, metric string, value double")


def _model_stage(spark, base, data, feats, quick, model_names, tune_top, draws) -> list[tuple[str, str, float]]:
    """Baseline CV of all models, random search of the best, selection, registry, held-out metrics."""
    train = split.assign_folds(data.where(F.col("split") == "train"), fx.KEY, "label", k=search.FOLDS, seed=fx.SEED)
    val, test = data.where(F.col("split") == "val"), data.where(F.col("split") == "test")
    matrix = Matrix.build(train, feats, fx.KEY)
    try:
        table, fitted = search.baseline(matrix, val, model_names, journal=f"{base}/journal")
        ranked = [r for r in table.collect() if r["cv_auc_mean"] is not None]
        report = [("model", f"cv_auc_{r['model']}", r["cv_auc_mean"]) for r in ranked]
        top = [r["model"] for r in ranked][:tune_top if tune_top is not None else (2 if quick else search.TUNED)]
        found = search.search(matrix, top, n=draws, journal=f"{base}/journal")
        fitted |= search.tuned(matrix, found, fitted)
        best, _ = search.select_best(fitted, val)
        search.save(fitted[best], f"{base}/best_model", f"{base}/registry", best, spark)
        scored = search.scored_rows(fitted[best], test, ["label"])
        m, auc = evaluate.weighted_metrics(scored).first(), evaluate.roc_auc(scored).first()["roc_auc"]
        report += [("model", f"best_test_{k}", float(m[k])) for k in ("accuracy", "precision", "recall", "f1")]
        return [*report, ("model", "best_test_auc", float(auc)), ("model", f"best_is_{best}", 1.0)]
    finally:
        matrix.release()
