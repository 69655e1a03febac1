"""Registered queries: one per operator family of the inventory, each ``(spark, sf_dir) -> DataFrame``.

All read the driver tables (or the profile stage table Spark derives from
them), so their work grows with the data.  Floating outputs are rounded to a
fixed number of digits so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.exprs import rounded
from strata.operators import clean, derive, eda, evaluate, labels, rank, select, split
from strata.plans import fixture as fx
from strata.sources.tables import (PROFILE_COUNTERS, QTY_PARTS, entity_profile, profile_table, read_table,
                                   stage_table)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _p(spark, sf) -> DataFrame:
    return profile_table(spark, sf)


def _build_hybrid(spark, sf) -> DataFrame:
    return labels.hybrid_label(_p(spark, sf), fx.HYBRID, fx.KEY, q=fx.HYBRID_Q, noise_weight=fx.HYBRID_NOISE,
                               seed=fx.SEED)


def _build_split(spark, sf) -> DataFrame:
    return split.assign_split(_hybrid(spark, sf), fx.KEY, "label", exact=True, seed=fx.SEED)


# Downstream operators read the upstream stages as written tables (computed once per session);
# the queries named after those stages ("label_hybrid", "split") run them from scratch.
def _hybrid(spark, sf) -> DataFrame:
    return stage_table(spark, sf, "labelled", lambda: _build_hybrid(spark, sf))


def _split(spark, sf) -> DataFrame:
    return stage_table(spark, sf, "split", lambda: _build_split(spark, sf))


def _scored(spark, sf) -> DataFrame:
    return stage_table(spark, sf, "scored", lambda: fx.scored(_p(spark, sf), _hybrid(spark, sf)))


# ---- sources / projections ----------------------------------------------------------------------

@query("profile")
def q_profile(spark, sf):
    return entity_profile(spark, sf)


@query("drop_leaky")
def q_drop_leaky(spark, sf):
    return clean.drop_columns(_p(spark, sf), fx.LEAKY)[0]


@query("min_activity_filter")
def q_min_activity(spark, sf):
    return clean.min_activity_filter(_p(spark, sf), "n_lines", fx.ACTIVITY_MIN_LINES).select(fx.KEY, "n_lines", "qty")


@query("column_info")
def q_column_info(spark, sf):
    df = _p(spark, sf)
    cols = df.columns
    wide = df.agg(*[F.count(c).alias(f"_c{i}") for i, c in enumerate(cols)])
    body = ", ".join(f"'{c}', '{df.schema[c].dataType.simpleString()}', _c{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {body}) as (column, dtype, non_null)")


@query("preview")
def q_preview(spark, sf):
    return _p(spark, sf).select(fx.KEY, "n_orders", "qty", "amount").orderBy(fx.KEY).limit(5)


@query("train_matrix")
def q_train_matrix(spark, sf):
    """Label + numeric features not excluded, plus family sums added in one projection."""
    df = _hybrid(spark, sf)
    fam = [c for c in df.columns if "qty_" in c]
    wide = df.withColumns({"qty_family": sum(F.col(c) for c in fam),
                           "qty_a": F.col("qty_af") + F.col("qty_ao")})
    from strata.functions.exprs import numeric_columns
    excluded = [fx.KEY, "score", "label", "span_days", "n_lines"]
    feats = numeric_columns(wide, exclude=excluded)
    return rounded(wide.select(fx.KEY, "label", *feats))


@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf):
    from strata.sources import io
    return io.csv_roundtrip(_p(spark, sf))


@query("split_files")
def q_split_files(spark, sf):
    """Write the split dataset partitioned by ``split``; read each split alone (partitions are pruned)."""
    from strata.sources import io
    path = io.write_dataset(_split(spark, sf).select(fx.KEY, "label", "qty", "split"), "splits")
    train, val, test = (io.read_split(spark, path, s) for s in ("train", "val", "test"))
    return train.unionByName(val).unionByName(test)


@query("resolve_source")
def q_resolve_source(spark, sf):
    """The first existing of several sources is read; ``source`` says which."""
    from strata.sources import io
    path = io.write_dataset(_p(spark, sf).select(fx.KEY, "qty"), "processed")
    found = io.resolve_source(spark, [f"{path}-fixed", path, f"{sf}/customer.parquet"])
    return io.read_dataset(spark, found).withColumn("source", F.lit("processed" if found == path else "other"))


@query("split_check")
def q_split_check(spark, sf):
    """Rows, distinct keys and positives of each split; the fractions are validated first."""
    split.validate_split(0.15, 0.15, 5)
    return _split(spark, sf).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(fx.KEY).alias("n_keys"),
                                                  F.sum("label").cast("bigint").alias("positives"))


# ---- cleaning ----------------------------------------------------------------------------------

@query("iqr_fences")
def q_iqr_fences(spark, sf):
    f = clean.fit_iqr_fences(_p(spark, sf), PROFILE_COUNTERS)
    return rounded(clean.fences_frame(spark, f))


@query("iqr_cap")
def q_iqr_cap(spark, sf):
    df = _p(spark, sf)
    f = clean.fit_iqr_fences(df, PROFILE_COUNTERS)
    return rounded(clean.apply_iqr_cap(df, f))


@query("outlier_counts")
def q_outlier_counts(spark, sf):
    df = _p(spark, sf)
    return rounded(clean.outlier_counts(df, clean.fit_iqr_fences(df, PROFILE_COUNTERS)))


@query("consistency_fix")
def q_consistency_fix(spark, sf):
    df = fx.plant_violations(_p(spark, sf))
    fixed = clean.consistency_fix(df, floor_col="n_returned", floor=1, parts=QTY_PARTS, total_col="qty",
                                  cap_col="n_done", cap_by="n_orders")
    return fixed.select(fx.KEY, "n_returned", *QTY_PARTS, "n_done", "fix_floor", "fix_parts", "fix_cap", "n_fixes")


@query("null_counts")
def q_null_counts(spark, sf):
    return clean.null_counts(fx.plant_nulls(_p(spark, sf)), fx.NULL_COLS)


@query("median_impute")
def q_median_impute(spark, sf):
    df = fx.plant_nulls(_p(spark, sf))
    med = clean.fit_medians(df, fx.NULL_COLS)
    return rounded(clean.apply_impute(df, med).select(fx.KEY, *fx.NULL_COLS))


@query("clean_summary")
def q_clean_summary(spark, sf):
    """Drop leaky -> activity filter -> IQR cap (fit after the filter) -> consistency fixes."""
    raw = _p(spark, sf)
    df, _ = clean.drop_columns(raw, fx.LEAKY)
    df = clean.min_activity_filter(raw, "n_lines", fx.ACTIVITY_MIN_LINES).select(*df.columns)
    feats = [c for c in PROFILE_COUNTERS if c in df.columns]
    df = clean.apply_iqr_cap(df, clean.fit_iqr_fences(df, feats))
    df = clean.consistency_fix(df, floor_col="n_returned", floor=1, parts=QTY_PARTS, total_col="qty",
                               cap_col="n_done", cap_by="n_orders")
    return rounded(clean.clean_summary(raw, df, feats))


@query("iqr_cap_missing")
def q_iqr_cap_missing(spark, sf):
    """C1/C2 with NULL, NaN and infinite values: missing stays missing, infinities become the fences."""
    df = fx.plant_missing(_p(spark, sf), fx.MISSING_COLS).select(fx.KEY, *fx.MISSING_COLS)
    return rounded(clean.apply_iqr_cap(df, clean.fit_iqr_fences(df, fx.MISSING_COLS)))


@query("outlier_counts_missing")
def q_outlier_counts_missing(spark, sf):
    df = fx.plant_missing(_p(spark, sf), fx.MISSING_COLS)
    return rounded(clean.outlier_counts(df, clean.fit_iqr_fences(df, fx.MISSING_COLS)))


@query("impute_inf")
def q_impute_inf(spark, sf):
    """NULL, NaN and infinite values get the median of the finite ones."""
    df = fx.plant_missing(_p(spark, sf), fx.MISSING_COLS).select(fx.KEY, *fx.MISSING_COLS)
    return rounded(clean.apply_impute(df, clean.fit_medians(df, fx.MISSING_COLS)))


def _fixed_with_nulls(spark, sf):
    df = fx.plant_null_counters(_p(spark, sf), fx.MISSING_COUNTERS)
    return clean.consistency_fix(df, floor_col="n_returned", floor=1, parts=QTY_PARTS, total_col="qty",
                                 cap_col="n_done", cap_by="n_orders")


@query("consistency_missing")
def q_consistency_missing(spark, sf):
    """C4-C8 with NULL counters: a rule whose inputs are missing changes and counts nothing."""
    return _fixed_with_nulls(spark, sf).select(fx.KEY, "n_returned", *QTY_PARTS, "n_done", "fix_floor", "fix_parts",
                                               "fix_cap", "n_fixes")


@query("correction_counts")
def q_correction_counts(spark, sf):
    return clean.correction_counts(_fixed_with_nulls(spark, sf))


@query("removed_rows")
def q_removed_rows(spark, sf):
    """P5: rows kept and removed by the activity filter."""
    return clean.activity_counts(_p(spark, sf), "n_lines", fx.ACTIVITY_MIN_LINES)


# ---- labels ------------------------------------------------------------------------------------

@query("label_quantile")
def q_label_quantile(spark, sf):
    df = _p(spark, sf)
    s = labels.composite_score("qty", "n_returned", "n_open", "n_lines", "n_done", "n_orders")
    return rounded(labels.quantile_label(df, s, 0.6, strict=True).select(fx.KEY, "score", "label"))


@query("label_rules")
def q_label_rules(spark, sf):
    return labels.rule_label(_p(spark, sf), fx.RULES, fx.RULE_MIN, fx.KEY).select(fx.KEY, "score", "label")


@query("label_experience")
def q_label_experience(spark, sf):
    return labels.threshold_label(_p(spark, sf), "span_days", fx.EXPERIENCE_MIN_DAYS, fx.KEY).select(fx.KEY, "label")


@query("label_hybrid")
def q_label_hybrid(spark, sf):
    return rounded(_build_hybrid(spark, sf).select(fx.KEY, "score", "label"))


@query("label_bernoulli")
def q_label_bernoulli(spark, sf):
    return labels.bernoulli_label(_p(spark, sf), fx.KEY, fx.BERNOULLI_P, fx.SEED).select(fx.KEY, "label")


@query("independent_target")
def q_independent_target(spark, sf):
    df, _ = labels.independent_target(_p(spark, sf), fx.HYBRID, fx.KEY, fx.FORBIDDEN, q=fx.HYBRID_Q, seed=fx.SEED)
    return df


# ---- derived features --------------------------------------------------------------------------

@query("derived_ratios")
def q_derived_ratios(spark, sf):
    # row-wise ratios are the same IEEE operations on every engine: compared unrounded
    df = derive.derived_ratios(_p(spark, sf), fx.RATIOS, fx.SUMS)
    return df.select(fx.KEY, *fx.SUMS, *[r.name for r in fx.RATIOS])


@query("tiers")
def q_tiers(spark, sf):
    return derive.experience_tier(_p(spark, sf), "span_days").select(fx.KEY, "span_days", "experience_tier")


@query("indices")
def q_indices(spark, sf):
    df = derive.advanced_indices(derive.derived_ratios(_p(spark, sf), fx.RATIOS), fx.ROLES)
    return df.select(fx.KEY, "playtime_efficiency", "performance_index", "damage_efficiency",
                     "damage_per_kill", "clutch_factor", "leadership_index", "team_dependency")


@query("diversity")
def q_diversity(spark, sf):
    return rounded(derive.diversity(_p(spark, sf), QTY_PARTS).select(fx.KEY, "diversity", "specialization"))


@query("stability")
def q_stability(spark, sf):
    df = derive.derived_ratios(_p(spark, sf), fx.RATIOS)
    return rounded(derive.stability(df, fx.STABILITY_COLS))


@query("pct_rank")
def q_pct_rank(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "value")
    return rounded(rank.percent_rank_avg(ev, "value", out_col="value_pct"))


@query("pct_rank_missing")
def q_pct_rank_missing(spark, sf):
    """W1 with missing values: NULL and NaN have no rank and don't count; infinities rank last and first."""
    ev = read_table(spark, sf, "events").select("event_id", "value")
    return rounded(rank.percent_rank_avg(fx.plant_missing(ev, ["value"]), "value", out_col="value_pct").select("event_id", "value_pct"))


@query("pct_rank_profile")
def q_pct_rank_profile(spark, sf):
    df = _p(spark, sf).withColumns({"kd": F.col("qty") / (F.col("n_returned") + 1),
                                    "acc": F.col("n_open") / (F.col("n_lines") + 1)})
    out = derive.percentile_features(df.select(fx.KEY, "kd", "acc"), ["kd", "acc"])
    return rounded(out.select(fx.KEY, "kd_percentile", "acc_percentile"))


@query("interactions")
def q_interactions(spark, sf):
    df = _p(spark, sf)
    cols = derive.interaction_columns(df.columns, fx.INTERACTION_PREFERRED)
    out = derive.interactions(df.select(fx.KEY, *cols), cols)
    # products of two doubles are one IEEE multiply on every engine: left unrounded
    # (decimal rounding of 1e11-sized products at half-cent ties differs between engines)
    return out.drop(*cols)


# ---- EDA ---------------------------------------------------------------------------------------

LINEITEM_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe")
def q_describe(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return rounded(eda.describe(li, LINEITEM_NUM), 4)


@query("label_counts")
def q_label_counts(spark, sf):
    return rounded(eda.value_counts(_hybrid(spark, sf), "label"))


@query("class_means")
def q_class_means(spark, sf):
    df = _hybrid(spark, sf).withColumns({"kd": F.col("qty") / (F.col("n_returned") + 1),
                                         "acc": F.col("n_open") / (F.col("n_lines") + 1)})
    return rounded(eda.class_means(df, "label", ["kd", "acc", "span_days", *QTY_PARTS]))


@query("corr_matrix")
def q_corr_matrix(spark, sf):
    return rounded(eda.corr_matrix(_p(spark, sf), PROFILE_COUNTERS))


@query("label_corr")
def q_label_corr(spark, sf):
    return rounded(eda.top_label_correlations(_hybrid(spark, sf), "label", PROFILE_COUNTERS, k=10))


@query("histogram")
def q_histogram(spark, sf):
    return rounded(eda.histogram(read_table(spark, sf, "lineitem"), "l_extendedprice", bins=30), 4)


@query("boxplot")
def q_boxplot(spark, sf):
    return rounded(eda.boxplot_stats(read_table(spark, sf, "events"), "value", "event_type"))


@query("eda_summary")
def q_eda_summary(spark, sf):
    from strata.plans import eda_report
    return rounded(eda_report.summary_flat(_hybrid(spark, sf).drop("score"), "label", fx.OUTLIER_VARS))


@query("class_sample")
def q_class_sample(spark, sf):
    return eda.class_sample(_hybrid(spark, sf), fx.KEY, "label", fx.SAMPLE_FRACTIONS, fx.SEED).select(
        fx.KEY, "label", "qty", "n_returned")


# ---- split / scale / select --------------------------------------------------------------------

@query("split")
def q_split(spark, sf):
    return _build_split(spark, sf).select(fx.KEY, "label", "split")


@query("scale")
def q_scale(spark, sf):
    df = _split(spark, sf)
    st = split.fit_standard(df.where(F.col("split") == "train"), fx.SCALE_COLS)
    return rounded(split.apply_standard(df, st).select(fx.KEY, "split", *fx.SCALE_COLS))


@query("folds")
def q_folds(spark, sf):
    tr = _split(spark, sf).where(F.col("split") == "train")
    return split.assign_folds(tr, fx.KEY, "label", k=5, seed=fx.SEED).select(fx.KEY, "label", "fold")


@query("anova_f")
def q_anova_f(spark, sf):
    tr = _split(spark, sf).where(F.col("split") == "train")
    return rounded(select.select_k_best(select.anova_f(tr, "label", PROFILE_COUNTERS), 10), 4)


@query("mutual_info")
def q_mutual_info(spark, sf):
    tr = _split(spark, sf).where(F.col("split") == "train")
    return rounded(select.binned_mutual_info(tr, "label", PROFILE_COUNTERS, bins=10))


@query("mutual_info_knn")
def q_mutual_info_knn(spark, sf):
    tr = _split(spark, sf).where(F.col("split") == "train")
    return rounded(select.knn_mutual_info(tr, "label", PROFILE_COUNTERS))


# ---- SQL-form models ---------------------------------------------------------------------------

@query("gaussian_nb")
def q_gaussian_nb(spark, sf):
    from strata.operators import models
    df = _split(spark, sf)
    tr = df.where(F.col("split") == "train")
    params = models.gaussian_nb_fit(tr, fx.NB_FEATURES)
    return rounded(models.gaussian_nb_score(df.where(F.col("split") == "test"), params, fx.KEY, fx.NB_FEATURES))


@query("dummy")
def q_dummy(spark, sf):
    from strata.operators import models
    df = _split(spark, sf)
    return models.dummy_most_frequent(df.where(F.col("split") == "train"), df.where(F.col("split") == "test"),
                                      keep=[fx.KEY])


# ---- evaluation on the deterministic scored fixture ---------------------------------------------

@query("binary_metrics")
def q_binary_metrics(spark, sf):
    return rounded(evaluate.binary_metrics(_scored(spark, sf)))


@query("weighted_metrics")
def q_weighted_metrics(spark, sf):
    return rounded(evaluate.weighted_metrics(_scored(spark, sf)))


@query("roc_auc")
def q_roc_auc(spark, sf):
    return rounded(evaluate.roc_auc(_scored(spark, sf)))


@query("confusion")
def q_confusion(spark, sf):
    return rounded(evaluate.confusion_matrix(_scored(spark, sf)))


@query("class_report")
def q_class_report(spark, sf):
    return rounded(evaluate.classification_report(_scored(spark, sf)))


@query("roc_curve")
def q_roc_curve(spark, sf):
    return rounded(evaluate.roc_curve(_scored(spark, sf)))


@query("roc_curve_compact")
def q_roc_curve_compact(spark, sf):
    return rounded(evaluate.roc_curve(_scored(spark, sf), drop_intermediate=True))


@query("pr_curve")
def q_pr_curve(spark, sf):
    return rounded(evaluate.pr_curve(_scored(spark, sf)))


@query("score_hist")
def q_score_hist(spark, sf):
    return rounded(eda.histogram(_scored(spark, sf), "score", bins=30, group="label", density=True))


@query("threshold_sweep")
def q_threshold_sweep(spark, sf):
    return rounded(evaluate.threshold_sweep(_scored(spark, sf)))


@query("evaluation_summary")
def q_evaluation_summary(spark, sf):
    return rounded(evaluate.evaluation_summary(_scored(spark, sf)))


@query("grade")
def q_grade(spark, sf):
    return rounded(evaluate.grade(evaluate.headline_metrics(_scored(spark, sf))))


@query("helper_ratios")
def q_helper_ratios(spark, sf):
    """Hours-like time column and the smoothed helper ratios added with the first label."""
    df = labels.helper_ratios(_p(spark, sf), "span_days", 24.0,
                              {"kd_ratio": ("qty", "n_returned"), "amount_per_line": ("amount", "n_lines"),
                               "urgent_rate": ("n_urgent", "n_orders")})
    return df.select(fx.KEY, "hours", "kd_ratio", "amount_per_line", "urgent_rate")


@query("sens_spec")
def q_sens_spec(spark, sf):
    return rounded(evaluate.sensitivity_specificity(_scored(spark, sf)))


@query("labels_balance")
def q_labels_balance(spark, sf):
    """A2/A3 on a real imbalanced label table: counts and shares of ``quality`` and ``toxic``."""
    lab = read_table(spark, sf, "labels")
    q = eda.value_counts(lab, "quality").withColumn("target", F.lit("quality"))
    t = eda.value_counts(lab, "toxic").withColumn("target", F.lit("toxic"))
    return rounded(q.unionByName(t))


@query("labels_doc_length")
def q_labels_doc_length(spark, sf):
    """A4 on real labels: mean document length per quality class (labels joined to documents on doc_id).

    The label table is small next to documents; only ``doc_id, n_chars`` are read from
    documents (column pruning), and the join is an equi-join AQE can broadcast when small.
    """
    lab = read_table(spark, sf, "labels")
    docs = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    j = lab.join(docs, "doc_id")
    return rounded(j.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.avg("n_chars").alias("mean_chars")))
