"""Cleaning operators (C1-C13, P1, P5): fit -> small dict of statistics, apply -> lazy expressions.

Fits run one aggregation job and bring back a bounded result (a few numbers
per column).  Applies inline those numbers as literals: the applied plan is a
single narrow projection inside whole-stage codegen -- no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.exprs import clip, finite, is_missing, numeric_columns, present, row_sum
from strata.operators.rank import exact_quantiles, quantiles


def drop_columns(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Drop the listed columns that exist; return the frame and the names dropped."""
    present = [n for n in names if n in df.columns]
    return df.drop(*present), present


def min_activity_filter(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """Keep rows with ``column >= threshold`` (P5); the filter is pushed to the scan."""
    return df.where(F.col(column) >= F.lit(threshold))


def activity_counts(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """``rows_before, rows_kept, rows_removed`` of :func:`min_activity_filter`, in one aggregation.

    Not by ``observe``: a session that has observed anything can't apply an MLlib model that keeps its training summary
    (the summary refers to the session, which then can't be serialized any more).
    """
    counts = df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(F.col(column) >= F.lit(threshold)).alias("rows_kept"))
    return counts.withColumn("rows_removed", F.col("rows_before") - F.col("rows_kept"))


def fit_iqr_fences(df: DataFrame, cols: Sequence[str], k: float = 1.5,
                   method: str = "exact") -> dict[str, tuple]:
    """IQR fences per column (C1): ``{col: (q1, q3, lower, upper)}``; linear-interpolated quartiles."""
    qs = quantiles(df, cols, [0.25, 0.75], method=method)
    out = {}
    for c in cols:
        q1, q3 = qs[c]
        if q1 is None:
            out[c] = (None, None, None, None)
            continue
        iqr = q3 - q1
        out[c] = (q1, q3, q1 - k * iqr, q3 + k * iqr)
    return out


def fences_frame(spark, fences: dict[str, tuple]) -> DataFrame:
    rows = [(c, *v) for c, v in fences.items()]
    return spark.createDataFrame(rows, "column string, q1 double, q3 double, lower double, upper double")


def apply_iqr_cap(df: DataFrame, fences: dict[str, tuple]) -> DataFrame:
    """Winsorise every fenced column to ``[lower, upper]`` (C2); values become DOUBLE, NULL and NaN become NULL."""
    exprs = {}
    for c, (_, _, lo, hi) in fences.items():
        if lo is None:
            continue
        exprs[c] = clip(c, lo, hi)
    return df.withColumns(exprs)


def outlier_counts(df: DataFrame, fences: dict[str, tuple]) -> DataFrame:
    """Rows strictly outside the fences, per column, in one aggregation pass.

    Returns long rows ``(column, n_outliers, n_rows, outlier_pct)``.
    """
    cols = [c for c, v in fences.items() if v[2] is not None]
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        _, _, lo, hi = fences[c]
        aggs.append(F.count_if((present(c) < F.lit(lo)) | (present(c) > F.lit(hi))).alias(f"_o{i}"))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', _o{i}" for i, c in enumerate(cols))
    long = wide.selectExpr("_n", f"stack({len(cols)}, {stack}) as (column, n_outliers)")
    return long.select("column", "n_outliers", F.col("_n").alias("n_rows"),
                       F.try_divide(F.col("n_outliers") * F.lit(100.0), F.col("_n")).alias("outlier_pct"))


def consistency_fix(df: DataFrame, floor_col: str | None = None, floor: int = 1,
                    parts: Sequence[str] = (), total_col: str | None = None, tolerance: float = 1.1,
                    cap_col: str | None = None, cap_by: str | None = None) -> DataFrame:
    """Repair internally inconsistent counters (C4-C8), row-local and narrow.

    * ``floor_col`` is floored at ``floor``;
    * when ``sum(parts) > tolerance * total`` every part is rescaled to
      ``cast(part * total / sum as bigint)`` (truncation);
    * ``cap_col`` is capped at ``cap_by``.
    Adds ``fix_floor``, ``fix_parts``, ``fix_cap`` (0/1) and ``n_fixes`` columns;
    :func:`correction_counts` has the totals (C8).  A rule whose inputs are missing
    (NULL or NaN) changes nothing.
    """
    def known(cond, *cols):
        for c in cols:
            if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
                cond = cond & ~F.isnan(c)
        return F.coalesce(cond, F.lit(False))

    out = {}
    flags = []
    if floor_col:
        low = known(F.col(floor_col) < F.lit(floor), floor_col)
        out["fix_floor"] = low.cast("int")
        out[floor_col] = F.when(low, F.lit(floor).cast(df.schema[floor_col].dataType)).otherwise(F.col(floor_col))
        flags.append("fix_floor")
    if parts and total_col:
        s = row_sum(parts)
        bad = known(s > F.col(total_col) * F.lit(tolerance), total_col, *parts)
        out["fix_parts"] = bad.cast("int")
        for p in parts:
            out[p] = F.when(bad, (F.col(p) * F.col(total_col) / s).cast("bigint")).otherwise(F.col(p))
        flags.append("fix_parts")
    if cap_col and cap_by:
        over = known(F.col(cap_col) > F.col(cap_by), cap_col, cap_by)
        out["fix_cap"] = over.cast("int")
        out[cap_col] = F.when(over, F.col(cap_by)).otherwise(F.col(cap_col))
        flags.append("fix_cap")
    # withColumns evaluates every expression against the *input* row, so the
    # flags and the repairs all see the original values.
    fixed = df.withColumns(out)
    return fixed.withColumn("n_fixes", row_sum(flags) if flags else F.lit(0))


def correction_counts(fixed: DataFrame) -> DataFrame:
    """Total corrections (C8) of a :func:`consistency_fix` result: one row ``fix_floor, fix_parts, fix_cap, corrections``."""
    flags = [c for c in ("fix_floor", "fix_parts", "fix_cap") if c in fixed.columns]
    return fixed.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in flags],
                     F.coalesce(F.sum("n_fixes"), F.lit(0)).alias("corrections"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing (NULL or NaN) count per column in one pass (C9): ``(column, n_missing)``."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    aggs = [F.count_if(is_missing(c)).alias(f"_m{i}") for i, c in enumerate(cols)]
    stack = ", ".join(f"'{c}', _m{i}" for i, c in enumerate(cols))
    return df.agg(*aggs).selectExpr(f"stack({len(cols)}, {stack}) as (column, n_missing)")


def fit_medians(df: DataFrame, cols: Sequence[str], method: str = "exact") -> dict[str, float]:
    """Median per column over finite values (C10/C11 fit)."""
    df = df.select(*[finite(c).alias(c) for c in cols])
    if method == "exact":
        res = exact_quantiles(df, cols, [0.5])
        return {k[-1]: v[0] for k, v in res.items()}
    return {c: v[0] for c, v in quantiles(df, cols, [0.5], method=method).items()}


def apply_impute(df: DataFrame, fills: dict[str, float]) -> DataFrame:
    """Replace NULL/NaN/inf with the fitted value."""
    exprs = {}
    for c, v in fills.items():
        exprs[c] = F.coalesce(finite(c), F.lit(v))
    return df.withColumns(exprs)


def clean_summary(before: DataFrame, after: DataFrame, feature_cols: Sequence[str] | None = None) -> DataFrame:
    """Before/after summary (C13): one row ``rows_before, rows_after, removed_pct, n_features, n_missing``."""
    feats = list(feature_cols) if feature_cols is not None else numeric_columns(after)
    # one pass over both inputs (union + single aggregate), no join
    miss = (sum(is_missing(c).cast("long") for c in feats) if feats else F.lit(0)).cast("long")
    both = (before.select(F.lit(1).alias("_b"), F.lit(0).alias("_a"), F.lit(0).cast("long").alias("_m"))
            .unionByName(after.select(F.lit(0).alias("_b"), F.lit(1).alias("_a"), miss.alias("_m"))))
    return both.agg(F.sum("_b").cast("bigint").alias("rows_before"),
                    F.sum("_a").cast("bigint").alias("rows_after"),
                    F.sum("_m").cast("bigint").alias("n_missing")).select(
        "rows_before", "rows_after",
        F.try_divide((F.col("rows_before") - F.col("rows_after")) * F.lit(100.0), F.col("rows_before"))
        .alias("removed_pct"),
        F.lit(len(feats)).cast("bigint").alias("n_features"), "n_missing")
