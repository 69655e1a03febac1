"""Reproducible splits, folds and scaling.

Assignment is a pure function of ``md5(key:seed)``: narrow, no shuffle, same
result on every run and partitioning.  ``exact=True`` hits the stratum sizes
exactly: the (hash, key) cut points at the wanted ranks per label come from
the distributed rank (bounded: a few rows per label) and are inlined, so the
assignment itself is still a narrow projection -- no per-label window (which
would put each class in one task) and no join back.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import md5_int, md5_uniform
from strata.operators.models_common import staged_table
from strata.operators.rank import select_ranks


def validate_split(test: float = 0.15, val: float = 0.15, folds: int = 5, tol: float = 1e-9) -> None:
    """Fractions in (0,1), train fraction positive, at least two folds."""
    for name, v in (("test", test), ("val", val)):
        if not 0.0 <= v < 1.0:
            raise ValueError(f"{name} fraction must be in [0, 1): {v}")
    if test + val >= 1.0 - tol:
        raise ValueError("test + val must leave a training share")
    if folds < 2:
        raise ValueError("need at least 2 folds")


def _tuple_le(cols: Sequence[str], values: tuple) -> Column:
    """Lexicographic ``(cols) <= values``."""
    (c0, *rest), (v0, *vrest) = cols, values
    if not rest:
        return F.col(c0) <= F.lit(v0)
    return (F.col(c0) < F.lit(v0)) | ((F.col(c0) == F.lit(v0)) & _tuple_le(rest, tuple(vrest)))


def _label_counts(df: DataFrame, label: str) -> dict:
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def split_sizes(n: int, test: float, val: float) -> tuple[int, int]:
    """Stratum sizes: test = ceil(test * n), then val = ceil(val / (1 - test) * rest)."""
    n_test = math.ceil(test * n)
    rest = n - n_test
    n_val = math.ceil(val / (1.0 - test) * rest)
    return n_test, n_val


def assign_split(df: DataFrame, key: str, label: str | None = None, test: float = 0.15,
                 val: float = 0.15, seed: int = 42, exact: bool = False,
                 out: str = "split") -> DataFrame:
    """Add ``split`` in {'train','val','test'}.

    Default: thresholds on the md5 uniform (independent of the label, so every
    stratum is split in the same proportions in expectation).  ``exact``:
    per-label sizes ``ceil`` as in :func:`split_sizes`, ranks by (hash, key).
    """
    validate_split(test, val)
    if not exact:
        u = md5_uniform(key, seed, "split")
        return df.withColumn(out, F.when(u < F.lit(test), "test")
                             .when(u < F.lit(test + val), "val").otherwise("train"))
    if label is None:
        raise ValueError("exact split needs a label")
    h = df.withColumn("_h", md5_int(key, seed, "split"))
    counts = _label_counts(h, label)
    wanted = {}
    for g, n in counts.items():
        n_test, n_val = split_sizes(n, test, val)
        wanted[g] = [r for r in (n_test - 1, n_test + n_val - 1) if 0 <= r < n]
    cuts = select_ranks(staged_table(h.select(label, "_h", key), "hashes"), label, ["_h", key], wanted)
    expr = F.lit("train")
    for g, n in counts.items():
        n_test, n_val = split_sizes(n, test, val)
        cut = cuts[g]
        e = F.lit("train")
        if n_test + n_val - 1 in cut and n_val > 0:
            e = F.when(_tuple_le(["_h", key], cut[n_test + n_val - 1]), "val").otherwise(e)
        if n_test - 1 in cut and n_test > 0:
            e = F.when(_tuple_le(["_h", key], cut[n_test - 1]), "test").otherwise(e)
        expr = F.when(F.col(label) == F.lit(g), e).otherwise(expr)
    return h.withColumn(out, expr).drop("_h")


def assign_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42,
                 out: str = "fold") -> DataFrame:
    """Stratified k folds: within each label, rows ordered by (hash, key), fold = floor(r*k/n)."""
    validate_split(folds=k)
    h = df.withColumn("_h", md5_int(key, seed, "fold"))
    counts = _label_counts(h, label)
    wanted = {g: sorted({-(-j * n // k) for j in range(1, k) if -(-j * n // k) < n}) for g, n in counts.items()}
    cuts = select_ranks(staged_table(h.select(label, "_h", key), "hashes"), label, ["_h", key], wanted)
    expr = F.lit(0)
    for g in counts:
        e = F.lit(0)
        for r in wanted[g]:
            # fold >= j  <=>  (hash, key) >= tuple at rank ceil(j*n/k)
            e = e + (~_tuple_le(["_h", key], cuts[g][r]) | _tuple_eq(["_h", key], cuts[g][r])).cast("int")
        expr = F.when(F.col(label) == F.lit(g), e).otherwise(expr)
    return h.withColumn(out, expr).drop("_h")


def _tuple_eq(cols: Sequence[str], values: tuple) -> Column:
    e = F.lit(True)
    for c, v in zip(cols, values):
        e = e & (F.col(c) == F.lit(v))
    return e


def fit_standard(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """X2 fit: mean and population std per column (one aggregation)."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(c).alias(f"_m{i}"), F.stddev_pop(c).alias(f"_s{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"_m{i}"], row[f"_s{i}"]) for i, c in enumerate(cols)}


def apply_standard(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """X2 apply: ``(x - mean) / std``; a constant column (std 0) maps to 0."""
    e = {}
    for c, (m, s) in stats.items():
        if m is None:
            continue
        e[c] = F.lit(0.0) if not s else (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
    return df.withColumns(e)
