"""Binary label builders.

Scores are plain column expressions; quantile thresholds are exact
(distributed rank, :mod:`strata.operators.rank`) and inlined as literals, so
labelling is a narrow projection.  Scores are rounded to 9 digits before the
threshold comparison so float noise cannot flip a tie between engines.
All randomness is a pure function of the row key (md5), never of row order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.exprs import clip, col
from strata.functions.hashing import bernoulli, beta_2_5
from strata.operators.models_common import staged_table
from strata.operators.rank import exact_quantiles

SCORE_DIGITS = 9


def _threshold(df: DataFrame, score_col: str, q: float) -> float:
    scores = staged_table(df.select(score_col), "scores")  # computed once, not in every pass of the quantile
    return exact_quantiles(scores, [score_col], [q])[(score_col,)][0]


def quantile_label(df: DataFrame, score: Column, q: float, strict: bool,
                   score_col: str = "score", label_col: str = "label") -> DataFrame:
    """label = score > quantile(score, q) (``strict``) or >= (T1 / T4 thresholding)."""
    scored = df.withColumn(score_col, F.round(score, SCORE_DIGITS))
    t = _threshold(scored, score_col, q)
    cmp = (F.col(score_col) > F.lit(t)) if strict else (F.col(score_col) >= F.lit(t))
    return scored.withColumn(label_col, cmp.cast("int"))


def composite_score(kills, deaths, hits, shots, wins, matches,
                    w_kd: float = 0.4, w_acc: float = 0.6, w_win: float = 0.3) -> Column:
    """T1 score: weighted smoothed ratios ``kd = k/(d+1)``, ``acc = h/(s+1)``, ``win = w/(m+1)``."""
    kd = col(kills) / (col(deaths) + F.lit(1))
    acc = col(hits) / (col(shots) + F.lit(1))
    win = col(wins) / (col(matches) + F.lit(1))
    return F.lit(w_kd) * kd + F.lit(w_acc) * acc + F.lit(w_win) * win


@dataclass(frozen=True)
class Rule:
    column: str
    op: str          # ">=" or "<="
    threshold: float
    weight: int      # integer weights: the sum is exact (no float-tie fragility)


def rule_label(df: DataFrame, rules: Sequence[Rule], min_points: int, key: str,
               p_fallback: float = 0.4, seed: int = 42,
               score_col: str = "score", label_col: str = "label") -> DataFrame:
    """Weighted fixed-threshold rules (T2): label = sum(weight * rule) >= min_points.

    Rules whose column is absent are skipped; if none is usable the label is a
    seeded Bernoulli(p_fallback) draw (T6).
    """
    usable = [r for r in rules if r.column in df.columns]
    if not usable:
        return df.withColumn(score_col, F.lit(None).cast("int")).withColumn(
            label_col, bernoulli(key, p_fallback, seed))
    pts = None
    for r in usable:
        c = F.col(r.column)
        hit = (c >= F.lit(r.threshold)) if r.op == ">=" else (c <= F.lit(r.threshold))
        term = hit.cast("int") * F.lit(r.weight)
        pts = term if pts is None else pts + term
    return df.withColumn(score_col, pts).withColumn(label_col, (F.col(score_col) >= F.lit(min_points)).cast("int"))


def threshold_label(df: DataFrame, column: str, threshold: float, key: str,
                    p_fallback: float = 0.4, seed: int = 42, label_col: str = "label") -> DataFrame:
    """label = column >= threshold; Bernoulli fallback when the column is absent."""
    if column not in df.columns:
        return df.withColumn(label_col, bernoulli(key, p_fallback, seed))
    return df.withColumn(label_col, (F.col(column) >= F.lit(threshold)).cast("int"))


def bernoulli_label(df: DataFrame, key: str, p: float = 0.4, seed: int = 42,
                    label_col: str = "label") -> DataFrame:
    """Seeded Bernoulli(p) label."""
    return df.withColumn(label_col, bernoulli(key, p, seed))


@dataclass(frozen=True)
class Factor:
    column: str
    scale: float     # contribution = clip(column / scale, 0, 1)
    weight: float


def hybrid_score(df: DataFrame, factors: Sequence[Factor], key: str, noise_weight: float = 0.25,
                 seed: int = 42) -> Column:
    """T4/T5 score: weighted clipped factors + weighted Beta(2,5) noise, divided by the
    total weight of the factors present."""
    terms, total = [], 0.0
    for f in factors:
        if f.column in df.columns:
            terms.append(F.lit(f.weight) * clip(F.col(f.column) / F.lit(f.scale)))
            total += f.weight
    if noise_weight:
        terms.append(F.lit(noise_weight) * beta_2_5(key, seed))
        total += noise_weight
    s = terms[0]
    for t in terms[1:]:
        s = s + t
    return s / F.lit(total)


def hybrid_label(df: DataFrame, factors: Sequence[Factor], key: str, q: float = 0.65,
                 noise_weight: float = 0.25, seed: int = 42,
                 score_col: str = "score", label_col: str = "label") -> DataFrame:
    """T4: label = hybrid score >= quantile(score, q) (non-strict)."""
    return quantile_label(df, hybrid_score(df, factors, key, noise_weight, seed), q, strict=False,
                          score_col=score_col, label_col=label_col)


def independent_target(df: DataFrame, factors: Sequence[Factor], key: str, forbidden: Sequence[str],
                       q: float = 0.65, seed: int = 42, label_col: str = "label"):
    """Replace the label by the hybrid label and strip the leaky columns.

    Returns ``(frame, dropped_names)``; the helper score column is removed too.
    """
    lab = hybrid_label(df, factors, key, q=q, seed=seed, score_col="_score", label_col=label_col)
    present = [c for c in forbidden if c in lab.columns and c != key]
    return lab.drop("_score", *present), present


def helper_ratios(df: DataFrame, time_col: str, unit: float, ratios: dict[str, tuple[str, str]]) -> DataFrame:
    """T8 helper columns: ``time/unit`` and smoothed ratios ``a/(b+1)``."""
    exprs = {"hours": F.col(time_col) / F.lit(unit)}
    for name, (a, b) in ratios.items():
        exprs[name] = F.col(a) / (F.col(b) + F.lit(1))
    return df.withColumns(exprs)
