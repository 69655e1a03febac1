"""Derived row features (D1-D21), percentile-rank features (W1) and pairwise interactions (F1).

Every feature is one column expression; a whole feature family is added with
ONE ``withColumns`` (one Project node, one codegen stage), never a
``withColumn`` loop.  Features whose inputs are absent are skipped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.exprs import entropy_log2, max_share, right_closed_cut, row_sum, safe_ratio
from strata.operators.rank import percent_ranks


@dataclass(frozen=True)
class Ratio:
    name: str
    num: str | Sequence[str]      # a column or a family summed row-wise
    den: str
    den_scale: float = 1.0        # ratio = num / (den * den_scale + plus)
    plus: float = 1.0


def _present(df: DataFrame, cols) -> bool:
    cols = [cols] if isinstance(cols, str) else list(cols)
    return all(c in df.columns for c in cols)


def derived_ratios(df: DataFrame, specs: Sequence[Ratio], sums: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Family sums (``sums``) and smoothed ratios, added in one projection."""
    exprs = {}
    for name, parts in (sums or {}).items():
        if _present(df, parts):
            exprs[name] = row_sum(parts)
    for s in specs:
        num_cols = [s.num] if isinstance(s.num, str) else list(s.num)
        if not (_present(df, num_cols) and _present(df, s.den)):
            continue
        num = F.col(s.num) if isinstance(s.num, str) else row_sum(num_cols)
        den = F.col(s.den).cast("double") * F.lit(s.den_scale)
        exprs[s.name] = safe_ratio(num, den, s.plus)
    return df.withColumns(exprs)


# Experience-tier edges (right-closed) 0, 50, 200, 500, 1000, infinity.
TIER_EDGES = (0.0, 50.0, 200.0, 500.0, 1000.0, float("inf"))


def experience_tier(df: DataFrame, column: str, out: str = "experience_tier",
                    edges: Sequence[float] = TIER_EDGES) -> DataFrame:
    """Right-closed bins ``(0,50], (50,200], (200,500], (500,1000], (1000,inf)`` -> 1..5."""
    if column not in df.columns:
        return df
    return df.withColumn(out, right_closed_cut(F.col(column), edges).cast("double"))


def advanced_indices(df: DataFrame, roles: dict[str, str]) -> DataFrame:
    """D13, D14, D17-D20 from a role -> column mapping (roles absent are skipped).

    roles: kills, deaths, hits, shots, wins, matches, hours, damage, rounds, and the
    derived rates plant_rate, defuse_rate, mvp_rate, win_rate (D5, D6, D11).
    """
    r = {k: v for k, v in roles.items() if v in df.columns}
    e = {}
    if {"kills", "hours"} <= r.keys():
        e["playtime_efficiency"] = safe_ratio(r["kills"], r["hours"])
    if {"kills", "deaths", "hits", "shots"} <= r.keys():
        kd = safe_ratio(r["kills"], r["deaths"])
        acc = safe_ratio(r["hits"], r["shots"])
        win = safe_ratio(r["wins"], r["matches"]) if {"wins", "matches"} <= r.keys() else F.lit(0.5)
        e["performance_index"] = F.lit(0.4) * kd + F.lit(1.5) * acc + F.lit(0.3) * win
    if {"damage", "rounds"} <= r.keys():
        e["damage_efficiency"] = safe_ratio(r["damage"], r["rounds"])
    if {"damage", "kills"} <= r.keys():
        e["damage_per_kill"] = safe_ratio(r["damage"], r["kills"])
    if {"defuse_rate", "plant_rate"} <= r.keys():
        e["clutch_factor"] = F.lit(0.6) * F.col(r["defuse_rate"]) + F.lit(0.4) * F.col(r["plant_rate"])
    if {"mvp_rate", "win_rate"} <= r.keys():
        e["leadership_index"] = safe_ratio(r["mvp_rate"], r["win_rate"], plus=0.01)
        e["team_dependency"] = F.col(r["win_rate"]) - F.col(r["mvp_rate"])
    return df.withColumns(e)


def diversity(df: DataFrame, parts: Sequence[str], eps: float = 1e-8) -> DataFrame:
    """Shannon entropy (bits) of the family shares and the largest share."""
    parts = [p for p in parts if p in df.columns]
    if len(parts) < 2:
        return df
    return df.withColumns({"diversity": entropy_log2(parts, eps), "specialization": max_share(parts, eps)})


def stability(df: DataFrame, cols: Sequence[str], eps: float = 1e-8) -> DataFrame:
    """``1 - std_samp / (mean + eps)`` per column -- a whole-table profile metric.

    One aggregation pass; long output ``(feature, stability)``.
    """
    cols = [c for c in cols if c in df.columns]
    if len(cols) < 2:  # the source asks for two of them at least
        return df.sparkSession.createDataFrame([], "feature string, stability double")
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.stddev_samp(c).alias(f"_s{i}"), F.avg(c).alias(f"_m{i}")]
    wide = df.agg(*aggs).select(*[
        (F.lit(1.0) - F.col(f"_s{i}") / (F.col(f"_m{i}") + F.lit(eps))).alias(f"_v{i}")
        for i in range(len(cols))])
    stack = ", ".join(f"'{c}', _v{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (feature, stability)")


def percentile_features(df: DataFrame, cols: Sequence[str], suffix: str = "_percentile") -> DataFrame:
    """Pandas ``rank(pct=True)`` for each column (exact, distributed, one ranking pass)."""
    return percent_ranks(df, [c for c in cols if c in df.columns], suffix=suffix)


def interaction_columns(cols: Sequence[str], preferred: Sequence[str] | None = None,
                        min_preferred: int = 3, fallback: int = 8) -> list[str]:
    """F1 column choice: the preferred list if >= ``min_preferred`` present, else the first ``fallback``."""
    if preferred:
        chosen = [c for c in preferred if c in cols]
        if len(chosen) >= min_preferred:
            return chosen
    return list(cols)[:fallback]


def interactions(df: DataFrame, cols: Sequence[str], degree: int = 2, sep: str = "__x__") -> DataFrame:
    """interaction-only products of every column combination of size 2..degree.

    One projection with C(k,2)+... generated products; the original columns stay
    (they are not re-emitted).
    """
    exprs = {}
    for d in range(2, degree + 1):
        for combo in combinations(cols, d):
            e = F.col(combo[0]).cast("double")
            for c in combo[1:]:
                e = e * F.col(c).cast("double")
            exprs[sep.join(combo)] = e
    return df.withColumns(exprs)
