"""The flagship query: the minimum end-to-end slice of the pipeline.

profile (3-table join + aggregate) -> IQR fences (exact, distributed) -> winsorise
-> derived ratios -> hybrid label (exact quantile threshold) -> class-conditional means.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.functions.exprs import rounded
from strata.operators import clean, derive, eda, labels
from strata.plans import fixture as fx
from strata.plans.oracle import PROFILE, _fences_cte, _hi, _lo, u
from strata.sources.tables import PROFILE_COUNTERS, entity_profile

FLAGSHIP_MEANS = ["qty", "amount", "revenue", "qty_per_line", "amount_per_line", "urgent_rate"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof = entity_profile(spark, sf_dir).cache()
    fences = clean.fit_iqr_fences(prof, PROFILE_COUNTERS)
    capped = clean.apply_iqr_cap(prof, fences)
    feats = derive.derived_ratios(capped, [r for r in fx.RATIOS if r.name in FLAGSHIP_MEANS])
    lab = labels.hybrid_label(feats, fx.HYBRID, fx.KEY, q=fx.HYBRID_Q, noise_weight=fx.HYBRID_NOISE, seed=fx.SEED)
    return rounded(eda.class_means(lab, "label", FLAGSHIP_MEANS))


def _sql() -> str:
    cols = PROFILE_COUNTERS
    capped = ", ".join(f"least(greatest(CAST({c} AS DOUBLE), {_lo(c)}), {_hi(c)}) AS {c}" for c in cols)
    beta = "list_sort([" + ", ".join(u(fx.KEY, i) for i in range(1, 7)) + "])[2]"
    score = (f"round((0.5 * least(greatest(span_days / 2000.0, 0.0), 1.0)"
             f" + 0.25 * least(greatest(n_lines / 60.0, 0.0), 1.0) + 0.25 * {beta}) / 1.0, 9)")
    ratios = {r.name: r for r in fx.RATIOS}

    def ratio(name):
        r = ratios[name]
        return f"CAST({r.num} AS DOUBLE) / (CAST({r.den} AS DOUBLE) + 1.0)"
    union = "\nUNION ALL\n".join(
        f"SELECT label, '{m}' AS \"column\", round(avg({m}), 6) AS mean FROM lab GROUP BY label"
        for m in FLAGSHIP_MEANS)
    return f"""WITH {PROFILE}, {_fences_cte(cols)},
cap AS (SELECT {fx.KEY}, {capped} FROM profile, fe),
der AS (SELECT *, {ratio('qty_per_line')} AS qty_per_line, {ratio('amount_per_line')} AS amount_per_line,
               {ratio('urgent_rate')} AS urgent_rate FROM cap),
sc AS (SELECT *, {score} AS score FROM der),
lab AS (SELECT *, CAST(score >= (SELECT quantile_cont(score, {fx.HYBRID_Q}) FROM sc) AS INTEGER) AS label FROM sc)
{union}"""


FLAGSHIP_SQL = _sql()
