"""Column roles and parameters of the entity-profile stand-in (FIXTURES.md).

Thresholds of the source pipeline are re-scaled to the profile columns here,
as parameters, so the operators themselves stay schema-agnostic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import md5_int
from strata.operators.derive import Ratio
from strata.operators.labels import Factor, Rule
from strata.sources.tables import PROFILE_COUNTERS, QTY_PARTS

KEY = "c_custkey"
SEED = 42
FEATURES = list(PROFILE_COUNTERS)

# Leaky-column list (P1) and the label ingredients stripped by T7.
LEAKY = ["span_days", "n_lines", "hours", "kd_ratio", "accuracy", "win_rate", "amount_per_line", "urgent_rate"]
FORBIDDEN = ["span_days", "n_lines", "n_open", "n_done", "hours"]

# Hybrid label (T4) -- span_days / 2000 weight .5, n_lines / 60 weight .25, Beta(2,5) weight .25, q .65.
HYBRID = [Factor("span_days", 2000.0, 0.5), Factor("n_lines", 60.0, 0.25)]
HYBRID_NOISE = 0.25
HYBRID_Q = 0.65

# Rule label (T2) -- qty >= 1000 (4), n_returned <= 12 (3), amount >= 2,000,000 (3); >= 7 points.
RULES = [Rule("qty", ">=", 1000, 4), Rule("n_returned", "<=", 12, 3), Rule("amount", ">=", 2000000, 3)]
RULE_MIN = 7

EXPERIENCE_MIN_DAYS = 1500        # T3
ACTIVITY_MIN_LINES = 20           # P5
BERNOULLI_P = 0.4                 # T6

# Role mapping for the derived features.
ROLES = dict(kills="qty", deaths="n_returned", damage="amount", money="revenue", rounds="n_lines",
             hits="n_open", shots="n_lines", wins="n_done", matches="n_orders", hours="span_days",
             plant_rate="disc_rate", defuse_rate="taxed_rate", mvp_rate="urgent_rate", win_rate="done_rate")

RATIOS = [
    Ratio("qty_per_line", "qty", "n_lines"),
    Ratio("returns_per_line", "n_returned", "n_lines"),
    Ratio("amount_per_line", "amount", "n_lines"),
    Ratio("revenue_per_line", "revenue", "n_lines"),
    Ratio("disc_rate", "n_disc", "n_lines", den_scale=0.5),
    Ratio("taxed_rate", "n_taxed", "n_lines", den_scale=0.5),
    Ratio("af_ao_share", ["qty_af", "qty_ao"], "qty"),
    Ratio("rf_share", "qty_rf", "qty"),
    Ratio("nf_share", "qty_nf", "qty"),
    Ratio("order_span", "span_days", "n_orders", den_scale=60.0),
    Ratio("urgent_rate", "n_urgent", "n_orders"),
    Ratio("done_rate", "n_done", "n_orders"),
]
SUMS = {"af_ao_qty": ["qty_af", "qty_ao"]}

STABILITY_COLS = ["qty_per_line", "returns_per_line", "amount_per_line"]
INTERACTION_PREFERRED = ["qty", "n_returned", "amount", "revenue", "n_lines", "n_orders", "span_days"]
MISSING_COLS = ["qty", "amount", "n_returned"]
MISSING_COUNTERS = ["n_returned", "qty_af", "n_done", "qty"]
NULL_COLS = ["qty", "amount", "n_returned", "revenue", "span_days"]
SCALE_COLS = ["qty", "amount", "n_returned", "revenue", "span_days"]
NB_FEATURES = ["qty", "n_returned", "amount", "n_open", "n_disc"]
OUTLIER_VARS = ["qty", "n_returned", "amount", "revenue"]
SAMPLE_FRACTIONS = {0: 0.2, 1: 0.4}


def plant_violations(df: DataFrame) -> DataFrame:
    """Consistency-test fixture: the six parts sum exactly to qty, so plant violations by hash.

    hash % 10 = 0: qty_af and qty_ro doubled; hash % 7 = 0: n_done += n_orders.
    """
    h = md5_int(KEY, SEED, "plant")
    return df.withColumns({
        "qty_af": F.when(h % 10 == 0, F.col("qty_af") * 2).otherwise(F.col("qty_af")),
        "qty_ro": F.when(h % 10 == 0, F.col("qty_ro") * 2).otherwise(F.col("qty_ro")),
        "n_done": F.when(h % 7 == 0, F.col("n_done") + F.col("n_orders")).otherwise(F.col("n_done")),
    })


def plant_nulls(df: DataFrame) -> DataFrame:
    """Missing-value fixture: column c is NULL where md5(key:42:null_c) % 10 = 0."""
    return df.withColumns({c: F.when(md5_int(KEY, SEED, f"null_{c}") % 10 == 0, F.lit(None))
                           .otherwise(F.col(c)) for c in NULL_COLS})


def plant_missing(df: DataFrame, cols) -> DataFrame:
    """Missing-value fixture in DOUBLE columns: md5(key:42:missing_c) % 12 = 0 NULL, 1 NaN, 2 inf, 3 -inf."""
    out = {}
    for c in cols:
        h = md5_int(KEY if KEY in df.columns else df.columns[0], SEED, f"missing_{c}") % 12
        out[c] = (F.when(h == 0, F.lit(None)).when(h == 1, F.lit(float("nan"))).when(h == 2, F.lit(float("inf")))
                  .when(h == 3, F.lit(float("-inf"))).otherwise(F.col(c).cast("double")))
    return df.withColumns(out)


def plant_null_counters(df: DataFrame, cols) -> DataFrame:
    """:func:`plant_violations` with NULL in the counters where md5(key:42:missing_c) % 12 = 0."""
    df = plant_violations(df)
    return df.withColumns({c: F.when(md5_int(KEY, SEED, f"missing_{c}") % 12 != 0, F.col(c)) for c in cols})


def scored(df: DataFrame, label_df: DataFrame) -> DataFrame:
    """Deterministic scored rows (F-4): z from population-standardised qty and amount.

    ``score = round(1 / (1 + exp(-z)), 3)``, ``pred = score >= 0.5``.
    """
    st = df.agg(F.avg("qty").alias("mq"), F.stddev_pop("qty").alias("sq"),
                F.avg("amount").alias("ma"), F.stddev_pop("amount").alias("sa")).first()
    z = (F.col("qty") - F.lit(st["mq"])) / F.lit(st["sq"]) + (F.col("amount") - F.lit(st["ma"])) / F.lit(st["sa"])
    s = F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 3)
    return label_df.select(KEY, "label", "qty", "amount").select(
        KEY, "label", s.alias("score"), (s >= 0.5).cast("int").alias("pred"))
