"""Independent DuckDB SQL for every SQL-expressible registered query (correctness oracle).

Written from the operator definitions, not from the Spark plans.  The views
``region nation customer ... conversations`` are pre-registered by the checker.
"""

from __future__ import annotations

from strata.plans import fixture as fx
from strata.sources.tables import PROFILE_COUNTERS, QTY_PARTS

K = fx.KEY
TWO_32 = 4294967296.0


def u(key: str, tag) -> str:
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{fx.SEED}:{tag}'), 1, 8))::BIGINT / {TWO_32})"


def h(key: str, tag) -> str:
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{fx.SEED}:{tag}'), 1, 8))::BIGINT)"


def r6(e: str, d: int = 6) -> str:
    return f"round({e}, {d})"


def _qpart(flag, status):
    return (f"CAST(sum(CASE WHEN l.l_returnflag = '{flag}' AND l.l_linestatus = '{status}' "
            f"THEN l.l_quantity ELSE 0 END) AS BIGINT)")


PROFILE = f"""profile AS (
  SELECT c.c_custkey,
    CAST(count(DISTINCT o.o_orderkey) AS BIGINT) AS n_orders,
    CAST(count(DISTINCT CASE WHEN o.o_orderstatus = 'F' THEN o.o_orderkey END) AS BIGINT) AS n_done,
    CAST(count(DISTINCT CASE WHEN o.o_orderpriority = '1-URGENT' THEN o.o_orderkey END) AS BIGINT) AS n_urgent,
    CAST(count(DISTINCT CASE WHEN o.o_orderpriority = '2-HIGH' THEN o.o_orderkey END) AS BIGINT) AS n_high,
    CAST(count(*) AS BIGINT) AS n_lines,
    CAST(sum(l.l_quantity) AS BIGINT) AS qty,
    CAST(sum(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_returned,
    CAST(sum(CAST(l.l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS amount,
    CAST(round(sum(CAST(l.l_extendedprice AS DECIMAL(15,2))
                   * (CAST(1 AS DECIMAL(5,2)) - CAST(l.l_discount AS DECIMAL(5,2)))), 2) AS DOUBLE) AS revenue,
    CAST(sum(CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_open,
    CAST(sum(CASE WHEN l.l_discount >= 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS n_disc,
    CAST(sum(CASE WHEN l.l_tax >= 0.04 THEN 1 ELSE 0 END) AS BIGINT) AS n_taxed,
    CAST(date_diff('day', min(o.o_orderdate)::DATE, max(o.o_orderdate)::DATE) AS BIGINT) AS span_days,
    {_qpart('A', 'F')} AS qty_af, {_qpart('A', 'O')} AS qty_ao, {_qpart('R', 'F')} AS qty_rf,
    {_qpart('R', 'O')} AS qty_ro, {_qpart('N', 'F')} AS qty_nf, {_qpart('N', 'O')} AS qty_no
  FROM customer c
  JOIN orders o ON o.o_custkey = c.c_custkey
  JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  GROUP BY c.c_custkey)"""


def _hybrid_cte() -> str:
    beta = "list_sort([" + ", ".join(u(K, i) for i in range(1, 7)) + "])[2]"
    score = (f"round((0.5 * least(greatest(span_days / 2000.0, 0.0), 1.0)"
             f" + 0.25 * least(greatest(n_lines / 60.0, 0.0), 1.0) + 0.25 * {beta}) / 1.0, 9)")
    return f"""{PROFILE},
hs AS (SELECT *, {score} AS score FROM profile),
hyb AS (SELECT *, CAST(score >= (SELECT quantile_cont(score, {fx.HYBRID_Q}) FROM hs) AS INTEGER) AS label FROM hs)"""


def _split_cte() -> str:
    hh = h(K, "split")
    return f"""{_hybrid_cte()},
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {hh}, {K}) AS r,
              count(*) OVER (PARTITION BY label) AS n FROM hyb),
sz AS (SELECT *, CAST(ceil(0.15 * n) AS BIGINT) AS n_test FROM rk),
sz2 AS (SELECT *, CAST(ceil(0.15 / (1.0 - 0.15) * (n - n_test)) AS BIGINT) AS n_val FROM sz),
spl AS (SELECT * EXCLUDE (r, n, n_test, n_val),
          CASE WHEN r <= n_test THEN 'test' WHEN r <= n_test + n_val THEN 'val' ELSE 'train' END AS split
        FROM sz2)"""


def _scored_cte() -> str:
    return f"""{_hybrid_cte()},
st AS (SELECT avg(qty) AS mq, stddev_pop(qty) AS sq, avg(amount) AS ma, stddev_pop(amount) AS sa FROM profile),
zz AS (SELECT p.{K}, p.label, round(1.0 / (1.0 + exp(-((p.qty - st.mq) / st.sq + (p.amount - st.ma) / st.sa))), 3)
              AS score FROM hyb p, st),
sc AS (SELECT {K}, label, score, CAST(score >= 0.5 AS INTEGER) AS pred FROM zz)"""


def _union(parts):
    return "\nUNION ALL\n".join(parts)


def _fences_cte(cols, src="profile", name="fe"):
    sel = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in cols)
    return f"{name} AS (SELECT {sel} FROM {src})"


def _lo(c):
    return f"(q1_{c} - 1.5 * (q3_{c} - q1_{c}))"


def _hi(c):
    return f"(q3_{c} + 1.5 * (q3_{c} - q1_{c}))"


def build() -> dict[str, str]:
    s: dict[str, str] = {}
    P = PROFILE
    cols = PROFILE_COUNTERS

    s["profile"] = f"WITH {P} SELECT * FROM profile"
    keep = [c for c in ["c_custkey", *cols] if c not in fx.LEAKY]
    s["drop_leaky"] = f"WITH {P} SELECT {', '.join(keep)} FROM profile"
    s["min_activity_filter"] = (f"WITH {P} SELECT {K}, n_lines, qty FROM profile "
                                f"WHERE n_lines >= {fx.ACTIVITY_MIN_LINES}")
    dtypes = {c: "bigint" for c in ["c_custkey", *cols]}
    dtypes.update(amount="double", revenue="double")
    s["column_info"] = f"WITH {P} " + _union(
        [f"SELECT '{c}' AS \"column\", '{dtypes[c]}' AS dtype, count({c}) AS non_null FROM profile"
         for c in ["c_custkey", *cols]])
    s["preview"] = f"WITH {P} SELECT {K}, n_orders, qty, amount FROM profile ORDER BY {K} LIMIT 5"

    fam = [c for c in ["c_custkey", *cols] if "qty_" in c]
    feats = [c for c in cols if c not in ("span_days", "n_lines")]
    s["train_matrix"] = (f"WITH {_hybrid_cte()} SELECT {K}, label, {', '.join(feats)}, "
                         f"{' + '.join(fam)} AS qty_family, qty_af + qty_ao AS qty_a FROM hyb")
    s["csv_roundtrip"] = s["profile"]
    s["split_files"] = f"WITH {_split_cte()} SELECT {K}, label, qty, split FROM spl"
    s["resolve_source"] = f"WITH {P} SELECT {K}, qty, 'processed' AS source FROM profile"
    s["split_check"] = f"""WITH {_split_cte()} SELECT split, count(*) AS n, count(DISTINCT {K}) AS n_keys,
  CAST(sum(label) AS BIGINT) AS positives FROM spl GROUP BY split"""

    # cleaning
    s["iqr_fences"] = f"WITH {P} " + _union(
        [f"SELECT '{c}' AS \"column\", {r6(f'quantile_cont({c}, 0.25)')} AS q1, "
         f"{r6(f'quantile_cont({c}, 0.75)')} AS q3, "
         f"{r6(f'quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))')} AS lower, "
         f"{r6(f'quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))')} AS upper "
         f"FROM profile" for c in cols])
    capped = ", ".join(f"{r6(f'least(greatest(CAST({c} AS DOUBLE), {_lo(c)}), {_hi(c)})')} AS {c}" for c in cols)
    s["iqr_cap"] = f"WITH {P}, {_fences_cte(cols)} SELECT {K}, {capped} FROM profile, fe"
    s["outlier_counts"] = f"WITH {P}, {_fences_cte(cols)} " + _union(
        [f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} < {_lo(c)} OR {c} > {_hi(c)}) AS BIGINT) "
         f"AS n_outliers, CAST(count(*) AS BIGINT) AS n_rows, "
         f"{r6(f'count(*) FILTER (WHERE {c} < {_lo(c)} OR {c} > {_hi(c)}) * 100.0 / count(*)')} AS outlier_pct "
         f"FROM profile, fe GROUP BY ALL" for c in cols])

    hp = h(K, "plant")
    parts_sum = " + ".join(QTY_PARTS)
    rescaled = ", ".join(
        f"CASE WHEN ({parts_sum}) > qty * 1.1 THEN CAST(trunc({p} * qty / ({parts_sum})) AS BIGINT) ELSE {p} END AS {p}"
        for p in QTY_PARTS)
    s["consistency_fix"] = f"""WITH {P},
pl AS (SELECT * REPLACE (
         CASE WHEN {hp} % 10 = 0 THEN qty_af * 2 ELSE qty_af END AS qty_af,
         CASE WHEN {hp} % 10 = 0 THEN qty_ro * 2 ELSE qty_ro END AS qty_ro,
         CASE WHEN {hp} % 7 = 0 THEN n_done + n_orders ELSE n_done END AS n_done) FROM profile),
fx AS (SELECT {K}, greatest(n_returned, 1) AS n_returned, {rescaled}, least(n_done, n_orders) AS n_done,
         CAST(n_returned < 1 AS INTEGER) AS fix_floor,
         CAST(({parts_sum}) > qty * 1.1 AS INTEGER) AS fix_parts,
         CAST(n_done > n_orders AS INTEGER) AS fix_cap FROM pl)
SELECT *, fix_floor + fix_parts + fix_cap AS n_fixes FROM fx"""

    nulled = ", ".join(f"CASE WHEN {h(K, 'null_' + c)} % 10 = 0 THEN NULL ELSE {c} END AS {c}" for c in fx.NULL_COLS)
    nl = f"{P}, nl AS (SELECT {K}, {nulled} FROM profile)"
    s["null_counts"] = f"WITH {nl} " + _union(
        [f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_missing FROM nl"
         for c in fx.NULL_COLS])
    med = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in fx.NULL_COLS)
    filled = ", ".join(f"{r6(f'coalesce(CAST({c} AS DOUBLE), m_{c})')} AS {c}" for c in fx.NULL_COLS)
    s["median_impute"] = f"WITH {nl}, md AS (SELECT {med} FROM nl) SELECT {K}, {filled} FROM nl, md"

    # missing values: NULL, NaN and infinities planted by hash
    def planted(key, c):
        m = f"{h(key, 'missing_' + c)} % 12"
        return (f"CASE WHEN {m} = 0 THEN NULL WHEN {m} = 1 THEN 'nan'::DOUBLE WHEN {m} = 2 THEN 'inf'::DOUBLE "
                f"WHEN {m} = 3 THEN '-inf'::DOUBLE ELSE CAST({c} AS DOUBLE) END AS {c}")
    mc = ["qty", "amount", "n_returned"]
    ms = f"{P}, ms AS (SELECT {K}, {', '.join(planted(K, c) for c in mc)} FROM profile)"
    qf = ", ".join(f"quantile_cont({c}, {p}) FILTER (WHERE NOT isnan({c})) AS q{n}_{c}" for c in mc for n, p in ((1, 0.25), (3, 0.75)))
    fences = f"{ms}, fe AS (SELECT {qf} FROM ms)"
    s["iqr_cap_missing"] = f"WITH {fences} SELECT {K}, " + ", ".join(
        f"CASE WHEN {c} IS NULL OR isnan({c}) THEN NULL WHEN {c} < {_lo(c)} THEN {r6(_lo(c))} "
        f"WHEN {c} > {_hi(c)} THEN {r6(_hi(c))} ELSE {r6(c)} END AS {c}" for c in mc) + " FROM ms, fe"
    s["outlier_counts_missing"] = f"WITH {fences} " + _union(
        [f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE NOT isnan({c}) AND ({c} < {_lo(c)} OR {c} > {_hi(c)})) AS n_outliers, "
         f"count(*) AS n_rows, {r6(f'count(*) FILTER (WHERE NOT isnan({c}) AND ({c} < {_lo(c)} OR {c} > {_hi(c)})) * 100.0 / count(*)')} "
         f"AS outlier_pct FROM ms, fe GROUP BY ALL" for c in mc])
    s["impute_inf"] = f"""WITH {ms}, md AS (SELECT {', '.join(f"quantile_cont({c}, 0.5) FILTER (WHERE isfinite({c})) AS m_{c}" for c in mc)} FROM ms)
SELECT {K}, {', '.join(f"{r6(f'CASE WHEN isfinite({c}) THEN {c} ELSE m_{c} END')} AS {c}" for c in mc)} FROM ms, md"""
    s["pct_rank_missing"] = f"""WITH ev AS (SELECT event_id, {planted('event_id', 'value')} FROM events),
rk AS (SELECT event_id, (rank() OVER (ORDER BY value) - 1 + (count(*) OVER (PARTITION BY value) + 1) / 2.0) / count(*) OVER () AS p
       FROM ev WHERE value IS NOT NULL AND NOT isnan(value))
SELECT event_id, round(p, 6) AS value_pct FROM ev LEFT JOIN rk USING (event_id)"""
    counters = {"n_returned": "n_returned", "qty": "qty", "qty_af": f"CASE WHEN {hp} % 10 = 0 THEN qty_af * 2 ELSE qty_af END",
                "n_done": f"CASE WHEN {hp} % 7 = 0 THEN n_done + n_orders ELSE n_done END"}
    nulls = ", ".join(f"CASE WHEN {h(K, 'missing_' + c)} % 12 <> 0 THEN {e} END AS {c}" for c, e in counters.items())
    parts_bad = f"({parts_sum}) > qty * 1.1"
    part_cols = ", ".join(f"CASE WHEN {parts_bad} THEN CAST(trunc({p} * qty / ({parts_sum})) AS BIGINT) ELSE {p} END AS {p}" for p in QTY_PARTS)
    fixed = f"""WITH {P},
pl AS (SELECT * REPLACE ({nulls}, CASE WHEN {hp} % 10 = 0 THEN qty_ro * 2 ELSE qty_ro END AS qty_ro) FROM profile),
fx AS (SELECT {K}, CASE WHEN n_returned < 1 THEN 1 ELSE n_returned END AS n_returned, {part_cols},
         CASE WHEN n_done > n_orders THEN n_orders ELSE n_done END AS n_done,
         CASE WHEN n_returned < 1 THEN 1 ELSE 0 END AS fix_floor, CASE WHEN {parts_bad} THEN 1 ELSE 0 END AS fix_parts,
         CASE WHEN n_done > n_orders THEN 1 ELSE 0 END AS fix_cap FROM pl)
"""
    s["consistency_missing"] = fixed + "SELECT *, fix_floor + fix_parts + fix_cap AS n_fixes FROM fx"
    s["correction_counts"] = fixed + """SELECT CAST(sum(fix_floor) AS BIGINT) AS fix_floor, CAST(sum(fix_parts) AS BIGINT) AS fix_parts,
  CAST(sum(fix_cap) AS BIGINT) AS fix_cap, CAST(sum(fix_floor + fix_parts + fix_cap) AS BIGINT) AS corrections FROM fx"""
    s["removed_rows"] = f"""WITH {P} SELECT count(*) AS rows_before, count(*) FILTER (WHERE n_lines >= {fx.ACTIVITY_MIN_LINES}) AS rows_kept,
  count(*) FILTER (WHERE NOT coalesce(n_lines >= {fx.ACTIVITY_MIN_LINES}, false)) AS rows_removed FROM profile"""

    kept = [c for c in cols if c not in fx.LEAKY]
    s["clean_summary"] = f"""WITH {P},
f AS (SELECT * FROM profile WHERE n_lines >= {fx.ACTIVITY_MIN_LINES})
SELECT CAST((SELECT count(*) FROM profile) AS BIGINT) AS rows_before,
       CAST((SELECT count(*) FROM f) AS BIGINT) AS rows_after,
       {r6('((SELECT count(*) FROM profile) - (SELECT count(*) FROM f)) * 100.0 / (SELECT count(*) FROM profile)')}
         AS removed_pct,
       CAST({len(kept)} AS BIGINT) AS n_features, CAST(0 AS BIGINT) AS n_missing"""

    # labels
    t1 = (f"round(0.4 * (qty / (n_returned + 1)) + 0.6 * (n_open / (n_lines + 1)) "
          f"+ 0.3 * (n_done / (n_orders + 1)), 9)")
    s["label_quantile"] = f"""WITH {P}, t AS (SELECT {K}, {t1} AS score FROM profile)
SELECT {K}, {r6('score')} AS score, CAST(score > (SELECT quantile_cont(score, 0.6) FROM t) AS INTEGER) AS label FROM t"""
    pts = "4 * CAST(qty >= 1000 AS INTEGER) + 3 * CAST(n_returned <= 12 AS INTEGER) + 3 * CAST(amount >= 2000000 AS INTEGER)"
    s["label_rules"] = f"WITH {P} SELECT {K}, {pts} AS score, CAST({pts} >= 7 AS INTEGER) AS label FROM profile"
    s["label_experience"] = (f"WITH {P} SELECT {K}, CAST(span_days >= {fx.EXPERIENCE_MIN_DAYS} AS INTEGER) AS label "
                             f"FROM profile")
    s["label_hybrid"] = f"WITH {_hybrid_cte()} SELECT {K}, {r6('score')} AS score, label FROM hyb"
    s["label_bernoulli"] = f"WITH {P} SELECT {K}, CAST({u(K, 0)} < {fx.BERNOULLI_P} AS INTEGER) AS label FROM profile"
    keep_t = [c for c in cols if c not in fx.FORBIDDEN]
    s["independent_target"] = f"WITH {_hybrid_cte()} SELECT {K}, {', '.join(keep_t)}, label FROM hyb"

    # derived
    def ratio(num, den, scale=1.0, plus=1.0):
        d = f"CAST({den} AS DOUBLE)" if scale == 1.0 else f"CAST({den} AS DOUBLE) * {scale}"
        return f"CAST({num} AS DOUBLE) / ({d} + {plus})"
    der = ["qty_af + qty_ao AS af_ao_qty"]
    for r in fx.RATIOS:
        num = r.num if isinstance(r.num, str) else "(" + " + ".join(r.num) + ")"
        der.append(f"{ratio(num, r.den, r.den_scale, r.plus)} AS {r.name}")
    s["derived_ratios"] = f"WITH {P} SELECT {K}, {', '.join(der)} FROM profile"
    s["tiers"] = f"""WITH {P} SELECT {K}, span_days,
  CAST(CASE WHEN span_days > 0 AND span_days <= 50 THEN 1 WHEN span_days > 50 AND span_days <= 200 THEN 2
            WHEN span_days > 200 AND span_days <= 500 THEN 3 WHEN span_days > 500 AND span_days <= 1000 THEN 4
            WHEN span_days > 1000 THEN 5 END AS DOUBLE) AS experience_tier FROM profile"""
    s["indices"] = f"""WITH {P} SELECT {K},
  {ratio('qty', 'span_days')} AS playtime_efficiency,
  0.4 * ({ratio('qty', 'n_returned')}) + 1.5 * ({ratio('n_open', 'n_lines')}) + 0.3 * ({ratio('n_done', 'n_orders')})
    AS performance_index,
  {ratio('amount', 'n_lines')} AS damage_efficiency,
  {ratio('amount', 'qty')} AS damage_per_kill,
  CAST(0.6 AS DOUBLE) * defuse_rate + CAST(0.4 AS DOUBLE) * plant_rate AS clutch_factor,
  mvp_rate / (win_rate + CAST(0.01 AS DOUBLE)) AS leadership_index,
  win_rate - mvp_rate AS team_dependency
FROM (SELECT *, CAST(n_disc AS DOUBLE) / (CAST(n_lines AS DOUBLE) * CAST(0.5 AS DOUBLE) + CAST(1 AS DOUBLE)) AS plant_rate,
             CAST(n_taxed AS DOUBLE) / (CAST(n_lines AS DOUBLE) * CAST(0.5 AS DOUBLE) + CAST(1 AS DOUBLE)) AS defuse_rate,
             CAST(n_urgent AS DOUBLE) / (CAST(n_orders AS DOUBLE) + CAST(1 AS DOUBLE)) AS mvp_rate,
             CAST(n_done AS DOUBLE) / (CAST(n_orders AS DOUBLE) + CAST(1 AS DOUBLE)) AS win_rate FROM profile)"""
    tot = " + ".join(f"({p} + 1e-8)" for p in QTY_PARTS)
    ent = " + ".join(f"(({p} + 1e-8) / ({tot})) * log2(({p} + 1e-8) / ({tot}))" for p in QTY_PARTS)
    mx = "greatest(" + ", ".join(f"({p} + 1e-8) / ({tot})" for p in QTY_PARTS) + ")"
    s["diversity"] = f"WITH {P} SELECT {K}, {r6(f'-({ent})')} AS diversity, {r6(mx)} AS specialization FROM profile"
    stab = []
    for name, num in (("qty_per_line", "qty"), ("returns_per_line", "n_returned"), ("amount_per_line", "amount")):
        e = ratio(num, "n_lines")
        stab.append(f"SELECT '{name}' AS feature, {r6(f'1.0 - stddev_samp({e}) / (avg({e}) + 1e-8)')} AS stability "
                    f"FROM profile")
    s["stability"] = f"WITH {P} " + _union(stab)
    s["pct_rank"] = ("SELECT event_id, value, round((rank() OVER (ORDER BY value) - 1 + "
                     "(count(*) OVER (PARTITION BY value) + 1) / 2.0) / count(*) OVER (), 6) AS value_pct "
                     "FROM events")
    kd, acc = "qty / (n_returned + 1)", "n_open / (n_lines + 1)"
    s["pct_rank_profile"] = f"""WITH {P}, b AS (SELECT {K}, {kd} AS kd, {acc} AS acc FROM profile)
SELECT {K},
  round((rank() OVER (ORDER BY kd) - 1 + (count(*) OVER (PARTITION BY kd) + 1) / 2.0) / count(*) OVER (), 6) AS kd_percentile,
  round((rank() OVER (ORDER BY acc) - 1 + (count(*) OVER (PARTITION BY acc) + 1) / 2.0) / count(*) OVER (), 6) AS acc_percentile
FROM b"""
    pref = fx.INTERACTION_PREFERRED
    prods = [f"CAST({a} AS DOUBLE) * CAST({b} AS DOUBLE) AS {a}__x__{b}"
             for i, a in enumerate(pref) for b in pref[i + 1:]]
    s["interactions"] = f"WITH {P} SELECT {K}, {', '.join(prods)} FROM profile"

    # EDA
    li = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    s["describe"] = _union(
        [f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
         f"round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, "
         f"round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM lineitem" for c in li])
    s["label_counts"] = (f"WITH {_hybrid_cte()} SELECT label AS value, count(*) AS n, "
                         f"round(count(*) / (SELECT count(*) FROM hyb), 6) AS share FROM hyb GROUP BY label")
    cm_cols = [("kd", kd), ("acc", acc), ("span_days", "span_days")] + [(p, p) for p in QTY_PARTS]
    s["class_means"] = f"WITH {_hybrid_cte()} " + _union(
        [f"SELECT label, '{n}' AS \"column\", {r6(f'avg({e})')} AS mean FROM hyb GROUP BY label" for n, e in cm_cols])
    pairs = [(b, a) for i, a in enumerate(cols) for b in cols[i + 1:]]
    s["corr_matrix"] = f"WITH {P} " + _union(
        [f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr({a}, {b})')} AS r FROM profile" for a, b in pairs])
    lc = _union([f"SELECT '{c}' AS feature, corr({c}, label) AS r FROM hyb" for c in cols])
    s["label_corr"] = f"""WITH {_hybrid_cte()}, lc AS ({lc}), ok AS (SELECT * FROM lc WHERE r IS NOT NULL)
SELECT feature, round(r, 6) AS r, round(abs(r), 6) AS abs_r,
       (SELECT count(*) FROM ok WHERE abs(r) > 0.3) AS n_strong
FROM ok ORDER BY abs(r) DESC, feature LIMIT 10"""
    s["histogram"] = _hist_sql("lineitem", "l_extendedprice", 30, None, density=False, digits=4)
    s["boxplot"] = """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM events WHERE value IS NOT NULL GROUP BY event_type),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT e.event_type, round(f.q1, 6) AS q1, round(f.median, 6) AS median, round(f.q3, 6) AS q3,
       round(f.lower, 6) AS lower, round(f.upper, 6) AS upper,
       round(min(e.value) FILTER (WHERE e.value >= f.lower AND e.value <= f.upper), 6) AS whisker_lo,
       round(max(e.value) FILTER (WHERE e.value >= f.lower AND e.value <= f.upper), 6) AS whisker_hi,
       count(*) FILTER (WHERE NOT (e.value >= f.lower AND e.value <= f.upper)) AS n_fliers,
       count(*) AS n
FROM events e JOIN f ON e.event_type = f.event_type WHERE e.value IS NOT NULL
GROUP BY e.event_type, f.q1, f.median, f.q3, f.lower, f.upper"""
    ov = fx.OUTLIER_VARS
    outl = " + ".join(f"(SELECT count(*) FROM hyb, fe WHERE {c} < {_lo(c)} OR {c} > {_hi(c)})" for c in ov)
    num_cols = [K, *cols]
    lcs = _union([f"SELECT corr({c}, label) AS r FROM hyb" for c in num_cols])
    n_cols = len(num_cols) + 1
    s["eda_summary"] = f"""WITH {_hybrid_cte()}, {_fences_cte(ov, 'hyb')}, lcs AS ({lcs}),
base AS (SELECT count(*) AS n, avg(CAST(label AS DOUBLE)) AS bal FROM hyb),
o AS (SELECT ({outl}) AS tot)
SELECT CAST(n AS BIGINT) AS dataset_size, CAST({n_cols} AS BIGINT) AS n_features, round(bal, 6) AS target_balance,
       round(tot * 100.0 / n, 6) AS outlier_percentage,
       CAST((SELECT count(*) FROM lcs WHERE abs(r) > 0.3) AS BIGINT) AS strong_correlations,
       true AS scaling_needed, tot > n * 0.05 AS outlier_treatment, true AS feature_engineering,
       abs(bal - 0.5) > 0.15 AS class_balancing
FROM base, o"""
    s["eda_json"] = s["eda_summary"]
    names = ["extra_trees", "gradient_boosting", "logistic_regression", "naive_bayes", "neural_network", "random_forest", "svm", "xgboost"]
    s["model_checks"] = f"""WITH {_split_cte()}, t AS (SELECT count(*) AS n_test, count(DISTINCT {K}) AS n_keys FROM spl WHERE split = 'test')
SELECT m.model, t.n_test, t.n_keys, true AS pred_follows, true AS in_range, true AS better_than_chance
FROM t, (VALUES {', '.join(f"('{n}')" for n in names)}) m(model)"""
    fr = " ".join(f"WHEN label = {k} THEN {v}" for k, v in fx.SAMPLE_FRACTIONS.items())
    s["class_sample"] = (f"WITH {_hybrid_cte()} SELECT {K}, label, qty, n_returned FROM hyb "
                         f"WHERE {u(K, 'sample')} < (CASE {fr} ELSE 0.0 END)")

    # split / scale / select
    s["split"] = f"WITH {_split_cte()} SELECT {K}, label, split FROM spl"
    sc_stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in fx.SCALE_COLS)
    sc_cols = ", ".join(f"{r6(f'CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END')} AS {c}"
                        for c in fx.SCALE_COLS)
    s["scale"] = (f"WITH {_split_cte()}, ss AS (SELECT {sc_stats} FROM spl WHERE split = 'train') "
                  f"SELECT {K}, split, {sc_cols} FROM spl, ss")
    hf = h(K, "fold")
    s["folds"] = f"""WITH {_split_cte()}, tr AS (SELECT * FROM spl WHERE split = 'train'),
fr AS (SELECT {K}, label, row_number() OVER (PARTITION BY label ORDER BY {hf}, {K}) - 1 AS r0,
              count(*) OVER (PARTITION BY label) AS n FROM tr)
SELECT {K}, label, CAST(floor(r0 * 5 / n) AS INTEGER) AS fold FROM fr"""
    an = _union([f"""SELECT '{c}' AS feature,
      (SELECT sum(nc * (mc - g) * (mc - g)) FROM (SELECT count({c}) AS nc, avg({c}) AS mc FROM tr GROUP BY label),
                                                (SELECT avg({c}) AS g FROM tr)) AS ssb,
      (SELECT sum(w) FROM (SELECT var_pop({c}) * count({c}) AS w FROM tr GROUP BY label)) AS ssw0,
      (SELECT count({c}) FROM tr) AS n, (SELECT count(DISTINCT label) FROM tr) AS k""" for c in cols])
    s["anova_f"] = f"""WITH {_split_cte()}, tr AS (SELECT * FROM spl WHERE split = 'train'), a AS ({an})
SELECT feature, round((ssb / (k - 1)) / (ssw0 / (n - k)), 4) AS f_score FROM a WHERE ssw0 > 0
ORDER BY (ssb / (k - 1)) / (ssw0 / (n - k)) DESC, feature LIMIT 10"""
    mi = _union([f"""SELECT '{c}' AS feature, sum(CASE WHEN nbc > 0 THEN (nbc / n) * ln(nbc * n / (nb * nc)) ELSE 0 END) AS mutual_info
FROM (SELECT b.bin, y.lbl, coalesce(cnt.nbc, 0) AS nbc, b.nb, y.nc, (SELECT count(*) FROM tr WHERE {c} IS NOT NULL) AS n
      FROM (SELECT bin, count(*) AS nb FROM (SELECT greatest(CAST(ceil(((rank() OVER (ORDER BY {c}) - 1 +
                  (count(*) OVER (PARTITION BY {c}) + 1) / 2.0) / count(*) OVER ()) * 10) AS BIGINT) - 1, 0) AS bin
                  FROM tr WHERE {c} IS NOT NULL) GROUP BY bin) b
      CROSS JOIN (SELECT label AS lbl, count(*) AS nc FROM tr WHERE {c} IS NOT NULL GROUP BY label) y
      LEFT JOIN (SELECT bin, label AS lbl, count(*) AS nbc FROM (SELECT label, greatest(CAST(ceil(((rank() OVER (ORDER BY {c}) - 1 +
                  (count(*) OVER (PARTITION BY {c}) + 1) / 2.0) / count(*) OVER ()) * 10) AS BIGINT) - 1, 0) AS bin
                  FROM tr WHERE {c} IS NOT NULL) GROUP BY bin, label) cnt ON cnt.bin = b.bin AND cnt.lbl = y.lbl)""" for c in cols])
    s["mutual_info"] = (f"WITH {_split_cte()}, tr AS (SELECT * FROM spl WHERE split = 'train'), m AS ({mi}) "
                        f"SELECT feature, round(mutual_info, 6) AS mutual_info FROM m")

    # nearest neighbours: all pairs of a feature, distances in whole multiples of a 1e15th of its largest value
    psi = lambda n: (f"(CASE WHEN {n} = 1 THEN -0.5772156649015329 WHEN {n} <= 20 THEN -0.5772156649015329 + "  # noqa: E731
                     f"list_sum(list_transform(range(1, CAST({n} AS BIGINT)), lambda i: 1.0 / i)) ELSE ln({n}) - 1.0 / (2 * {n}) "
                     f"- 1.0 / (12.0 * {n} * {n}) + 1.0 / (120.0 * {n} * {n} * {n} * {n}) - 1.0 / (252.0 * power({n}, 6)) END)")
    values = _union([f"SELECT '{c}' AS feature, label AS y, CAST(round(CAST({c} AS DOUBLE) / (SELECT max(abs(CAST({c} AS DOUBLE))) FROM tr) * 1e15) AS BIGINT) AS v "
                     f"FROM tr WHERE {c} IS NOT NULL" for c in cols])
    s["mutual_info_knn"] = f"""WITH {_split_cte()}, tr AS (SELECT * FROM spl WHERE split = 'train'), x AS ({values}),
u AS (SELECT feature, y, v, count(*) AS cnt, sum(count(*)) OVER (PARTITION BY feature, y) AS total FROM x GROUP BY feature, y, v),
d AS (SELECT a.feature, a.y, a.v, a.cnt, a.total, abs(a.v - b.v) AS dist, sum(CASE WHEN a.v = b.v THEN b.cnt - 1 ELSE b.cnt END) AS n
      FROM u a JOIN u b ON a.feature = b.feature AND a.y = b.y WHERE a.total > 1 GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY feature, y, v ORDER BY dist) AS upto FROM d),
r AS (SELECT feature, y, v, any_value(cnt) AS cnt, any_value(total) AS total, least(3, any_value(total) - 1) AS k,
             min(dist) FILTER (upto >= least(3, total - 1)) AS r FROM c GROUP BY feature, y, v),
m AS (SELECT r.feature, r.cnt, r.total, r.k, sum(o.cnt) FILTER (CASE WHEN r.r = 0 THEN o.v = r.v ELSE abs(o.v - r.v) < r.r END) AS m
      FROM r JOIN u o ON o.feature = r.feature WHERE o.total > 1 GROUP BY r.feature, r.y, r.v, r.cnt, r.total, r.k),
e AS (SELECT feature, sum(cnt) AS n, sum(cnt * ({psi('k')} - {psi('total')} - {psi('m')})) AS s FROM m GROUP BY feature)
SELECT feature, round(greatest(0, {psi('n')} + s / n), 6) AS mutual_info FROM e"""

    # SQL-form models
    nbf = fx.NB_FEATURES
    nb_stats = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in nbf)
    all_var = ", ".join(f"var_pop({c})" for c in nbf)
    def jll(cls):
        terms = " ".join(f"- 0.5 * ln(2 * pi() * (c{cls}.v_{c} + e.eps)) - ({c} - c{cls}.m_{c}) * ({c} - c{cls}.m_{c}) "
                         f"/ (2 * (c{cls}.v_{c} + e.eps))" for c in nbf)
        return f"(ln(c{cls}.prior) {terms})"
    s["gaussian_nb"] = f"""WITH {_split_cte()}, tr AS (SELECT * FROM spl WHERE split = 'train'),
cs AS (SELECT label, count(*) * 1.0 / (SELECT count(*) FROM tr) AS prior, {nb_stats} FROM tr GROUP BY label),
e AS (SELECT 1e-9 * greatest({all_var}) AS eps FROM tr),
j AS (SELECT t.{K}, {jll(0)} AS j0, {jll(1)} AS j1
      FROM spl t, e, (SELECT * FROM cs WHERE label = 0) c0, (SELECT * FROM cs WHERE label = 1) c1
      WHERE t.split = 'test')
SELECT {K}, round(exp(j1 - greatest(j0, j1)) / (exp(j0 - greatest(j0, j1)) + exp(j1 - greatest(j0, j1))), 6) AS score,
       CAST(j1 > j0 AS INTEGER) AS pred FROM j"""
    s["naive_bayes_joint"] = s["gaussian_nb"]
    moments = _union([f"SELECT '{c}' AS term, avg(label * (CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END)) AS moment FROM tr, ss" for c in fx.SCALE_COLS])
    s["logreg_optimum"] = f"""WITH {_split_cte()}, ss AS (SELECT {sc_stats} FROM spl WHERE split = 'train'), tr AS (SELECT * FROM spl WHERE split = 'train'),
mo AS (SELECT 'offset' AS term, avg(label) AS moment FROM tr UNION ALL {moments})
SELECT engine, term, round(moment, 4) AS moment FROM mo, (VALUES ('mllib'), ('joint')) e(engine)"""
    train_corr = _union([f"SELECT '{c}' AS feature, abs(corr({c}, label)) AS r FROM spl WHERE split = 'train'" for c in PROFILE_COUNTERS])
    s["leakage_parts"] = f"""WITH {_split_cte()}, lc AS ({train_corr})
SELECT CAST(0.5 AS DOUBLE) AS dummy_auc, round(r, 6) AS max_correlation, feature AS top_feature, true AS better_than_chance, true AS flag_follows
FROM lc WHERE NOT isnan(r) ORDER BY r DESC, feature LIMIT 1"""
    s["registry_checks"] = f"""WITH {_split_cte()}, t AS (SELECT count(*) AS n FROM spl WHERE split = 'test')
SELECT engine, model_name, CAST({len(fx.SCALE_COLS)} AS INTEGER) AS features_count, CAST(2 AS BIGINT) AS n_models, n AS n_test, n AS n_same
FROM t, (VALUES ('mllib', 'logistic_regression'), ('joint', 'naive_bayes')) m(engine, model_name)"""
    s["pca_checks"] = """WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT a.i, b.i AS j, covar_samp(a.x, b.x) AS v FROM e a JOIN e b USING (vec_id) GROUP BY ALL)
SELECT (SELECT count(*) FROM embeddings) AS n, CAST(max(i) AS INTEGER) AS n_components, round(sum(v) FILTER (i = j), 4) AS total_variance,
       round(sum(v * v), 4) AS squared_variance, true AS ratios_follow, true AS uncorrelated, true AS fewest, true AS kept_first FROM c"""
    s["dummy"] = f"""WITH {_split_cte()},
m AS (SELECT label FROM spl WHERE split = 'train' GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)
SELECT {K}, CAST(m.label AS DOUBLE) AS score, CAST(m.label AS INTEGER) AS pred FROM spl, m WHERE split = 'test'"""

    # evaluation
    S = _scored_cte()
    cnt = """cc AS (SELECT count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp,
                 count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE label = 0 AND pred = 0) AS tn,
                 count(*) AS n FROM sc)"""

    def dv(a, b):
        return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"

    def f1(p, r):
        return dv(f"2.0 * ({p}) * ({r})", f"({p}) + ({r})")
    p1, r1 = dv("tp", "tp + fp"), dv("tp", "tp + fn")
    p0, r0 = dv("tn", "tn + fn"), dv("tn", "tn + fp")
    s["binary_metrics"] = (f"WITH {S}, {cnt} SELECT {r6(dv('tp + tn', 'n'))} AS accuracy, {r6(p1)} AS precision, "
                           f"{r6(r1)} AS recall, {r6(f1(p1, r1))} AS f1 FROM cc")

    def wv(a0, a1):
        return dv(f"({a0}) * (tn + fp) + ({a1}) * (tp + fn)", "n")
    s["weighted_metrics"] = (f"WITH {S}, {cnt} SELECT {r6(dv('tp + tn', 'n'))} AS accuracy, {r6(wv(p0, p1))} AS precision, "
                             f"{r6(wv(r0, r1))} AS recall, {r6(wv(f1(p0, r0), f1(p1, r1)))} AS f1 FROM cc")
    curve = f"""{S},
g AS (SELECT score, count(*) AS cnt, sum(label) AS pos, sum(1 - label) AS neg FROM sc GROUP BY score),
cu AS (SELECT *, sum(cnt) OVER w AS cum, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
              sum(pos) OVER () AS tp_all, sum(neg) OVER () AS tn_all
       FROM g WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
    s["roc_auc"] = f"""WITH {curve}
SELECT round(sum(pos * ((tn_all - cum_neg) + neg / 2.0)) / (max(tp_all) * max(tn_all)), 6) AS roc_auc,
       round(sum(({dv('cum_pos', 'tp_all')} - {dv('cum_pos - pos', 'tp_all')})
                 * ({dv('cum_pos', 'cum')} + CASE WHEN cum - cnt = 0 THEN 1.0 ELSE {dv('cum_pos - pos', 'cum - cnt')} END) / 2.0), 6)
         AS pr_auc,
       round(max(tp_all) / (max(tp_all) + max(tn_all)), 6) AS prevalence,
       CAST(max(tp_all) + max(tn_all) AS BIGINT) AS n FROM cu"""
    s["evaluation_summary"] = f"""WITH {curve}, {cnt},
a AS (SELECT sum(pos * ((tn_all - cum_neg) + neg / 2.0)) / (max(tp_all) * max(tn_all)) AS roc,
             sum(({dv('cum_pos', 'tp_all')} - {dv('cum_pos - pos', 'tp_all')})
                 * ({dv('cum_pos', 'cum')} + CASE WHEN cum - cnt = 0 THEN 1.0 ELSE {dv('cum_pos - pos', 'cum - cnt')} END) / 2.0)
               AS pr FROM cu)
SELECT 'accuracy' AS metric, {r6(dv('tp + tn', 'n'))} AS value FROM cc
UNION ALL SELECT 'precision_weighted', {r6(wv(p0, p1))} FROM cc
UNION ALL SELECT 'recall_weighted', {r6(wv(r0, r1))} FROM cc
UNION ALL SELECT 'f1_weighted', {r6(wv(f1(p0, r0), f1(p1, r1)))} FROM cc
UNION ALL SELECT 'roc_auc', round(roc, 6) FROM a
UNION ALL SELECT 'pr_auc', round(pr, 6) FROM a"""
    s["confusion"] = f"""WITH {S}, {cnt}
SELECT 0 AS label, 0 AS pred, tn AS n, {r6(dv('tn', 'tn + fp'))} AS row_share FROM cc UNION ALL
SELECT 0, 1, fp, {r6(dv('fp', 'tn + fp'))} FROM cc UNION ALL
SELECT 1, 0, fn, {r6(dv('fn', 'tp + fn'))} FROM cc UNION ALL
SELECT 1, 1, tp, {r6(dv('tp', 'tp + fn'))} FROM cc"""
    s["class_report"] = f"""WITH {S}, {cnt},
pc AS (SELECT '0' AS class, {p0} AS precision, {r0} AS recall, {f1(p0, r0)} AS f1, tn + fp AS support FROM cc
       UNION ALL SELECT '1', {p1}, {r1}, {f1(p1, r1)}, tp + fn FROM cc)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM pc
UNION ALL SELECT 'accuracy', {r6(dv('tp + tn', 'n'))}, {r6(dv('tp + tn', 'n'))}, {r6(dv('tp + tn', 'n'))}, n FROM cc
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
  CAST(sum(support) AS BIGINT) FROM pc
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM pc"""
    s["roc_curve"] = (f"WITH {curve} SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr UNION ALL "
                      f"SELECT round(score, 6), {r6(dv('cum_neg', 'tn_all'))}, {r6(dv('cum_pos', 'tp_all'))} FROM cu")
    s["roc_curve_compact"] = f"""WITH {curve},
nb AS (SELECT *, lag(cum_pos, 1, 0) OVER o AS p_pos, lag(cum_neg, 1, 0) OVER o AS p_neg,
              lead(cum_pos) OVER o AS n_pos, lead(cum_neg) OVER o AS n_neg,
              row_number() OVER o AS k FROM cu WINDOW o AS (ORDER BY score DESC))
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr UNION ALL
SELECT round(score, 6), {r6(dv('cum_neg', 'tn_all'))}, {r6(dv('cum_pos', 'tp_all'))} FROM nb
WHERE k = 1 OR n_pos IS NULL OR p_pos - 2 * cum_pos + n_pos <> 0 OR p_neg - 2 * cum_neg + n_neg <> 0"""
    s["pr_curve"] = (f"WITH {curve} SELECT round(score, 6) AS threshold, {r6(dv('cum_pos', 'cum'))} AS precision, "
                     f"{r6(dv('cum_pos', 'tp_all'))} AS recall FROM cu "
                     f"UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0, 0.0")
    s["score_hist"] = f"WITH {S}, " + _hist_sql("sc", "score", 30, "label", density=True, digits=6, with_prefix=False)
    s["threshold_sweep"] = f"""WITH {S},
t AS (SELECT range AS i, range / 99.0 AS threshold FROM range(100)),
tot AS (SELECT sum(label) AS P, count(*) AS n FROM sc),
m AS (SELECT t.i, t.threshold,
             (SELECT count(*) FROM sc WHERE score >= t.threshold AND label = 1) AS tp,
             (SELECT count(*) FROM sc WHERE score >= t.threshold) AS pp FROM t),
r AS (SELECT i, threshold, CASE WHEN pp = 0 OR pp = n THEN 0.0 ELSE {dv('tp', 'pp')} END AS precision,
             CASE WHEN pp = 0 OR pp = n THEN 0.0 ELSE {dv('tp', 'P')} END AS recall FROM m, tot),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM r)
SELECT CAST(i AS INTEGER) AS i, round(threshold, 6) AS threshold, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1,
       row_number() OVER (ORDER BY f1 DESC, i) = 1 AS is_best FROM f"""
    s["grade"] = f"""WITH {curve}, {cnt},
a AS (SELECT sum(pos * ((tn_all - cum_neg) + neg / 2.0)) / (max(tp_all) * max(tn_all)) AS auc FROM cu)
SELECT {r6(dv('tp + tn', 'n'))} AS accuracy, round(auc, 6) AS roc_auc,
  CASE WHEN {dv('tp + tn', 'n')} >= 0.85 THEN 'excellent' WHEN {dv('tp + tn', 'n')} >= 0.75 THEN 'good'
       WHEN {dv('tp + tn', 'n')} >= 0.65 THEN 'fair' ELSE 'poor' END AS accuracy_grade,
  CASE WHEN auc >= 0.9 THEN 'excellent' WHEN auc >= 0.8 THEN 'good' WHEN auc >= 0.7 THEN 'fair' ELSE 'poor' END
    AS auc_grade FROM cc, a"""
    s["helper_ratios"] = (f"WITH {P} SELECT {K}, span_days / 24.0 AS hours, "
                          f"{ratio('qty', 'n_returned')} AS kd_ratio, {ratio('amount', 'n_lines')} AS amount_per_line, "
                          f"{ratio('n_urgent', 'n_orders')} AS urgent_rate FROM profile")
    s["sens_spec"] = (f"WITH {S}, {cnt} SELECT {r6(dv('tp', 'tp + fn'))} AS sensitivity, "
                      f"{r6(dv('tn', 'tn + fp'))} AS specificity FROM cc")
    s["labels_balance"] = _union([f"""SELECT {t} AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM labels), 6) AS share,
  '{t}' AS target FROM labels GROUP BY {t}""" for t in ("quality", "toxic")])
    s["labels_doc_length"] = ("SELECT l.quality, count(*) AS n, round(avg(d.n_chars), 6) AS mean_chars "
                              "FROM labels l JOIN documents d ON l.doc_id = d.doc_id GROUP BY l.quality")
    return s


def _hist_sql(table, col, bins, group, density, digits, with_prefix=True):
    """numpy.histogram binning: truncated ``(x - lo) * (bins / (hi - lo))`` corrected against the
    linspace edges ``i * ((hi - lo) / bins) + lo``; the last bin is closed."""
    g = group or "NULL"
    step = f"((rg.hi - rg.lo) / {float(bins)})"

    def edge(i):
        return f"(CASE WHEN {i} >= {bins} THEN rg.hi ELSE CAST({i} AS DOUBLE) * {step} + rg.lo END)"
    i0 = f"least(CAST(floor((t.{col} - rg.lo) * ({float(bins)} / (rg.hi - rg.lo))) AS BIGINT), {bins - 1})"
    body = f"""rg0 AS (SELECT {g} AS grp, min({col}) AS lo0, max({col}) AS hi0, count(*) AS n FROM {table}
                WHERE {col} IS NOT NULL GROUP BY ALL),
rg AS (SELECT grp, n, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
              CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM rg0),
b0 AS (SELECT rg.grp, t.{col} AS x, {i0} AS i0, rg.lo, rg.hi
       FROM {table} t JOIN rg ON rg.grp IS NOT DISTINCT FROM {('t.' + group) if group else 'NULL'}
       WHERE t.{col} IS NOT NULL),
bn AS (SELECT grp, CASE WHEN x < {edge('i0').replace('rg.', 'b0.')} THEN i0 - 1
                        WHEN x >= {edge('(i0 + 1)').replace('rg.', 'b0.')} AND i0 <> {bins - 1} THEN i0 + 1
                        ELSE i0 END AS bin, count(*) AS c
       FROM b0 GROUP BY ALL)
SELECT {'rg.grp AS ' + group + ', ' if group else ''}CAST(s.range AS INTEGER) AS bin,
       round(CAST(s.range AS DOUBLE) * {step} + rg.lo, {digits}) AS lo,
       round(CASE WHEN s.range = {bins - 1} THEN rg.hi ELSE CAST(s.range + 1 AS DOUBLE) * {step} + rg.lo END, {digits}) AS hi,
       CAST(coalesce(bn.c, 0) AS BIGINT) AS n
       {f", round(coalesce(bn.c, 0) / (rg.n * ((rg.hi - rg.lo) / {bins})), {digits}) AS density" if density else ''}
FROM rg CROSS JOIN range({bins}) s LEFT JOIN bn ON bn.grp IS NOT DISTINCT FROM rg.grp AND bn.bin = s.range"""
    return ("WITH " + body) if with_prefix else body


ORACLE = build()
