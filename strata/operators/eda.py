"""Exploratory profiles (A1-A14): fused aggregation passes, long-form outputs."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import md5_uniform
from strata.operators.rank import exact_quantiles, grouped_quantiles, null_safe_join


def _stack(wide: DataFrame, names: Sequence[str], prefix: str, out_cols: str, keep: Sequence[str] = ()) -> DataFrame:
    body = ", ".join(f"'{n}', {prefix}{i}" for i, n in enumerate(names))
    return wide.selectExpr(*keep, f"stack({len(names)}, {body}) as ({out_cols})")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A1: count, mean, std (ddof 1), min, exact quartiles, max per column.

    One aggregation for the moments + one distributed rank pass for all quartiles.
    """
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    qs = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    rows = []
    for i, c in enumerate(cols):
        q = qs[(c,)]
        rows.append((c, row[f"n{i}"], row[f"m{i}"], row[f"s{i}"], row[f"lo{i}"], q[0], q[1], q[2], row[f"hi{i}"]))
    return df.sparkSession.createDataFrame(
        rows, "column string, count bigint, mean double, std double, min double, "
              "q25 double, q50 double, q75 double, max double")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """A2/A3: ``(value, n, share)`` ordered by n desc (label balance)."""
    total = df.count()
    return (df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("share", F.try_divide(F.col("n"), F.lit(float(total)))).orderBy(F.desc("n"), "value"))


def class_means(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """A4/A5: per-class means, long ``(label, column, mean)`` (groupBy + stack)."""
    wide = df.groupBy(label).agg(*[F.avg(c).alias(f"_a{i}") for i, c in enumerate(cols)])
    return _stack(wide, cols, "_a", "column, mean", keep=[label])


def correlation_values(df: DataFrame, cols: Sequence[str], method: str = "gramian") -> dict:
    """Pearson r for every column pair: ``{(a, b): r}``.

    ``gramian`` (default): MLlib ``Correlation.corr`` -- one tree-aggregated
    p x p Gramian pass (p^2 doubles per partition, independent of row count);
    rows with a NULL in any column are skipped (listwise).
    ``pairwise``: one SQL ``corr(a, b)`` aggregate per pair (pandas pairwise-complete
    semantics; heavier codegen for wide inputs).
    """
    cols = list(cols)
    if method == "pairwise":
        pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
        row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_r{i}")
                       for i, (a, b) in enumerate(pairs)]).first()
        out = {}
        for i, (a, b) in enumerate(pairs):
            out[(a, b)] = out[(b, a)] = row[f"_r{i}"]
        return out
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation
    vec = VectorAssembler(inputCols=cols, outputCol="_v", handleInvalid="skip").transform(
        df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
    m = Correlation.corr(vec, "_v").first()[0].toArray()
    import math
    return {(a, b): (None if math.isnan(m[i][j]) else float(m[i][j]))
            for i, a in enumerate(cols) for j, b in enumerate(cols) if i != j}


def corr_matrix(df: DataFrame, cols: Sequence[str], method: str = "gramian") -> DataFrame:
    """Lower triangle ``(a, b, r)`` -- a is the later column, b the earlier one."""
    cols = list(cols)
    vals = correlation_values(df, cols, method)
    rows = [(b, a, vals[(a, b)]) for i, a in enumerate(cols) for b in cols[i + 1:]]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def label_correlations(df: DataFrame, label: str, cols: Sequence[str], method: str = "gramian") -> DataFrame:
    """``(feature, r, abs_r)`` correlation of each column with the label (label excluded)."""
    cols = [c for c in cols if c != label]
    vals = correlation_values(df, cols + [label], method)
    rows = [(c, vals[(c, label)]) for c in cols]
    return df.sparkSession.createDataFrame(rows, "feature string, r double").withColumn("abs_r", F.abs("r"))


def top_label_correlations(df: DataFrame, label: str, cols: Sequence[str], k: int = 10,
                           strong: float = 0.3, method: str = "gramian") -> DataFrame:
    """The k strongest |r| with the label (top-k is the feature) plus the count of |r| > strong."""
    cols = [c for c in cols if c != label]
    vals = correlation_values(df, cols + [label], method)
    rs = [(c, vals[(c, label)]) for c in cols if vals[(c, label)] is not None]
    n_strong = sum(1 for _, r in rs if abs(r) > strong)
    top = sorted(rs, key=lambda t: (-abs(t[1]), t[0]))[:k]
    return df.sparkSession.createDataFrame(
        [(c, r, abs(r), n_strong) for c, r in top], "feature string, r double, abs_r double, n_strong bigint")


MAX_HIST_GROUPS = 4096


def _np_bin(x, lo, hi, bins: int):
    """numpy.histogram's uniform-bin index: ``(x - lo) * (bins / (hi - lo))`` truncated, then
    corrected against the ``linspace`` edges ``lo + i * ((hi - lo) / bins)`` (last edge = hi,
    last bin closed)."""
    step = (hi - lo) / F.lit(float(bins))
    i0 = F.least(F.floor((x - lo) * (F.lit(float(bins)) / (hi - lo))), F.lit(bins - 1)).cast("int")

    def edge(i):
        return F.when(i >= F.lit(bins), hi).otherwise(i.cast("double") * step + lo)
    down = x < edge(i0)
    up = (x >= edge(i0 + 1)) & (i0 != F.lit(bins - 1))
    return F.when(down, i0 - 1).when(up, i0 + 1).otherwise(i0)


def histogram(df: DataFrame, column: str, bins: int = 30, group: str | None = None,
              density: bool = False) -> DataFrame:
    """Equal-width bins over [min, max] (per group if given); last bin closed.

    Output ``(group?, bin, lo, hi, n[, density])`` with empty bins filled with 0.
    The range is one aggregate (bounded: one row per group); binning is a narrow
    expression; counts are a partial aggregation; the dense grid is the
    ``range(bins)`` table joined per group (groups x bins rows).
    """
    x = F.col(column).cast("double")
    data = df.where(x.isNotNull())
    if group is None:
        data = data.withColumn("_g", F.lit(0))
    gcols = [group or "_g"]
    rng_all = data.groupBy(*gcols).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"), F.count(F.lit(1)).alias("_n"))
    rows = rng_all.limit(MAX_HIST_GROUPS + 1).collect()
    if len(rows) > MAX_HIST_GROUPS:
        return _histogram_many_groups(data, x, column, gcols, rng_all, bins, density)
    # numpy: a zero-width range becomes [v - 0.5, v + 0.5]
    ranges = []
    for r in rows:
        lo, hi = (r["_lo"] - 0.5, r["_hi"] + 0.5) if r["_lo"] == r["_hi"] else (r["_lo"], r["_hi"])
        ranges.append((r[gcols[0]], r["_n"], lo, hi, (hi - lo) / bins))
    gtype = data.schema[gcols[0]].dataType.simpleString()
    # bounded (checked above): one row per group, safe to broadcast
    rng = df.sparkSession.createDataFrame(ranges, f"{gcols[0]} {gtype}, _n bigint, _lo double, _hi double, _w double")
    if group is None:
        # one range: inline it (narrow binning, no join at all)
        (_, n_all, lo, hi, w), = ranges
        b = _np_bin(x, F.lit(lo), F.lit(hi), bins)
        counts = data.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
        out = grid.join(counts, "bin", "left").select(
            "bin", (F.col("bin") * F.lit(w) + F.lit(lo)).alias("lo"),
            F.when(F.col("bin") == bins - 1, F.lit(hi)).otherwise((F.col("bin") + 1) * F.lit(w) + F.lit(lo)).alias("hi"),
            F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))
        if density:
            out = out.withColumn("density", F.col("n") / F.lit(n_all * w))
        return out
    b = _np_bin(x, F.col("_lo"), F.col("_hi"), bins)
    # rng has one row per group (checked bound): equi-join on the group key, broadcast
    counts = (null_safe_join(data.select(*gcols, x.alias(column)), F.broadcast(rng), gcols)
              .groupBy(*gcols, b.alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    grid = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    out = null_safe_join(grid, counts, gcols + ["bin"], "left").select(
        *gcols, "bin", (F.col("bin") * F.col("_w") + F.col("_lo")).alias("lo"),
        F.when(F.col("bin") == bins - 1, F.col("_hi"))
        .otherwise((F.col("bin") + 1) * F.col("_w") + F.col("_lo")).alias("hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"), "_n", "_w")
    if density:
        out = out.withColumn("density", F.col("n") / (F.col("_n") * F.col("_w")))
    return out.drop("_n", "_w")


def _histogram_many_groups(data, x, column, gcols, rng_all, bins, density) -> DataFrame:
    """Histogram for many groups: the per-group ranges stay distributed (equi-joins, no broadcast hint)."""
    same = F.col("_lo") == F.col("_hi")
    rng = rng_all.select(*gcols, "_n",
                         F.when(same, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
                         F.when(same, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))
    rng = rng.withColumn("_w", (F.col("_hi") - F.col("_lo")) / F.lit(bins))
    b = _np_bin(x, F.col("_lo"), F.col("_hi"), bins)
    counts = (null_safe_join(data.select(*gcols, x.alias(column)), rng, gcols)
              .groupBy(*gcols, b.alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    grid = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    out = null_safe_join(grid, counts, gcols + ["bin"], "left").select(
        *gcols, "bin", (F.col("bin") * F.col("_w") + F.col("_lo")).alias("lo"),
        F.when(F.col("bin") == bins - 1, F.col("_hi"))
        .otherwise((F.col("bin") + 1) * F.col("_w") + F.col("_lo")).alias("hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"), "_n", "_w")
    if density:
        out = out.withColumn("density", F.col("n") / (F.col("_n") * F.col("_w")))
    return out.drop("_n", "_w")


def boxplot_stats(df: DataFrame, value: str, group: str, k: float = 1.5) -> DataFrame:
    """A10: per group Q1, median, Q3, whiskers (extreme values inside the fences) and flier count.

    Quartiles are exact and distributed (:func:`grouped_quantiles`, one row per
    group); the fences are joined back on the group key for one aggregation pass.
    Up to ``MAX_HIST_GROUPS`` groups they are broadcast, so the rows of a hot group
    stay where they are; more are left to the planner and AQE's skew-join splitting.
    """
    q = grouped_quantiles(df, value, [group], [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    fences = q.select(group, "q1", "median", "q3",
                      (F.col("q1") - F.lit(k) * (F.col("q3") - F.col("q1"))).alias("lower"),
                      (F.col("q3") + F.lit(k) * (F.col("q3") - F.col("q1"))).alias("upper"))
    few = fences.limit(MAX_HIST_GROUPS + 1).collect()
    if len(few) <= MAX_HIST_GROUPS:
        fences = F.broadcast(df.sparkSession.createDataFrame(few, fences.schema))
    x = F.col(value).cast("double")
    rows = df.select(group, x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    joined = null_safe_join(rows, fences, [group])
    inside = (F.col("_x") >= F.col("lower")) & (F.col("_x") <= F.col("upper"))
    return joined.groupBy(group, "q1", "median", "q3", "lower", "upper").agg(
        F.min(F.when(inside, F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_fliers"),
        F.count(F.lit(1)).alias("n"))


def class_sample(df: DataFrame, key: str, label: str, fractions: dict, seed: int = 42) -> DataFrame:
    """Bounded plot sample per class -- keep a row when its md5 uniform < fraction[label]."""
    frac = F.lit(0.0)
    for lv, f in fractions.items():
        frac = F.when(F.col(label) == F.lit(lv), F.lit(float(f))).otherwise(frac)
    return df.where(md5_uniform(key, seed, "sample") < frac)
