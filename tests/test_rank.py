import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators.rank import exact_quantiles, ordered_counts, percent_rank_avg, quantiles


def _frame(spark, n=2000, seed=0):
    rng = np.random.default_rng(seed)
    v = np.round(rng.exponential(10, n), 1)            # heavy ties
    v[rng.random(n) < 0.05] = np.nan                   # some missing
    g = rng.integers(0, 3, n)
    pdf = pd.DataFrame({"id": np.arange(n), "g": g, "v": v})
    df = spark.createDataFrame(pdf.astype({"v": "float64"})).selectExpr(
        "id", "g", "CASE WHEN isnan(v) THEN NULL ELSE v END AS v")
    return pdf, df


@pytest.mark.parametrize("single", [0, 10 ** 9])
def test_exact_quantiles_match_numpy(spark, single, monkeypatch):
    import strata.operators.rank as R
    monkeypatch.setattr(R, "SINGLE_BUCKET_MAX", single)
    pdf, df = _frame(spark)
    probs = [0.0, 0.25, 0.5, 0.65, 0.75, 1.0]
    got = exact_quantiles(df, ["v"], probs)[("v",)]
    want = np.quantile(pdf.v.dropna().values, probs)
    assert np.allclose(got, want, rtol=0, atol=1e-9)


def test_grouped_quantiles(spark):
    pdf, df = _frame(spark, seed=1)
    got = exact_quantiles(df, ["v"], [0.25, 0.75], group_cols=["g"])
    for gv, sub in pdf.groupby("g"):
        want = np.quantile(sub.v.dropna().values, [0.25, 0.75])
        assert np.allclose(got[(gv, "v")], want)


@pytest.mark.parametrize("single", [0, 10 ** 9])
def test_percent_rank_matches_pandas(spark, single, monkeypatch):
    import strata.operators.rank as R
    monkeypatch.setattr(R, "SINGLE_BUCKET_MAX", single)
    pdf, df = _frame(spark, seed=2)
    out = percent_rank_avg(df.select("id", "v"), "v", out_col="p").toPandas().set_index("id").sort_index()
    want = pdf.set_index("id").v.rank(pct=True)
    both = pd.concat([out.p, want], axis=1).dropna()
    assert np.allclose(both.iloc[:, 0], both.iloc[:, 1])
    assert out.p.isna().sum() == pdf.v.isna().sum()


def test_ordered_counts_descending_with_weights(spark):
    pdf, df = _frame(spark, seed=3)
    oc = ordered_counts(df.where("v IS NOT NULL"), ["v"], weights={"w": df.g.cast("long")},
                        descending=True, buckets=5, single_bucket_max=0).toPandas().sort_values("v", ascending=False)
    sub = pdf.dropna()
    agg = sub.groupby("v").agg(cnt=("id", "size"), w=("g", "sum")).sort_index(ascending=False)
    assert list(oc.cnt) == list(agg.cnt)
    assert list(oc.cum) == list(agg.cnt.cumsum())
    assert list(oc.cum_w) == list(agg.w.cumsum())
    assert list(oc.idx) == list(range(1, len(agg) + 1))


def test_one_value_per_rank_reaches_the_driver(spark, monkeypatch):
    _, df = _frame(spark, n=5000, seed=7)
    df = df.selectExpr("id", "v + id / 1e6 AS v").cache()
    want = np.quantile([r.v for r in df.where("v IS NOT NULL").collect()], [0.0, 0.25, 0.5, 0.75, 1.0])
    collect, seen = type(df).collect, []
    monkeypatch.setattr(type(df), "collect", lambda self: seen.append(collect(self)) or seen[-1])
    got = exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 0.75, 1.0])[("v",)]
    assert np.allclose(got, want, rtol=0, atol=1e-12) and seen and max(map(len, seen)) <= 10


def test_approx_quantiles_close(spark):
    pdf, df = _frame(spark, seed=4)
    got = quantiles(df, ["v"], [0.5], method="approx")["v"][0]
    assert abs(got - pdf.v.median()) <= 1.0


@pytest.mark.parametrize("single", [0, 10 ** 9])
def test_hot_value_third_of_rows(spark, single, monkeypatch):
    """One value holds a third of all rows: ranks and quantiles stay exact on both paths."""
    import strata.operators.rank as R
    monkeypatch.setattr(R, "SINGLE_BUCKET_MAX", single)
    n = 3000
    rng = np.random.default_rng(11)
    v = rng.integers(0, 500, n).astype(float)
    v[: n // 3] = 42.0
    pdf = pd.DataFrame({"id": np.arange(n), "v": v})
    df = spark.createDataFrame(pdf)
    got = exact_quantiles(df, ["v"], [0.1, 0.33, 0.5, 0.9])[("v",)]
    assert np.allclose(got, np.quantile(v, [0.1, 0.33, 0.5, 0.9]))
    pr = percent_rank_avg(df, "v", out_col="p").toPandas().set_index("id").sort_index()
    assert np.allclose(pr.p.values, pdf.v.rank(pct=True).values)


def test_bucket_lookup_matches_linear_count(spark):
    from pyspark.sql import functions as F

    from strata.operators.rank import _bucket_of
    bounds = sorted(set(np.round(np.random.default_rng(5).normal(0, 3, 300), 2).tolist()))
    vals = np.round(np.random.default_rng(6).normal(0, 4, 2000), 2).tolist() + bounds
    df = spark.createDataFrame([(float(v),) for v in vals], "k double").withColumn(
        "b", F.array(*[F.lit(float(x)) for x in bounds]))
    for p in (2, 17, 301, 1024):
        got = [r[0] for r in df.select(_bucket_of(F.col("b"), F.col("k"), p)).collect()]
        want = [sum(1 for x in bounds if x < v) for v in vals]
        assert got == want


def test_many_buckets_exact(spark):
    pdf, df = _frame(spark, n=4000, seed=9)
    oc = ordered_counts(df.where("v IS NOT NULL"), ["v"], buckets=400, single_bucket_max=0).toPandas().sort_values("v")
    agg = pdf.dropna().groupby("v").size().sort_index()
    assert list(oc.cum) == list(agg.cumsum())


@pytest.mark.parametrize("max_groups", [10, 1000])
def test_many_groups_with_hot_ones(spark, monkeypatch, max_groups):
    """More groups than MAX_GROUPS, two of them hot: exact per-group ranks either way."""
    import strata.operators.rank as R
    monkeypatch.setattr(R, "MAX_GROUPS", max_groups)
    rng = np.random.default_rng(21)
    g = np.concatenate([rng.integers(2, 40, 1500), np.zeros(800, int), np.ones(700, int)])
    v = np.round(rng.normal(0, 5, len(g)), 1)
    pdf = pd.DataFrame({"g": g, "v": v})
    df = spark.createDataFrame(pdf)
    oc = R.ordered_counts(df, ["v"], ["g"], buckets=7, single_bucket_max=50).toPandas()
    want = pdf.groupby(["g", "v"]).size().rename("cnt").reset_index()
    want["cum"] = want.sort_values(["g", "v"]).groupby("g")["cnt"].cumsum()
    m = oc.merge(want, on=["g", "v"], suffixes=("", "_w"))
    assert len(m) == len(want) == len(oc)
    assert (m.cnt == m.cnt_w).all() and (m.cum == m.cum_w).all()
    q = R.exact_quantiles(df, ["v"], [0.5], group_cols=["g"]) if max_groups > 40 else None
    if q is not None:
        assert np.isclose(q[(0, "v")][0], np.median(pdf[pdf.g == 0].v))


def test_rows_outside_all_brackets_make_no_array(spark, monkeypatch):
    """Brackets are comparisons; only the rows at the wanted ranks are looked at by an array function (once a call)."""
    import numpy as np

    from strata.operators import rank
    monkeypatch.setattr(rank, "BRACKET_ROWS", 50)
    df = spark.range(3000).selectExpr("CASE WHEN id % 7 = 0 THEN NULL ELSE id % 3 END AS g", "CASE WHEN id % 4 = 0 THEN 5.0D ELSE id * 37 % 1009 / 8 END AS v")
    calls, plain = [], rank.F.filter
    monkeypatch.setattr(rank.F, "filter", lambda *a: calls.append(1) or plain(*a))
    wanted = {g: [0, 1, 100, 101, 300] for g in (None, 0, 1, 2)}
    found = rank.select_ranks(df, "g", ["v"], wanted)
    rows = df.collect()
    for g, ranks in wanted.items():
        own = np.sort([r.v for r in rows if r.g == g])
        assert {r: found[g][r][0] for r in ranks} == {r: own[r] for r in ranks}
    assert len(calls) == 1


def test_quantiles_of_many_rows_make_no_long_table(spark, monkeypatch):
    """Columns of more rows than a bracket may hold are bracketed side by side; a bracket that misses is left to the ranks."""
    import strata.operators.rank as R
    rng = np.random.default_rng(3)
    n = 6000
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 3, n).astype(float), "c": np.where(rng.random(n) < 0.3, np.nan, rng.exponential(5, n).round(1)),
                        "d": np.zeros(n), "e": np.where(rng.random(n) < 0.5, 0.0, rng.random(n)), "f": np.arange(n) * 1.0})
    pdf.loc[:99, "e"] = -np.inf
    df = spark.createDataFrame(pdf).withColumn("z", F.lit(None).cast("double")).repartition(5)
    probs = [0.0, 0.25, 0.5, 0.9999]
    want = exact_quantiles(df, df.columns, probs)
    assert np.allclose(want[("a",)], np.quantile(pdf.a, probs), rtol=0, atol=1e-12) and want[("z",)] == [None] * len(probs)
    left, ranks = [], R.select_ranks

    def spied(long, group, order_cols, wanted):
        left.append(wanted)
        return ranks(long, group, order_cols, wanted)

    monkeypatch.setattr(R, "select_ranks", spied)
    monkeypatch.setattr(R, "BRACKET_ROWS", 1000)
    assert exact_quantiles(df, df.columns, probs) == want and not left
    monkeypatch.setattr(R, "BRACKET_ROWS", 1)
    assert exact_quantiles(df, df.columns, probs) == want and left
