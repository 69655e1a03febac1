import math

import numpy as np
from pyspark.sql import functions as F

from strata.operators import derive, eda, split


def test_exact_split_sizes_and_disjoint(spark):
    df = spark.range(800).selectExpr("id AS k", "CAST(id % 20 < 7 AS INT) AS label")
    out = split.assign_split(df, "k", "label", exact=True)
    assert out.count() == 800 and out.select("k").distinct().count() == 800
    sizes = {(r["label"], r["split"]): r["n"] for r in out.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    for lab, n in ((1, 280), (0, 520)):
        n_test, n_val = split.split_sizes(n, 0.15, 0.15)
        assert sizes[(lab, "test")] == n_test and sizes[(lab, "val")] == n_val
        assert sizes[(lab, "train")] == n - n_test - n_val
    assert split.split_sizes(800, 0.15, 0.15) == (120, 121)


def test_hash_split_is_reproducible(spark):
    df = spark.range(5000).selectExpr("id AS k")
    a = split.assign_split(df, "k").groupBy("split").count().orderBy("split").collect()
    b = split.assign_split(df.repartition(7), "k").groupBy("split").count().orderBy("split").collect()
    assert a == b


def test_folds_balanced(spark):
    df = spark.range(103).selectExpr("id AS k", "CAST(id % 3 = 0 AS INT) AS label")
    out = split.assign_folds(df, "k", "label", k=5)
    for r in out.groupBy("label").agg(F.min("fold"), F.max("fold")).collect():
        assert (r[1], r[2]) == (0, 4)
    per = out.groupBy("label", "fold").count().collect()
    by_label = {}
    for r in per:
        by_label.setdefault(r["label"], []).append(r["count"])
    for counts in by_label.values():
        assert max(counts) - min(counts) <= 1


def test_standard_scaling_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, c double")
    st = split.fit_standard(df, ["x", "c"])
    out = [r.asDict() for r in split.apply_standard(df, st).collect()]
    assert [round(r["x"], 6) for r in out] == [round(v, 6) for v in (-1 / math.sqrt(2 / 3), 0.0, 1 / math.sqrt(2 / 3))]
    assert all(r["c"] == 0.0 for r in out)


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(0, 1, 1000)
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    got = [r["n"] for r in eda.histogram(df, "x", bins=30).orderBy("bin").collect()]
    want, _ = np.histogram(v, bins=30)
    assert got == list(want)


def test_describe_matches_pandas(spark):
    import pandas as pd
    pdf = pd.DataFrame({"a": [1.0, 2.0, 2.0, 5.0, 9.0], "b": [0.5, 0.1, 0.2, 0.2, 0.9]})
    got = {r["column"]: r for r in eda.describe(spark.createDataFrame(pdf), ["a", "b"]).collect()}
    d = pdf.describe()
    for c in ("a", "b"):
        assert abs(got[c]["std"] - d.loc["std", c]) < 1e-12
        assert got[c]["q25"] == d.loc["25%", c] and got[c]["q75"] == d.loc["75%", c]


def test_entropy_bounds(spark):
    df = spark.createDataFrame([(1, 1, 1, 1), (10, 0, 0, 0), (3, 1, 0, 2)], "a long, b long, c long, d long")
    rows = derive.diversity(df, ["a", "b", "c", "d"]).collect()
    for r in rows:
        assert -1e-9 <= r["diversity"] <= math.log2(4) + 1e-9
        assert 0.25 - 1e-9 <= r["specialization"] <= 1.0
    assert abs(rows[0]["diversity"] - 2.0) < 1e-9


def test_interactions_count(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    out = derive.interactions(df, ["a", "b", "c"], degree=3)
    assert set(out.columns) - {"a", "b", "c"} == {"a__x__b", "a__x__c", "b__x__c", "a__x__b__x__c"}
    assert out.first()["a__x__b__x__c"] == 6.0


def test_boxplot_whiskers(spark):
    rows = [("g", float(v)) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]]
    r = eda.boxplot_stats(spark.createDataFrame(rows, "k string, v double"), "v", "k").first()
    assert r["q1"] == 3.0 and r["q3"] == 7.0 and r["whisker_hi"] == 8.0 and r["n_fliers"] == 1


def test_grouped_quantiles_and_many_group_histogram(spark, monkeypatch):
    import pandas as pd

    import strata.operators.eda as E
    from strata.operators.rank import grouped_quantiles
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"g": rng.integers(0, 30, 3000), "v": np.round(rng.normal(0, 3, 3000), 1)})
    df = spark.createDataFrame(pdf)
    q = {r["g"]: r for r in grouped_quantiles(df, "v", ["g"], [0.25, 0.5], ["a", "b"]).collect()}
    for gv, sub in pdf.groupby("g"):
        assert np.allclose([q[gv]["a"], q[gv]["b"]], np.quantile(sub.v, [0.25, 0.5]))
    monkeypatch.setattr(E, "MAX_HIST_GROUPS", 5)
    h = E.histogram(df, "v", bins=10, group="g").collect()
    for gv, sub in pdf.groupby("g"):
        want, _ = np.histogram(sub.v, bins=10)
        assert [r["n"] for r in sorted((r for r in h if r["g"] == gv), key=lambda r: r["bin"])] == list(want)
