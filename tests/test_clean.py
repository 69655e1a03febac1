import math

from pyspark.sql import functions as F

from strata.operators import clean


def test_fences_cap_and_counts(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 100, -50])], "k int, x double")
    f = clean.fit_iqr_fences(df, ["x"])
    q1, q3, lo, hi = f["x"]
    assert (q1, q3) == (2.25, 6.75)
    assert math.isclose(lo, 2.25 - 1.5 * 4.5) and math.isclose(hi, 6.75 + 1.5 * 4.5)
    capped = clean.apply_iqr_cap(df, f).agg(F.min("x"), F.max("x")).first()
    assert capped[0] == lo and capped[1] == hi
    oc = clean.outlier_counts(df, f).first()
    assert oc["n_outliers"] == 2 and oc["n_rows"] == 10


def test_value_on_fence_is_not_outlier(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0, 0, 0, 10]], "x double")
    f = clean.fit_iqr_fences(df, ["x"])  # q1 = q3 = 0 -> fences 0, 0
    assert clean.outlier_counts(df, f).first()["n_outliers"] == 1


def test_constant_and_all_null_columns(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None), (1.0, None)], "c double, z double")
    f = clean.fit_iqr_fences(df, ["c", "z"])
    assert f["c"][2] == 1.0 and f["z"] == (None, None, None, None)
    out = clean.apply_iqr_cap(df, f).collect()
    assert all(r["c"] == 1.0 and r["z"] is None for r in out)


def test_consistency_fix(spark):
    df = spark.createDataFrame([(0, 10, 20, 5, 7, 9), (3, 10, 4, 5, 5, 4)], "d long, total long, a long, b long, won long, played long")
    out = clean.consistency_fix(df, floor_col="d", parts=["a", "b"], total_col="total",
                                cap_col="won", cap_by="played").orderBy("d").collect()
    r0, r1 = out
    assert r0["d"] == 1 and r0["fix_floor"] == 1
    assert (r0["a"], r0["b"]) == (int(20 * 10 / 25), int(5 * 10 / 25)) and r0["fix_parts"] == 1
    assert r0["won"] == 7 and r0["fix_cap"] == 0
    assert r1["won"] == 4 and r1["fix_cap"] == 1 and r1["fix_parts"] == 0
    assert r0["n_fixes"] == 2 and r1["n_fixes"] == 1


def test_null_counts_and_median_impute(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (float("nan"),), (10.0,)], "x double")
    assert clean.null_counts(df, ["x"]).first()["n_missing"] == 2
    med = clean.fit_medians(df, ["x"])
    assert med["x"] == 3.0
    vals = sorted(r["x"] for r in clean.apply_impute(df, med).collect())
    assert vals == [1.0, 3.0, 3.0, 3.0, 10.0]


def test_clean_summary(spark):
    before = spark.range(10).selectExpr("id", "CAST(id AS DOUBLE) AS x")
    after = before.where("id >= 4")
    r = clean.clean_summary(before, after, ["x"]).first()
    assert (r["rows_before"], r["rows_after"], r["removed_pct"], r["n_features"], r["n_missing"]) == (10, 6, 40.0, 1, 0)


def test_approx_fences_close_to_exact(spark):
    df = spark.range(5000).selectExpr("CAST(id % 997 AS DOUBLE) AS x")
    ex = clean.fit_iqr_fences(df, ["x"])["x"]
    ap = clean.fit_iqr_fences(df, ["x"], method="approx")["x"]
    assert abs(ex[0] - ap[0]) <= 5 and abs(ex[1] - ap[1]) <= 5
