"""NULL, NaN and infinities: missing stays missing, infinities are values outside the fences."""
import pytest
from pyspark.sql import functions as F

from strata.functions.exprs import clip
from strata.operators import clean, eda, rank
from strata.plans import pipeline
from strata.session import scratch_path

NAN, INF = float("nan"), float("inf")
SF = "/root/testdata/sf0.001"


@pytest.fixture()
def values(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 2.0, 3.0, 4.0, 100.0, None, NAN, INF, -INF])], "k int, x double")


def by_key(df, c):
    return [r[c] for r in df.orderBy("k").collect()]


def test_clip_keeps_missing(values):
    assert by_key(values.select("k", clip("x", 2.0, 4.0).alias("x")), "x") == [2, 2, 3, 4, 4, None, None, 4, 2]


def test_cap_and_outliers(values):
    fences = {"x": (None, None, 0.0, 10.0)}
    assert by_key(clean.apply_iqr_cap(values, fences), "x") == [1, 2, 3, 4, 10, None, None, 10, 0]
    assert clean.outlier_counts(values, fences).first()["n_outliers"] == 3


def test_impute_from_finite_values(values):
    fills = clean.fit_medians(values, ["x"])
    assert fills == {"x": 3.0}
    assert by_key(clean.apply_impute(values, fills), "x") == [1, 2, 3, 4, 100, 3, 3, 3, 3]


def test_consistency_rules_skip_missing_inputs(spark):
    df = spark.createDataFrame([(0, None, 5, None, 9, 3), (1, 0, None, 4, 9, None), (2, 0, 5, 5, 4, 2)], "k int, f int, a int, b int, t int, c int")
    fixed = clean.consistency_fix(df, floor_col="f", floor=1, parts=["a", "b"], total_col="t", cap_col="t", cap_by="c")
    assert [tuple(r) for r in fixed.select("f", "a", "b", "t", "fix_floor", "fix_parts", "fix_cap", "n_fixes").orderBy("k").collect()] == [
        (None, 5, None, 3, 0, 0, 1, 1), (1, None, 4, 9, 1, 0, 0, 1), (1, 2, 2, 2, 1, 1, 1, 3)]
    assert clean.correction_counts(fixed).first()["corrections"] == 5


def test_percent_rank_skips_missing(values):
    assert by_key(rank.percent_rank_avg(values, "x", out_col="p"), "p") == [2 / 7, 3 / 7, 4 / 7, 5 / 7, 6 / 7, None, None, 1.0, 1 / 7]
    assert by_key(rank.percent_ranks(values, ["x"]), "x_pct") == [2 / 7, 3 / 7, 4 / 7, 5 / 7, 6 / 7, None, None, 1.0, 1 / 7]


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(1, None, 5.0), (2, None, 7.0), (3, "a", 1.0)], "k int, g string, x double")
    assert by_key(rank.percent_rank_avg(df, "x", ["g"], "p"), "p") == [0.5, 1.0, 1.0]


def test_null_group_has_a_histogram_and_a_boxplot(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 5.0), ("a", 9.0)], "g string, x double")
    n = {g: sum(r.n for r in eda.histogram(df, "x", bins=2, group="g").collect() if r.g == g) for g in (None, "a")}
    assert n == {None: 2, "a": 2}
    assert {r.g: r.n for r in eda.boxplot_stats(df, "x", "g").collect()} == {None: 2, "a": 2}


@pytest.mark.parametrize("single", [0, 10 ** 6])
def test_order_beyond_double_precision_and_of_texts(spark, single):
    big = [2 ** 53 + i for i in (3, 1, 0, 2)] + [-5]
    oc = rank.ordered_counts(spark.createDataFrame([(v,) for v in big], "v long"), ["v"], single_bucket_max=single, buckets=3)
    assert [r.v for r in oc.orderBy("cum").collect()] == sorted(big)
    words = ["b", "a", "abcdefgh", "abcdefga", "", "é", "zz"]
    oc = rank.ordered_counts(spark.createDataFrame([(w,) for w in words], "v string"), ["v"], single_bucket_max=single, buckets=3)
    assert [r.v for r in oc.orderBy("cum").collect()] == sorted(words)


def test_more_hot_groups_than_are_listed(spark, monkeypatch):
    monkeypatch.setattr(rank, "MAX_GROUPS", 8)
    df = spark.range(2000).selectExpr("id % 40 AS g", "id AS v")
    oc = rank.ordered_counts(df, ["v"], ["g"], single_bucket_max=10, buckets=4)
    assert oc.where("cum <> idx OR total <> 50").count() == 0 and oc.agg(F.max("cum")).first()[0] == 50


@pytest.mark.parametrize("limit", [3, 40])
def test_select_ranks_narrows_to_exact_values(spark, monkeypatch, limit):
    monkeypatch.setattr(rank, "BRACKET_ROWS", limit)
    df = spark.range(3000).selectExpr("'a' AS g", "CAST(IF(id % 3 = 0, 7, id * 31 % 1000) AS DOUBLE) AS v", "id").unionByName(
        spark.range(50).selectExpr("CAST(NULL AS STRING) AS g", "CAST(id AS DOUBLE) AS v", "id"))
    want = {"a": sorted((r.v, r.id) for r in df.where("g = 'a'").collect()), None: sorted((r.v, r.id) for r in df.where("g IS NULL").collect())}
    ranks = {"a": [0, 10, 1500, 2999], None: [0, 49, 20]}
    got = rank.select_ranks(df, "g", ["v", "id"], ranks)
    assert got == {g: {r: want[g][r] for r in rs} for g, rs in ranks.items()}
    one = rank.select_ranks(df, "g", ["v"], ranks)
    assert one == {g: {r: want[g][r][:1] for r in rs} for g, rs in ranks.items()}


def test_pipeline_steps_on_an_earlier_run(spark):
    base = scratch_path(spark, "subset")
    with pytest.raises(FileNotFoundError):
        pipeline.run_pipeline(spark, SF, steps=("model", "evaluate"), base=base)
    pipeline.run_pipeline(spark, SF, steps=("collect", "preprocess"), base=base)
    with pytest.raises(FileNotFoundError):
        pipeline.run_pipeline(spark, SF, steps=("evaluate",), base=base)
    rep = pipeline.run_pipeline(spark, SF, steps=("features", "model", "evaluate"), base=base, quick=True, tune_top=1, draws=2,
                                model_names=["logistic_regression", "naive_bayes"]).collect()
    got = {(r.stage, r.metric): r.value for r in rep}
    assert 0 < got["features", "selected"] <= 30 and got["evaluate", "roc_auc"] == pytest.approx(got["model", "best_test_auc"])
    assert {s for s, _ in got} == {"features", "model", "evaluate"}
