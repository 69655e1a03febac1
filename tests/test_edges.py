"""Edge fixtures: equal scores everywhere, one-row groups, zero denominators."""

from pyspark.sql import functions as F

from strata.functions.exprs import safe_ratio
from strata.operators import eda, evaluate
from strata.operators.rank import exact_quantiles


def test_equal_scores_everywhere(spark):
    df = spark.createDataFrame([(i % 2, 0.5, 1) for i in range(10)], "label int, score double, pred int")
    assert evaluate.roc_auc(df).first()["roc_auc"] == 0.5
    roc = [r for r in evaluate.roc_curve(df).collect() if r["threshold"] is not None]
    assert len(roc) == 1 and (roc[0]["fpr"], roc[0]["tpr"]) == (1.0, 1.0)
    sweep = evaluate.threshold_sweep(df).collect()
    assert all(r["precision"] == 0.0 for r in sweep)  # one class predicted at every threshold


def test_one_row_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 4.0)], "g string, v double")
    q = exact_quantiles(df, ["v"], [0.25, 0.5], group_cols=["g"])
    assert q[("a", "v")] == [1.0, 1.0] and q[("b", "v")] == [2.5, 3.0]
    box = {r["g"]: r for r in eda.boxplot_stats(df, "v", "g").collect()}
    assert box["a"]["whisker_lo"] == box["a"]["whisker_hi"] == 1.0 and box["a"]["n_fliers"] == 0


def test_zero_denominators(spark):
    df = spark.createDataFrame([(5, -1), (3, 0)], "a long, b long")
    got = [r[0] for r in df.select(safe_ratio("a", "b")).collect()]
    assert got == [None, 3.0]
    m = evaluate.binary_metrics(spark.createDataFrame([(0, 0), (0, 0)], "label int, pred int")).first()
    assert (m["precision"], m["recall"], m["f1"], m["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(3.0,)] * 5, "x double")
    h = eda.histogram(df, "x", bins=30).orderBy("bin").collect()
    assert sum(r["n"] for r in h) == 5 and h[0]["lo"] == 2.5 and h[-1]["hi"] == 3.5
    assert h[15]["n"] == 5  # numpy puts v into the middle bin of [v - .5, v + .5]
