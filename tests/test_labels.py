from pyspark.sql import functions as F

from strata.operators import derive, labels
from strata.operators.labels import Factor, Rule


def test_rule_label_integer_weights(spark):
    df = spark.createDataFrame([(1, 1500, 1000, 200000), (2, 1500, 2000, 0), (3, 0, 0, 0)], "k int, a int, b int, c int")
    rules = [Rule("a", ">=", 1500, 4), Rule("b", "<=", 1200, 3), Rule("c", ">=", 150000, 3), Rule("absent", ">=", 1, 9)]
    out = {r["k"]: (r["score"], r["label"]) for r in labels.rule_label(df, rules, 7, "k").collect()}
    assert out == {1: (10, 1), 2: (4, 0), 3: (3, 0)}


def test_bernoulli_fallback_is_deterministic(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = labels.rule_label(df, [Rule("missing", ">=", 1, 1)], 1, "k").agg(F.avg("label")).first()[0]
    b = labels.bernoulli_label(df, "k", 0.4).agg(F.avg("label")).first()[0]
    assert a == b and 0.35 < a < 0.45


def test_hybrid_label_share(spark):
    df = spark.range(3000).selectExpr("id AS k", "CAST(id % 2500 AS DOUBLE) AS t", "CAST(id % 70 AS DOUBLE) AS r")
    out = labels.hybrid_label(df, [Factor("t", 2000.0, 0.5), Factor("r", 60.0, 0.25)], "k", q=0.65)
    share = out.agg(F.avg("label")).first()[0]
    assert 0.33 <= share <= 0.37
    s = out.agg(F.min("score"), F.max("score")).first()
    assert 0.0 <= s[0] and s[1] <= 1.0


def test_beta_noise_moments(spark):
    from strata.functions.hashing import beta_2_5
    m = spark.range(20000).select(beta_2_5("id").alias("b")).agg(F.avg("b"), F.var_samp("b")).first()
    assert abs(m[0] - 2 / 7) < 0.01 and abs(m[1] - 10 / (49 * 8)) < 0.003


def test_tier_boundaries_right_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 50, 50.5, 200, 500, 1000, 1000.1]], "h double")
    got = [r["experience_tier"] for r in derive.experience_tier(df, "h").collect()]
    assert got == [None, 1.0, 1.0, 2.0, 2.0, 3.0, 4.0, 5.0]


def test_independent_target_drops_forbidden(spark):
    df = spark.range(100).selectExpr("id AS k", "CAST(id AS DOUBLE) AS t", "id % 7 AS leak")
    out, dropped = labels.independent_target(df, [Factor("t", 100.0, 1.0)], "k", ["leak", "absent"])
    assert dropped == ["leak"] and "leak" not in out.columns and "label" in out.columns


def test_scores_and_hashes_are_computed_once(spark):
    """The passes of an exact quantile or cut read a table, they don't make the rows again."""
    from strata.operators import labels, split
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return float(x)

    df = spark.range(200).withColumn("score", counted("id"))
    assert labels._threshold(df, "score", 0.5) == 99.5
    assert seen.value == 200
    rows = spark.range(200).select("id", (counted("id") % 2).cast("int").alias("label"))
    for made in (lambda: split.assign_split(rows, "id", "label", exact=True), lambda: split.assign_folds(rows, "id", "label")):
        before = seen.value
        made()
        assert seen.value - before == 400  # the labels' counts, and the table
