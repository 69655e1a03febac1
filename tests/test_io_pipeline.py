import pytest
from pyspark.sql import functions as F

from strata.plans import pipeline
from strata.session import scratch_path
from strata.sources import io

SF = "/root/testdata/sf0.001"


def test_csv_roundtrip_keeps_schema_and_rows(spark):
    df = spark.range(50).selectExpr("id", "CAST(id * 1.5 AS DOUBLE) AS x", "CAST(id % 3 AS STRING) AS s")
    back = io.csv_roundtrip(df)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(back.collect()) == sorted(df.collect())


def test_resolve_source_prefers_first_existing(spark):
    p = io.write_dataset(spark.range(3), "exists")
    missing = scratch_path(spark, "missing")
    assert io.resolve_source(spark, [missing, p]) == p
    with pytest.raises(FileNotFoundError):
        io.resolve_source(spark, [missing])


def test_split_partitioned_read_prunes(spark):
    df = spark.range(30).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'test' ELSE 'train' END AS split")
    p = io.write_dataset(df, "parts")
    t = io.read_split(spark, p, "test")
    assert t.count() == 10
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split" in plan


def test_pipeline_rejects_unknown_step():
    with pytest.raises(ValueError):
        pipeline.validate_steps(["collect", "train"])


def test_pipeline_quick_runs_end_to_end(spark):
    rep = pipeline.run_pipeline(spark, SF, steps=("collect", "preprocess", "model", "evaluate"), quick=True,
                                model_names=["logistic_regression", "naive_bayes"], tune_top=0)
    got = {(r["stage"], r["metric"]): r["value"] for r in rep.collect()}
    n = got[("collect", "rows")]
    assert got[("preprocess", "rows_train")] + got[("preprocess", "rows_val")] + got[("preprocess", "rows_test")] == n
    assert 0.5 <= got[("evaluate", "roc_auc")] <= 1.0


def test_stage_outputs_have_no_leaky_columns(spark):
    df, feats = pipeline.preprocess_stage(pipeline.collect_stage(spark, SF))
    from strata.plans import fixture as fx
    assert not set(fx.FORBIDDEN) & set(df.columns)
    assert df.where(F.col("split") == "train").count() > 0


def test_many_lines_are_grouped_in_more_partitions(spark, tmp_path, monkeypatch):
    from strata.sources import tables
    days = "date_add(DATE'2020-01-01', cast(id % 90 AS int))"
    spark.range(60).selectExpr("id AS c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(400).selectExpr("id AS o_orderkey", "id % 50 AS o_custkey", "'F' AS o_orderstatus", "'1-URGENT' AS o_orderpriority", f"{days} AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(2000).selectExpr("CASE WHEN id % 5 = 0 THEN 7 ELSE id % 400 END AS l_orderkey", "cast(id % 50 AS double) AS l_quantity", "id / 4.0D AS l_extendedprice", "0.05D AS l_discount",
                                 "0.04D AS l_tax", "'A' AS l_returnflag", "'F' AS l_linestatus").write.parquet(f"{tmp_path}/lineitem.parquet")
    want = sorted(map(tuple, tables.entity_profile(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(tables, "ORDER_ROWS", 200)
    dealt = tables.entity_profile(spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().toString()
    assert sorted(map(tuple, dealt.collect())) == want


def test_money_of_whole_cents_is_summed_as_cents(spark):
    """The same sums as by DECIMAL, whichever way they are taken; what isn't whole hundredths is left to DECIMAL."""
    from strata.sources import tables
    rows = [(1, 84197.04, 0.01), (1, 0.1, 0.1), (1, 0.2, None), (2, None, 0.05), (2, -0.0, 0.0), (3, 99330.95, 0.07), (3, -12.29, 0.1), (4, None, None)]
    odd = {"cents": [], "price": [(5, 1.005, 0.01)], "discount": [(5, 1.0, 0.015)], "large": [(5, 2e12, 0.01)], "sum": [(5, 9e10, 900.0)]}
    for name, own in odd.items():
        li = spark.createDataFrame(rows + own, "l_orderkey long, l_extendedprice double, l_discount double")
        n, amount, revenue = tables._money_sums(li)
        got = {r[0]: tuple(r)[1:] for r in li.groupBy("l_orderkey").agg(amount.alias("a"), revenue.alias("r")).collect()}
        want = {r[0]: tuple(r)[1:] for r in li.selectExpr("l_orderkey AS k", "cast(l_extendedprice AS decimal(15,2)) AS p", "cast(l_discount AS decimal(5,2)) AS d")
                .groupBy("k").agg(F.expr("sum(p)"), F.expr("sum(p * (cast(1 AS decimal(5,2)) - d))")).collect()}
        assert n == len(rows + own) and got == want, name
        assert ("rint" in str(amount).lower()) == (name == "cents"), name
