"""Scans of the driver tables and the entity-profile stand-in (FIXTURES: F-1)."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import default_parallelism

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Column roles of the profile (fixed values of the fixture definition).
PROFILE_COUNTERS = ["n_orders", "n_done", "n_urgent", "n_high", "n_lines", "qty", "n_returned",
                    "amount", "revenue", "n_open", "n_disc", "n_taxed", "span_days",
                    "qty_af", "qty_ao", "qty_rf", "qty_ro", "qty_nf", "qty_no"]
QTY_PARTS = ["qty_af", "qty_ao", "qty_rf", "qty_ro", "qty_nf", "qty_no"]


#: Lines that one task groups by order; the session's shuffle partitions hold so many each, or the lines are dealt to more.
ORDER_ROWS = 1_000_000


def entity_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with order/line counters.

    Plan shape (scale): lineitem is pre-aggregated per ``l_orderkey`` (map-side
    partial aggregation, so a hot order never reaches one reducer whole; of more rows than
    ``ORDER_ROWS`` a partition, whose groups would fill a task's memory, the lines are dealt by
    order to as many partitions as that takes, and a hot order's rows are added up one by one), joined
    1:1 to the projected orders on the order key (sort-merge join, both sides
    hash-partitioned on the key; AQE may broadcast at small scale), then
    aggregated per customer (again partial + final).  ``count(DISTINCT order)``
    becomes ``count(*)`` because the join output has one row per order.
    Customer existence is a left-semi join (no customer columns are carried).
    Money is summed exactly, so results are the same on every engine: as DECIMAL, or within an order as whole
    cents where the lines' prices and discounts are such (:func:`_money_sums`).
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")
    n, amount, revenue = _money_sums(li)
    parts = -(-n // ORDER_ROWS)
    if parts > default_parallelism(spark):
        li = li.repartition(parts, "l_orderkey")
    rf, ls, q = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")

    def qpart(flag, status):
        return F.sum(F.when((rf == flag) & (ls == status), q).otherwise(F.lit(0.0)))

    per_order = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("o_lines"),
        F.sum(q).alias("o_qty"),
        F.count_if(rf == "R").alias("o_returned"),
        amount.alias("o_amount"),
        revenue.alias("o_revenue"),
        F.count_if(ls == "O").alias("o_open"),
        F.count_if(F.col("l_discount") >= 0.05).alias("o_disc"),
        F.count_if(F.col("l_tax") >= 0.04).alias("o_taxed"),
        qpart("A", "F").alias("o_af"), qpart("A", "O").alias("o_ao"),
        qpart("R", "F").alias("o_rf"), qpart("R", "O").alias("o_ro"),
        qpart("N", "F").alias("o_nf"), qpart("N", "O").alias("o_no"),
    )
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.to_date("o_orderdate").alias("o_day"))
    joined = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "inner")
    prof = joined.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_done"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
        F.count_if(F.col("o_orderpriority") == "2-HIGH").alias("n_high"),
        F.sum("o_lines").alias("n_lines"),
        F.sum("o_qty").cast("bigint").alias("qty"),
        F.sum("o_returned").alias("n_returned"),
        F.sum("o_amount").cast("double").alias("amount"),
        F.round(F.sum("o_revenue"), 2).cast("double").alias("revenue"),
        F.sum("o_open").alias("n_open"),
        F.sum("o_disc").alias("n_disc"),
        F.sum("o_taxed").alias("n_taxed"),
        F.datediff(F.max("o_day"), F.min("o_day")).cast("bigint").alias("span_days"),
        *[F.sum(f"o_{p[4:]}").cast("bigint").alias(p) for p in QTY_PARTS],
    )
    cust = read_table(spark, sf_dir, "customer").select("c_custkey")
    return prof.join(cust, "c_custkey", "left_semi")


def _money_sums(li: DataFrame) -> tuple[int, Column, Column]:
    """Rows, and the exact sums of an order's prices and discounted prices.

    A DOUBLE is cast to DECIMAL by way of its text, a DECIMAL sum of this width makes an object a row.  So one
    pass looks whether every price and discount is the DOUBLE nearest to whole hundredths, as the cast would find it,
    and so small that no sum of all rows leaves a BIGINT: then hundredths are summed, else DECIMALs.
    """
    price, disc = F.col("l_extendedprice"), F.col("l_discount")
    decimals = price.cast("decimal(15,2)"), disc.cast("decimal(5,2)")
    sums = F.sum(decimals[0]), F.sum(decimals[0] * (F.lit(1).cast("decimal(5,2)") - decimals[1]))
    if any(li.schema[c].dataType != T.DoubleType() for c in ("l_extendedprice", "l_discount")):
        return li.count(), *sums
    cents, off = F.rint(price * 100), F.rint(disc * 100)
    whole = (cents / 100 == price) & (F.abs(cents) < 1e13), (off / 100 == disc) & (F.abs(off) < 1e5)
    n, fits, most = li.agg(F.count(F.lit(1)), F.every(reduce(and_, (F.coalesce(w, F.lit(True)) for w in whole))),
                           F.max(F.abs(cents) * F.greatest(F.lit(1.0), F.abs(100 - off)))).first()
    if not fits or n * (most or 0.0) >= 2.0 ** 62:
        return n, *sums
    cents, off = cents.cast("bigint"), off.cast("bigint")
    return n, *(F.sum(c).cast("decimal(20,0)") * F.lit(unit) for c, unit in ((cents, Decimal("0.01")), (cents * (100 - off), Decimal("0.0001"))))


_MATERIALIZED: dict = {}


def input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Identifies a session's view of the input: application, path, and name, size and time of its files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir.rstrip("/"))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path)))
    return spark.sparkContext.applicationId, sf_dir.rstrip("/"), files


def stage_table(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A pipeline stage as a table: ``build()`` is written once per session as Parquet
    below the shared folder (``spark.checkpoint.dir``) and read back.

    Later stages scan a small columnar table instead of re-running the upstream
    plan; lineage is cut at the stage edge, so a lost executor only recomputes
    from the last written stage.
    """
    from strata.session import scratch_path

    key = (*input_state(spark, sf_dir), name)
    path = _MATERIALIZED.get(key)
    if path is None or not _exists(spark, path):
        path = scratch_path(spark, name)
        build().write.mode("overwrite").parquet(path)
        _MATERIALIZED[key] = path
    return spark.read.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity profile as a stage table (see :func:`stage_table`)."""
    return stage_table(spark, sf_dir, "entity_profile", lambda: entity_profile(spark, sf_dir))
