"""Dataset IO (S1-S7, S11): schema-first CSV/Parquet reads, source resolution, stage writes.

Every write goes below the cluster-shared folder (``spark.checkpoint.dir``)
unless the caller names a path; nothing touches a machine-local temp dir.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def resolve_source(spark: SparkSession, candidates: Sequence[str]) -> str:
    """The first existing dataset among ``candidates`` (e.g. fixed, then raw); error if none."""
    for c in candidates:
        if _exists(spark, c):
            return c
    raise FileNotFoundError(f"none of the sources exist: {list(candidates)}")


def read_dataset(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                 fmt: str | None = None) -> DataFrame:
    """Parquet (schema from the footer) or CSV with header and an explicit schema."""
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    if fmt == "csv":
        r = spark.read.option("header", True)
        r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
        return r.csv(path)
    return spark.read.parquet(path)


def write_dataset(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet",
                  partition_by: str | None = "split") -> str:
    """Overwrite a named dataset; partitioned by ``split`` when present."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    w = df.write.mode("overwrite")
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """S3: one split of a partitioned dataset; the filter prunes partitions (only that folder is read)."""
    return spark.read.parquet(path).where(F.col("split") == split)


def csv_roundtrip(df: DataFrame) -> DataFrame:
    """S1+S6: write as CSV with header, read back with the original schema (no inference)."""
    path = write_dataset(df, "csv_roundtrip", fmt="csv", partition_by=None)
    return read_dataset(df.sparkSession, path, schema=df.schema, fmt="csv")


def write_json_row(df: DataFrame, name: str, path: str | None = None) -> str:
    """A one-row (possibly nested) summary as JSON."""
    path = path or scratch_path(df.sparkSession, name)
    df.coalesce(1).write.mode("overwrite").json(path)
    return path
