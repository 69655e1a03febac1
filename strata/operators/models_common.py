"""Helpers of the model operators: stage tables, and this checkout on the workers' path."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from strata.session import scratch_path


def workers_import_this(spark: SparkSession) -> None:
    """Python workers get this checkout on their path (harmless where the package is installed)."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def staged_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read again: a lost executor reads the table, not what made it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
