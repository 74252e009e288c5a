"""Header CSV to a typed table (explicit schema, no inference); padded names trimmed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read a header CSV with ``schema`` (fields in file order) and trim the column names."""
    df = spark.read.option("header", "true").option("mode", "PERMISSIVE").schema(schema).csv(path)
    return df.toDF(*[c.strip() for c in df.columns])


def write_csv(df: DataFrame, path: str) -> None:
    """One header CSV folder (the writer keeps names as given, padding included)."""
    df.write.mode("errorifexists").option("header", "true").csv(path)
