"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sonara.session import materialize

WHITE = r"\x20\x09-\x0D"
WORD = f"[^{WHITE}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage, survives lost executors."""
    return materialize(df, name)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """Array of the words (runs of characters other than space and \\x09-\\x0D); empty array without one."""
    one = F.regexp_replace(c, f"[{WHITE}]+", " ")
    return F.filter(F.split(one, " ", -1), lambda w: w != "")


def per_worker(key: tuple, build):
    """``build()`` once per Python worker process: reused workers keep tables between tasks.

    The functions here travel to the workers by value, so module globals would not last."""
    import sys
    import types

    kept = sys.modules.setdefault("_sonara_worker_tables", types.ModuleType("_sonara_worker_tables")).__dict__
    if key not in kept:
        kept[key] = build()
    return kept[key]
