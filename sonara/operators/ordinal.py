"""Skew-safe row numbering.

``row_number().over(Window.partitionBy(k).orderBy(o))`` sends a whole key group to one
task, and ``Window.orderBy(o)`` without a partition sends the whole table to one task.
Here the rows are range-partitioned on (keys, order), so a hot group is spread over many
tasks; each task numbers its rows locally and a small per-(task, key) count table gives
every slice its starting offset. Work per task stays bounded by the partition size.

The order must be total within a key (add a tie-break column). The locally numbered slices
are written once to the shared scratch folder, so retries and both consumers see one copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_PID = "__sonara_pid"
_MID = "__sonara_mid"


def _as_cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def ordinal_within(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   name: str = "ordinal", base: int = 0,
                   num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = position (from ``base``) of each row in its ``keys`` group by ``order``.

    ``keys`` may be empty for a table-wide numbering; rows whose key is NULL form one group.
    Rows equal in ``order`` are numbered in any order: add a tie-break where that matters.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key_cols = _as_cols(keys)
    order_cols = _as_cols(order)
    # range partitioning on (keys, order) cuts a hot key into many slices; inside a task
    # the sorted rows get increasing ids. Range bounds come from a sample seeded by the RDD
    # id, so two exchanges would disagree: the slices are written once and both branches
    # below read the same stored ids.
    local = (df.repartitionByRange(n, *key_cols, *order_cols)
             .sortWithinPartitions(*key_cols, *order_cols)
             .withColumn(_PID, F.spark_partition_id())
             .withColumn(_MID, F.monotonically_increasing_id()))
    local = materialize(local, "ordinal")
    # one row per slice: at most (#keys + #tasks) rows; offsets are running slice sizes
    slices = local.groupBy(_PID, *keys).agg(F.min(_MID).alias("__first"), F.count(F.lit(1)).alias("__n"))
    spec = Window.partitionBy(*keys) if keys else Window
    w = spec.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(_PID, *keys, "__first",
                           F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__offset"))
    right = slices.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate([_PID, *keys])], "__first", "__offset")
    same = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate([_PID, *keys])]
    out = local.join(right, same, "inner").drop(*[f"__k{i}" for i in range(len(keys) + 1)])
    out = out.withColumn(name, (F.col("__offset") + F.col(_MID) - F.col("__first") + F.lit(base)).cast("bigint"))
    return out.drop(_PID, _MID, "__first", "__offset")
