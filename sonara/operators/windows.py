"""Windowed series (batch): tumbling windows per subject, point counts, and a per-series
reducer over the time-sorted points.

The shipped reducer is the mean absolute successive difference. It is computed without
gathering a window's points into one list: points are range-partitioned in time order, each
point meets its predecessor inside its slice or over a slice boundary (``consecutive``), and the
differences are summed with a partial aggregate. A window holding a third of all points is
therefore spread over many tasks. Points of one time are ordered by value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

GATE = 0.9   # windows with fewer than 90 % of the expected points get no result


def window_points(events: DataFrame, duration: str, time_col: str = "instr_time",
                  keys: Sequence[str] = ("subject_id",), value: str = "value") -> DataFrame:
    """Tag each point with its tumbling window (epoch-aligned, ``duration`` long)."""
    w = F.window(time_col, duration)
    return events.select(*keys, w.start.alias("window_start"), w.end.alias("window_end"),
                         time_col, value)


def consecutive(points: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "value") -> DataFrame:
    """(keys..., __prev, __cur, __paired, __n): every point once (__n = 1) beside its predecessor in the
    key's (``order``, ``value``) order, and one row more (__n = 0) per pair that a slice boundary parts.

    The points are range-partitioned on (keys, order, value) once, so a hot key spreads over many
    slices. Inside a slice the predecessor is a ``lag``; a table with one row per (slice, key)
    holds each slice's first and last point and supplies the pairs between slices. Equal times are
    ordered by value; NULL keys are a group like any other."""
    spark = points.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    full = [*order, value]
    local = materialize(points.select(*keys, *full).repartitionByRange(n, *keys, *full)
                        .withColumn("__slice", F.spark_partition_id()), "slices")
    inside = Window.partitionBy("__slice", *keys).orderBy(*full)
    own = local.select(*keys, F.lag(value).over(inside).alias("__prev"), F.col(value).alias("__cur"),
                       F.lag(F.lit(True)).over(inside).isNotNull().alias("__paired"), F.lit(1).alias("__n"))
    ends = local.groupBy("__slice", *keys).agg(F.min(F.struct(*full)).alias("first"), F.max(F.struct(*full)).alias("last"))
    slices = Window.partitionBy(*keys).orderBy("__slice")
    parted = (ends.select(*keys, F.lag("last").over(slices).alias("last"), "first").where("last IS NOT NULL")
              .select(*keys, F.col(f"last.{value}").alias("__prev"), F.col(f"first.{value}").alias("__cur"),
                      F.lit(True).alias("__paired"), F.lit(0).alias("__n")))
    return own.unionByName(parted)


def pairwise_reduce(points: DataFrame, keys: Sequence[str], order: Sequence[str],
                    pair: Callable[[Column, Column], Column], value: str = "value",
                    name: str = "total") -> DataFrame:
    """(keys..., name, n_pairs): sum over consecutive points (in (``order``, ``value``)) of
    ``pair(previous, current)``, a Column expression (JVM-side). Any reducer built from
    consecutive pairs fits: absolute or squared successive differences, sign changes,
    threshold crossings. No group is gathered, and a hot key spreads over many tasks."""
    rows = consecutive(points, keys, order, value).where("__paired")
    return rows.groupBy(*keys).agg(F.sum(pair(F.col("__prev"), F.col("__cur"))).alias(name),
                                   F.count(F.lit(1)).alias("n_pairs"))


def successive_abs_diff(points: DataFrame, keys: Sequence[str], order: Sequence[str],
                        value: str = "value") -> DataFrame:
    """(keys..., sum_abs_diff, n_pairs): |x_i - x_{i-1}| over each key's time-sorted points."""
    return pairwise_reduce(points, keys, order, lambda a, b: F.abs(b - a), value, "sum_abs_diff")


def window_series(events: DataFrame, duration: str, expected: int,
                  keys: Sequence[str] = ("subject_id",), time_col: str = "instr_time",
                  value: str = "value", gate: float = GATE) -> DataFrame:
    """One row per key and window: window end, point count, and the reducer's result as
    float; NULL (row kept) when the window has fewer than ``gate * expected`` points."""
    pts = window_points(events, duration, time_col, keys, value)
    wkeys = [*keys, "window_start", "window_end"]
    rows = consecutive(pts, wkeys, [time_col], value)
    out = rows.groupBy(*wkeys).agg(F.sum("__n").alias("num_datapoints"),
                                   F.sum(F.abs(F.col("__cur") - F.col("__prev"))).alias("sum_abs_diff"))
    n = F.col("num_datapoints")
    mean = F.col("sum_abs_diff") / (n - 1)
    ind = F.when(n >= F.lit(gate * expected), F.round(mean, 6).cast("float"))
    return out.select(*keys, F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                      n.cast("bigint").alias("num_datapoints"), ind.alias("indicator"))


def per_series_reduce(events: DataFrame, duration: str, keys: Sequence[str] = ("subject_id",),
                      time_col: str = "instr_time", value: str = "value") -> DataFrame:
    """The reducer alone, ungated: (keys..., window_start, indicator double) for windows with
    at least two points."""
    pts = window_points(events, duration, time_col, keys, value)
    wkeys = [*keys, "window_start"]
    d = successive_abs_diff(pts, wkeys, [time_col], value)
    return d.select(*keys, F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                    F.round(F.col("sum_abs_diff") / F.col("n_pairs"), 6).alias("indicator"))
