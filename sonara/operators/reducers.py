"""Reducers in Python over sorted series, and the sorted value list of a window, without gathering a series.

A reducer sees a series as consecutive sorted slices. The points are range-partitioned on (keys,
order, value), so a series that holds a third of all points lies in many tasks; each task folds
the part it has, batch by batch, into one state per series. Only these states are shuffled (one row
per task and series) and merged in slice order. Memory is one Arrow batch and one state.

    class Mean:
        def start(self): return (0.0, 0)
        def add(self, state, times, values): return (state[0] + values.sum(), state[1] + len(values))
        def merge(self, left, right): return (left[0] + right[0], left[1] + right[1])
        def finish(self, state): return state[0] / state[1]

``add`` gets the next slice in order (numpy arrays); ``merge`` two states of neighbouring parts, the
earlier first; ``finish`` returns a number or None. States are pickled between the two steps; the workers
must be able to import the reducer's module, unless it is sent by value (``cloudpickle.register_pickle_by_value``).

NULL keys are a group like any other; equal times are ordered by value; NULL values reach ``add`` as NaN."""

from __future__ import annotations

import pickle
from collections.abc import Sequence
from typing import Any, Protocol

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordinal import ordinal_within
from .windows import GATE, window_points

SEGMENT = 4096
OUT_ROWS = 4096   # states handed on together


class Reducer(Protocol):
    def start(self) -> Any: ...
    def add(self, state: Any, times: np.ndarray, values: np.ndarray) -> Any: ...
    def merge(self, left: Any, right: Any) -> Any: ...
    def finish(self, state: Any) -> float | None: ...


class Drawdown:
    """The largest fall from an earlier high: needs the order, and no sum over neighbouring points gives it."""

    def start(self):
        return -np.inf, np.inf, 0.0   # highest, lowest, largest fall

    def add(self, state, times, values):
        fall = float((np.maximum.accumulate(values) - values).max())
        return self.merge(state, (float(values.max()), float(values.min()), fall))

    def merge(self, left, right):
        return max(left[0], right[0]), min(left[1], right[1]), max(left[2], right[2], left[0] - right[1])

    def finish(self, state):
        return state[2]


def _starts(columns) -> np.ndarray:
    """Where a new group begins in sorted Arrow columns (NULL equals NULL)."""
    import pyarrow.compute as pc

    n = len(columns[0])
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for c in columns:
        a, b = c.slice(1), c.slice(0, n - 1)
        differ = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
        new[1:] |= differ.to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _folder(reducer: Reducer, n_keys: int, names: list[str]):
    """Sorted points -> (keys, part, n, state), one row per series met in the task."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, rows, held, types = TaskContext.get().partitionId(), [], None, None

        def out():
            columns = [pa.array(c, type=t) for c, t in zip(zip(*(r[0] for r in rows)), types)]
            sent = pa.RecordBatch.from_arrays(
                [*columns, pa.array([part] * len(rows), pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([pickle.dumps(r[2]) for r in rows], pa.binary())], names=names)
            rows.clear()
            return sent

        for b in batches:
            if not b.num_rows:
                continue
            keys = [b.column(i) for i in range(n_keys)]
            types = [k.type for k in keys]
            times, values = (b.column(i).to_numpy(zero_copy_only=False) for i in (n_keys, n_keys + 1))
            starts = _starts(keys)
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), b.num_rows]):
                key = tuple(k[s].as_py() for k in keys)
                if held is None or held[0] != key:
                    if held is not None:
                        rows.append(held)
                        if len(rows) >= OUT_ROWS:
                            yield out()
                    held = (key, 0, reducer.start())
                held = (key, held[1] + e - s, reducer.add(held[2], times[s:e], values[s:e]))
        if held is not None:
            rows.append(held)
            yield out()
    return run


def _merger(reducer: Reducer, n_keys: int, names: list[str]):
    """(keys, part, n, state) sorted by keys and part -> (keys, n, result)."""
    def run(batches):
        import pyarrow as pa

        rows, held, types = [], None, None

        def out():
            columns = [pa.array(c, type=t) for c, t in zip(zip(*(r[0] for r in rows)), types)]
            results = [reducer.finish(r[2]) for r in rows]
            sent = pa.RecordBatch.from_arrays([*columns, pa.array([r[1] for r in rows], pa.int64()),
                                               pa.array([None if x is None else float(x) for x in results], pa.float64())], names=names)
            rows.clear()
            return sent

        for b in batches:
            types = [b.column(i).type for i in range(n_keys)]
            for r in range(b.num_rows):
                key = tuple(b.column(i)[r].as_py() for i in range(n_keys))
                n, state = b.column(n_keys + 1)[r].as_py(), pickle.loads(b.column(n_keys + 2)[r].as_py())
                if held is not None and held[0] == key:
                    held = (key, held[1] + n, reducer.merge(held[2], state))
                    continue
                if held is not None:
                    rows.append(held)
                    if len(rows) >= OUT_ROWS:
                        yield out()
                held = (key, n, state)
        if held is not None:
            rows.append(held)
            yield out()
    return run


def reduce_series(points: DataFrame, keys: Sequence[str], order: str, reducer: Reducer, value: str = "value",
                  name: str = "result", num_partitions: int | None = None) -> DataFrame:
    """(keys..., num_datapoints, ``name`` double): ``reducer`` over every key's points in (``order``, ``value``) order."""
    n = num_partitions or int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = list(keys)
    full = [*keys, order, value]
    ordered = points.select(*keys, order, F.col(value).cast("double").alias(value))
    key_fields = [ordered.schema[k] for k in keys]
    sorted_points = ordered.repartitionByRange(n, *full).sortWithinPartitions(*full)
    parts = sorted_points.mapInArrow(
        _folder(reducer, len(keys), [*keys, "__part", "__n", "__state"]),
        T.StructType([*key_fields, T.StructField("__part", T.IntegerType()), T.StructField("__n", T.LongType()),
                      T.StructField("__state", T.BinaryType())]))
    return parts.repartition(*keys).sortWithinPartitions(*keys, "__part").mapInArrow(
        _merger(reducer, len(keys), [*keys, "num_datapoints", name]),
        T.StructType([*key_fields, T.StructField("num_datapoints", T.LongType()), T.StructField(name, T.DoubleType())]))


def window_reduce(events: DataFrame, duration: str, expected: int, reducer: Reducer, keys: Sequence[str] = ("subject_id",),
                  time_col: str = "instr_time", value: str = "value", gate: float = GATE) -> DataFrame:
    """``window_series`` with the caller's reducer: one row per key and window, the result as float, NULL (row
    kept) when the window has fewer than ``gate * expected`` points."""
    points = window_points(events, duration, time_col, keys, value)
    out = reduce_series(points, [*keys, "window_start", "window_end"], time_col, reducer, value, "indicator")
    enough = F.col("num_datapoints") >= F.lit(gate * expected)
    return out.select(*keys, F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "num_datapoints",
                      F.when(enough, F.col("indicator").cast("float")).alias("indicator"))


def window_values(events: DataFrame, duration: str, keys: Sequence[str] = ("subject_id",), time_col: str = "instr_time",
                  value: str = "value", segment: int = SEGMENT) -> DataFrame:
    """(keys..., window_start, segment, values): every window's values in time order, as arrays of at most
    ``segment`` values; the segments of a window, one after the other, are its sorted list."""
    points = window_points(events, duration, time_col, keys, value)
    window = [*keys, "window_start"]
    at = ordinal_within(points.select(*window, time_col, value), window, [time_col, value], name="__i")
    whole = at.withColumn("segment", F.floor(F.col("__i") / segment).cast("bigint"))
    lists = whole.groupBy(*window, "segment").agg(F.array_sort(F.collect_list(F.struct("__i", value))).alias("__v"))
    return lists.select(*keys, F.col("window_start").cast("timestamp_ntz").alias("window_start"), "segment",
                        F.col(f"__v.{value}").alias("values"))
