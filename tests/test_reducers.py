"""Reducers and value lists against brute force, a hot window over many tasks included."""

import random
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sonara.operators import reducers as R

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this module


class LongestRun:
    """Length of the longest stretch that never falls; what spans two slices is found by ``merge``."""

    def start(self):
        return None

    def add(self, state, times, values):
        assert (np.diff(times.astype("int64")) >= 0).all()
        cuts = [0, *(np.flatnonzero(np.diff(values) < 0) + 1).tolist(), len(values)]
        runs = np.diff(cuts)
        mine = (values[0], values[-1], int(runs[0]), int(runs[-1]), int(runs.max()), len(values))
        return mine if state is None else self.merge(state, mine)

    def merge(self, a, b):
        joined = a[3] + b[2] if a[1] <= b[0] else 0
        head = a[5] + b[2] if a[2] == a[5] and joined else a[2]
        tail = b[5] + a[3] if b[3] == b[5] and joined else b[3]
        return a[0], b[1], head, tail, max(a[4], b[4], joined), a[5] + b[5]

    def finish(self, state):
        return None if state[5] < 2 else state[4]


def rows(n=6000):
    rng = random.Random(1)
    out = [(None if rng.random() < 0.1 else rng.choice("aaaabc"), rng.randrange(n // 2), float(rng.randrange(50))) for _ in range(n)]
    return out + [("one", 5, 1.0)]


def series(data):
    want = {}
    for k, t, v in data:
        want.setdefault(k, []).append((t, v))
    return {k: [v for _, v in sorted(x)] for k, x in want.items()}


def longest(v):
    best = run = 1
    for a, b in zip(v, v[1:]):
        run = run + 1 if b >= a else 1
        best = max(best, run)
    return best


def test_reducers_equal_a_loop_and_spread_a_hot_series(spark):
    data = rows()
    df = spark.createDataFrame(data, "subject_id string, t long, value double").repartition(3)
    got = {r.subject_id: (r.num_datapoints, r.result) for r in R.reduce_series(df, ["subject_id"], "t", LongestRun(), num_partitions=7).collect()}
    assert got == {k: (len(v), float(longest(v)) if len(v) > 1 else None) for k, v in series(data).items()}
    fall = {r.subject_id: r.result for r in R.reduce_series(df, ["subject_id"], "t", R.Drawdown(), num_partitions=5).collect()}
    assert fall == {k: max(max(v[:i + 1]) - x for i, x in enumerate(v)) for k, v in series(data).items()}
    # small Arrow batches give the same, and the hot key's points lie in several tasks
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        again = {r.subject_id: (r.num_datapoints, r.result) for r in R.reduce_series(df, ["subject_id"], "t", LongestRun(), num_partitions=7).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert again == got
    spread = df.repartitionByRange(7, "subject_id", "t", "value").where("subject_id = 'a'").select(F.spark_partition_id()).distinct().count()
    assert spread >= 4


def test_empty_series(spark):
    df = spark.createDataFrame([], "subject_id string, t long, value double")
    assert R.reduce_series(df, ["subject_id"], "t", R.Drawdown()).count() == 0
    ev = spark.createDataFrame([], "subject_id string, instr_time timestamp_ntz, value double")
    assert R.window_values(ev, "5 days").count() == 0 and R.window_reduce(ev, "5 days", 3, R.Drawdown()).count() == 0


def test_value_segments_make_up_the_sorted_list(spark):
    data = rows(3000)
    ev = spark.createDataFrame(data, "subject_id string, t long, value double").select(
        "subject_id", F.timestamp_seconds(F.col("t") * 600).cast("timestamp_ntz").alias("instr_time"), "value")
    got = {}
    for r in R.window_values(ev, "5 days", segment=64).orderBy("subject_id", "window_start", "segment").collect():
        assert 0 < len(r["values"]) <= 64
        got.setdefault((r.subject_id, r.window_start), []).append((r.segment, r["values"]))
    want = {}
    for r in ev.withColumn("w", F.window("instr_time", "5 days").start.cast("timestamp_ntz")).collect():
        want.setdefault((r.subject_id, r.w), []).append((r.instr_time, r.value))
    assert {k: sum((v for _, v in x), []) for k, x in got.items()} == {k: [v for _, v in sorted(x)] for k, x in want.items()}
    assert all([s for s, _ in x] == list(range(len(x))) and all(len(v) == 64 for _, v in x[:-1]) for x in got.values())
