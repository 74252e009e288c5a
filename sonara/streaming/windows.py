"""Windowed series over a stream of files.

The sink is laid out by window end (``e``), so a batch opens only the windows it touches:

* ``points/e=<end>/batch=<id>``: the batch's points (duplicates included) of windows that are not final yet;
* ``windows/e=<end>/batch=<id>``: the windows it touched, computed by the skew-safe batch operator
  (``operators.windows.window_series``) from the points of these windows staged up to this batch;
* ``seen/batch=<id>``: the largest event time up to this batch;
* ``final/e=<end>``: the windows that can't change any more, one row each;
* Spark's own checkpoint of the files read.

Every write of a batch is a function of its id and of the batches before it, so a replayed batch
rewrites its own folders and nothing else. The watermark of a batch is the largest event time of the batches
before it minus the delay. A window that ended at or before it is final, and a row of such a window is
late and dropped. A batch first moves the windows that became final to ``final``; their points and their log go
with a later batch, so readers have a trigger's time to finish. So what lies in the sink besides ``final`` is bounded
by the open windows, and the work of a batch by the windows it touches, however long the stream has run.
The result is the newest row of every (keys, window); windows still open are part of it and are updated when
more points arrive. No state store and no window's points in one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import GATE, window_series
from ..session import child_names, path_exists, remove_path, scratch_path

SEEN_KEPT = 20   # batches whose largest event time stays stored
SUBJECT = {"subject_id": "user_id"}
SUBJECT_AND_CHANNEL = {"subject_id": "user_id", "channel": "channel"}


def stream_path(source: str) -> str:
    """A single table file as a one-file glob: the file source treats a plain file path as
    its base path and refuses it, a glob it lists."""
    head, _, name = source.rstrip("/").rpartition("/")
    if "." in name and not any(ch in name for ch in "{}[]*?"):
        return f"{head}/{{{name}}}"
    return source


def _label(end: Column) -> Column:
    """A window end as digits down to the microsecond: sorts as time does, whatever the session's zone."""
    return F.rpad(F.regexp_replace(end.cast("timestamp_ntz").cast("string"), "[^0-9]", ""), 20, "0")


def _folders(spark: SparkSession, path: str, name: str) -> list[str]:
    return [x.partition("=")[2] for x in child_names(spark, path) if x.startswith(f"{name}=")]


def _write(rows: DataFrame, path: str, *folders: str) -> None:
    """Replace the folders that ``rows`` has and leave the others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


def watermark_before(spark: SparkSession, sink: str, batch_id: int | None, delay: str):
    """The watermark for ``batch_id`` (None: after all batches), or None before any event."""
    ids = [int(x) for x in _folders(spark, f"{sink}/seen", "batch")]
    ids = [x for x in ids if batch_id is None or x < batch_id]
    if not ids:
        return None
    seen = spark.read.schema("max_time timestamp_ntz").parquet(f"{sink}/seen/batch={max(ids)}")
    return seen.agg((F.max("max_time") - F.expr(f"interval {delay}")).alias("w")).first()["w"]


def _newest(log: DataFrame, keys) -> DataFrame:
    cols = ["window_end", "num_datapoints", "indicator"]
    return (log.groupBy(*keys, "window_start").agg(F.max_by(F.struct(*cols), "batch").alias("r"))
            .select(*keys, "window_start", *[F.col(f"r.{c}").alias(c) for c in cols]))


def read_windows(spark: SparkSession, sink: str, keys=("subject_id",), final_before=None) -> DataFrame:
    """The newest row of every (keys, window); with ``final_before`` only windows that ended by then."""
    cols = [*keys, "window_start", "window_end", "num_datapoints", "indicator"]
    log = None
    for part, batch in (("windows", F.col("batch").cast("long")), ("final", F.lit((1 << 63) - 1))):
        if _folders(spark, f"{sink}/{part}", "e"):
            rows = spark.read.parquet(f"{sink}/{part}").select(*cols, batch.alias("batch"))
            log = rows if log is None else log.unionByName(rows)
    if log is None:
        raise FileNotFoundError(f"no window in {sink}")
    rows = _newest(log, keys)
    return rows if final_before is None else rows.where(F.col("window_end") <= F.lit(final_before).cast("timestamp_ntz"))


def settle(spark: SparkSession, sink: str, late, keys) -> None:
    """Move the windows that ended by ``late`` to ``final``, and delete what an earlier call moved."""
    until = late.strftime("%Y%m%d%H%M%S%f")
    done = set(_folders(spark, f"{sink}/final", "e"))
    ended = [e for e in _folders(spark, f"{sink}/windows", "e") if e <= until]
    for e in done.intersection(ended):
        remove_path(spark, f"{sink}/points/e={e}")
        remove_path(spark, f"{sink}/windows/e={e}")
    fresh = [e for e in ended if e not in done]
    if fresh:
        log = spark.read.option("basePath", f"{sink}/windows").parquet(*[f"{sink}/windows/e={e}" for e in fresh])
        _write(_newest(log, keys).withColumn("e", _label(F.col("window_end"))), f"{sink}/final", "e")


def process_batch(batch: DataFrame, batch_id: int, sink: str, duration: str, expected: int, watermark: str,
                  gate: float = GATE, keys=("subject_id",)) -> None:
    """One micro-batch of (keys..., instr_time, value). Running it again with the same id changes nothing."""
    spark = batch.sparkSession
    late = watermark_before(spark, sink, batch_id, watermark)
    if late is not None:
        settle(spark, sink, late, keys)
    w = F.window("instr_time", duration)
    tagged = batch.select(*keys, "instr_time", "value", w.start.cast("timestamp_ntz").alias("window_start"),
                          w.end.cast("timestamp_ntz").alias("window_end"))
    if late is not None:
        tagged = tagged.where(F.col("window_end") > F.lit(late).cast("timestamp_ntz"))
    tagged = tagged.select("*", _label(F.col("window_end")).alias("e"), F.lit(batch_id).cast("long").alias("batch"))
    _write(tagged, f"{sink}/points", "e", "batch")
    ids = [int(x) for x in _folders(spark, f"{sink}/seen", "batch")]
    before = max((x for x in ids if x < batch_id), default=None)
    top = batch.agg(F.max("instr_time").cast("timestamp_ntz").alias("max_time"))
    if before is not None:
        top = top.union(spark.read.schema(top.schema).parquet(f"{sink}/seen/batch={before}")).agg(F.max("max_time").alias("max_time"))
    top.coalesce(1).write.mode("overwrite").parquet(f"{sink}/seen/batch={batch_id}")
    for old in ids:  # a batch is replayed only before the next one begins
        if old < batch_id - SEEN_KEPT:
            remove_path(spark, f"{sink}/seen/batch={old}")
    mine = [f"{sink}/points/e={e}" for e in _folders(spark, f"{sink}/points", "e")
            if path_exists(spark, f"{sink}/points/e={e}/batch={batch_id}")]
    if not mine:
        return
    points = spark.read.schema(tagged.schema).option("basePath", f"{sink}/points").parquet(*mine).where(F.col("batch") <= batch_id)
    touched = points.where(F.col("batch") == batch_id).select(
        *[F.col(k).alias(f"__{k}") for k in (*keys, "window_start")]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in (*keys, "window_start")]
    again = points.join(touched, same, "left_semi").select(*keys, "instr_time", "value")
    rows = window_series(again, duration, expected, keys=tuple(keys), gate=gate)
    _write(rows.select("*", _label(F.col("window_end")).alias("e"), F.lit(batch_id).cast("long").alias("batch")), f"{sink}/windows", "e", "batch")


def _writer(spark, source, duration, expected, watermark, gate, sink, checkpoint, max_files_per_trigger,
            keys: Mapping[str, str], time_col: str, value_col: str):
    reader = spark.readStream.schema(spark.read.parquet(source).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.parquet(stream_path(source)).select(
        *[F.col(c).alias(k) for k, c in keys.items()], F.col(time_col).alias("instr_time"), F.col(value_col).alias("value"))

    def step(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, sink, duration, expected, watermark, gate, tuple(keys))

    return events.writeStream.outputMode("append").foreachBatch(step).option("checkpointLocation", checkpoint)


def window_series_stream(spark: SparkSession, source: str, duration: str, expected: int,
                         watermark: str = "1 day", gate: float = GATE,
                         sink: str | None = None, checkpoint: str | None = None,
                         max_files_per_trigger: int | None = None, keys: Mapping[str, str] = SUBJECT,
                         time_col: str = "ts", value_col: str = "value") -> DataFrame:
    """Process all available Parquet files at ``source``; return the current windows.

    ``keys`` maps result columns to source columns (e.g. ``SUBJECT_AND_CHANNEL``). With the same
    ``sink`` and ``checkpoint`` a later call goes on where this one ended."""
    sink = sink or scratch_path(spark, "window-series")
    checkpoint = checkpoint or scratch_path(spark, "window-series-ckpt")
    q = _writer(spark, source, duration, expected, watermark, gate, sink, checkpoint, max_files_per_trigger,
                keys, time_col, value_col).trigger(availableNow=True).start()
    q.awaitTermination()
    if _folders(spark, f"{sink}/windows", "e") or _folders(spark, f"{sink}/final", "e"):
        return read_windows(spark, sink, tuple(keys))
    schema = spark.read.parquet(source).schema  # no batch so far
    columns = ", ".join(f"`{k}` {schema[c].dataType.simpleString()}" for k, c in keys.items())
    empty = spark.createDataFrame([], f"{columns}, instr_time timestamp_ntz, value double")
    return window_series(empty, duration, expected, keys=tuple(keys), gate=gate)


def start_window_series_service(spark: SparkSession, source: str, duration: str, expected: int,
                                watermark: str = "1 day", gate: float = GATE, sink: str | None = None,
                                checkpoint: str | None = None, interval: str = "1 minute",
                                max_files_per_trigger: int | None = None, keys: Mapping[str, str] = SUBJECT,
                                time_col: str = "ts", value_col: str = "value"):
    """The stream as a long-running query with a processing-time trigger. Returns (query, sink);
    read ``read_windows(spark, sink, keys)`` while it runs, and with
    ``final_before=watermark_before(spark, sink, None, delay)`` only windows that can't change."""
    sink = sink or scratch_path(spark, "window-series")
    checkpoint = checkpoint or scratch_path(spark, "window-series-ckpt")
    q = _writer(spark, source, duration, expected, watermark, gate, sink, checkpoint, max_files_per_trigger,
                keys, time_col, value_col).trigger(processingTime=interval).start()
    return q, sink
