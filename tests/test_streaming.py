"""Stream = batch for windowed series; late rows are dropped; file stream ingests once."""

import os
import random

import pytest

from pyspark.sql import functions as F

from sonara.operators import windows as W
from sonara.streaming.ingest import ingest_stream
from sonara.streaming.windows import (SUBJECT_AND_CHANNEL, process_batch, read_windows, start_window_series_service,
                                      watermark_before, window_series_stream)
from sonara.sources.wav import wav_bytes

from data_dirs import SF01


def test_stream_equals_batch(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    src = os.path.join(tmp_dir, "src")
    # two files, the second strictly later in time: nothing is late
    cut = ev.agg(F.expr("percentile_approx(ts, 0.5)")).first()[0]
    ev.where(F.col("ts") < cut).coalesce(1).write.parquet(os.path.join(src, "p1"))
    ev.where(F.col("ts") >= cut).coalesce(1).write.parquet(os.path.join(src, "p2"))
    stream = window_series_stream(spark, src + "/*", "5 days", 10, watermark="30 days", max_files_per_trigger=1)
    batch = W.window_series(ev.select(F.col("user_id").alias("subject_id"), F.col("ts").alias("instr_time"), "value"),
                            "5 days", 10)
    assert stream.count() == batch.count() == 1050
    assert stream.exceptAll(batch).count() == batch.exceptAll(stream).count() == 0


def test_late_rows_dropped(spark, tmp_dir):
    """Late-event filtering uses the previous batch's watermark: the late file comes third."""
    import glob
    import time

    src = os.path.join(tmp_dir, "late")
    schema = "event_id bigint, user_id bigint, ts string, value double"
    batches = {
        "a": [(1, 1, "2024-01-20 00:00:00", 1.0), (2, 1, "2024-01-20 01:00:00", 2.0)],
        "c": [(3, 1, "2024-01-21 00:00:00", 4.0)],
        "b": [(4, 1, "2024-01-01 00:00:00", 50.0)],          # late: its window ended long ago
    }
    t0 = time.time() - 1000
    for k, (name, rows) in enumerate(batches.items()):
        df = spark.createDataFrame(rows, schema).withColumn("ts", F.to_timestamp("ts").cast("timestamp_ntz"))
        df.coalesce(1).write.parquet(os.path.join(src, name))
        for f in glob.glob(os.path.join(src, name, "*.parquet")):
            os.utime(f, (t0 + 100 * k, t0 + 100 * k))
    out = window_series_stream(spark, src + "/*", "5 days", 2, watermark="1 day", max_files_per_trigger=1)
    got = out.collect()
    assert len(got) == 1 and got[0].num_datapoints == 3 and abs(got[0].indicator - 1.5) < 1e-6


def test_file_stream_ingests_each_file_once(spark, tmp_dir):
    root, cat, ck = (os.path.join(tmp_dir, x) for x in ("in", "cat", "ck"))
    os.makedirs(root)
    for name in ("b.wav", "a.wav"):
        with open(os.path.join(root, name), "wb") as fh:
            fh.write(wav_bytes([0.1, 0.2, 0.3], 8000))
    ingest_stream(spark, root, cat, ck)
    with open(os.path.join(root, "c.wav"), "wb") as fh:
        fh.write(wav_bytes([0.1], 8000))
    ingest_stream(spark, root, cat, ck)
    got = sorted((r.s3_key, r.song_id) for r in spark.read.parquet(cat).collect())
    assert got == [("a.wav", 1), ("b.wav", 2), ("c.wav", 3)]


def test_stream_windows_do_not_depend_on_session_zone(spark, tmp_dir):
    src = os.path.join(tmp_dir, "tz")
    ev = spark.read.parquet(f"{SF01}/events.parquet").where("user_id < 20")
    ev.coalesce(1).write.parquet(os.path.join(src, "p"))
    batch = W.window_series(ev.select(F.col("user_id").alias("subject_id"), F.col("ts").alias("instr_time"), "value"),
                            "5 days", 10)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        stream = window_series_stream(spark, src + "/*", "5 days", 10, watermark="30 days")
        rows = stream.collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, batch.collect()))


def _batch(ev, keys=("subject_id",)):
    cols = [F.col("user_id").alias("subject_id"), *[F.col(k) for k in keys if k != "subject_id"]]
    return W.window_series(ev.select(*cols, F.col("ts").alias("instr_time"), "value"), "5 days", 10, keys=keys)


def _same(a, b):
    """Equal rows; the indicator, a sum in any order, to its last rounded digit."""
    a, b = ({tuple(r[c] for c in b.columns if c != "indicator"): r["indicator"] for r in d.collect()} for d in (a, b))
    return a.keys() == b.keys() and all(
        a[k] == b[k] or (a[k] is not None and b[k] is not None and abs(a[k] - b[k]) <= 2e-6 * max(1.0, abs(b[k]))) for k in b)


def test_any_split_and_second_runs_equal_batch(spark, tmp_dir):
    """Random halves (not by time) over several runs with duplicates, per subject and channel."""
    ev = spark.read.parquet(f"{SF01}/events.parquet").where("user_id < 40")
    ev = ev.withColumn("channel", F.when(F.col("event_id") % 5 > 0, F.col("event_id") % 2).cast("string"))  # NULLs too
    ev = ev.union(ev.where("event_id % 3 = 0"))  # genuine repeated points
    src, sink, ck = (os.path.join(tmp_dir, x) for x in ("src", "sink", "ck"))
    run = lambda: window_series_stream(spark, src + "/*", "5 days", 10, watermark="90 days", sink=sink, checkpoint=ck,
                                       max_files_per_trigger=1, keys=SUBJECT_AND_CHANNEL)
    keys = ("subject_id", "channel")
    for part in range(3):
        ev.where(F.col("event_id") % 3 == part).repartition(2).write.parquet(os.path.join(src, f"p{part}"))
        so_far = ev.where(F.col("event_id") % 3 <= part)
        assert _same(run(), _batch(so_far, keys))
    again = run()  # no new input
    assert _same(again, _batch(ev, keys))
    assert again.agg(F.sum("num_datapoints")).first()[0] == ev.count()


def test_replayed_batch_changes_nothing(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF01}/events.parquet").where("user_id < 20").select(
        F.col("user_id").alias("subject_id"), F.col("ts").alias("instr_time"), "value")
    sink = os.path.join(tmp_dir, "replay")
    half = F.xxhash64("instr_time") % 2 == 0
    for k, rows in enumerate((ev.where(half), ev.where(~half))):
        process_batch(rows, k, sink, "5 days", 10, "90 days")
    before = sorted(map(tuple, read_windows(spark, sink).collect()))
    process_batch(ev.where(~half), 1, sink, "5 days", 10, "90 days")
    process_batch(ev.where(half), 0, sink, "5 days", 10, "90 days")
    process_batch(ev.where(~half), 1, sink, "5 days", 10, "90 days")
    assert sorted(map(tuple, read_windows(spark, sink).collect())) == before
    assert before == sorted(map(tuple, W.window_series(ev, "5 days", 10).collect()))


def test_window_series_service(spark, tmp_dir):
    """Long-running form: windows before the watermark are final and complete while the query runs."""
    ev = spark.read.parquet(f"{SF01}/events.parquet").where("user_id < 30")
    src = os.path.join(tmp_dir, "svc")
    ev.where("ts < timestamp_ntz'2024-01-20 00:00:00'").coalesce(1).write.parquet(os.path.join(src, "p0"))
    q, sink = start_window_series_service(spark, src + "/*", "5 days", 10, watermark="1 day",
                                          interval="1 second", max_files_per_trigger=1)
    try:
        q.processAllAvailable()
        ev.where("ts >= timestamp_ntz'2024-01-20 00:00:00'").coalesce(1).write.parquet(os.path.join(src, "p1"))
        q.processAllAvailable()
    finally:
        q.stop()
    late = watermark_before(spark, sink, None, "1 day")
    batch = _batch(ev)
    assert _same(read_windows(spark, sink), batch)
    assert _same(read_windows(spark, sink, final_before=late), batch.where(F.col("window_end") <= F.lit(late).cast("timestamp_ntz")))


def test_ties_and_null_keys(spark):
    """Equal times are ordered by value whatever order they arrive in; NULL subjects are a group."""
    rows = [(None if i % 4 == 0 else i % 3, "2024-01-02 00:00:00", float((i * 7) % 5)) for i in range(40)]
    frames = [spark.createDataFrame(r, "subject_id int, t string, value double").select(
        "subject_id", F.to_timestamp("t").cast("timestamp_ntz").alias("instr_time"), "value") for r in (rows, rows[::-1])]
    a, b = (sorted(map(repr, W.window_series(f, "5 days", 1).collect())) for f in frames)
    assert a == b and len(a) == 4
    want = {}
    for k, _, v in rows:
        want.setdefault(k, []).append(v)
    got = {r.subject_id: (r.num_datapoints, r.indicator) for r in W.window_series(frames[0], "5 days", 1).collect()}
    assert got == {k: (len(v), pytest.approx((max(v) - min(v)) / (len(v) - 1), abs=1e-5)) for k, v in want.items()}


def _folder_names(sink, part):
    import glob
    return sorted(os.path.relpath(p, os.path.join(sink, part)) for p in glob.glob(os.path.join(sink, part, "*", "batch=*")))


def test_work_per_batch_stays_flat_and_final_windows_settle(spark, tmp_dir, monkeypatch):
    """A window a day, a batch half a day, some rows a day late: what a batch opens and what is kept do not grow."""
    from sonara.streaming import windows as SW

    monkeypatch.setattr(SW, "SEEN_KEPT", 3)
    sink = os.path.join(tmp_dir, "flat")
    day = lambda d: f"timestampadd(SECOND, cast(({d}) * 86400 as int), timestamp_ntz'2024-01-01 00:00:00')"
    opened, parts = [], []
    real = SW.window_series

    def spy(points, *a, **k):
        opened.append(len([f for f in points.inputFiles() if "/points/" in f]))
        return real(points, *a, **k)

    monkeypatch.setattr(SW, "window_series", spy)
    n, kept = 14, []
    for b in range(n):
        rows = spark.range(40).select((F.col("id") % 3).cast("int").alias("subject_id"),
                                      F.expr(day(f"{b} / 2 + (id % 20) / 40 - if(id % 10 = 9, 1, 0)")).alias("instr_time"),
                                      (F.col("id") * 7 % 11 + b).cast("double").alias("value")).coalesce(1)
        parts.append(rows)
        process_batch(rows, b, sink, "1 day", 20, "36 hours")
        kept.append((len(_folder_names(sink, "points")), len(_folder_names(sink, "windows")), len(os.listdir(os.path.join(sink, "seen")))))
    assert max(opened[10:]) <= max(opened[5:10]) and max(kept[10:]) <= max(kept[5:10])
    assert len(SW._folders(spark, f"{sink}/final", "e")) > n // 2 - 5
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.union(p)
    want = sorted(map(tuple, W.window_series(whole, "1 day", 20).collect()))
    assert sorted(map(tuple, read_windows(spark, sink).collect())) == want       # 36 hours: no row is late
    process_batch(parts[-1], n - 1, sink, "1 day", 20, "36 hours")
    process_batch(parts[-1], n - 1, sink, "1 day", 20, "36 hours")
    assert sorted(map(tuple, read_windows(spark, sink).collect())) == want


def test_a_batch_broken_between_its_writes_is_repeated(spark, tmp_dir, monkeypatch):
    from sonara.streaming import windows as SW

    ev = spark.read.parquet(f"{SF01}/events.parquet").where("user_id < 10").select(
        F.col("user_id").alias("subject_id"), F.col("ts").alias("instr_time"), "value")
    cuts = ["2024-01-01", "2024-01-12", "2024-01-25", "2024-02-05", "2030-01-01"]
    parts = [ev.where(f"instr_time >= timestamp_ntz'{a} 00:00:00' and instr_time < timestamp_ntz'{b} 00:00:00'") for a, b in zip(cuts, cuts[1:])]
    real, calls, luck = SW._write, [], random.Random(4)

    def broken(*a):
        calls.append(luck.random() < 0.4)
        if calls[-1]:
            raise RuntimeError("lost")
        real(*a)

    sink = os.path.join(tmp_dir, "broken")
    monkeypatch.setattr(SW, "_write", broken)
    for b, rows in enumerate(parts):
        done = False
        while not done:
            try:
                process_batch(rows, b, sink, "5 days", 10, "1 day")
                done = True
            except RuntimeError:
                pass
    assert 2 < sum(calls) < len(calls)
    assert sorted(map(tuple, read_windows(spark, sink).collect())) == sorted(map(tuple, W.window_series(ev.where("instr_time >= timestamp_ntz'2024-01-01 00:00:00'"), "5 days", 10).collect()))
