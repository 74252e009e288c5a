"""Sample series: array -> rows, ordinals, 5-second segments, newest-first access, counts.

``audio`` is ``(song_id, timeseries, intensity)``, one row per sample. Segment slices are
written as range predicates on ``timeseries`` so they reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import mm_ss, seek_uri
from .ordinal import ordinal_within

SEGMENT_MS = 5000   # waveform segment length


def audio_long(signals: DataFrame) -> DataFrame:
    """Packed signal -> (song_id, timeseries, intensity); the song id survives the explode."""
    out = signals.select("song_id", F.posexplode("samples").alias("timeseries", "intensity"))
    return out.withColumn("timeseries", F.col("timeseries").cast("bigint"))


def sample_ordinal(rows: DataFrame, key: str, order: list[str], name: str = "timeseries") -> DataFrame:
    """0-based position of each row within its series, skew-safe (see ``ordinal_within``)."""
    return ordinal_within(rows, [key], order, name=name, base=0)


def rows_per_segment(sr: float, segment_ms: int = SEGMENT_MS) -> int:
    return int(sr * segment_ms / 1000)


def segment_col(n_per_segment: int) -> Column:
    return F.floor(F.col("timeseries") / F.lit(n_per_segment)).cast("bigint")


def segment_slice(audio: DataFrame, k: int, n_per_segment: int) -> DataFrame:
    """Samples of segment k: ``[k*n, (k+1)*n)``; a negative k has no rows."""
    if k < 0:
        return audio.where(F.lit(False))
    lo, hi = k * n_per_segment, (k + 1) * n_per_segment
    return audio.where((F.col("timeseries") >= lo) & (F.col("timeseries") < hi))


def previous_segment(audio: DataFrame, k: int, n_per_segment: int) -> DataFrame:
    return segment_slice(audio, k - 1, n_per_segment)


def audio_by_song(audio: DataFrame, song_id: int) -> DataFrame:
    """Intensities of one song in sample order (typed literal, pushed to the scan)."""
    return (audio.where(F.col("song_id") == F.lit(song_id).cast("bigint"))
            .select("timeseries", "intensity").orderBy("timeseries"))


def latest_samples(audio: DataFrame, k: int) -> DataFrame:
    """The k newest samples of every song, newest first. ``row_number() <= k`` lets Spark
    keep only k rows per song in each task before the shuffle (group limit)."""
    w = Window.partitionBy("song_id").orderBy(F.col("timeseries").desc())
    return (audio.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k)
            .drop("__rn").orderBy("song_id", F.col("timeseries").desc()))


def points_per_song(audio: DataFrame) -> DataFrame:
    return audio.groupBy("song_id").agg(F.count(F.lit(1)).alias("n_points"))


def segment_index(audio: DataFrame, n_per_segment: int, paths: DataFrame | None = None,
                  segment_ms: int = SEGMENT_MS) -> DataFrame:
    """One row per song and segment: start second, 'M:SS' label, seek address, sample count.

    ``paths`` (song_id, path) names each song's object; its size follows the catalog, so
    the join is left to AQE's measured-size choice."""
    seg = audio.groupBy("song_id", segment_col(n_per_segment).alias("segment")).agg(
        F.count(F.lit(1)).alias("n_samples"))
    seg = seg.withColumn("start_s", F.col("segment") * F.lit(segment_ms / 1000.0))
    if paths is not None:
        seg = seg.join(paths, "song_id", "left")
    else:
        seg = seg.withColumn("path", F.concat(F.lit("song/"), F.col("song_id").cast("string")))
    return seg.select("song_id", "segment", "start_s", mm_ss("start_s").alias("label"),
                      seek_uri(F.col("path"), "start_s").alias("seek"), "n_samples")


def frame_timeline(frames: DataFrame, duration: Column, n_frames: Column | None = None) -> DataFrame:
    """n evenly spaced times from 0 to the duration inclusive (step d/(n-1)), rounded to whole
    seconds half to even, and the interval d/n. ``frames`` has (song_id, timeseries);
    ``duration`` is a column on it (seconds). When the frame count is known per row
    (``n_frames``, e.g. 1 + L div hop) no aggregation is needed; otherwise it is counted per
    song (partial aggregate) and joined back."""
    if n_frames is not None:
        j, n = frames, n_frames
    else:
        counts = frames.groupBy("song_id").agg(F.count(F.lit(1)).alias("__n"))
        j, n = frames.join(counts, "song_id"), F.col("__n")
    t = F.when(n > 1, F.col("timeseries") * duration / (n - 1)).otherwise(F.lit(0.0))
    return j.select("song_id", "timeseries", t.alias("t"), F.bround(t, 0).alias("t_rounded"),
                    (duration / n).alias("interval"))
