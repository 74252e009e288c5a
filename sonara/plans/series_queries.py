"""Series and position queries on ``v_audio``, ``v_signal`` and ``v_positions`` (SEQ-02,
SEQ-03, SEQ-05..07, SEQ-09, SEQ-10, SRC-08, PRJ-05, AGG-03, STR-07..09)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import series as Q
from ..operators import spectral as S
from ..sinks.tables import read_latest
from .catalog_queries import _ACCEPTED
from .registry import register
from .stored import audio_table, catalog_table, chunked_audio
from .views import v_audio, v_positions, v_signal

AUDIO_RATE = 2.0                      # test-scale samples per second of v_audio
SEG_ROWS = Q.rows_per_segment(AUDIO_RATE)   # 10 rows per 5-second segment
STEP = 3                              # the segment a seek lands on
LOOKUP_SONG = 7
NEWEST = 5
CHUNK = 16   # samples per chunk of the stored layout
PODCAST_PATH = "podcast.mp3"

_MMSS = ("cast(floor({s} / 60) as bigint) || ':' || "
         "lpad(cast(cast(round_even(({s} / 60 - floor({s} / 60)) * 60, 0) as int) as varchar), 2, '0')")
_SEEK = "{p} || '#t=' || case when {s} - 5 > 0 then cast({s} - 5 as varchar) else '0' end"
_EXPLODE = """select song_id, cast(i - 1 as bigint) as timeseries, samples[i] as intensity
from (select song_id, samples, unnest(range(1, len(samples) + 1)) as i from v_signal)"""


@register("audio_long", _EXPLODE)
def audio_long(spark, d):
    return Q.audio_long(v_signal(spark, d))


@register("stamp_song_id", f"select song_id, timeseries from ({_EXPLODE})")
def stamp_song_id(spark, d):
    return Q.audio_long(v_signal(spark, d)).select("song_id", "timeseries")


@register("sample_ordinal", "select song_id, timeseries, intensity from v_audio")
def sample_ordinal(spark, d):
    return v_audio(spark, d)


@register("audio_by_song", f"""select timeseries, intensity from v_audio where song_id = {LOOKUP_SONG}
order by timeseries""")
def audio_by_song(spark, d):
    return Q.audio_by_song(audio_table(spark, d), LOOKUP_SONG)


@register("segment_slice", f"""select * from v_audio
where timeseries >= {STEP * SEG_ROWS} and timeseries < {(STEP + 1) * SEG_ROWS}""")
def segment_slice(spark, d):
    return Q.segment_slice(audio_table(spark, d), STEP, SEG_ROWS)


@register("previous_segment", f"""select * from v_audio
where timeseries >= {(STEP - 1) * SEG_ROWS} and timeseries < {STEP * SEG_ROWS}""")
def previous_segment(spark, d):
    return Q.previous_segment(audio_table(spark, d), STEP, SEG_ROWS)


@register("seek_step", "select event_id, s, cast(round_even(s / 5, 0) as bigint) as step from v_positions")
def seek_step(spark, d):
    return v_positions(spark, d).select("event_id", "s", X.seek_step("s").alias("step"))


@register("mm_ss", f"select event_id, s, {_MMSS.format(s='s')} as label from v_positions")
def mm_ss(spark, d):
    return v_positions(spark, d).select("event_id", "s", X.mm_ss("s").alias("label"))


@register("seek_uri", f"select event_id, {_SEEK.format(p=repr(PODCAST_PATH), s='s')} as uri from v_positions")
def seek_uri(spark, d):
    return v_positions(spark, d).select("event_id", X.seek_uri(F.lit(PODCAST_PATH), "s").alias("uri"))


@register("latest_samples", f"""select song_id, timeseries, intensity from v_audio
qualify row_number() over (partition by song_id order by timeseries desc) <= {NEWEST}
order by song_id, timeseries desc""")
def latest_samples(spark, d):
    return read_latest(spark, chunked_audio(spark, d, CHUNK), NEWEST)


@register("points_per_song", "select song_id, cast(count(*) as bigint) as n_points from v_audio group by song_id")
def points_per_song(spark, d):
    return Q.points_per_song(audio_table(spark, d))


@register("segment_index", f"""with {_ACCEPTED},
seg as (select song_id, cast(floor(timeseries / {SEG_ROWS}) as bigint) as segment, cast(count(*) as bigint) as n_samples
        from v_audio group by 1, 2),
s2 as (select seg.*, cast(segment * 5 as double) as start_s, a.s3_key as path
       from seg left join accepted a on a.song_id = seg.song_id)
select song_id, segment, start_s, {_MMSS.format(s='start_s')} as label,
       {_SEEK.format(p='path', s='start_s')} as seek, n_samples from s2""")
def segment_index(spark, d):
    paths = catalog_table(spark, d).select(F.col("song_id").cast("bigint").alias("song_id"),
                                           F.col("s3_key").alias("path"))
    return Q.segment_index(audio_table(spark, d), SEG_ROWS, paths)


@register("frame_timeline", f"""with fr as (select song_id, unnest(range(0, len(samples) // {S.TEST_PARAMS.hop} + 1)) as timeseries,
                  len(samples) / cast(sr as double) as duration from v_signal),
n as (select song_id, count(*) as n from fr group by song_id)
select fr.song_id, fr.timeseries,
       round(case when n.n > 1 then fr.timeseries * fr.duration / (n.n - 1) else 0.0 end, 9) as t,
       round_even(case when n.n > 1 then fr.timeseries * fr.duration / (n.n - 1) else 0.0 end, 0) as t_rounded,
       round(fr.duration / n.n, 12) as interval
from fr join n on n.song_id = fr.song_id""")
def frame_timeline(spark, d):
    n = F.size("samples")
    sig = v_signal(spark, d).select(
        "song_id", n.alias("n_samples"), (n / F.col("sr").cast("double")).alias("duration"),
        S.frame_count(n, S.TEST_PARAMS.hop).alias("n_frames"))
    frames = S.frame_index(sig, S.TEST_PARAMS.hop, "duration", "n_frames")
    tl = Q.frame_timeline(frames, F.col("duration"), F.col("n_frames"))
    return tl.select("song_id", "timeseries", F.round("t", 9).alias("t"), "t_rounded",
                     F.round("interval", 12).alias("interval"))
