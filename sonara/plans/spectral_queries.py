"""Spectrogram queries (SIG-01..11, AGG-02, SRC-07, JON-01) on ``v_signal``.

Parameters are the small oracle set (N=32, H=8, M=8, fmax=10 kHz); the production
parameters only change ``MelParams``. Values are rounded in both engines: dB to 4 places,
powers and weights to 10.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import spectral as S
from ..schemas import band_names
from .registry import register
from .spectral_sql import ctes
from .stored import spec_table
from .views import v_signal

P = S.TEST_PARAMS
LOOKUP_SONG = 7  # the song a lookup page asks for


def _db_long(spark, d, p=P):
    return S.spec_long_db(S.mel_spectrogram(v_signal(spark, d), p), p)


@register("frame_signal", ctes(P, "taps") + """
select song_id, timeseries, n, x from taps""")
def frame_signal(spark, d):
    fr = S.frame_signal(v_signal(spark, d), P)
    out = fr.select("song_id", "timeseries", F.posexplode("frame").alias("n", "x"))
    return out.select("song_id", "timeseries", F.col("n").cast("bigint").alias("n"), F.col("x").cast("double").alias("x"))


@register("frame_index", ctes(P, "fr") + f"""
select song_id, timeseries, timeseries * {P.hop} - {P.n_fft // 2} as start_sample from fr""")
def frame_index(spark, d):
    fr = S.frame_index(v_signal(spark, d).select("song_id", F.size("samples").alias("n_samples")), P.hop)
    return fr.select("song_id", "timeseries",
                     (F.col("timeseries") * P.hop - P.n_fft // 2).alias("start_sample"))


@register("power_spectrum", ctes(P, "pw") + """
select song_id, timeseries, bin, round(power, 10) as power from pw""")
def power_spectrum(spark, d):
    pw = S.power_spectrum(v_signal(spark, d), P)
    out = pw.select("song_id", "timeseries", F.posexplode("power").alias("bin", "power"))
    return out.select("song_id", "timeseries", F.col("bin").cast("bigint").alias("bin"),
                      F.round("power", 10).alias("power"))


@register("mel_filterbank", ctes(P, "fb") + """
select cast(sr as int) as sr, band, bin, round(weight, 10) as weight from fb""")
def mel_filterbank(spark, d):
    fb = S.mel_filterbank(v_signal(spark, d).select("sr"), P)
    return fb.select("sr", "band", "bin", F.round("weight", 10).alias("weight"))


@register("mel_spectrogram", ctes(P, "mel") + """
select song_id, timeseries, band, round(mel, 10) as mel from mel""")
def mel_spectrogram(spark, d):
    m = S.mel_spectrogram(v_signal(spark, d), P)
    out = m.select("song_id", "timeseries", F.posexplode("mel").alias("band", "mel"))
    return out.select("song_id", "timeseries", F.col("band").cast("bigint").alias("band"),
                      F.round("mel", 10).alias("mel"))


@register("song_peak", ctes(P, "peak") + """
select song_id, round(10 * log10(peak), 4) as peak_db, round(peak, 10) as peak from peak""")
def song_peak(spark, d):
    pk = S.song_peak(S.mel_spectrogram(v_signal(spark, d), P))
    return pk.select("song_id", F.round(10 * F.log10("peak"), 4).alias("peak_db"),
                     F.round("peak", 10).alias("peak"))


@register("power_to_db", ctes(P, "db") + """
select song_id, timeseries, band, round(db, 4) as db from db""")
def power_to_db(spark, d):
    return _db_long(spark, d).withColumn("db", F.round("db", 4))


@register("spec_long", ctes(P, "db") + """
select song_id, timeseries, band, round(db, 4) as db from db""")
def spec_long(spark, d):
    # long form obtained from the stored wide table (unpivot of spec1..specM)
    wide = S.spec_wide_db(S.mel_spectrogram(v_signal(spark, d), P), P)
    return S.wide_to_long(wide, P.n_mels).withColumn("db", F.round("db", 4))


_WIDE_SQL = ctes(P, "db") + "\nselect song_id, timeseries, " + ", ".join(
    f"round(max(case when band = {i} then db end), 4) as {n}" for i, n in enumerate(band_names(P.n_mels))
) + "\nfrom db group by song_id, timeseries"


@register("spec_wide", _WIDE_SQL)
def spec_wide(spark, d):
    wide = S.spec_wide_db(S.mel_spectrogram(v_signal(spark, d), P), P)
    return wide.select("song_id", "timeseries", *[F.round(n, 4).alias(n) for n in band_names(P.n_mels)])


_NOKEY_SQL = ctes(P, "db") + "\nselect " + ", ".join(
    f"round(max(case when band = {i} then db end), 4) as {n}" for i, n in enumerate(band_names(P.n_mels))
) + "\nfrom db group by song_id, timeseries"


@register("drop_index_cols", _NOKEY_SQL)
def drop_index_cols(spark, d):
    """PRJ-06: the spectrogram values without the two leading index columns."""
    wide = spec_table(spark, d).drop("song_id", "timeseries")
    return wide.select(*[F.round(n, 4).alias(n) for n in band_names(P.n_mels)])


@register("zip_index_with_values", _WIDE_SQL)
def zip_index_with_values(spark, d):
    """JON-01: the index frame (song_id, timeseries), built from the signals' lengths, and the
    value frame joined on the key, never by position."""
    values = S.spec_wide_db(S.mel_spectrogram(v_signal(spark, d), P), P)
    index = S.frame_index(v_signal(spark, d).select("song_id", F.size("samples").alias("n_samples")), P.hop)
    j = index.join(values, ["song_id", "timeseries"])
    return j.select("song_id", "timeseries", *[F.round(n, 4).alias(n) for n in band_names(P.n_mels)])


@register("spec_image", ctes(P, "db") + """
select song_id, band, timeseries, round(db, 4) as db from db order by song_id, band, timeseries""")
def spec_image(spark, d):
    """SIG-09: the display matrix of every song, from the stored spectrogram table."""
    img = S.spec_image(S.wide_to_long(spec_table(spark, d), P.n_mels))
    return img.withColumn("db", F.round("db", 4)).orderBy("song_id", "band", "timeseries")


@register("spec_image_flipped", ctes(P, "db") + f"""
select song_id, {P.n_mels - 1} - band as band, timeseries, round(db, 4) as db from db
order by song_id, band, timeseries""")
def spec_image_flipped(spark, d):
    img = S.spec_image(S.wide_to_long(spec_table(spark, d), P.n_mels), flipped=True, n_mels=P.n_mels)
    return img.withColumn("db", F.round("db", 4)).orderBy("song_id", "band", "timeseries")


_FULL = S.full_band(P)


@register("mel_full_band", ctes(_FULL, "db") + """
select song_id, timeseries, band, round(db, 4) as db from db""")
def mel_full_band(spark, d):
    return _db_long(spark, d, _FULL).withColumn("db", F.round("db", 4))


@register("spec_by_song", ctes(P, "db") + f"""
select song_id, timeseries, band, round(db, 4) as db from db where song_id = {LOOKUP_SONG}
order by timeseries, band""")
def spec_by_song(spark, d):
    """SRC-07: all frames of one song, in frame order, read from the stored (song-clustered)
    spectrogram table; the filter is a typed literal pushed to the Parquet scan."""
    hit = spec_table(spark, d).where(F.col("song_id") == F.lit(LOOKUP_SONG).cast("bigint"))
    long = S.wide_to_long(hit, P.n_mels)
    return long.withColumn("db", F.round("db", 4)).orderBy("timeseries", "band")


@register("points_per_song_frames", ctes(P, "fr") + """
select song_id, cast(count(*) as bigint) as n_frames, max(n_samples) as n_samples from fr group by song_id""")
def points_per_song_frames(spark, d):
    """AGG-03 (frames): frame count per song equals 1 + floor(L / hop)."""
    sig = v_signal(spark, d)
    return sig.select("song_id", S.frame_count(F.size("samples"), P.hop).cast("bigint").alias("n_frames"),
                      F.size("samples").cast("bigint").alias("n_samples"))


_JOB_SQL = ctes(S.JOB_PARAMS, "db", by_sample=True) + "\nselect song_id, timeseries, " + ", ".join(
    f"round(max(case when band = {i} then db end), 4) as {n}" for i, n in enumerate(band_names(S.JOB_PARAMS.n_mels))
) + "\nfrom db group by song_id, timeseries"


@register("spec_job_params", _JOB_SQL)
def spec_job_params(spark, d):
    """The ingest job's own parameters (n_fft 2048, hop 512, 128 bands to 10 kHz) on every
    signal, wide form."""
    wide = S.spec_wide_db(S.mel_spectrogram(v_signal(spark, d), S.JOB_PARAMS), S.JOB_PARAMS)
    return wide.select("song_id", "timeseries",
                       *[F.round(n, 4).alias(n) for n in band_names(S.JOB_PARAMS.n_mels)])
