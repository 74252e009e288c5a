"""Ingest queries over WAV files that Spark derives from ``v_signal`` (SRC-01..04, UDF-01,
SNK-01..04, STM-02).

The files are written once per session and data folder, one mono 16-bit WAV per song
named by its id, into the shared scratch folder; the oracle rebuilds the same values from
``v_signal`` (16-bit quantisation: x * 32767 rounded half to even, read back / 32768).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as C
from ..operators import ingest as I
from ..operators import spectral as S
from ..session import scratch_path
from ..sinks import tables as K
from ..sources.objects import list_objects as _list, relative_key, scan_binary as _scan
from ..sources.paged import list_in_pages
from ..sources.wav import export_wav, file_heads
from ..streaming.ingest import ingest_pages as _ingest_pages, ingest_stream as _ingest_stream
from .catalog_queries import _ACCEPTED, _STRING_COLS, records
from .registry import register
from .spectral_sql import ctes
from .views import v_audio, v_signal

CHUNK = 16   # samples per stored chunk of the series table

_EXPORTS: dict[tuple[str, str], str] = {}


def wav_folder(spark, d) -> str:
    key = (spark.sparkContext.applicationId, d)
    if key not in _EXPORTS:
        folder = scratch_path(spark, "wav")
        export_wav(v_signal(spark, d), folder)
        _EXPORTS[key] = folder
    return _EXPORTS[key]


_KEY = "lpad(cast(song_id as varchar), 6, '0') || '.wav'"
_QSIG = ("qsig", """select song_id, sr,
       list(cast(round_even(cast(x as double) * 32767, 0) / 32768 as float) order by i) as samples
from (select song_id, sr, samples[i] as x, i
      from (select song_id, sr, samples, unnest(range(1, len(samples) + 1)) as i from v_signal))
group by song_id, sr""")


@register("list_objects", f"select {_KEY} as s3_key, cast(44 + 2 * len(samples) as bigint) as length from v_signal")
def list_objects(spark, d):
    root = wav_folder(spark, d)
    return _list(spark, root).select(relative_key("path", root).alias("s3_key"), "length")


@register("list_pages", f"select {_KEY} as s3_key, cast(44 + 2 * len(samples) as bigint) as length from v_signal")
def list_pages(spark, d):
    """SRC-01 in pages: every key once, whatever the number of rounds."""
    out = scratch_path(spark, "listed")
    list_in_pages(spark, wav_folder(spark, d), scratch_path(spark, "listing"),
                  lambda page: page.write.mode("append").parquet(out))
    return spark.read.parquet(out).select("s3_key", "length")


@register("scan_binary", f"""select {_KEY} as s3_key, cast(44 + 2 * len(samples) as bigint) as length,
'5249464657415645' as magic from v_signal""")
def scan_binary(spark, d):
    root = wav_folder(spark, d)
    b = _scan(spark, root)
    return b.select(relative_key("path", root).alias("s3_key"), "length",
                    F.concat(F.hex(F.substring("content", 1, 4)), F.hex(F.substring("content", 9, 4))).alias("magic"))


@register("wav_catalog", f"""select {_KEY} as s3_key, song_id, cast(1 as bigint) as channels,
cast(sr as bigint) as samplerate, sr * 2 * 8 / 1000.0 as bitrate,
round(2.0 * len(samples) / (sr * 2), 9) as duration, cast(44 + 2 * len(samples) as bigint) as filesize
from v_signal""")
def wav_catalog(spark, d):
    root = wav_folder(spark, d)
    numbered = I.number_files(_list(spark, root), root)
    h = file_heads(numbered)
    return h.select("s3_key", "song_id", "channels", "samplerate", "bitrate",
                    F.round("duration", 9).alias("duration"), "filesize")


@register("ingest_signals", ctes(S.TEST_PARAMS, "sig", "qsig", [_QSIG]) + """
select song_id, cast(i - 1 as bigint) as timeseries, samples[i] as intensity
from (select song_id, samples, unnest(range(1, len(samples) + 1)) as i from sig)""")
def ingest_signals(spark, d):
    """SRC-03: decoded samples as (song_id, timeseries, intensity), read by byte ranges of the files."""
    return I.ingest(spark, wav_folder(spark, d), S.TEST_PARAMS).audio


@register("per_file_extract", ctes(S.TEST_PARAMS, "db", "qsig", [_QSIG]) + """
select song_id, timeseries, band, round(db, 4) as db from db""")
def per_file_extract(spark, d):
    """UDF-01: files -> decoded signals -> dB mel spectrogram, the Python boundary being
    bytes -> samples only."""
    out = I.ingest(spark, wav_folder(spark, d), S.TEST_PARAMS)
    return S.spec_long_db(out.mel, S.TEST_PARAMS, stage=False).withColumn("db", F.round("db", 4))


@register("write_create", f"with {_ACCEPTED} select {_STRING_COLS} from accepted")
def write_create(spark, d):
    path = scratch_path(spark, "catalog-create")
    K.write_create(C.stringify_all(records(spark, d)), path)
    return spark.read.parquet(path)


@register("write_append", f"""with {_ACCEPTED}, t as (select {_STRING_COLS} from accepted)
select * from t union all select * from t""")
def write_append(spark, d):
    path = scratch_path(spark, "catalog-append")
    cat = C.stringify_all(records(spark, d))
    K.write_append(cat, path)
    K.write_append(cat, path)
    return spark.read.parquet(path)


@register("write_routed", ctes(S.TEST_PARAMS, "db", "v_signal") + f""", {_ACCEPTED}
select 'audio' as store, cast(song_id as varchar) as song_id, timeseries, cast(intensity as double) as value from v_audio
union all select 'spec', cast(song_id as varchar), timeseries, round(db, 4) from db where band = 0
union all select 'catalog', song_id, null, null from (select {_STRING_COLS} from accepted)""")
def write_routed(spark, d):
    """SNK-03: catalog and spectra to one store, samples to another; all three are read back."""
    a, b = scratch_path(spark, "store-a"), scratch_path(spark, "store-b")
    routes = {"catalog": K.Route(f"{a}/catalog"), "spec": K.Route(f"{a}/spec"),
              "audio": K.Route(f"{b}/audio")}
    spec = S.spec_wide_db(S.mel_spectrogram(v_signal(spark, d), S.TEST_PARAMS), S.TEST_PARAMS)
    K.write_routed({"catalog": C.stringify_all(records(spark, d)), "spec": spec,
                    "audio": v_audio(spark, d)}, routes)
    back = {t: K.read_table(spark, r) for t, r in routes.items()}
    song = F.col("song_id").cast("string").alias("song_id")
    audio = back["audio"].select(F.lit("audio").alias("store"), song, "timeseries", F.col("intensity").cast("double").alias("value"))
    bands = back["spec"].select(F.lit("spec"), song, "timeseries", F.round("spec1", 4))
    catalog = back["catalog"].select(F.lit("catalog"), song, F.lit(None).cast("bigint"), F.lit(None).cast("double"))
    return audio.union(bands).union(catalog)


@register("write_chunked", f"""select song_id, timeseries, intensity,
cast(floor(timeseries / {CHUNK}) as bigint) as chunk from v_audio""")
def write_chunked(spark, d):
    path = scratch_path(spark, "audio-chunked")
    K.write_chunked(v_audio(spark, d), path, CHUNK)
    back = spark.read.parquet(path)
    return back.select("song_id", "timeseries", "intensity", F.col("chunk").cast("bigint").alias("chunk"))


@register("ingest_stream", f"""select {_KEY} as s3_key, song_id, cast(1 as bigint) as channels,
cast(sr as bigint) as samplerate, cast(44 + 2 * len(samples) as bigint) as filesize from v_signal""")
def ingest_stream(spark, d):
    """STM-02: a file stream over the folder; each new file is catalogued once."""
    root = wav_folder(spark, d)
    cat = scratch_path(spark, "catalog-stream")
    _ingest_stream(spark, root, cat, scratch_path(spark, "catalog-stream-ckpt"))
    return spark.read.parquet(cat).select("s3_key", "song_id", "channels", "samplerate", "filesize")


@register("ingest_pages", f"""select {_KEY} as s3_key, song_id, cast(1 as bigint) as channels,
cast(sr as bigint) as samplerate, cast(44 + 2 * len(samples) as bigint) as filesize from v_signal""")
def ingest_pages(spark, d):
    """STM-02 from a paged listing that keeps its position."""
    cat = scratch_path(spark, "catalog-pages")
    _ingest_pages(spark, wav_folder(spark, d), cat, scratch_path(spark, "catalog-pages-place"))
    return spark.read.parquet(cat).select("s3_key", "song_id", "channels", "samplerate", "filesize")
