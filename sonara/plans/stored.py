"""Stored tables: what the ingest writes once and the lookup pages read many times.

The samples table and the spectrogram table are built from the driver's tables once per
session and version of the data folder, written to the shared scratch folder clustered by song (range
partitioned on (song_id, timeseries), sorted within files), and read back with Parquet
pushdown. Queries that model reads of the stored tables (a song's series, segments, the
newest samples, display matrices, the catalog join) use these; queries that model the
computation itself (ordinals, framing, FFT, mel, dB) compute from the source tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import catalog as C
from ..operators import spectral as S
from ..session import folder_version, scratch_path
from ..sinks.tables import write_chunked, write_clustered
from .views import v_audio, v_catalog, v_signal

_PATHS: dict[tuple[str, str, str, str], str] = {}


def stored(spark: SparkSession, d: str, name: str, build: Callable[[SparkSession, str], DataFrame],
           key: str = "song_id", order: tuple[str, ...] = ("timeseries",)) -> DataFrame:
    k = (spark.sparkContext.applicationId, d, name, folder_version(spark, d))
    if k not in _PATHS:
        path = scratch_path(spark, f"table-{name}")
        write_clustered(build(spark, d), path, key=key, order=order)
        _PATHS[k] = path
    return spark.read.parquet(_PATHS[k])


def catalog_table(spark: SparkSession, d: str) -> DataFrame:
    """The stored catalog: 20 text fields ('None' for missing), accepted keys numbered in key
    order, clustered by key."""
    def build(s, dd):
        return C.stringify_all(C.catalog_record(C.assign_song_id(C.filter_known_ext(v_catalog(s, dd)))))
    return stored(spark, d, "catalog", build, key="s3_key", order=())


def audio_table(spark: SparkSession, d: str) -> DataFrame:
    """(song_id, timeseries, intensity), clustered by song."""
    return stored(spark, d, "audio", v_audio)


def chunked_audio(spark: SparkSession, d: str, chunk_size: int) -> str:
    """Path of the samples laid out by ordinal chunk, with the rows per song and chunk beside it."""
    k = (spark.sparkContext.applicationId, d, f"chunked-{chunk_size}", folder_version(spark, d))
    if k not in _PATHS:
        path = scratch_path(spark, "table-chunked")
        write_chunked(v_audio(spark, d), path, chunk_size)
        _PATHS[k] = path
    return _PATHS[k]


def spec_table(spark: SparkSession, d: str, p: S.MelParams = S.TEST_PARAMS) -> DataFrame:
    """(song_id, timeseries, spec1..specM) in dB, clustered by song."""
    name = f"spec-{p.n_fft}-{p.hop}-{p.n_mels}-{p.fmax}"
    return stored(spark, d, name, lambda s, dd: S.spec_wide_db(S.mel_spectrogram(v_signal(s, dd), p), p))
