"""The ingest job: a folder of audio objects -> catalog, signals, samples, spectrogram.

  list keys (content pruned) -> keep known extensions -> number by key (skew-safe)
  -> [first n only] -> heads by seeking in each file -> byte ranges of the files, decoded
  by as many tasks as the bytes ask for -> staged once -> catalog / audio / spec.

Every table is written once per run (not once per file), and the ids are a function of the
key order, so a retried task or a re-run produces the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import add_empty_file, child_names, materialize, path_exists
from ..sources.objects import list_objects, relative_key
from ..sources.wav import TAG_FIELDS, decode_ranges, decode_wav, file_heads, header_fields, is_wav
from . import catalog as C
from . import spectral as S


TABLES = ("catalog", "audio", "spec")


@dataclass
class Ingested:
    catalog: DataFrame     # 20 text fields, 'None' for missing
    pieces: DataFrame      # (song_id, sr, n_samples, k, ext_start, ext): haloed pieces of piece_len(params)
    audio: DataFrame       # (song_id, timeseries, intensity)
    spec: DataFrame        # (song_id, timeseries, db array)
    piece_length: int = 0
    mel: DataFrame | None = None   # staged (song_id, timeseries, mel array): wide/long dB from here


def number_files(listing: DataFrame, root: str, known_only: bool = True) -> DataFrame:
    """(path, s3_key, song_id): accepted keys numbered 1.. in key order."""
    keyed = listing.select("path", relative_key("path", root).alias("s3_key"))
    if known_only:
        keyed = C.filter_known_ext(keyed)
    return C.assign_song_id(keyed)


def selected_files(numbered: DataFrame, limit: int | None, first_id: int = 1) -> DataFrame:
    """(path, s3_key, song_id) of the files to open, staged; with a limit ``first_id .. first_id + limit - 1``."""
    ids = numbered.select("path", "s3_key", "song_id")
    if limit is not None:
        ids = ids.where((F.col("song_id") >= first_id) & (F.col("song_id") < first_id + limit))
    return materialize(ids, "ids")


def catalog_from_headers(headers: DataFrame) -> DataFrame:
    """The 20-field catalog (all text) from header fields; what a file does not state is 'None'."""
    rec = C.catalog_record(headers.select(
        "s3_key", "song_id", "channels", "samplerate", "bitrate", "duration", "filesize", *TAG_FIELDS))
    return C.stringify_all(rec)


def ingest(spark: SparkSession, root: str, params: S.MelParams = S.JOB_PARAMS,
           limit: int | None = None, known_only: bool = True, first_id: int = 1,
           numbered: DataFrame | None = None, objects: DataFrame | None = None) -> Ingested:
    """``root`` is a folder of objects, or with ``objects`` the key prefix of an objects
    table (path, length, content), e.g. a Parquet table of packed small files."""
    if numbered is None:
        listing = objects.select("path", "length") if objects is not None else list_objects(spark, root)
        numbered = number_files(listing, root, known_only)
    ids = selected_files(numbered, limit, first_id)
    # the decoder cuts each signal into pieces of piece_len(params) samples: bounded rows
    # however long a recording is, and exactly the pieces the spectral operators expect
    P, halo = S.piece_len(params), params.n_fft // 2
    if objects is None:  # files: heads by seeking, samples by byte ranges
        heads = materialize(file_heads(ids), "heads")
        catalog = catalog_from_headers(heads)
        pieces = materialize(decode_ranges(heads, P, halo, keep=["song_id"]), "ingest")
    else:  # small objects in a table: one scan of the bytes for the heads and the decoder
        head = ["song_id", "s3_key", "channels", "samplerate", "bitrate", "duration", "filesize", *TAG_FIELDS]
        # only WAV bytes travel to the Python decoder; other objects keep their header row
        with_head = header_fields(objects.join(ids, "path"), keep_content=True)
        with_head = with_head.withColumn("content", F.when(is_wav(F.col("content")), F.col("content")))
        staged = materialize(decode_wav(with_head, keep=head, all_rows=True, piece=P, halo=halo), "ingest")
        catalog = catalog_from_headers(staged.where(F.col("k") == 0))
        pieces = staged.where(F.col("ext").isNotNull()).select("song_id", "sr", "n_samples", "k", "ext_start", "ext")
    audio = S.owned_samples(pieces, P)
    # the staged pieces are read back in row-group splits, which already spreads a long
    # recording over many tasks: no balancing shuffle, no sample moves between decode and FFT
    mel = materialize(S.mel_spectrogram(pieces, replace(params, balance=False)), "mel")
    spec = S.power_to_db(mel, params, stage=False)
    return Ingested(catalog, pieces, audio, spec, P, mel)


def table_paths(out: str | Mapping[str, str]) -> dict[str, str]:
    """Places of ``catalog``, ``audio``, ``spec`` and of the log ``commits``: below one folder, or as
    given. Without a place of its own the log lies beside the catalog."""
    if isinstance(out, str):
        out = {t: f"{out}/{t}" for t in TABLES}
    return {"commits": f"{out['catalog'].rstrip('/')}-commits", **out}


def committed_batches(spark: SparkSession, out: str | Mapping[str, str]) -> list[int]:
    """First ids of the batches whose three tables are complete, ascending."""
    names = child_names(spark, table_paths(out)["commits"])
    return sorted(int(n.removeprefix("first_id=")) for n in names if n.startswith("first_id="))


def read_ingested(spark: SparkSession, out: str | Mapping[str, str], table: str) -> DataFrame | None:
    """A table of ``ingest_batches`` as of its last complete batch; None before the first.

    All three tables show the same batches: a batch appears in each of them by the one file that
    its run adds to the log after the last write."""
    path = table_paths(out)[table].rstrip("/")
    batches = committed_batches(spark, out)
    if not batches:
        return None
    return spark.read.option("basePath", path).parquet(*[f"{path}/first_id={b}" for b in batches])


def _adopt(spark: SparkSession, paths: dict[str, str]) -> None:
    """Tables written before there was a log: a batch was complete once its catalog folder was."""
    if not path_exists(spark, paths["commits"]):
        for name in child_names(spark, paths["catalog"]):
            if name.startswith("first_id=") and path_exists(spark, f"{paths['catalog']}/{name}/_SUCCESS"):
                add_empty_file(spark, f"{paths['commits']}/{name}")


def ingest_batches(spark: SparkSession, root: str, out: str | Mapping[str, str], batch_files: int,
                   params: S.MelParams = S.JOB_PARAMS, known_only: bool = True) -> int:
    """All files that the stored catalog lacks, in id ranges of ``batch_files`` files. ``out`` is one
    folder for the tables, or the paths of ``catalog``, ``audio`` and ``spec`` (and ``commits``).

    Keys already catalogued are left alone and new ids go on after the stored maximum, so a second
    run adds nothing. Each batch writes folders named by its first id, then adds one file to the log:
    ``read_ingested`` shows a batch in all three tables or in none. A run that broke off is repeated
    from its unfinished batch, over the same folders. One run at a time. Returns the number of batches."""
    paths = table_paths(out)
    keyed = list_objects(spark, root).select("path", relative_key("path", root).alias("s3_key"))
    if known_only:
        keyed = C.filter_known_ext(keyed)
    last = 0
    _adopt(spark, paths)
    done = read_ingested(spark, paths, "catalog")
    if done is not None:
        last = int(done.agg(F.max(F.col("song_id").cast("bigint"))).first()[0] or 0)
        keyed = keyed.join(done.select("s3_key"), "s3_key", "left_anti")
    fresh = C.assign_song_id(keyed).withColumn("song_id", (F.col("song_id") + last).cast("bigint"))
    numbered = materialize(fresh, "listing")
    n = numbered.count()
    batches = 0
    for first in range(last + 1, last + n + 1, batch_files):
        b = ingest(spark, root, params, limit=batch_files, first_id=first, numbered=numbered)
        spec = S.spec_wide_db(b.mel, params, stage=False)
        for table, rows in (("audio", b.audio), ("spec", spec), ("catalog", b.catalog)):
            rows.write.mode("overwrite").parquet(f"{paths[table]}/first_id={first}")
        add_empty_file(spark, f"{paths['commits']}/first_id={first}")
        batches += 1
    return batches
