"""Catalog queries on ``v_catalog`` (SRC-05/06, PRJ-01..04, PRJ-09, SEQ-01, SEQ-04,
AGG-04, SNK-05, SNK-06, JON-02)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as C
from ..operators import spectral as S
from ..schemas import CATALOG_FIELDS, band_names
from .registry import register
from .spectral_sql import ctes
from .stored import catalog_table, spec_table
from .views import v_catalog

FILE_LIMIT = 100  # files per ingest run

_ACCEPT = ("contains(s3_key, '.mp3') or contains(s3_key, '.wav') or contains(s3_key, '.m4a')")
_ACCEPTED = f"""accepted as (select *, row_number() over (order by s3_key) as song_id
from v_catalog where {_ACCEPT})"""

_PRESENT = {"s3_key", "song_id", "album", "artist", "genre", "title", "filesize", "samplerate"}
_RECORD_COLS = ", ".join(c if c in _PRESENT else f"cast(null as varchar) as {c}" for c in CATALOG_FIELDS)
_STRING_COLS = ", ".join(
    (f"coalesce(cast({c} as varchar), 'None') as {c}" if c in _PRESENT else f"'None' as {c}")
    for c in CATALOG_FIELDS)


def accepted(spark, d):
    return C.assign_song_id(C.filter_known_ext(v_catalog(spark, d)))


def records(spark, d):
    return C.catalog_record(accepted(spark, d))


@register("scan_catalog", "select * from v_catalog")
def scan_catalog(spark, d):
    return v_catalog(spark, d)


@register("schema_probe", "select * from v_catalog where false")
def schema_probe(spark, d):
    return C.schema_probe(v_catalog(spark, d))


@register("filter_known_ext", f"select * from v_catalog where {_ACCEPT}")
def filter_known_ext(spark, d):
    return C.filter_known_ext(v_catalog(spark, d))


@register("key_extension", "select s3_key, right(s3_key, 4) as ext from v_catalog")
def key_extension(spark, d):
    return C.key_extension(v_catalog(spark, d).select("s3_key"))


@register("assign_song_id", f"with {_ACCEPTED} select s3_key, song_id from accepted")
def assign_song_id(spark, d):
    return accepted(spark, d).select("s3_key", "song_id")


@register("limit_files", f"with {_ACCEPTED} select s3_key, song_id from accepted where song_id <= {FILE_LIMIT}")
def limit_files(spark, d):
    return C.first_files(C.filter_known_ext(v_catalog(spark, d)).select("s3_key"), FILE_LIMIT)


@register("catalog_record", f"with {_ACCEPTED} select {_RECORD_COLS} from accepted")
def catalog_record(spark, d):
    return records(spark, d)


@register("stringify_all", f"with {_ACCEPTED} select {_STRING_COLS} from accepted")
def stringify_all(spark, d):
    return C.stringify_all(records(spark, d))


@register("catalog_cells", f"""with {_ACCEPTED}, t as (select {_STRING_COLS} from accepted)
select row_key, field, value from (select s3_key as row_key, * from t)
unpivot (value for field in ({', '.join(CATALOG_FIELDS)}))""")
def catalog_cells(spark, d):
    """PRJ-09: the tooltip cells of the stored catalog."""
    return C.catalog_cells(catalog_table(spark, d))


_JSON_FIELDS = ", ".join(f"'{c}', {c}" for c in CATALOG_FIELDS)


@register("rows_as_records", f"""with {_ACCEPTED}, t as (select {_STRING_COLS} from accepted)
select s3_key as row_key, cast(json_object({_JSON_FIELDS}) as varchar) as record from t""")
def rows_as_records(spark, d):
    """SNK-06: the stored catalog as one JSON record per row."""
    return C.rows_as_records(catalog_table(spark, d))


@register("distinct_catalog", "select distinct album, artist, genre from v_catalog")
def distinct_catalog(spark, d):
    return C.distinct_rows(v_catalog(spark, d), ["album", "artist", "genre"])


@register("append_new_files", f"""with {_ACCEPTED},
stored as (select s3_key, row_number() over (order by s3_key) as song_id from accepted where artist = 'en'),
fresh as (select a.s3_key from accepted a where not exists (select 1 from stored s where s.s3_key = a.s3_key))
select s3_key, row_number() over (order by s3_key) + (select coalesce(max(song_id), 0) from stored) as song_id
from fresh""")
def append_new_files(spark, d):
    """SNK-05: a previous run stored the English keys; the new listing has all keys."""
    known = C.filter_known_ext(v_catalog(spark, d))
    listing = known.select("s3_key")
    stored = C.assign_song_id(known.where(F.col("artist") == "en").select("s3_key"))
    return C.append_new_files(stored, listing).select("s3_key", "song_id")


@register("catalog_spec_join", f"""{ctes(S.TEST_PARAMS, 'db')},
{_ACCEPTED}, t as (select {_STRING_COLS} from accepted)
select db.song_id, t.s3_key, t.title, db.timeseries, db.band, round(db.db, 4) as db
from db join t on db.song_id = cast(t.song_id as bigint)""")
def catalog_spec_join(spark, d):
    """JON-02: a song's catalog row with its spectrogram; the text id is cast once.

    Joined on the wide table (one row per frame), then unpivoted: the exchange carries
    M-times fewer rows than joining the long form. The catalog grows with the number of
    files, so AQE decides broadcast from its measured size (skew-split merge join beyond)."""
    wide = spec_table(spark, d)
    cat = catalog_table(spark, d).select(F.col("song_id").cast("bigint").alias("cat_id"), "s3_key", "title")
    j = wide.join(cat, wide.song_id == cat.cat_id).drop("cat_id")
    long = S.wide_to_long(j.select("song_id", "timeseries", *band_names(S.TEST_PARAMS.n_mels),
                                   F.struct("s3_key", "title").alias("__c")), S.TEST_PARAMS.n_mels, keep=["__c"])
    return long.select("song_id", "__c.s3_key", "__c.title", "timeseries", "band", F.round("db", 4).alias("db"))


@register("assign_song_id_all_keys", """select s3_key, row_number() over (order by s3_key) as song_id
from v_catalog""")
def assign_song_id_all_keys(spark, d):
    """SEQ-01 variant without the extension filter: every listed key is numbered."""
    return C.assign_song_id(v_catalog(spark, d).select("s3_key")).select("s3_key", "song_id")
