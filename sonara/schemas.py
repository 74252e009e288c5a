"""Table schemas carried forward (catalog, samples, spectrogram) and name generators."""

from __future__ import annotations

from pyspark.sql import types as T

# The 20 catalog fields, in the order the catalog stores them.
CATALOG_FIELDS = [
    "s3_key", "song_id", "album", "albumartist", "artist", "audio_offset", "bitrate",
    "channels", "comment", "composer", "disc", "disc_total", "duration", "filesize",
    "genre", "samplerate", "title", "track", "track_total", "year",
]

# Object keys holding one of these substrings are accepted as audio.
KNOWN_EXTENSIONS = [".mp3", ".wav", ".m4a"]

# Fixed value: text written for a missing catalog field.
MISSING_TEXT = "None"

CATALOG = T.StructType([T.StructField(c, T.StringType(), True) for c in CATALOG_FIELDS])

AUDIO = T.StructType([
    T.StructField("song_id", T.LongType(), False),
    T.StructField("timeseries", T.LongType(), False),
    T.StructField("intensity", T.FloatType(), True),
])

SIGNALS = T.StructType([
    T.StructField("song_id", T.LongType(), False),
    T.StructField("sr", T.IntegerType(), False),
    T.StructField("samples", T.ArrayType(T.FloatType(), False), False),
])

BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


def band_names(n_mels: int) -> list[str]:
    """spec1 .. specM: 1-based generated names of the wide spectrogram columns."""
    return [f"spec{i + 1}" for i in range(n_mels)]


def spec_wide_schema(n_mels: int) -> T.StructType:
    return T.StructType(
        [T.StructField("song_id", T.LongType(), False), T.StructField("timeseries", T.LongType(), False)]
        + [T.StructField(n, T.DoubleType(), True) for n in band_names(n_mels)]
    )
