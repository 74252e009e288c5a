"""Catalog operators: key filters, numbering, the 20-field record, text forms.

The catalog holds one row per file (it is the smallest of the three tables); still,
numbering uses the skew-safe ordinal instead of an unpartitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import CATALOG_FIELDS, KNOWN_EXTENSIONS, MISSING_TEXT
from .ordinal import ordinal_within


def filter_known_ext(df: DataFrame, key: str = "s3_key",
                     extensions: Sequence[str] = tuple(KNOWN_EXTENSIONS)) -> DataFrame:
    """Keep keys that contain one of the extensions anywhere (substring, case-sensitive;
    not a suffix test, so 'x.mp3.bak' is kept)."""
    cond = reduce(lambda a, b: a | b, [F.col(key).contains(e) for e in extensions])
    return df.where(cond)


def key_extension(df: DataFrame, key: str = "s3_key", name: str = "ext") -> DataFrame:
    """Last four characters of the key."""
    return df.withColumn(name, F.right(F.col(key), F.lit(4)))


def assign_song_id(df: DataFrame, order: Sequence[str] = ("s3_key",), name: str = "song_id",
                   start: int = 1) -> DataFrame:
    """1-based running number in key order; deterministic under retries (ordered by key,
    never by arrival)."""
    return ordinal_within(df, [], list(order), name=name, base=start)


def first_files(df: DataFrame, n: int, key: str = "s3_key", name: str = "song_id") -> DataFrame:
    """The first n rows in key order, numbered 1..n. A top-k: every task ships at most n rows,
    so only these n meet in the numbering window."""
    top = df.orderBy(key).limit(n)
    return top.withColumn(name, F.row_number().over(Window.orderBy(key)).cast("bigint"))


def limit_files(numbered: DataFrame, n: int, id_col: str = "song_id") -> DataFrame:
    """First n accepted files of a numbered table: a filter on the assigned number (not a bare ``limit``)."""
    return numbered.where(F.col(id_col) <= F.lit(n))


def catalog_record(df: DataFrame) -> DataFrame:
    """The 20 catalog fields in their fixed order; fields the input lacks are NULL text."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c)
                       for c in CATALOG_FIELDS])


def stringify_all(df: DataFrame, missing: str = MISSING_TEXT) -> DataFrame:
    """Every field to text; a missing value becomes the text 'None'."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(c) for c in df.columns])


def none_to_null(df: DataFrame, missing: str = MISSING_TEXT) -> DataFrame:
    """Inverse view: the text 'None' back to NULL."""
    return df.select(*[F.nullif(F.col(c), F.lit(missing)).alias(c) for c in df.columns])


def catalog_cells(df: DataFrame, key: str = "s3_key") -> DataFrame:
    """(key, field, value): one row per cell of the stringified catalog."""
    text = stringify_all(df)
    return text.select(F.col(key).alias("row_key"), *text.columns).unpivot(
        "row_key", text.columns, "field", "value")


def rows_as_records(df: DataFrame, key: str = "s3_key") -> DataFrame:
    """Each row as one JSON record keyed by column name."""
    return df.select(F.col(key).alias("row_key"), F.to_json(F.struct(*df.columns)).alias("record"))


def schema_probe(df: DataFrame) -> DataFrame:
    """No rows, every column (Catalyst folds it to an empty relation)."""
    return df.where(F.lit(False))


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def append_new_files(stored: DataFrame, listing: DataFrame, key: str = "s3_key",
                     id_col: str = "song_id") -> DataFrame:
    """Rows of ``listing`` whose key is not stored yet, numbered after the stored maximum.

    Anti join on the key; the maximum is a scalar subquery (one value, no join)."""
    new = listing.join(stored.select(key), key, "left_anti")
    top = stored.select(F.coalesce(F.max(F.col(id_col).cast("bigint")), F.lit(0)).alias("m")).scalar()
    numbered = ordinal_within(new, [], [key], name="__n", base=1)
    return numbered.withColumn(id_col, (top + F.col("__n")).cast("bigint")).drop("__n")
