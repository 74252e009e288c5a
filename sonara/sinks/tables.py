"""Sinks: create, append, routed targets, chunked series layout, incremental catalog.

Each table is written with one ``df.write`` per run and an explicit mode. A route may name
any DataFrameWriter format (parquet, jdbc with the caller's options, ...).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.catalog import append_new_files
from ..operators.series import latest_samples
from ..session import materialize, path_exists


@dataclass(frozen=True)
class Route:
    path: str | None = None            # file-based targets
    format: str = "parquet"
    mode: str = "errorifexists"
    options: dict = field(default_factory=dict)   # e.g. jdbc url/dbtable/user/password


def write_table(df: DataFrame, route: Route, partition_by: list[str] | None = None) -> None:
    w = df.write.format(route.format).mode(route.mode).options(**route.options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if route.path is not None:
        w.save(route.path)
    else:
        w.save()


def read_table(spark: SparkSession, route: Route) -> DataFrame:
    r = spark.read.format(route.format).options(**route.options)
    return r.load(route.path) if route.path is not None else r.load()


def write_create(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """Create the table; fail when it exists (the writer's default mode)."""
    write_table(df, Route(path, fmt, "errorifexists", options))


def write_append(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """Bag union with what is stored."""
    write_table(df, Route(path, fmt, "append", options))


def write_routed(tables: dict[str, DataFrame], routes: dict[str, Route]) -> None:
    """Each table to its own target (e.g. catalog and spec to one store, samples to another)."""
    missing = set(tables) - set(routes)
    if missing:
        raise KeyError(f"no route for {sorted(missing)}")
    for name, df in tables.items():
        write_table(df, routes[name])


def chunked_layout(audio: DataFrame, chunk_size: int, num_partitions: int | None = None) -> DataFrame:
    """The series laid out by ordinal range: ``chunk = timeseries div chunk_size``.

    Range-partitioned on (chunk, song_id) so the low chunks, which every song fills, are
    split over many tasks; within a task rows are clustered by (song_id, timeseries DESC),
    the access path of newest-first reads, and Parquet min/max stats prune on song_id."""
    spark = audio.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with_chunk = audio.withColumn("chunk", F.floor(F.col("timeseries") / F.lit(chunk_size)).cast("bigint"))
    return (with_chunk.repartitionByRange(n, "chunk", "song_id")
            .sortWithinPartitions("chunk", "song_id", F.col("timeseries").desc()))


def write_chunked(audio: DataFrame, path: str, chunk_size: int, num_partitions: int | None = None) -> None:
    """Replace the table; one folder per ordinal chunk. Beside it (``<path>-counts``) goes the table
    of rows per song and chunk that newest-first reads start from."""
    laid = chunked_layout(audio, chunk_size, num_partitions)
    laid.write.mode("overwrite").partitionBy("chunk").parquet(path)
    stored = audio.sparkSession.read.schema(laid.schema).parquet(path)   # an empty table has no file to ask
    counts = stored.groupBy("song_id", "chunk").agg(F.count(F.lit(1)).alias("n"))
    counts.write.mode("overwrite").parquet(f"{path}-counts")


def newest_chunks(counts: DataFrame, k: int) -> DataFrame:
    """(song_id, chunk): the chunks that hold the k newest samples of each song.

    Every counted chunk holds a sample, so a song's k newest chunks suffice (group limit: at most
    k rows per song and task are shuffled); of these, the ones before which fewer than k samples lie."""
    newest = Window.partitionBy("song_id").orderBy(F.col("chunk").desc())
    before = F.sum("n").over(newest.rowsBetween(Window.unboundedPreceding, -1))
    top = counts.withColumn("__rn", F.row_number().over(newest)).where(F.col("__rn") <= k)
    return (top.withColumn("__before", F.coalesce(before, F.lit(0))).where(F.col("__before") < k)
            .select("song_id", "chunk"))


def read_latest(spark: SparkSession, path: str, k: int, song_id: int | None = None) -> DataFrame:
    """The k newest samples of every song (or of one) from a chunked table, newest first.

    Only folders that hold such samples are scanned: their numbers, at most one per folder, go
    into the partition filter. ``song_id`` is pushed to the row groups. Within the folders a semi
    join keeps each song's own chunks. Gaps in the ordinals and missing song ids are allowed; an
    empty table gives no rows of (song_id, timeseries, intensity)."""
    counts = spark.read.parquet(f"{path}-counts")
    if counts.isEmpty():
        return counts.select("song_id", F.lit(0).cast("bigint").alias("timeseries"), F.lit(0).cast("float").alias("intensity"))
    audio = spark.read.parquet(path)
    if song_id is not None:
        one = F.col("song_id") == F.lit(song_id).cast("bigint")
        counts, audio = counts.where(one), audio.where(one)
    need = materialize(newest_chunks(counts, k), "newest")
    chunks = [r.chunk for r in need.select("chunk").distinct().collect()]
    named = F.col("chunk").isin(sorted(c for c in chunks if c is not None))
    audio = audio.where(named | F.col("chunk").isNull() if None in chunks else named)
    need = need.select(F.col("song_id").alias("__song"), F.col("chunk").alias("__chunk"))
    own = audio.join(need, F.col("song_id").eqNullSafe(F.col("__song"))
                     & F.col("chunk").eqNullSafe(F.col("__chunk")), "left_semi")
    return latest_samples(own.drop("chunk"), k)


def append_catalog(spark: SparkSession, path: str, listing: DataFrame, key: str = "s3_key",
                   id_col: str = "song_id") -> DataFrame:
    """Append only keys not stored yet, numbered after the stored maximum. Returns the rows
    appended. Running it twice with the same listing appends nothing the second time."""
    if path_exists(spark, path):
        stored = spark.read.parquet(path)
    else:  # first run; any read error of an existing table is raised
        stored = spark.createDataFrame([], f"{key} string, {id_col} bigint")
    fresh = append_new_files(stored.select(key, F.col(id_col).cast("bigint").alias(id_col)), listing, key, id_col)
    fresh = fresh.select(*[c for c in listing.columns if c != id_col], id_col)
    # the new rows depend on the stored table itself: stage them before appending to it
    staged = materialize(fresh, "catalog-append")
    staged.write.mode("append").parquet(path)
    return staged


def write_clustered(df: DataFrame, path: str, key: str = "song_id", order: tuple[str, ...] = ("timeseries",),
                    num_partitions: int | None = None, mode: str = "overwrite") -> None:
    """Store a table for point lookups by ``key``: range-partitioned on (key, order) and
    sorted within files, so a lookup's pushed filter skips every row group of other keys
    (and a hot key spreads over several files instead of one)."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, key, *order).sortWithinPartitions(key, *order)
     .write.mode(mode).parquet(path))
