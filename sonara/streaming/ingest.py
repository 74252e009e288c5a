"""Incremental ingest over a file stream: every new object is handled once.

``readStream.format("binaryFile")`` lists the folder on each trigger and hands only files
it has not seen (tracked in the checkpoint) to ``foreachBatch``; each micro-batch numbers
its accepted keys after the stored maximum and appends them to the catalog table. A file is known by
its path; its header is read by seeking, its data never.

``ingest_pages`` does the same without listing the folder on every trigger: it goes through the keys in pages
and keeps its position in a folder of its own (``sources/paged``).

``foreachBatch`` is at-least-once: a batch replayed after a failure finds its keys already
stored and appends nothing (the anti join makes the append idempotent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import catalog as C
from ..schemas import BINARY_FILE
from ..session import path_exists
from ..sinks.tables import append_catalog
from ..sources.objects import relative_key
from ..sources.paged import list_in_pages
from ..sources.wav import TAG_FIELDS, file_heads


def ingest_stream(spark: SparkSession, root: str, catalog_path: str, checkpoint: str,
                  max_files_per_trigger: int = 10000) -> None:
    """Run until every available file is processed (``availableNow``), then return.

    ``max_files_per_trigger`` bounds each micro-batch."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE)
              .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files_per_trigger))
    files = reader.load(root)

    def handle(batch: DataFrame, batch_id: int) -> None:
        keyed = file_heads(batch.select("path")).select(
            relative_key("path", root).alias("s3_key"), "channels", "samplerate", "bitrate",
            "duration", "filesize", *TAG_FIELDS)
        accepted = C.filter_known_ext(keyed)
        append_catalog(spark, catalog_path, accepted)

    q = (files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def ingest_pages(spark: SparkSession, root: str, catalog_path: str, place: str, page_keys: int = 100_000,
                 depth: int = 1, later_keys_only: bool = False) -> int:
    """Catalogue every key below ``root`` that the catalog lacks, a page of each prefix at a time; returns the rounds.

    Only heads of accepted keys that are new are read. Broken-off runs, repeated pages and second runs add no key twice; ids go on
    after the stored maximum, page by page."""
    def handle(page: DataFrame) -> None:
        fresh = C.filter_known_ext(page.select("path", "s3_key"))
        if path_exists(spark, catalog_path):
            fresh = fresh.join(spark.read.parquet(catalog_path).select("s3_key"), "s3_key", "left_anti")
        append_catalog(spark, catalog_path, file_heads(fresh.select("path", "s3_key")).select(
            "s3_key", "channels", "samplerate", "bitrate", "duration", "filesize", *TAG_FIELDS))

    return list_in_pages(spark, root, place, handle, page_keys, depth, later_keys_only)


def stored_catalog(spark: SparkSession, catalog_path: str) -> DataFrame:
    """The stored catalog as the 20 text fields."""
    return C.stringify_all(C.catalog_record(spark.read.parquet(catalog_path)))
