"""Object listing and binary scans over a folder of files (local, HDFS or object store)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _reader(spark: SparkSession, glob: str | None = None):
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r


def list_objects(spark: SparkSession, location: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Every key below ``location`` with its size and time. ``content`` is not selected, so
    the scan never opens the files (ReadSchema: path, modificationTime, length).

    ``location`` may be a list of prefixes (e.g. the top-level folders of a bucket): with
    more than ``spark.sql.sources.parallelPartitionDiscovery.threshold`` of them, Spark lists
    them with a distributed job instead of on the driver alone."""
    locs = [location] if isinstance(location, str) else list(location)
    return _reader(spark, glob).load(locs).select("path", "length", "modificationTime")


def literal_path(path: str) -> str:
    """``path`` as a pattern that matches only itself: the file source reads ``[ ] { } * ? \\`` as wildcards."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def scan_binary(spark: SparkSession, location: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Object bytes as rows: (path, length, modificationTime, content).

    ``location`` may be a list of files (e.g. the first n keys of a run): only those are read.
    """
    locs = [location] if isinstance(location, str) else list(location)
    return _reader(spark, glob).load(locs)


def relative_key(path_col: str, root: str) -> F.Column:
    """Key relative to ``root`` (what a bucket listing calls the object key)."""
    def strip(x):
        return x[len("file://"):] if x.startswith("file://") else x[len("file:"):] if x.startswith("file:") else x
    r = strip(root.rstrip("/")) + "/"
    p = F.regexp_replace(F.col(path_col), r"^file:(//)?", "")
    return F.when(p.startswith(r), F.substring(p, len(r) + 1, 1 << 30)).otherwise(p)
