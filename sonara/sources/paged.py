"""Paged listings: keys below a root in key order, a page at a time from each of its folders.

A listing is a table of prefixes with the last key seen in each. A round lists one page of every unfinished prefix in
Spark's tasks, hands the keys on, and writes the table anew; that table is all a later run needs to go on.
Nothing but the number of unfinished prefixes reaches the driver.

Key order is code-point order of the whole key, as a bucket lists. Names that start with ``_`` (without ``=``) or
``.`` are skipped, as Spark's file sources do; a root that does not exist raises; an empty one lists nothing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import child_names, materialize, path_exists, remove_path
from .files import file_system

PREFIXES = "prefix string, deep boolean, after string, done boolean"
PAGE = "prefix string, path string, s3_key string, length long, modificationTime timestamp, done boolean"
BATCH = 10_000   # keys of one Arrow batch


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def children_of(root: str) -> Callable[[str], list]:
    """A function: key of a folder (``""`` or with a slash at its end) -> its (key, is folder, length, time), in key order."""
    from pyarrow import fs

    system, base = file_system(root)
    base = base.rstrip("/")

    def children(prefix: str) -> list:
        found = []
        for x in system.get_file_info(fs.FileSelector(f"{base}/{prefix}".rstrip("/") or "/")):
            if not _hidden(x.base_name):
                folder = x.type == fs.FileType.Directory
                found.append((prefix + x.base_name + "/" * folder, folder, None if folder else x.size, x.mtime))
        return sorted(found, key=lambda x: x[0])

    return children


def keys_after(children: Callable[[str], list], prefix: str, deep: bool, after: str, page_keys: int) -> Iterator[tuple]:
    """(key, length, time, None) of the keys below ``prefix`` behind ``after``, then (None, None, None, whether none is left).

    A page ends where a folder begins or ends, once it has ``page_keys`` keys, so a folder of files is listed once however
    many pages a listing takes; of what lies before ``after`` only the folders around it are opened again."""
    n, open_folders = 0, [iter(children(prefix))]
    while open_folders:
        for key, folder, length, time in open_folders[-1]:
            if not folder:
                if key > after:
                    n += 1
                    yield key, length, time, None
            elif deep and (key > after or after.startswith(key)):
                if n >= page_keys:
                    yield None, None, None, False
                    return
                open_folders.append(iter(children(key)))
                break
        else:
            open_folders.pop()
            if n >= page_keys and open_folders:
                yield None, None, None, False
                return
    yield None, None, None, True


def find_prefixes(spark: SparkSession, root: str, depth: int = 1) -> DataFrame:
    """The folders ``depth`` levels below ``root``, each to be listed whole, and those above them for their own files."""
    def split(batches):
        import pyarrow as pa

        children = children_of(root)
        for rb in batches:
            rows = []
            for prefix, deep in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                rows.append((prefix, False if deep else deep))
                rows += [(key, True) for key, folder, *_ in children(prefix) if folder] if deep else []
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.bool_())],
                                             names=["prefix", "deep"])

    found = spark.createDataFrame([("", True)], "prefix string, deep boolean").coalesce(1)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for level in range(depth):
        found = (found.repartition(tasks, "prefix") if level else found).mapInArrow(split, found.schema)
    return found.select("prefix", "deep", F.lit("").alias("after"), F.lit(False).alias("done"))


def list_page(state: DataFrame, root: str, page_keys: int) -> DataFrame:
    """The next page of every unfinished prefix, and one row per prefix without key that says whether it is done."""
    def read(batches):
        import pyarrow as pa

        children = children_of(root)
        schema = pa.schema([("prefix", pa.string()), ("path", pa.string()), ("s3_key", pa.string()), ("length", pa.int64()),
                            ("modificationTime", pa.timestamp("us", "UTC")), ("done", pa.bool_())])

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        top = root.rstrip("/")
        for rb in batches:
            for row in rb.to_pylist():
                rows = []
                for key, length, time, done in keys_after(children, row["prefix"], row["deep"], row["after"], page_keys):
                    path = None if key is None else f"{top}/{key}"
                    rows.append((row["prefix"], path, key, length, time, done))
                    if len(rows) == BATCH:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    tasks = int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    todo = state.where("NOT done").repartition(tasks, "prefix")
    return todo.mapInArrow(read, PAGE)


def _rounds(spark: SparkSession, place: str) -> list[int]:
    """Numbers of the complete tables of prefixes in ``place``, ascending."""
    names = [n for n in child_names(spark, place) if n.startswith("round=")]
    return sorted(int(n[len("round="):]) for n in names if path_exists(spark, f"{place}/{n}/_SUCCESS"))


def list_in_pages(spark: SparkSession, root: str, place: str, handle: Callable[[DataFrame], None],
                  page_keys: int = 100_000, depth: int = 1, later_keys_only: bool = False) -> int:
    """List everything below ``root`` once, giving ``handle`` a page (path, s3_key, length, modificationTime) of each prefix
    at a time; returns the number of rounds. ``place`` is a folder of its own that keeps the position.

    A run that broke off goes on behind the last round that ``handle`` finished; that round's successor may be handed
    on twice, so ``handle`` must not mind. After a whole listing the next call starts anew, finding new and old keys; with
    ``later_keys_only`` it goes on behind the last key of each prefix (for keys that only grow, such as dated ones)."""
    place = place.rstrip("/")

    def table(n: int) -> DataFrame:
        return spark.read.schema(PREFIXES).parquet(f"{place}/round={n}")

    known = _rounds(spark, place)
    at = known[-1] if known else 0
    if not known or table(at).where("NOT done").isEmpty():
        found = find_prefixes(spark, root, depth)
        if known and later_keys_only:
            seen = table(at).select("prefix", "deep", F.col("after").alias("__after"))
            found = (found.join(seen, ["prefix", "deep"], "left")
                     .withColumn("after", F.coalesce("__after", "after")).select("prefix", "deep", "after", "done"))
        at += 1
        found.write.mode("overwrite").parquet(f"{place}/round={at}")
    rounds = 0
    while not table(at).where("NOT done").isEmpty():
        page = materialize(list_page(table(at), root, page_keys), "page")
        handle(page.where("s3_key IS NOT NULL").select("path", "s3_key", "length", "modificationTime"))
        seen = page.groupBy("prefix").agg(F.max("s3_key").alias("__last"), F.bool_or("done").alias("__done"))
        moved = table(at).join(seen, "prefix", "left").select(
            "prefix", "deep", F.coalesce("__last", "after").alias("after"), F.coalesce("__done", "done").alias("done"))
        moved.write.mode("overwrite").parquet(f"{place}/round={at + 1}")
        remove_path(spark, f"{place}/round={at - 1}")
        at, rounds = at + 1, rounds + 1
    return rounds
