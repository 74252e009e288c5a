"""Session helpers: building a session for tests/bench, the shared scratch folder, and
materialising an intermediate result as a written table (lineage cut that survives
executor loss)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(master: str | None = None, app: str = "sonara",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Session for local runs (tests, bench). On a cluster the caller's session is used as is."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when nothing is configured (local tests) a fresh temp
    folder is set. An already active checkpoint folder is used as is.
    """
    sc = spark.sparkContext
    active = sc.getCheckpointDir()
    if active:
        return active
    path = spark.conf.get(CHECKPOINT_KEY, None) or sc.getConf().get(CHECKPOINT_KEY, None)
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="sonara-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its file system; any other trouble (access, network) is raised."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in ``path``, ascending; none where it does not exist."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []


def add_empty_file(spark: SparkSession, path: str) -> None:
    """Create an empty file at ``path`` (and the folders above it); one that is there stays as it is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True).close()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def folder_version(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of what lies in ``path``: differs when its tables were written anew."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return ";".join(sorted(f"{x.getPath().getName()},{x.getLen()},{x.getModificationTime()}" for x in fs.listStatus(at)))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared scratch folder."""
    root = scratch_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where one expensive intermediate feeds two branches (e.g. the song-wide dB peak
    and the per-frame values): it is computed once, and a lost executor only costs a re-read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized for a data volume and a cluster (pass to the builder/submit).

    * shuffle partitions: enough that each holds about ``target_partition_bytes`` of the
      input volume (and at least 3 waves of tasks); AQE coalesces what turns out smaller and
      splits skewed join partitions.
    * file splits: ``target_partition_bytes`` per scan task.
    * Arrow batches into Python workers: 64 MB at most (the FFT kernel sub-batches below it).
    * Parquet min/max aggregates answered from footers (catalog maximum id).
    * RocksDB state store for streaming state.
    """
    parts = max(3 * total_cores, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
        "spark.sql.parquet.aggregatePushdown": "true",
        # streaming state in RocksDB, not the heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.enabled": "false",
    }
