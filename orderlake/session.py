"""Session settings the operators are written for, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session should carry.  Shuffle width comes from the caller:
# about 2-3x the cores for local runs, and sized so a shuffle partition is
# ~128-256 MB on a cluster (AQE coalesces small ones at run time).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def sizing_conf(input_bytes: int, total_cores: int,
                target_partition_bytes: int = 256 << 20,
                max_split_bytes: int = 256 << 20,
                max_partitions: int = 100_000) -> dict[str, str]:
    """Shuffle and scan sizing for a run over ``input_bytes`` of source data.

    Shuffle width: enough partitions that each holds ~``target_partition_bytes``
    of the largest shuffle (about the input size here: the order lines are
    shuffled once, with few columns), and at least 2x the cores so every core
    has work; AQE then coalesces partitions that come out small and splits
    skewed ones.  Scan splits stay at most ``max_split_bytes`` so a task's
    input fits executor memory with room for the aggregation buffers.
    The width is capped (``max_partitions``): map-output bookkeeping grows
    with maps x reducers, so at 100 TB partitions grow to ~1 GB instead and
    spill to disk as they must.
    """
    width = max(2 * total_cores, -(-int(input_bytes) // target_partition_bytes))
    width = min(width, max(max_partitions, 2 * total_cores))
    return {
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes":
            str(4 * target_partition_bytes),
    }


def build_session(master: str | None = "local[8]", shuffle_partitions: int = 16,
                  app_name: str = "orderlake", extra: dict | None = None) -> SparkSession:
    """A session with ``BASE_CONF``.  ``master=None`` keeps the master chosen by
    the launcher (``spark-submit --master ...`` on a cluster)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files below ``paths``, from file-system metadata
    (a listing on the driver; no data is read)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


def apply_sizing(spark: SparkSession, n_bytes: int, total_cores: int | None = None) -> dict:
    """Set the runtime shuffle and scan sizing for ``n_bytes`` of input on
    ``total_cores`` (default: the session's default parallelism, i.e. all
    executor cores); returns the settings applied."""
    cores = total_cores or spark.sparkContext.defaultParallelism
    conf = sizing_conf(n_bytes, cores)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def work_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables and checkpoints.

    On a cluster this is ``spark.checkpoint.dir`` as configured for the
    cluster (a shared file system every executor can read).  Only on a local
    master without any checkpoint folder, as in tests, a fresh local folder is
    registered with ``SparkContext.setCheckpointDir``; on a cluster the missing
    setting is an error, as executors don't share local folders.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir is not set for {master}: name a folder "
                             "that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orderlake-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder below the shared work root."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
