"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package assumes. Adaptive execution re-plans
# joins and coalesces partitions from runtime sizes and splits skewed join
# partitions; the session zone is pinned so timestamp casts are reproducible.
# Streaming state (open windows, keys inside the watermark) is kept in
# RocksDB on the executors' disks rather than on the JVM heap, so a large
# state spills instead of failing; it is checkpointed to the shared folder.
DEFAULT_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "tablewise",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  driver_memory: str = "16g",
                  shuffle_bytes: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster leave ``master`` unset and let spark-submit decide; the
    shuffle partition count then stays whatever the cluster configured. In
    local mode the driver JVM runs every task, so it gets ``driver_memory``.

    ``shuffle_bytes`` -- the expected size of the largest shuffle, after
    column pruning and map-side aggregation (not the raw input) -- sizes
    the shuffles: adaptive execution only merges partitions, never splits
    them (skewed joins aside), so it has to start from enough partitions
    and coalesces them to the advisory size.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if shuffle_bytes:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                                 str(initial_partitions(shuffle_bytes)))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def initial_partitions(shuffle_bytes: int, partition_bytes: int = 256 << 20) -> int:
    """Shuffle partitions to start from: one per ``partition_bytes`` of the
    largest shuffle, at least 200 (a 20 TB shuffle -> about 75,000)."""
    return max(200, -(-shuffle_bytes // partition_bytes))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints and state.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Where neither is set, a local run gets a private folder;
    on a cluster that is an error, as executors could not reach it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # Already registered. Registering again would make Spark create yet
        # another sub-folder inside the current one on every call.
        return current
    found = _shared_folder(spark)
    sc.setCheckpointDir(found)
    return sc.getCheckpointDir() or found


def _shared_folder(spark: SparkSession) -> str:
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not found:
        # local-cluster runs executors of their own, like any other cluster.
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        found = tempfile.mkdtemp(prefix="tablewise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def stream_home(spark: SparkSession, name: str) -> str:
    """The folder for a stream's sink and checkpoint: the same for the same
    ``name`` in every application that shares the folder, so that a restarted
    stream goes on where it stopped. (The context's checkpoint folder is a
    new one per application.)"""
    return f"{_shared_folder(spark).rstrip('/')}/streams/{name}"
