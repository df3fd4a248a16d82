"""Session settings and the shared folder for checkpoints and written tables."""

import atexit
import shutil
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Adaptive execution coalesces small shuffle partitions and splits skewed join partitions at run time.
BATCH_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

PARTITION_BYTES = 128 * 1024 * 1024

# Keyed state with its own column families needs RocksDB. Changelogs keep a commit proportional to what changed,
# and without a running row count a write does not have to read first.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

STATE_PARTITIONS = "spark.spindlewatch.statePartitions"


def partitions_for(shuffle_bytes):
    """Shuffle partitions that leave each one about 128 MiB, which a task sorts and aggregates in memory."""
    return max(200, -(-shuffle_bytes // PARTITION_BYTES))


def build_session(app_name="spindlewatch", master=None, shuffle_bytes=None, **conf):
    """A session with this library's settings; ``conf`` keys use ``__`` for dots.

    ``shuffle_bytes`` is about how much the largest shuffle moves: for averages, the events less what the
    first reduction takes off. Stored data is then shuffled into that many more partitions, and adaptive
    execution merges those that turn out small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**BATCH_CONF, **STREAM_CONF}
    if shuffle_bytes is not None:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(partitions_for(shuffle_bytes))
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stream_conf(spark, state_partitions=None):
    """Settings to start a stateful query under.

    Every state partition is a store that each micro-batch opens and commits, so unless told otherwise, here or
    by the session's ``spark.spindlewatch.statePartitions``, there is one per core of the cluster as it is now.
    The number stays with a checkpoint: a restarted query keeps the one it began with, so a query that is to
    outgrow its cluster should be told a larger one.
    """
    if state_partitions is None:
        state_partitions = spark.conf.get(STATE_PARTITIONS, None) or spark.sparkContext.defaultParallelism
    return {**STREAM_CONF, "spark.sql.shuffle.partitions": str(state_partitions)}


@contextmanager
def session_conf(spark, conf):
    """Set ``conf`` for the duration of the block. A streaming query keeps the values it was started under."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark):
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a folder of its own beside its warehouse,
    which is removed when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    folder = f"{warehouse.rstrip('/')}/shared-{uuid.uuid4().hex}"
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_dir(spark, name):
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
