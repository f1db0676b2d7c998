"""Session settings the engine relies on."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings whose value changes results; everything about sizing is left to the cluster.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    # An object that repeats a key still parses; without this it would be lost whole.
    "spark.sql.variant.allowDuplicateKeys": "true",
}
# Plan settings for skew and small partitions, on by default in Spark and pinned here, and the
# method size from which generated code is split, at the JIT compiler's own limit: wide JSON
# projections would otherwise run uncompiled.
PLANNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# State of streams lies in RocksDB, in a share of memory of fixed size and on local disk, and a batch writes what it
# changed: in memory the rows and spans of all open keys would have to fit the executors' heaps, some versions of them.
_STATE = "spark.sql.streaming.stateStore"
STREAMING = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STATE}.rocksdb.trackTotalNumberOfRows": "false",
}


def configure(spark):
    """Apply the settings to a running session and return it."""
    for key, value in {**REQUIRED, **PLANNING, **STREAMING}.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus="*", shuffle_partitions=8, app_name="telemere"):
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
    for key, value in {**REQUIRED, **PLANNING, **STREAMING}.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


_local_root = {}


def shared_dir(spark, purpose):
    """A fresh path below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary
    folder, which on a cluster the executors would not see.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_root:
            _local_root[app] = tempfile.mkdtemp(prefix="telemere-")
        root = _local_root[app]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
