"""Session construction and the shared scratch location.

On a cluster the shared folder comes from ``spark.checkpoint.dir``; we only
fall back to a local temporary folder when it is unset (local runs, tests).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants. The values suit local[N]; on a cluster
# shuffle partitions should be sized so one partition is ~100-200 MB.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.log.structuredLogging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Additional settings for a large cluster (hundreds of executors, TB-scale input).
# Size shuffle partitions from the data: ~input bytes / 200 MB for the widest stage;
# AQE then coalesces small ones and splits skewed ones.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    # broadcast only what is measured small; the rest is a sort-merge join
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


_NOT_SQL = {"spark.ui.enabled", "spark.log.structuredLogging.enabled", "spark.ui.showConsoleProgress"}


def get_or_create_session(master: str | None = None, shuffle_partitions: int | None = None,
                          app_name: str = "actimetry", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session.

    * ``master='local[N]'`` (tests, bench, a laptop): our defaults, a 16 GB driver heap,
      ``shuffle_partitions`` (default 8).
    * no master (under ``spark-submit`` on a cluster): whatever the submitter set wins;
      our SQL defaults and ``CLUSTER_CONF`` fill in only keys left unset.
    """
    builder = SparkSession.builder.appName(app_name)
    if master and master.startswith("local"):
        conf = dict(DEFAULT_CONF)
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
        # local mode: the driver JVM is the only executor, so its heap is the memory knob
        conf["spark.driver.memory"] = "16g"
        conf.update(extra or {})
        for k, v in conf.items():
            builder = builder.config(k, v)
        spark = builder.master(master).getOrCreate()
    else:
        if master:
            builder = builder.master(master)
        for k, v in (extra or {}).items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
        given = {k for k, _ in spark.sparkContext.getConf().getAll()} | set(extra or {})
        fill = {k: v for k, v in {**DEFAULT_CONF, **CLUSTER_CONF}.items() if k not in _NOT_SQL}
        if shuffle_partitions:
            fill["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        for k, v in fill.items():
            if k not in given:
                try:
                    spark.conf.set(k, v)
                except Exception:  # noqa: BLE001 - a static conf cannot be changed at runtime
                    pass
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (or set with ``setCheckpointDir``).
    When neither is set, a local run makes and registers a temporary folder; on a cluster that is an error."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) \
        or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.getConf().get("spark.master", "local")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="actimetry-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    path = f"{root}/actimetry/{name}-{uuid.uuid4().hex[:12]}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return path
