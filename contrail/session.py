"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every contrail session wants; the cluster's own values win where the
# caller passes a session in (queries() never changes the driver's session).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "contrail",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is only read here.
    Only when it is unset and the master is local (one machine) a fresh scratch
    folder is made and set; a cluster without the setting is an error, since
    executors can't see each other's local folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="contrail-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique path under the shared checkpoint folder, scheme included."""
    name = "-".join(parts + (uuid.uuid4().hex[:12],))
    return f"{checkpoint_dir(spark).rstrip('/')}/contrail/{name}"


# Target bytes per task, for scans and for shuffle partitions; AQE coalesces
# partitions that turn out smaller and splits skewed ones.
PARTITION_BYTES = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the files under ``paths``, which may be globs (any Hadoop-compatible store)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        for status in fs.globStatus(path) or []:
            total += fs.getContentSummary(status.getPath()).getLength()
    return total


def size_for_input(spark: SparkSession, total_bytes: int, partition_bytes: int = PARTITION_BYTES) -> int:
    """Size a session for an input of ``total_bytes``: scan splits and AQE's
    target of ``partition_bytes``, and an initial shuffle partition count of
    about one per ``partition_bytes`` of input (at least the default
    parallelism), which AQE coalesces down at runtime. Returns the count."""
    n = max(spark.sparkContext.defaultParallelism, -(-total_bytes // partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(partition_bytes))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes // 4))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return n
