"""SparkSession defaults and the shared lake root.

The lake root (where Bronze/Silver/Gold and lineage-cutting tables are
written) is the cluster's ``spark.checkpoint.dir``. Only when a session has
none (local tests) do we create one, and only for ``local`` masters: a
machine-local folder is never used on a cluster.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.scheduler.mode": "FAIR",
}


def build_session(master: str | None = None, app: str = "pitchlake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and split sizing for a cluster run over ``input_bytes`` of input.

    Initial shuffle partitions: enough that a partition of the largest shuffle
    (at most the input size) stays near ``target_partition_bytes`` and fits in
    executor memory, and at least 2 per core; AQE then coalesces small ones
    and splits skewed ones, so the number is an upper bound, not a guess.
    There is no upper limit: beyond it a partition would outgrow its target size.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the conf is all we have
        return spark.conf.get("spark.checkpoint.dir", None)
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    return sc.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint dir, creating one only for local (test) masters."""
    existing = checkpoint_dir(spark)
    if existing:
        return existing
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):  # not local-cluster
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared folder there")
    local = tempfile.mkdtemp(prefix="pitchlake-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def lake_root(spark: SparkSession, run_id: str | None = None) -> str:
    """A lake folder under the checkpoint dir; a fresh one per run id."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/pitchlake-lake/{run_id or uuid.uuid4().hex}"


_SCRATCH: list[tuple[object, object]] = []


def delete_at_exit(spark: SparkSession, path: str) -> str:
    """Registers a scratch folder for removal when the driver ends."""
    with contextlib.suppress(Exception):  # no JVM access: the folder stays
        conf = spark._jsc.hadoopConfiguration()
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not _SCRATCH:
            atexit.register(_delete_scratch)
        _SCRATCH.append((hadoop_path, conf))
    return path


def _delete_scratch() -> None:
    for hadoop_path, conf in _SCRATCH:
        with contextlib.suppress(Exception):  # the JVM may be gone
            hadoop_path.getFileSystem(conf).delete(hadoop_path, True)
    _SCRATCH.clear()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder that this library wrote."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def scratch_lake(spark: SparkSession) -> str:
    """A fresh lake folder that is removed when the driver ends."""
    return delete_at_exit(spark, lake_root(spark))


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder, from its file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hadoop_path).getLength())


def size_for(spark: SparkSession, n_bytes: int) -> None:
    """Applies the runtime settings of ``cluster_conf`` to a session."""
    for k, v in cluster_conf(n_bytes, spark.sparkContext.defaultParallelism).items():
        spark.conf.set(k, v)


def join_path(*parts: str) -> str:
    return "/".join(p.strip("/") if i else p.rstrip("/") for i, p in enumerate(parts))


def default_cpus() -> int:
    return int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
