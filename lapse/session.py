"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a partition once it is 4x the median and over 64 MB; the
    # payment fingerprint and activity joins can see one very hot key.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Starting point for a large cluster (applied only to non-local masters):
# many initial shuffle partitions that AQE coalesces to ~128 MB each.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
}


def build_session(
    master: str | None = None,
    app_name: str = "lapse",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with the engine defaults.

    Settings given at submit time (spark-submit, spark-defaults) win over the
    defaults here; ``shuffle_partitions`` and ``extra`` win over both. The
    cluster defaults apply to every master that is not local.
    """
    submitted = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    where = master or submitted.get("spark.master", "local[*]")
    conf = dict(DEFAULT_CONF)
    if not where.startswith("local"):
        conf.update(CLUSTER_CONF)
    conf = {k: v for k, v in conf.items() if not submitted.contains(k)}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One JVM, or the local-cluster test master: all tasks on this machine."""
    return spark.sparkContext.master.startswith("local")


def _checked(spark: SparkSession, folder: str) -> str:
    """``folder``, unless it lies in a temp folder that each machine of a
    cluster has for itself (a mounted folder may be shared)."""
    scheme, path = folder.split(":", 1) if ":" in folder.split("/", 1)[0] else ("", folder)
    path = "/" + path.lstrip("/")
    private = any(path.startswith(f"{d.rstrip('/')}/") for d in ("/tmp", "/var/tmp", tempfile.gettempdir()))
    if scheme in ("", "file") and private and not _is_local(spark):
        raise RuntimeError(f"{folder} is local to each machine; name a folder that all executors share")
    return folder


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The folder comes from ``spark.checkpoint.dir`` (or a directory already
    set on the context). Only a local-mode session, as in tests, gets a
    private folder when none is configured; a cluster without the setting
    is an error, because a machine-local folder would not survive the loss
    of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return _checked(spark, current)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder"
            )
        configured = tempfile.mkdtemp(prefix="lapse-ckpt-")
    sc.setCheckpointDir(_checked(spark, configured))
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession) -> str:
    """Base of the shared folder named by ``spark.checkpoint.dir``.

    ``checkpoint_dir`` returns the per-application subfolder Spark creates
    under it; tables meant to outlive one application go to the base.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return _checked(spark, configured).rstrip("/")
    return checkpoint_dir(spark).rstrip("/").rsplit("/", 1)[0]
