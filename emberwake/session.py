"""Session construction and the shared scratch folder.

Everything that must survive the loss of an executor (staged files, cut
lineage, stream checkpoints) lives below the folder the cluster names in
``spark.checkpoint.dir``. We only pick our own folder when the session has
none *and* runs in local mode (tests, the bench); on a cluster an unset
``spark.checkpoint.dir`` is an error, never a silent machine-local path.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session defaults that matter at scale: AQE re-plans joins and coalesces
# partitions from real shuffle statistics, splits skewed join partitions, and
# converts a join to broadcast only when the measured side is small.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "emberwake",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    shared_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide checkpoint folder, registered with the context."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        current = sc.getCheckpointDir()
        if current:
            # setCheckpointDir adds a random child folder; the parent is ours.
            return current.rsplit("/", 1)[0]
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is unset; set it to a folder every executor can reach")
        d = tempfile.mkdtemp(prefix="emberwake-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared folder (never reused)."""
    base = shared_dir(spark)
    return f"{base}/emberwake/{name}-{uuid.uuid4().hex[:12]}"
