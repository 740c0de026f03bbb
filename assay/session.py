"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans joins and coalesces small
# shuffle partitions, skew join splits hot keys, and the broadcast threshold
# is an explicit bound (a side is broadcast only when its measured size is
# under it; everything else takes a shuffle join).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(cpus: int | str | None = None, app: str = "assay",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and the bench (cluster jobs get theirs from
    spark-submit and only need :func:`checkpoint_dir`)."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions",
                 str(shuffle_partitions or os.environ.get("ASSAY_SHUFFLE_PARTITIONS") or cpus))
    if os.environ.get("ASSAY_AQE"):                 # to test plans without adaptive execution
        b = b.config("spark.sql.adaptive.enabled", os.environ["ASSAY_AQE"])
    if os.environ.get("ASSAY_SESSION_TZ"):          # to test time-zone independence
        b = b.config("spark.sql.session.timeZone", os.environ["ASSAY_SESSION_TZ"])
    b = b.config("spark.driver.memory", os.environ.get("ASSAY_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and points at shared storage;
    it is only filled in here when unset (local tests), with a fresh folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="assay-ckpt-")   # local runs and tests only
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint root, one per job (never a
    machine-local temp folder)."""
    root = checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}"
