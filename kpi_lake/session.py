"""Session defaults and the shared lake folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on. AQE re-plans joins and coalesces shuffle partitions at run time,
# splits skewed join partitions, and turns a shuffle join into a broadcast join only after it has
# measured the build side (a size-checked broadcast).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Semi joins on a filtered dimension pre-filter the fact before the shuffle (Bloom filter)
    # or prune its date partitions (dynamic partition pruning).
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app_name: str = "kpi_lake", **conf: str) -> SparkSession:
    """Return the active session as it is, or build one with the library defaults.

    On a cluster the session normally exists already and its settings are the operator's; see
    ``RECOMMENDED_CONF`` for those the library is written for.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session that has none (tests) gets a folder of its own. On any other master that
    would be a folder of the driver's machine, which executors don't see, so the setting is asked
    for instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master {sc.master})")
        configured = tempfile.mkdtemp(prefix="kpi-lake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def lake_root(spark: SparkSession) -> str:
    """Root folder of the bronze / silver / gold layers.

    ``kpi_lake.root`` wins when set; otherwise a ``lake`` folder inside the shared checkpoint
    folder is used, so written tables are visible to every executor.
    """
    root = spark.conf.get("kpi_lake.root", None)
    if root:
        return root.rstrip("/")
    return checkpoint_dir(spark).rstrip("/") + "/lake"


def session_key(spark: SparkSession) -> tuple[str, str]:
    """A stable identity of a session: application id and Spark's own session UUID (a Python
    object id could be reused once a stopped session is garbage collected)."""
    return spark.sparkContext.applicationId, str(spark._jsparkSession.sessionUUID())  # noqa: SLF001


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (used only by tests that inspect written files)."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["RECOMMENDED_CONF", "get_spark", "checkpoint_dir", "lake_root", "local_path", "session_key"]

if __name__ == "__main__":  # pragma: no cover
    print(lake_root(get_spark(os.environ.get("SPARK_MASTER", "local[2]"))))
