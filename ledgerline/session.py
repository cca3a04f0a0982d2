"""Session helpers: sensible defaults for the operators, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "ledgerline", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster ``master`` stays None and the launcher's settings win; tests pass ``local[n]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, local_fallback: bool = False) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster sets it. Where it is unset, a session whose tasks all run in this machine's one process (``local[n]``: tests, trials) gets a
    fresh scratch folder with ``local_fallback=True``; on a cluster a folder of the driver would be lost to the executors, so that is an error.
    """
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    master = spark.sparkContext.master
    if not local_fallback or not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir is not set; the cluster must name a shared folder")
    folder = tempfile.mkdtemp(prefix="ledgerline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir() or folder
