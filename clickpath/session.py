"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Declared schemas everywhere; never infer on the read path.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "true",
    # Static overwrite: a full rebuild must not leave vanished partitions behind.
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_spark(master: str = "local[8]", app: str = "clickpath",
                shuffle_partitions: int = 8, conf: dict | None = None) -> SparkSession:
    """Session with the engine's defaults (UTC, AQE, no UI)."""
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        # Local mode runs every task in the driver JVM; the 1 GB default is too small for
        # the large generated classes of the contract validator.  A cluster sets its own.
        settings["spark.driver.memory"] = "8g"
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables (``spark.checkpoint.dir``).

    The cluster names it.  Only a session in local mode, where the driver is the only
    machine, may go without: a scratch folder is made for it.  On a cluster an unset
    folder is an error, because executors cannot see each other's disks.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="clickpath-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")
