"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

#: Settings the jobs rely on; a cluster's own spark-defaults win for sizes and partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", app: str = "pricemill", driver_memory: str = "8g") -> SparkSession:
    """Session for tests and for ``bench.py``."""
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", partitions)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Root for intermediate tables: the folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, they go beside the managed tables, a place that all executors share as well. The choice is
    kept in the session, so that every caller sees the same one. The library deletes nothing there: whoever runs the
    jobs gives the folder a retention rule.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.pricemill.workDir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/pricemill-work"
        if not spark.sparkContext.master.startswith("local[") and re.match("file:|/", root):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all executors share")
        spark.conf.set("spark.pricemill.workDir", root)
    return root.rstrip("/")


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh, unused folder below the shared one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
