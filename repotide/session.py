"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults only: values given to spark-submit or already set win.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # larger splits of the JSON text: one split becomes one file of the events table
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(app_name: str, **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    spark = builder.getOrCreate()
    given = dict(spark.sparkContext.getConf().getAll())
    for key, value in {**DEFAULTS, **overrides}.items():
        if key in overrides or key not in given:
            spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, the folder all executors share.

    Where the setting is missing a temporary folder serves, but only in local mode.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"{purpose}-")
