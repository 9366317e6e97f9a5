"""Session helper and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app: str = "growthkit", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are written for.

    On a cluster leave `master` unset: master, memory and shuffle partitions then
    come from spark-submit. Adaptive execution picks the real partition count.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that spark.checkpoint.dir names.

    Only a local session without that setting falls back to a temporary folder; on
    a cluster a machine-local folder would be invisible to the other machines.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all machines share")
        shared = tempfile.mkdtemp(prefix="growthkit-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
