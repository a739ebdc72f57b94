"""Session defaults and the scratch folder used for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


#: what every session of this library has, on one machine and from the command line
SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.ui.enabled": "false",
            "spark.sql.parquet.compression.codec": "zstd"}


def local_session(cpus: int = 8, app: str = "snapdemand") -> SparkSession:
    """A local session for tests and the benchmark. On a cluster, pass the cluster's own session instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("SNAPDEMAND_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config(map=SETTINGS)
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    A session on one machine that names none gets a folder of that machine; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "snapdemand-scratch")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
