"""A new folder for tables that a run writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """Below the folder that the cluster's executors share (spark.checkpoint.dir), in a folder of this
    application.  Where the session names none, a local master (tests) gets a temporary folder of
    this machine; on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
