"""Where intermediate tables live: the folder that every executor shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the session names none, a local master (tests, a laptop) gets a temporary folder of this
    machine; on a cluster that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to, below the shared folder, in a folder of this application: what a
    run leaves behind, tables of lost attempts included, can be removed with that folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends here, and a lost executor costs
    nothing that was computed before.  ``by``: a column with a folder for each value."""
    spark = df.sparkSession
    path = new_path(spark, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
