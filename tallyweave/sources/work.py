"""Work tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark removes the shuffle files of a query as soon as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_LOCAL: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a new local folder for each application on one machine, and an error on a cluster."""
    if found := spark.sparkContext.getConf().get("spark.checkpoint.dir"):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    name = spark.sparkContext.applicationId
    if name not in _LOCAL:
        _LOCAL[name] = "file://" + tempfile.mkdtemp(prefix="tallyweave-")
    return _LOCAL[name]


def written(df: DataFrame) -> DataFrame:
    """df through a Parquet table in the shared folder: worked out once, however often it is read, and kept when an executor is lost. Its shuffle files go once it is written; the session keeps that setting."""
    df.sparkSession.conf.set(CLEANUP, "true")
    path = f"{work_dir(df.sparkSession)}/tallyweave-linkage/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
