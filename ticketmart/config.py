"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import uuid
from datetime import datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "ticketmart", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings the operators are written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors reach, as the cluster names it.

    A local session without the setting takes a folder of the warehouse.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """New, unused path under the shared folder."""
    return f"{shared_folder(spark)}/ticketmart/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Removes an intermediate table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def moment(as_of: datetime | str | None) -> Column:
    """The time a job takes as "now": a parameter, else the current time."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp")
