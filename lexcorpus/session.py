"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lexcorpus", **conf: str) -> SparkSession:
    """A session with adaptive plans on; the cluster's own settings stay in force."""
    builder = SparkSession.builder.appName(app).config("spark.sql.adaptive.enabled", "true")
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which all executors must be able to read."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError(
            "spark.checkpoint.dir names no folder: set it to one that the driver and all "
            "executors share"
        )
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/lexcorpus/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` as a stored table. Its size is then known before a join on it is planned, so Spark
    broadcasts it only where it is small."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame) -> DataFrame:
    """``df`` stored reliably, so that everything after it sees the same rows in the same order."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
