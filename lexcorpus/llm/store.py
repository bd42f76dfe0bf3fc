"""Intermediate tables in the shared folder, and names that don't clash with a caller's columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the context's own setting."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and executors share")
    return named.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again. It cuts the lineage: a task
    that runs again after a lost executor reads the same rows in the same order. While it is
    written, at most ``BATCH_ROWS`` rows go to Python at once, since rows hold whole texts."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(BATCHES)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(BATCHES, str(BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCHES, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Remove stored tables that no later step reads."""
    for table in tables:
        path = getattr(table, "stored_at", None)
        if path:
            jvm = table.sparkSession._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            conf = table.sparkSession.sparkContext._jsc.hadoopConfiguration()
            place.getFileSystem(conf).delete(place, True)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns called like one of ``names`` in any letter case."""
    taken = {n.lower() for n in names}
    return df.select([df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def own_names(df: DataFrame, *bases: str) -> list[str]:
    """Column names made from ``bases`` that ``df`` has in no letter case."""
    taken, names = {c.lower() for c in df.columns}, []
    for base in bases:
        name = base
        while name.lower() in taken:
            name += "_"
        names.append(name)
        taken.add(name.lower())
    return names
