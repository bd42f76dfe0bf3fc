"""Captured texts as tables bucketed by their keys, so that joins on the keys leave them in place."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lexcorpus.session import new_path


def open_texts(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> DataFrame:
    """A folder written by ``store_texts``, in this or an earlier application, as a table that Spark
    knows to be dealt and sorted by ``keys``."""
    name = f"texts_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    listed = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({listed}) SORTED BY ({listed}) "
        f"INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def store_texts(
    texts: DataFrame, keys: Sequence[str], buckets: int | None = None, path: str | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``texts`` written once, one file a bucket, and opened again. A join on all of ``keys`` then
    deals the other side to the buckets and reads the texts where they are. ``buckets`` should be no
    less than the shuffle partitions of the jobs to come (the default is their number now), or Spark
    deals both sides anew. ``derive`` makes the stored columns from rows that are dealt already, so
    that what can be made from short columns is not moved; it must keep ``keys``."""
    spark = texts.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = path or new_path(spark, "texts")
    name = f"texts_{uuid.uuid4().hex}"
    dealt = texts.repartition(buckets, *keys)
    dealt = derive(dealt) if derive else dealt
    writer = dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("compression", "zstd").option("path", path).saveAsTable(name)
    return spark.table(name)
