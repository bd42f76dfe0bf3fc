"""Streams: documents cleaned and deduplicated as they arrive, and a log kept up to date.

The batch jobs keep the first document in input order. ``clean_documents`` keeps the first that
arrives; ``first_in_order`` corrects what it gave out when an earlier one comes later.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from lexcorpus import schemas
from lexcorpus.operators import cache, records
from lexcorpus.operators.dedup import keep_last_merged
from lexcorpus.session import saved


def read_documents(spark: SparkSession, folder: str, schema: T.StructType = schemas.DOCUMENT):
    """Documents of JSON line files, as the files arrive."""
    return spark.readStream.schema(schema).json(folder)


def clean_documents(stream: DataFrame, code: str | None = None, delay: str | None = None):
    """Cleaned documents, one per id. With ``delay`` the ids are forgotten once the watermark on
    ``retrieved_at`` has passed them; without it every id is remembered."""
    cleaned = records.clean(stream, code)
    if delay is None:
        return cleaned.dropDuplicates(["document_id"])
    timed = cleaned.withColumn("seen_at", F.to_timestamp("retrieved_at"))
    return timed.withWatermark("seen_at", delay).dropDuplicatesWithinWatermark(["document_id"])


#: Buckets of a log, by a hash of its key. Fixed for the life of a log.
LOG_BUCKETS = 64
LOG_KEY = ("celex_full", "lang")


def add_to_log(batch: DataFrame, folder: str, number: int) -> None:
    """Add a batch of attempts as part ``number`` of the buckets it falls into. A batch that runs
    again replaces its own parts."""
    rows = cache.conform(batch)
    bucket = F.pmod(F.xxhash64(*LOG_KEY), F.lit(LOG_BUCKETS)).cast("int")
    rows = rows.withColumns({"bucket": bucket, "part_ord": F.lit(number).cast("long"), "kind": F.lit("batch")})
    _write_parts(rows, folder)


def _write_parts(rows: DataFrame, folder: str) -> None:
    """Write parts of a log. A part appears whole, by one rename, or not at all."""
    parts = rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket", "part_ord", "kind")
    parts.option("partitionOverwriteMode", "dynamic").parquet(folder)


def _parts(log: DataFrame) -> DataFrame:
    """The parts of a log with the newest compacted one of their bucket (``base``). A part that it
    holds already is not ``live``."""
    parts = log.select("bucket", "part_ord", "kind").distinct()
    bases = parts.where("kind = 'base'").groupBy("bucket").agg(F.max("part_ord").alias("base"))
    held = (F.col("part_ord") < F.col("base")) | ((F.col("part_ord") == F.col("base")) & (F.col("kind") == "batch"))
    return parts.join(bases, "bucket", "left").withColumn("live", ~F.coalesce(held, F.lit(False)))


def _read_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).withColumns({"bucket": F.col("bucket").cast("int"), "part_ord": F.col("part_ord").cast("long")})


def _live(log: DataFrame) -> DataFrame:
    """The rows of the parts that count. At most one base a bucket is known, so they are sent to
    the tasks, and the parts they hold are skipped."""
    bases = _parts(log).where("base is not null").select("bucket", "base").distinct()
    rows = log.join(F.broadcast(bases), "bucket", "left")
    newer = F.col("base").isNull() | (F.col("part_ord") > F.col("base"))
    return rows.where(newer | ((F.col("part_ord") == F.col("base")) & (F.col("kind") == "base"))).drop("base")


def compact_log(spark: SparkSession, folder: str, most: int = 8) -> int:
    """Merge the parts of every bucket that has more than ``most`` live ones into one that keeps
    the newest attempt of a key; other buckets are not touched. Returns the number of buckets
    merged.

    The merged part carries the number of the newest part in it; readers skip what it holds, so a
    failure at any point leaves a right log. Parts skipped since an earlier call are deleted first:
    readers that began before it have had the time between two calls to end.
    """
    log = _read_log(spark, folder)
    parts = [r.asDict() for r in _parts(log).collect()]  # names of folders, not rows
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    for r in parts:
        if not r["live"]:
            old = fs_path(f"{folder}/bucket={r['bucket']}/part_ord={r['part_ord']}/kind={r['kind']}")
            old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
    live = {}
    for r in parts:
        if r["live"]:
            live.setdefault(r["bucket"], []).append(r["part_ord"])
    due = {b: max(n) for b, n in live.items() if len(n) > most}
    if not due:
        return 0
    upto = F.create_map(*[F.lit(x) for pair in due.items() for x in pair])[F.col("bucket")].cast("long")
    rows = _live(_read_log(spark, folder)).where(F.col("bucket").isin(*due)).where(F.col("part_ord") <= upto)
    merged = keep_last_merged(rows, LOG_KEY).withColumns({"part_ord": upto, "kind": F.lit("base")})
    _write_parts(saved(merged, "compacted"), folder)
    return len(due)


def keep_log(stream: DataFrame, folder: str, most: int = 8) -> DataStreamWriter:
    """Keep a retrieval log: each batch of attempts is added as parts of its own, and readers take
    the newest attempt of a document. Every ``most`` batches the buckets with more than that many
    parts are merged, so the log grows with its documents, not with the attempts. A batch that runs
    again after a failure replaces its own parts, or is skipped where they are merged already."""

    def add(batch: DataFrame, number: int) -> None:
        add_to_log(batch, folder, number)
        if number % most == most - 1:
            compact_log(batch.sparkSession, folder, most)

    return stream.writeStream.foreachBatch(add)


def newest_log(spark: SparkSession, folder: str, upto: int | None = None) -> DataFrame:
    """The newest attempt of each document and language, over all batches or those up to one, as
    long as no later one is merged with it."""
    log = _live(_read_log(spark, folder))
    if upto is not None:
        if not log.where((F.col("kind") == "base") & (F.col("part_ord") > upto)).isEmpty():
            raise ValueError(f"batches after {upto} are merged with earlier ones")
        log = log.where(F.col("part_ord") <= upto)
    return keep_last_merged(log, LOG_KEY).drop("part_ord", "bucket", "kind")


class _LeastOrder(StatefulProcessor):
    """Keeps the least ``ord`` of each key and gives out the rows that go below it. The state of a
    key is one number; of a batch only the best row so far is held."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.least = handle.getValueState("least", "ord long")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        old = self.least.get()[0] if self.least.exists() else None
        best, row = old, None
        for frame in rows:
            at = frame["ord"].argmin()
            if best is None or frame["ord"].iloc[at] < best:
                best, row = int(frame["ord"].iloc[at]), frame.iloc[[at]]
        if row is not None:
            self.least.update((best,))
            yield row.assign(replaces=pd.array([old], dtype="Int64"))

    def close(self) -> None:
        pass


def first_in_order(stream: DataFrame, key: str = "document_id") -> DataFrame:
    """The rows of a stream that are first by ``ord`` among those of their ``key`` that came so
    far. A row that goes before one given out earlier is given out too, with the order of that one
    in ``replaces`` (null for the first of a key). ``settled`` of all that was given out is what
    the batch rule keeps, in whatever order the rows came.

    Rows without a key are one group, as in the batch rule. ``ord`` must be there and unique. The
    state, a number for each key, is in RocksDB, so
    ``spark.sql.streaming.stateStore.providerClass`` must name its provider. The rows of a key in
    one batch stream through one task, so the trigger's limit on input bounds a hot key.
    """
    held = "_key"
    while held in stream.columns:
        held += "_"
    keyed = stream.withColumn(held, F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("none")))
    schema = T.StructType([*stream.schema, T.StructField("replaces", T.LongType())])
    return keyed.groupBy(held).transformWithStateInPandas(_LeastOrder(), schema, outputMode="Append", timeMode="None")


def settled(given: DataFrame) -> DataFrame:
    """The rows that ``first_in_order`` gave out and no later one replaced, without ``replaces``.
    Rows are only moved if the replaced orders are too many to broadcast."""
    gone = given.where("replaces is not null").select(F.col("replaces").alias("ord"))
    return given.join(gone, "ord", "left_anti").select([c for c in given.columns if c != "replaces"])


cloudpickle.register_pickle_by_value(sys.modules[__name__])
