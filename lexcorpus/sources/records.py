"""Readers: records, query inventories, cached tables and text files."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexcorpus import schemas
from lexcorpus.functions import celex
from lexcorpus.functions.text import empty, strip
from lexcorpus.operators.skew import number_rows
from lexcorpus.sources import json_source


def read_records(
    spark: SparkSession, path: str, fmt: str = "jsonl", schema: T.StructType = schemas.LOCAL_RECORD
) -> DataFrame:
    """Records of a JSON file (a list, or an object with a ``records`` list) or of JSON lines, or of
    all files of a folder. Blank lines are skipped; anything that is no record of the schema fails
    the job with its file and line.

    Large files of lines are read in parts, lists a record at a time. Paths of a scheme that Arrow
    has no file system for are read by Spark's own reader, which fails without naming the line.
    """
    if fmt not in ("json", "jsonl"):
        raise ValueError("fmt must be 'json' or 'jsonl'")
    try:
        json_source.place(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return _spark_records(spark, path, fmt, schema)
    spark.dataSource.register(json_source.Records)
    return spark.read.format(json_source.Records.name()).schema(schema).option("format", fmt).load(path)


def _spark_records(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    if fmt == "jsonl":
        return spark.read.schema(schema).json(path, mode="FAILFAST")
    files = spark.read.text(path, wholetext=True)
    listed = F.from_json("value", T.ArrayType(schema), {"mode": "FAILFAST"})
    wrapped = F.from_json(
        "value", T.StructType([T.StructField("records", T.ArrayType(schema))]), {"mode": "FAILFAST"}
    )["records"]
    is_list = F.col("value").rlike(r"^\s*\[")
    return files.select(F.inline(F.when(is_list, listed).otherwise(wrapped)))


def with_order(df: DataFrame, by: list[str], out: str = "ord") -> DataFrame:
    """Number records by columns that order them (and end in a unique one)."""
    return number_rows(df, [F.col(c) for c in by], out, start=0)


def inventory_queries(files: DataFrame, body: str = "value", path: str = "path") -> DataFrame:
    """Queries of inventory texts: one per line, blank lines and ``#`` lines skipped. The id
    carries the number the line has in its file."""
    lines = files.select(
        F.col(path).alias("source_path"),
        F.posexplode(F.split(body, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]", -1)).alias(
            "i", "line"
        ),
    )
    text = strip(F.col("line"))
    number = (F.col("i") + 1).cast("string")
    padded = F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number)
    return lines.where((text != "") & ~F.startswith(text, F.lit("#"))).select(
        text.alias("text"),
        F.concat(F.lit("inventory-"), padded).alias("query_id"),
        F.lit("inventory").alias("origin"),
        "source_path",
    )


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.text(path, wholetext=True)
    return inventory_queries(files.select("value", F.col("_metadata.file_path").alias("path")))


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """A cached hit, document or log table with a declared schema."""
    if fmt == "csv":
        return spark.read.schema(schema).csv(
            path, header=True, multiLine=True, quote='"', escape='"', mode="FAILFAST"
        )
    return spark.read.schema(schema).format(fmt).load(path)


def corpus_part(docs: DataFrame, eu: bool) -> DataFrame:
    """The EU or the non-EU rows of a cached corpus; EU rows get their identifier columns."""
    is_eu = F.coalesce(F.col("jurisdiction") == "European Union", F.lit(False))
    if not eu:
        return docs.where(~is_eu)
    full = F.coalesce(celex.token(F.col("doc_uid")), empty())
    text = F.coalesce("full_text_clean", empty())
    out = docs.where(is_eu).withColumn("celex_full", full).withColumns(
        {
            "celex": celex.split_base(F.col("celex_full")),
            "celex_version": celex.split_version(F.col("celex_full")),
            "full_text_source": F.lit("fallback from persisted EU full-text export"),
            "text_missing": strip(text) == "",
        }
    )
    return out if "text_len" in docs.columns else out.withColumn("text_len", F.length(text))


def text_files(files: DataFrame, body: str = "value", path: str = "path") -> DataFrame:
    """Id (file stem), length and path of cached text files."""
    stem = F.regexp_replace(F.regexp_extract(path, "([^/]*)$", 1), r"\.[^.]*$", "")
    return files.select(
        F.url_decode(stem).alias("stem"),
        F.length(body).alias("file_text_len"),
        F.col(path).alias("text_path"),
        F.lit(True).alias("file_exists"),
    )


def read_text_files(spark: SparkSession, folder: str) -> DataFrame:
    """Cached ``.txt`` files with their text; ``text`` is read only where it is used."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt", recursiveFileLookup=True)
    return files.select("value", F.col("_metadata.file_path").alias("path"))


def eu_files(files: DataFrame) -> DataFrame:
    """``text_files`` keyed by the identifier of EU documents."""
    full = F.col("stem")
    return files.select(
        full.alias("celex_full"),
        celex.split_base(full).alias("celex"),
        celex.split_version(full).alias("celex_version"),
        "file_text_len", "text_path", "file_exists",
    )


def nim_files(files: DataFrame) -> DataFrame:
    """``text_files`` keyed by the cache key of national measures."""
    return files.withColumnRenamed("stem", "cache_key")
