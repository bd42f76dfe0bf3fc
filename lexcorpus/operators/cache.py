"""Retrieval logs: conforming rows, the state per document, and what is left to fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcorpus import schemas
from lexcorpus.functions import celex, langs, quality
from lexcorpus.functions.text import cached_text, empty, strip
from lexcorpus.operators.dedup import keep_best, keep_last, keep_last_merged
from lexcorpus.session import saved

KEYS = ["celex_full", "celex", "celex_version"]
MIN_CHARS = 500
ROWS = 20_000  # rows that a task makes of documents and their texts, about


def _whole(name: str) -> Column:
    """A number written as text, cut to a whole number; null when it is none."""
    return F.expr(f"cast(try_cast(trim(cast({name} as string)) as double) as int)")


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), empty())


def conform(log: DataFrame) -> DataFrame:
    """EU log rows in the fixed shape, the last one per identifier and language. ``ord`` is the
    position in the log."""
    if "celex_full" not in log.columns and "celex" in log.columns:
        log = log.withColumn("celex_full", F.col("celex"))
    df = schemas.with_missing(log, schemas.CACHE_TEXT)
    df = schemas.with_missing(df, ("retrieval_status", "text_len"))
    df = df.withColumns({c: _filled(c) for c in schemas.CACHE_TEXT})
    full = celex.split_full(F.col("celex_full"))
    given = _whole("text_len")
    df = df.withColumns(
        {
            "celex": celex.split_base(full),
            "celex_version": celex.split_version(full),
            "retrieval_status": F.coalesce(_whole("retrieval_status"), F.lit(0)),
            "text_len": F.when(given > 0, given).otherwise(F.length("text")),
        }
    )
    df = df.select("ord", *schemas.CACHE_TEXT, "retrieval_status", "text_len")
    return keep_last(df, ["celex_full", "lang"])


def conform_nim(log: DataFrame) -> DataFrame:
    """National-measure log rows in the fixed shape; every row is kept."""
    df = schemas.with_missing(log, schemas.NIM_CACHE)
    numbers = ("retrieval_status", "text_len")
    cols = {c: _filled(c) for c in schemas.NIM_CACHE if c not in numbers}
    cols |= {c: F.coalesce(_whole(c), F.lit(0)) for c in numbers}
    df = df.withColumns(cols)
    length = F.length("text")
    df = df.withColumn(
        "text_len",
        F.when((F.col("text_len") <= 0) & (length > 0), length).otherwise(F.col("text_len")),
    )
    return df.select("ord", *schemas.NIM_CACHE)


def latest(log: DataFrame, keys: list[str], last: tuple[str, ...]) -> DataFrame:
    """Per key the values of the newest row and the greatest text length."""
    row = F.max_by(F.struct(*last), F.struct("timestamp", "ord")).alias("l")
    return (
        log.groupBy(*keys)
        .agg(row, F.max("text_len").alias("text_len"))
        .select(*keys, *[F.col(f"l.{c}").alias(c) for c in last], "text_len")
    )


def latest_eu(log: DataFrame) -> DataFrame:
    last = ("lang", "retrieval_status", "retrieval_error", "source_url", "timestamp")
    return latest(log, KEYS, last)


def _with_files(log: DataFrame, files: DataFrame) -> DataFrame:
    return latest_eu(log).join(files.select(*KEYS, "file_text_len", "text_path", "file_exists"),
                               KEYS, "full")


def _split_docs(docs: DataFrame) -> DataFrame:
    full = celex.split_full(F.col("celex_full" if "celex_full" in docs.columns else "celex"))
    return docs.select(
        full.alias("celex_full"),
        celex.split_base(full).alias("celex"),
        celex.split_version(full).alias("celex_version"),
    ).distinct()


def state(docs: DataFrame, log: DataFrame, files: DataFrame, min_chars: int = MIN_CHARS):
    """Retrieval state of every EU document: successful, failed or pending."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    known = _with_files(log, files)
    ok = (F.coalesce("file_exists", F.lit(False)) & (zero("file_text_len") >= min_chars)) | (
        zero("text_len") >= min_chars
    )
    known = known.withColumn("cache_state", F.when(ok, "successful").otherwise("failed"))
    blank = ("lang", "retrieval_error", "source_url", "timestamp", "text_path")
    return (
        _split_docs(docs)
        .join(known, KEYS, "left")
        .withColumns(
            {c: F.coalesce(c, empty()) for c in blank}
            | {c: zero(c) for c in ("retrieval_status", "text_len", "file_text_len")}
            | {
                "file_exists": F.coalesce("file_exists", F.lit(False)),
                "cache_state": F.coalesce("cache_state", F.lit("pending")),
            }
        )
    )


def measure_keys(measures: DataFrame) -> DataFrame:
    """Add the cache key of each national measure."""
    whole = F.to_json(F.struct(*sorted(measures.columns)))
    return measures.withColumn(
        "cache_key",
        langs.measure_key(
            F.col("national_measure_id"), F.col("nim_celex"), F.col("member_state_iso3"), whole
        ),
    )


def state_nim(measures: DataFrame, log: DataFrame, files: DataFrame, min_chars: int = MIN_CHARS):
    """Retrieval state of every national measure; failed only if something was tried."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    ids = ("cache_key", "nim_celex", "national_measure_id", "member_state_iso3", "member_state_name")
    last = ("lang", "retrieval_status", "retrieval_error", "source_url", "timestamp")
    df = (
        measure_keys(measures).select(*ids).distinct()
        .join(latest(log, ["cache_key"], last), "cache_key", "left")
        .join(files.select("cache_key", "file_text_len", "text_path", "file_exists"),
              "cache_key", "left")
        .withColumns(
            {c: zero(c) for c in ("retrieval_status", "text_len", "file_text_len")}
            | {
                "file_exists": F.coalesce("file_exists", F.lit(False)),
                "retrieval_error": F.coalesce("retrieval_error", empty()),
            }
        )
    )
    got = (F.col("file_exists") & (F.col("file_text_len") >= min_chars)) | (
        F.col("text_len") >= min_chars
    )
    tried = (F.col("retrieval_status") > 0) | (F.col("retrieval_error") != "")
    return df.withColumn(
        "cache_state",
        F.when(got, "successful").when(tried, "failed").otherwise("pending"),
    )


def worklist(docs: DataFrame, states: DataFrame, retry_failures: bool = True) -> DataFrame:
    """Documents still to fetch: not successful, and not failed unless failures are retried."""
    done = ["successful"] if retry_failures else ["successful", "failed"]
    skip = states.where(F.col("cache_state").isin(*done)).select("celex_full").distinct()
    return docs.join(skip, "celex_full", "left_anti")


def _spread(docs: DataFrame, got: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """``docs`` and ``got`` with ``_part``, and the number of tasks for rows of ``ROWS`` each, which are
    counted first. The texts of an identifier with more rows are split, its documents stand in each part."""
    fan = got.join(texts.select("text_path"), "text_path").groupBy(*KEYS).agg(F.count("*").alias("_n"))
    fan = fan.join(docs.groupBy(*KEYS).agg(F.count("*").alias("_docs")), KEYS)
    fan = saved(fan.select(*KEYS, (F.col("_n") * F.col("_docs")).alias("_n")), "fan")
    parts = F.ceil(F.col("_n") / ROWS).cast("int")
    got = got.join(fan, KEYS).withColumn("_part", F.pmod(F.hash("text_path"), parts)).drop("_n")
    docs = docs.join(fan, KEYS).withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_n")
    return docs, got, -(-(fan.agg(F.sum("_n")).first()[0] or 0) // ROWS)


def resumed(docs: DataFrame, states: DataFrame, texts: DataFrame) -> DataFrame:
    """Documents already retrieved, with their cached text (``text_path, text``)."""
    got = states.where(F.col("cache_state") == "successful").select(
        *KEYS, F.col("lang").alias("_lang"), "retrieval_status", "retrieval_error", "source_url",
        "text_path",
    )
    docs = schemas.with_missing(docs, ("title", "url", "lang"))
    docs = schemas.with_missing(docs, ("query_langs",), kind="array<string>")
    full = F.col("celex_full")
    docs = docs.withColumns(
        {"celex": celex.split_base(full), "celex_version": celex.split_version(full)}
    )
    docs = docs.withColumn("_first", F.get(langs.doc_candidates(F.col("query_langs"), F.col("lang")), F.lit(0)))
    shown = docs.columns
    docs, got, tasks = _spread(docs, saved(got, "cached"), texts)
    # only texts that are asked for are cleaned, each once: as the row of a list of one, a text is not cleaned again
    # by filters on it. Documents come last, as many of them may share the texts of one identifier
    got = got.join(texts.select("text_path", F.col("text").alias("_text")), "text_path")
    got = got.select("*", F.explode(F.array(cached_text(F.col("_text")))).alias("full_text_clean")).drop("_text")
    got = got.where(strip(F.col("full_text_clean")) != "").withColumns(
        {
            "_lang": F.nullif(strip(F.col("_lang")), empty()),
            "text_source_url": F.coalesce(
                F.nullif(strip(F.col("source_url")), empty()), F.lit("CACHE")
            ),
            "text_len": F.length("full_text_clean"),
        }
    )
    lang = F.coalesce("_lang", "_first")
    # texts lead the join: the rows of a text come one after the other, which files keep small, and what is held of an
    # identifier while its rows are made are its short documents, not its texts
    keys = [*KEYS, "_part"]
    if tasks > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        got = got.repartition(tasks, *keys)
    rest = [docs[c] for c in shown if c not in KEYS] + [got[c] for c in got.columns if c not in keys]
    return got.join(docs, keys).select(*KEYS, *rest).withColumns(
        {
            "lang_source_fulltext": langs.text_lang_source(lang, F.col("lang"), F.col("query_langs")),
            "lang": lang,
            "fetched_from_cache": F.lit(True),
            "route_used": F.lit("cache_resume"),
        }
    ).drop("_lang", "_first", "source_url")


def failed_attempts(log: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    return log.where(F.col("text_len") < min_chars)


def diagnostics(log: DataFrame, files: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Six counts that compare the log with the text files."""
    n = lambda cond: F.count_if(cond)
    in_log = log.agg(
        F.count("*").alias("cache_csv_rows"),
        n(F.col("retrieval_status") == 200).alias("cache_csv_status_200"),
        n(F.col("text_len") >= min_chars).alias("cache_csv_text_ge_threshold"),
    )
    in_files = files.agg(
        n(F.col("file_exists")).alias("existing_txt_files"),
        n(F.col("file_text_len") >= min_chars).alias("txt_files_ge_threshold"),
    )
    both = _with_files(log, files)
    differ = (F.coalesce("text_len", F.lit(0)) >= min_chars) != (
        F.coalesce("file_text_len", F.lit(0)) >= min_chars
    )
    mixed = both.agg(n(differ).alias("csv_vs_file_inconsistencies"))
    rows = lambda df: df.unpivot([], df.columns, "metric", "value")
    return rows(in_log).unionByName(rows(in_files)).unionByName(rows(mixed))


def merge_logs(old: DataFrame, new: DataFrame) -> DataFrame:
    """EU log after adding rows: the newer row per identifier and language replaces the older."""
    both = old.withColumn("part_ord", F.lit(0)).unionByName(new.withColumn("part_ord", F.lit(1)))
    kept = keep_last_merged(both, ["celex_full", "lang"])
    return kept.withColumnRenamed("part_ord", "batch")


def merge_nim_logs(old: DataFrame, new: DataFrame) -> DataFrame:
    """National-measure log after adding rows: newest, then longest, per key and language."""
    both = old.withColumn("batch", F.lit(0)).unionByName(new.withColumn("batch", F.lit(1)))
    both = both.withColumn("pos", F.struct("batch", "ord"))
    return keep_best(
        both, ["cache_key", "lang"], [F.col("timestamp"), F.col("text_len")], "pos"
    ).drop("pos")


def with_failure(results: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Mark each retrieval result as success or name its failure category."""
    category = quality.failure(
        F.col("retrieval_status"), F.col("retrieval_error"), F.col("celex_class"),
        F.col("fulltext_support"),
    )
    ok = F.col("text_len") >= min_chars
    return results.withColumns(
        {"success": ok, "failure_category": F.when(~ok, category)}
    )
