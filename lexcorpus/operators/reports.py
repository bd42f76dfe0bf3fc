"""Roll-ups over results: success by type, failures, routes, coverage, languages, run counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexcorpus.functions.text import missing
from lexcorpus.operators.cache import MIN_CHARS

TYPE = ("celex_sector", "celex_sector_label", "celex_descriptor", "celex_descriptor_label",
        "celex_class")
SHORT_TYPE = ("celex_sector", "celex_descriptor", "celex_class")


def type_summary(results: DataFrame) -> DataFrame:
    """Attempts, successes, failures and the most frequent failure per identifier type.
    ``results`` comes from ``cache.with_failure``."""
    counted = results.groupBy(*TYPE, "failure_category").agg(
        F.count("*").alias("n"), F.count_if("success").alias("ok")
    )
    per_type = counted.groupBy(*TYPE).agg(
        F.sum("n").alias("attempted"), F.sum("ok").alias("successful")
    )
    failures = (
        counted.where(F.col("n") > F.col("ok"))
        .groupBy(*SHORT_TYPE, "failure_category")
        .agg(F.sum("n").alias("n"))
    )
    top = failures.groupBy(*SHORT_TYPE).agg(
        F.min_by(F.struct("failure_category", "n"), F.struct(-F.col("n"), "failure_category")).alias("t")
    )
    return per_type.join(top, list(SHORT_TYPE), "left").select(
        *TYPE, "attempted", "successful",
        (F.col("attempted") - F.col("successful")).alias("failed"),
        F.col("t.failure_category").alias("top_failure_reason"),
        F.col("t.n").alias("top_failure_count"),
    )


def failure_counts(results: DataFrame) -> DataFrame:
    return (
        results.where(~F.col("success"))
        .groupBy("failure_category")
        .agg(F.count("*").alias("n"))
    )


def route_counts(results: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Results, successes and failures per route."""
    name = lambda c: F.nullif(F.col(c), F.lit(""))
    route = F.coalesce(name("text_route_used"), name("route_used"), F.lit("unknown"))
    ok = F.col("text_len") >= min_chars
    return results.groupBy(route.alias("route")).agg(
        F.count("*").alias("n"), F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed")
    )


def coverage(docs: DataFrame) -> DataFrame:
    """Texts and missing titles and years per country."""
    with_text = F.count_if("has_text")
    return docs.groupBy("country").agg(
        F.count("*").alias("documents"),
        with_text.alias("with_text"),
        F.avg("text_len").alias("mean_text_len"),
        F.count_if(missing(F.col("title"))).alias("missing_title"),
        F.count_if(F.col("year").isNull()).alias("missing_year"),
        (with_text / F.greatest(F.count("*"), F.lit(1))).alias("text_coverage"),
    )


def hit_summary(hits: DataFrame) -> DataFrame:
    """Rows, documents, terms and missing values of raw hits per country."""
    return hits.groupBy("country").agg(
        F.count("*").alias("rows"),
        F.countDistinct("doc_id").alias("documents"),
        F.countDistinct("term").alias("matched_terms"),
        F.count_if(missing(F.col("title"))).alias("missing_title"),
        F.count_if(F.col("year").isNull()).alias("missing_year"),
    )


def value_counts(df: DataFrame, columns: list[str], out: str = "rows") -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias(out))


def page_diagnostics(log: DataFrame) -> DataFrame:
    """Search pages per term: first status, sums, greatest total, last stop reason."""
    return log.groupBy("term", "page").agg(
        F.min_by("status_code", "ord").alias("status_code"),
        F.sum("candidates_found").alias("candidates_found"),
        F.sum("new_urls_kept").alias("new_urls_kept"),
        F.max("kept_total").alias("kept_total"),
        F.max_by("stop_reason", "ord").alias("stop_reason"),
    )


def source_log(attempts: DataFrame) -> DataFrame:
    """Rows and outcome per source; a failed source counts no rows and names its first error."""
    error = F.min_by("error", F.when(F.col("error") != "", F.col("ord")))
    return attempts.groupBy("source").agg(
        F.coalesce(error, F.lit("")).alias("error"),
        error.isNull().alias("ok"),
        F.when(error.isNull(), F.sum("rows")).otherwise(F.lit(0)).alias("rows"),
    )


def run_counts(docs: DataFrame, group: str = "jurisdiction") -> DataFrame:
    """Documents and documents with text per group and in total (group null)."""
    return docs.rollup(group).agg(
        F.count("*").alias("document_count"),
        F.count_if(F.coalesce("full_text", F.lit("")) != "").alias("full_text_document_count"),
    )
