"""Likely-duplicate audit: signals, groups, review ranks and roll-ups. It removes nothing.

Signals are exploded from a narrow table (position, signal, value); blank values are dropped
before the shuffle, groups are counted with partial aggregates, and member rows join their
stored groups, of which Spark splits the hot ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcorpus.functions import celex, text, urls
from lexcorpus.operators.skew import join_sized, number_rows

SIGNALS = ("document_id", "source_document_id", "celex", "normalized_url", "normalized_title")
RAW_CELEX_KEYS = ("celex", "celex_full", "nim_celex", "act_celex", "source_celex")
MIN_TITLE = 16
JOINER = " | "


def document_celex(raw_record: Column | None = None) -> Column:
    found = [
        celex.token(F.col(c)) for c in ("source_document_id", "document_id", "url", "download_url")
    ]
    if raw_record is not None:
        found += [celex.token(F.get_json_object(raw_record, f"$.{k}")) for k in RAW_CELEX_KEYS]
    return F.coalesce(*found, F.lit(""))


def contexts(docs: DataFrame) -> DataFrame:
    """The comparison columns of every document."""
    blank = lambda name: F.coalesce(F.col(name), F.lit(""))
    docs = urls.with_comparison(docs, "url", "_url")
    docs = docs.withColumn("_key", F.coalesce(text.folded_title(F.col("title")), F.lit("")))
    key = F.col("_key")
    raw = F.col("raw_record") if "raw_record" in docs.columns else None
    ident = lambda c: F.coalesce(text.identifier(F.col(c)), F.lit("")).alias(c)
    return docs.select(
        F.col("ord"),
        ident("document_id"),
        blank("source_name").alias("source_name"),
        ident("source_document_id"),
        blank("title").alias("title"),
        F.when(F.length(key) >= MIN_TITLE, key).otherwise(F.lit("")).alias("normalized_title"),
        blank("url").alias("url"),
        F.col("_url").alias("normalized_url"),
        document_celex(raw).alias("celex"),
        blank("jurisdiction").alias("jurisdiction"),
        blank("publication_date").alias("publication_date"),
    )


def _members(ctx: DataFrame, *carry: str) -> DataFrame:
    signals = F.array(
        *[
            F.struct(
                F.lit(i).alias("signal_ord"), F.lit(name).alias("signal"), F.col(name).alias("value")
            )
            for i, name in enumerate(SIGNALS)
        ]
    )
    picked = F.filter(signals, lambda s: s["value"] != "")
    return ctx.select("ord", *carry, F.explode(picked).alias("s")).select(
        "ord", *carry, "s.signal_ord", "s.signal", F.col("s.value").alias("representative_value")
    )


KEY = ("signal_ord", "signal", "representative_value")


def _group_id() -> Column:
    return F.concat(F.lit("dup-"), F.lpad(F.col("_no").cast("string"), 6, "0"))


def _sized(members: DataFrame, *aggs: Column) -> DataFrame:
    return (
        members.groupBy(*KEY)
        .agg(F.count("*").alias("group_size"), *aggs)
        .where(F.col("group_size") > 1)
    )


def _numbered(groups: DataFrame) -> DataFrame:
    numbered = number_rows(groups, [F.col("signal_ord"), F.col("representative_value")], "_no")
    # ids past a million stay unique: the number is longer than the padding then
    wide = F.length(F.col("_no").cast("string")) > 6
    name = F.when(wide, F.concat(F.lit("dup-"), F.col("_no").cast("string"))).otherwise(_group_id())
    return numbered.withColumn("duplicate_group_id", name).drop("_no")


def duplicate_rows(docs: DataFrame) -> DataFrame:
    """One row per document and likely-duplicate group it belongs to."""
    ctx = contexts(docs)
    members = _members(ctx)
    groups = _numbered(_sized(members))
    joined = join_sized(members, groups, KEY)
    return joined.drop("signal_ord").join(ctx, "ord").select(
        "duplicate_group_id", "signal", "group_size", "representative_value", "document_id",
        "source_name", "source_document_id", "title", "normalized_title", "url", "normalized_url",
        "celex", "jurisdiction", "publication_date",
    )


def _present(c: str) -> Column:
    return F.nullif(text.strip(F.col(c)), F.lit(""))


def group_members(docs: DataFrame) -> DataFrame:
    """One row per group and distinct document id in it, whatever the size of the group."""
    members = _members(contexts(docs), "document_id")
    groups = _numbered(_sized(members))
    return (
        join_sized(members, groups, KEY)
        .select("duplicate_group_id", "signal", _present("document_id").alias("document_id"))
        .where("document_id is not null")
        .distinct()
    )


def group_summary(docs: DataFrame) -> DataFrame:
    """One review row per group, ranked. A group's jurisdictions and sources, of which a run has
    few, are listed; its documents are the rows of ``group_members``."""
    ctx = contexts(docs)
    members = _members(ctx, "jurisdiction", "source_name", "publication_date")
    groups = _sized(
        members,
        F.array_sort(F.collect_set(_present("jurisdiction"))).alias("_lands"),
        F.array_sort(F.collect_set(_present("source_name"))).alias("_sources"),
        F.min(_present("publication_date")).alias("_from"),
        F.max(_present("publication_date")).alias("_to"),
    )
    many_lands = F.size("_lands") > 1
    many_sources = F.size("_sources") > 1
    many_dates = F.coalesce(F.col("_from") != F.col("_to"), F.lit(False))
    points = lambda cond, n: F.when(cond, n).otherwise(0)
    scored = groups.select(
        *KEY,
        "group_size",
        F.array_join("_lands", JOINER).alias("jurisdictions"),
        F.array_join("_sources", JOINER).alias("source_names"),
        F.coalesce("_from", F.lit("")).alias("publication_date_min"),
        F.coalesce("_to", F.lit("")).alias("publication_date_max"),
        many_lands.alias("spans_multiple_jurisdictions"),
        many_sources.alias("spans_multiple_source_names"),
        (
            F.col("group_size")
            + points(many_lands, 3) + points(many_sources, 2) + points(many_dates, 1)
        ).alias("review_interest_score"),
        F.concat_ws(
            JOINER,
            F.concat(F.lit("group_size="), F.col("group_size").cast("string")),
            F.when(many_lands, "spans_multiple_jurisdictions"),
            F.when(many_sources, "spans_multiple_source_names"),
            F.when(many_dates, "publication_date_range"),
        ).alias("review_interest_reasons"),
        "_lands",
        "_sources",
    )
    scored = _numbered(scored)
    ranked = number_rows(
        scored,
        [
            F.col("review_interest_score").desc(), F.col("group_size").desc(), F.col("signal"),
            F.col("duplicate_group_id"),
        ],
        "review_rank",
    )
    return ranked.drop("signal_ord")


SUMMARY_COLUMNS = (
    "review_rank", "duplicate_group_id", "signal", "group_size", "representative_value",
    "jurisdictions", "source_names", "publication_date_min", "publication_date_max",
    "spans_multiple_jurisdictions", "spans_multiple_source_names",
    "review_interest_score", "review_interest_reasons",
)


def light_summary(docs: DataFrame) -> DataFrame:
    """Groups with their jurisdictions and sources only, for the roll-ups."""
    members = _members(contexts(docs), "jurisdiction", "source_name")
    return _sized(
        members,
        F.array_sort(F.collect_set(_present("jurisdiction"))).alias("_lands"),
        F.array_sort(F.collect_set(_present("source_name"))).alias("_sources"),
    )


#: Roll-ups with the name of their value column.
ROLLUPS = {
    "groups_by_signal": "signal",
    "groups_by_jurisdiction": "jurisdiction",
    "groups_by_jurisdiction_combination": "jurisdictions",
    "groups_by_source_name": "source_name",
    "groups_by_source_name_combination": "source_names",
}


def rollups(summary: DataFrame) -> DataFrame:
    """(rollup, value, group_count): groups by signal, by single jurisdictions and sources, and by
    their combinations. Each group gives one row for each of its values, so that one pass and one
    aggregate count them all; groups without values count as missing."""
    missing = F.lit("(missing)")
    single = lambda c: F.when(F.size(c) == 0, F.array(missing)).otherwise(F.col(c))
    joined = lambda c: F.array(F.coalesce(F.nullif(F.array_join(c, JOINER), F.lit("")), missing))
    of = (F.array("signal"), single("_lands"), joined("_lands"), single("_sources"), joined("_sources"))

    def named(name: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(name).alias("rollup"), v.alias("value")))

    pairs = F.concat(*[named(name, values) for name, values in zip(ROLLUPS, of, strict=True)])
    rows = summary.select(F.explode(pairs).alias("r")).select("r.*")
    return rows.groupBy("rollup", "value").agg(F.count("*").alias("group_count"))


def rollup(counts: DataFrame, name: str) -> DataFrame:
    """One of the ``rollups``, its values in the column of their name."""
    return counts.where(F.col("rollup") == name).select(F.col("value").alias(ROLLUPS[name]), "group_count")


def top_groups(summary: DataFrame, by: tuple[str, ...], k: int) -> DataFrame:
    return summary.orderBy(*[F.col(c).desc() for c in by], "duplicate_group_id").limit(k)


def totals(docs: DataFrame) -> DataFrame:
    """Number of groups and of the distinct documents in them."""
    members = _members(contexts(docs), "document_id")
    groups = _sized(members)
    involved = join_sized(members, groups, KEY)
    return involved.agg(
        F.countDistinct("signal", "representative_value").alias("duplicate_group_count"),
        F.countDistinct(_present("document_id")).alias("document_count"),
    )
