"""Deduplication, merging and the likely-duplicate audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexcorpus.catalog import rules as R
from lexcorpus.catalog.inputs import load
from lexcorpus.catalog.registry import query
from lexcorpus.operators import audit, dedup, reports

FIRST = """
SELECT ord, document_id, source_name, title, publication_date FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {table}) t
WHERE rn = 1
"""


@query("dedup_first", FIRST.format(keys="document_id", order="ord", table="[[docs]]"))
def dedup_first(spark, sf):
    kept = dedup.keep_first(load(spark, sf, "docs"), ["document_id"])
    return kept.select("ord", "document_id", "source_name", "title", "publication_date")


@query(
    "dedup_first_nulls",
    FIRST.format(keys="source_name, title, publication_date", order="ord", table="[[docs]]"),
)
def dedup_first_nulls(spark, sf):
    """Several fields as the key, missing values included."""
    kept = dedup.keep_first(load(spark, sf, "docs"), ["source_name", "title", "publication_date"])
    return kept.select("ord", "document_id", "source_name", "title", "publication_date")


PARTS = """
SELECT 0 AS part_ord, ord, document_id, jurisdiction, full_text FROM [[docs]] WHERE ord % 7 = 1
UNION ALL SELECT 1, ord, document_id, jurisdiction, full_text FROM [[docs]] WHERE ord % 7 <> 1
UNION ALL SELECT 2, ord, document_id, jurisdiction, full_text FROM [[docs]]
"""


def _parts(spark, sf):
    docs = load(spark, sf, "docs").select("ord", "document_id", "jurisdiction", "full_text")
    return dedup.merge_sources(
        [docs.where("ord % 7 = 1"), docs.where("ord % 7 <> 1"), docs]
    )


@query(
    "merge_jurisdictions",
    f"""SELECT part_ord, ord, document_id, jurisdiction FROM (SELECT *, row_number() OVER (
  PARTITION BY document_id ORDER BY part_ord, ord) AS rn FROM ({PARTS}) p) t WHERE rn = 1""",
)
def merge_jurisdictions(spark, sf):
    kept = dedup.keep_first_merged(_parts(spark, sf), ["document_id"])
    return kept.select("part_ord", "ord", "document_id", "jurisdiction")


@query(
    "run_counts",
    f"""
SELECT part_ord, count(*) AS document_count,
  count(CASE WHEN full_text <> '' THEN 1 END) AS full_text_document_count,
  count(DISTINCT document_id) AS distinct_documents
FROM ({PARTS}) p GROUP BY ROLLUP (part_ord)
""",
)
def run_counts(spark, sf):
    parts = _parts(spark, sf)
    ids = parts.rollup("part_ord").agg(F.countDistinct("document_id").alias("distinct_documents"))
    counts = reports.run_counts(parts, "part_ord")
    on = counts["part_ord"].eqNullSafe(ids["part_ord"])
    return counts.join(ids, on).select(
        counts["part_ord"], "document_count", "full_text_document_count", "distinct_documents"
    )


CONTEXT = f"""
ctx AS (SELECT ord, {R.norm('document_id')} AS document_id, coalesce(source_name, '') AS source_name,
  {R.norm('source_document_id')} AS source_document_id, coalesce(title, '') AS title,
  CASE WHEN length({R.collapse(R.fold(R.strip('title')))}) >= 16
    THEN {R.collapse(R.fold(R.strip('title')))} ELSE '' END AS normalized_title,
  coalesce(url, '') AS url, {R.comparison_url('url')} AS normalized_url,
  coalesce({R.token('source_document_id')}, {R.token('document_id')}, {R.token('url')},
    {R.token('download_url')}, '') AS celex,
  coalesce(jurisdiction, '') AS jurisdiction, coalesce(publication_date, '') AS publication_date
  FROM [[docs]]),
m AS (SELECT ord, 0 AS so, 'document_id' AS signal, document_id AS v FROM ctx
  UNION ALL SELECT ord, 1, 'source_document_id', source_document_id FROM ctx
  UNION ALL SELECT ord, 2, 'celex', celex FROM ctx
  UNION ALL SELECT ord, 3, 'normalized_url', normalized_url FROM ctx
  UNION ALL SELECT ord, 4, 'normalized_title', normalized_title FROM ctx),
g0 AS (SELECT so, signal, v, count(*) AS n FROM m WHERE v <> '' GROUP BY ALL HAVING count(*) > 1),
g AS (SELECT *, 'dup-' || lpad(cast(row_number() OVER (ORDER BY so, v) AS varchar), 6, '0') AS gid FROM g0)
"""


@query(
    "dup_groups",
    f"""
WITH {CONTEXT}
SELECT gid AS duplicate_group_id, signal, n AS group_size, v AS representative_value,
  document_id, source_name, source_document_id, title, normalized_title, url, normalized_url,
  celex, jurisdiction, publication_date
FROM m JOIN g USING (so, signal, v) JOIN ctx USING (ord)
""",
)
def dup_groups(spark, sf):
    return audit.duplicate_rows(load(spark, sf, "docs"))


SUMMARY = f"""
{CONTEXT},
s0 AS (SELECT gid, signal, n, v,
  list_sort(list_distinct(list(nullif({R.strip('jurisdiction')}, '')))) AS lands,
  list_sort(list_distinct(list(nullif({R.strip('source_name')}, '')))) AS srcs,
  min(nullif({R.strip('publication_date')}, '')) AS d0,
  max(nullif({R.strip('publication_date')}, '')) AS d1
  FROM m JOIN g USING (so, signal, v) JOIN ctx USING (ord) GROUP BY gid, signal, n, v),
s1 AS (SELECT *, len(lands) > 1 AS ml, len(srcs) > 1 AS ms, coalesce(d0 <> d1, false) AS md FROM s0),
s2 AS (SELECT *, n + CASE WHEN ml THEN 3 ELSE 0 END + CASE WHEN ms THEN 2 ELSE 0 END
  + CASE WHEN md THEN 1 ELSE 0 END AS score FROM s1),
s AS (SELECT row_number() OVER (ORDER BY score DESC, n DESC, signal, gid) AS review_rank,
  gid AS duplicate_group_id, signal, n AS group_size, v AS representative_value,
  coalesce(array_to_string(lands, ' | '), '') AS jurisdictions,
  coalesce(array_to_string(srcs, ' | '), '') AS source_names,
  coalesce(d0, '') AS publication_date_min, coalesce(d1, '') AS publication_date_max,
  ml AS spans_multiple_jurisdictions, ms AS spans_multiple_source_names,
  score AS review_interest_score,
  concat_ws(' | ', 'group_size=' || cast(n AS varchar),
    CASE WHEN ml THEN 'spans_multiple_jurisdictions' END,
    CASE WHEN ms THEN 'spans_multiple_source_names' END,
    CASE WHEN md THEN 'publication_date_range' END) AS review_interest_reasons,
  lands, srcs FROM s2)
"""


@query("dup_summary", f"WITH {SUMMARY} SELECT * EXCLUDE (lands, srcs) FROM s")
def dup_summary(spark, sf):
    return audit.group_summary(load(spark, sf, "docs")).select(*audit.SUMMARY_COLUMNS)


@query(
    "dup_members",
    f"""WITH {CONTEXT}
SELECT DISTINCT gid AS duplicate_group_id, signal, nullif({R.strip('document_id')}, '') AS document_id
FROM m JOIN g USING (so, signal, v) JOIN ctx USING (ord) WHERE {R.strip('document_id')} <> ''""",
)
def dup_members(spark, sf):
    return audit.group_members(load(spark, sf, "docs"))


@query(
    "dup_top",
    f"""
WITH {SUMMARY}
SELECT * FROM (SELECT 'largest' AS list, * EXCLUDE (lands, srcs) FROM s
  ORDER BY group_size DESC, duplicate_group_id LIMIT 10) a
UNION ALL
SELECT * FROM (SELECT 'review' AS list, * EXCLUDE (lands, srcs) FROM s
  ORDER BY review_interest_score DESC, group_size DESC, duplicate_group_id LIMIT 20) b
""",
)
def dup_top(spark, sf):
    summary = audit.group_summary(load(spark, sf, "docs")).select(*audit.SUMMARY_COLUMNS)
    largest = audit.top_groups(summary, ("group_size",), 10)
    review = audit.top_groups(summary, ("review_interest_score", "group_size"), 20)
    return largest.withColumn("list", F.lit("largest")).unionByName(
        review.withColumn("list", F.lit("review"))
    )


def _rollups(spark, sf):
    return audit.rollups(audit.light_summary(load(spark, sf, "docs")))


@query("dup_by_signal", f"WITH {SUMMARY} SELECT signal, count(*) AS group_count FROM s GROUP BY 1")
def dup_by_signal(spark, sf):
    return audit.rollup(_rollups(spark, sf), "groups_by_signal")


@query(
    "dup_by_jurisdiction",
    f"""WITH {SUMMARY},
u AS (SELECT unnest(CASE WHEN jurisdictions = '' THEN ['(missing)'] ELSE string_split(jurisdictions, ' | ') END) AS jurisdiction FROM s)
SELECT jurisdiction, count(*) AS group_count FROM u GROUP BY 1""",
)
def dup_by_jurisdiction(spark, sf):
    return audit.rollup(_rollups(spark, sf), "groups_by_jurisdiction")


@query(
    "dup_by_source",
    f"""WITH {SUMMARY},
u AS (SELECT unnest(CASE WHEN source_names = '' THEN ['(missing)'] ELSE string_split(source_names, ' | ') END) AS source_name FROM s)
SELECT source_name, count(*) AS group_count FROM u GROUP BY 1""",
)
def dup_by_source(spark, sf):
    return audit.rollup(_rollups(spark, sf), "groups_by_source_name")


@query(
    "dup_by_combo",
    f"""WITH {SUMMARY}
SELECT 'jurisdictions' AS kind, coalesce(nullif(jurisdictions, ''), '(missing)') AS value,
  count(*) AS group_count FROM s GROUP BY 2
UNION ALL SELECT 'source_names', coalesce(nullif(source_names, ''), '(missing)'), count(*)
FROM s GROUP BY 2""",
)
def dup_by_combo(spark, sf):
    combined = ("groups_by_jurisdiction_combination", "groups_by_source_name_combination")
    rows = _rollups(spark, sf).where(F.col("rollup").isin(*combined))
    kind = F.when(F.col("rollup") == combined[0], "jurisdictions").otherwise("source_names")
    return rows.select(kind.alias("kind"), "value", "group_count")


@query(
    "dup_totals",
    f"""WITH {CONTEXT}
SELECT count(DISTINCT gid) AS duplicate_group_count, count(DISTINCT document_id) AS document_count
FROM m JOIN g USING (so, signal, v) JOIN ctx USING (ord)""",
)
def dup_totals(spark, sf):
    return audit.totals(load(spark, sf, "docs"))
