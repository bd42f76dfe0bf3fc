"""National implementing measures of EU acts: eligible acts, metadata, roll-ups, records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexcorpus import lookups as L
from lexcorpus import schemas
from lexcorpus.functions import celex, langs
from lexcorpus.functions.text import blank_to_null, empty, strip, text_or_empty
from lexcorpus.operators.dedup import keep_best, ordered_distinct
from lexcorpus.session import written

RESOURCE = "http://publications.europa.eu/resource/nim/"
SCORES = (
    "ecological_ambition_score", "design_specificity_score", "governance_gap_score",
    "renewables_alignment_score",
)
# fixed values: names of the columns of captured rows
RAW_TEXTS = (
    "celex", "eu_act_title", "eu_act_type", "nim_celex", "national_measure_id", "nim_title",
    "nim_title_notice", "nim_title_lang", "nim_date", "member_state_iso3", "member_state_name",
    "available_expr_langs3", "available_langs", "available_languages", "eurlex_url",
    "nim_resource_uri", "text_source_url", "text_path", "html_path", "route_used",
    "text_route_used", "content_type", "source_format", "retrieval_error", "lang_detected",
    "lang_source", "cache_key",
)
RAW_OTHER = ("year", "retrieval_status", "fetch_seconds", "fetched_from_cache")
MEASURE_TEXTS = (
    "nim_title", "nim_title_lang", "available_expr_langs3", "member_state_iso3", "eurlex_url",
    "national_measure_id", "nim_celex", "cellar_uri", "nim_resource_uri",
)


def seed_references(docs: DataFrame) -> DataFrame:
    """What each EU document says it is: its own identifier, or the one in its raw record."""
    raw = F.col("raw_record") if "raw_record" in docs.columns else F.lit(None).cast("string")
    field = lambda k: blank_to_null(F.get_json_object(raw, f"$.{k}"))
    reference = F.coalesce(
        blank_to_null(F.col("source_document_id")), field("celex_full"), field("celex")
    )
    return docs.select("ord", reference.alias("reference"))


def seeds(references: DataFrame) -> DataFrame:
    """Eligible act identifiers among references, each with its first position."""
    act = references.select("ord", celex.eligible_act(F.col("reference")).alias("celex"))
    return ordered_distinct(act.where(F.col("celex").isNotNull()), "celex")


def eligible_acts(docs: DataFrame) -> DataFrame:
    """One row per eligible act: the shortest title, then the highest governance score, then
    the first in input order."""
    docs = schemas.with_missing(docs, SCORES, kind="double")
    act = F.col("celex")
    rows = docs.withColumn("celex", celex.eligible_act(act)).where(act.isNotNull())
    has_score = F.col("governance_gap_score").isNotNull()
    pick = F.min_by(
        F.struct("title", *SCORES),
        F.struct(
            F.length(F.coalesce(F.col("title"), F.lit("None"))),
            (~has_score).cast("int"),
            -F.coalesce("governance_gap_score", F.lit(0.0)),
            F.col("ord"),
        ),
    )
    best = rows.groupBy("celex").agg(pick.alias("p"))
    return best.select(
        "celex",
        F.col("p.title").alias("eu_act_title"),
        celex.descriptor_label(F.lit("3"), celex.act_descriptor(act)).alias("eu_act_type"),
        celex.act_descriptor(act).alias("descriptor"),
        celex.act_year(act).alias("year"),
        *[F.col(f"p.{s}").alias(s) for s in SCORES],
    )


def with_merge_keys(df: DataFrame) -> DataFrame:
    """Act identifier in legal-act form, and trimmed measure identifiers."""
    if "celex" not in df.columns and "act_celex" in df.columns:
        df = df.withColumn("celex", F.col("act_celex"))
    df = schemas.with_missing(df, ("celex", "nim_celex", "national_measure_id"), "")
    return df.withColumns(
        {
            "celex": F.coalesce(celex.legal_act(F.col("celex")), empty()),
            "nim_celex": text_or_empty(F.col("nim_celex")),
            "national_measure_id": text_or_empty(F.col("national_measure_id")),
        }
    )


def enrich(measures: DataFrame) -> DataFrame:
    """Resource address, languages and their sources of each measure."""
    df = schemas.with_missing(measures, MEASURE_TEXTS, "")
    df = df.withColumns({c: langs.optional(F.col(c)) for c in MEASURE_TEXTS})
    found = langs.detect(
        F.col("eurlex_url"), F.col("available_expr_langs3"), F.col("nim_title_lang"),
        F.col("member_state_iso3"),
    )
    df = df.withColumns(
        {
            "nim_title_notice": F.col("nim_title"),
            "nim_resource_uri": F.when(
                (F.col("nim_resource_uri") == "") & (F.col("national_measure_id") != ""),
                F.concat(F.lit(RESOURCE), F.col("national_measure_id")),
            ).otherwise(F.col("nim_resource_uri")),
            "available_langs": F.array_join(langs.langs2_of(F.col("available_expr_langs3")), ","),
            "_found": found,
        }
    )
    title_lang = langs.lang2(F.col("nim_title_lang"))
    return df.withColumns(
        {
            "lang_detected": F.col("_found.lang"),
            "lang_source": F.col("_found.source"),
            "nim_title_lang": F.when(title_lang == "", F.col("_found.lang")).otherwise(title_lang),
        }
    ).drop("_found")


def _join_known(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Left join on ``key``; rows without a key match nothing and are left out of the join, where
    they would all meet in one task."""
    known = F.coalesce(F.col(key) != "", F.lit(False))
    joined = rows.where(known).join(facts.where(known), key, "left")
    return joined.unionByName(rows.where(~known), allowMissingColumns=True)


def fill_from_cache(measures: DataFrame, cache: DataFrame) -> DataFrame:
    """Fill blank titles and languages from the best cached row of the same measure: the
    longest text, then the newest, then the first."""
    cols = (
        "nim_title", "page_title", "page_title_lang", "lang_detected", "lang_source",
        "available_languages",
    )
    cache = schemas.with_missing(cache, ("nim_celex", *cols), "")
    cache = cache.withColumns({c: langs.optional(F.col(c)) for c in ("nim_celex", *cols)})
    best = keep_best(
        cache.withColumn("_back", -F.col("ord")),
        ["nim_celex"], [F.col("text_len"), F.col("timestamp")], "_back",
    )
    best = best.select("nim_celex", *[F.col(c).alias(f"_c_{c}") for c in cols])
    df = _join_known(measures, best, "nim_celex")
    fill = lambda c, *froms: F.coalesce(
        *[F.nullif(strip(F.col(x)), empty()) for x in (c, *[f"_c_{f}" for f in froms])], empty()
    )
    filled = {
        "nim_title": fill("nim_title", "nim_title", "page_title"),
        "nim_title_lang": fill("nim_title_lang", "page_title_lang"),
        "lang_detected": fill("lang_detected", "lang_detected"),
        "lang_source": fill("lang_source", "lang_source"),
        "available_langs": fill("available_langs", "available_languages"),
    }
    return df.withColumns(filled).drop(*[f"_c_{c}" for c in cols])


def fill_from_page(measures: DataFrame, pages: DataFrame) -> DataFrame:
    """Fill what is still blank, and weakly known languages, from the measure's own page record
    (``page_title``, ``page_title_lang``, ``page_langs``), matched by resource address."""
    one = pages.groupBy("nim_resource_uri").agg(
        *[F.min_by(c, "ord").alias(f"_p_{c}") for c in ("page_title", "page_title_lang", "page_langs")]
    )
    df = _join_known(measures, one, "nim_resource_uri")
    weak = F.col("lang_source").isin("country_fallback", "default_en")
    probe = F.col("_p_page_title").isNotNull() & (
        (F.col("nim_title") == "") | (F.col("available_langs") == "") | weak
    )
    got = lambda c: langs.optional(F.col(f"_p_{c}"))
    blank = lambda c, v: F.when(probe & (F.col(c) == ""), v).otherwise(F.col(c))
    page_lang = F.coalesce(
        F.nullif(got("page_title_lang"), empty()), F.split(got("page_langs"), ",", -1)[0]
    )
    better = probe & weak & (page_lang != "")
    out = df.withColumns(
        {
            "nim_title": blank("nim_title", got("page_title")),
            "nim_title_lang": blank("nim_title_lang", got("page_title_lang")),
            "available_langs": blank("available_langs", got("page_langs")),
            "lang_detected": F.when(better, page_lang).otherwise(F.col("lang_detected")),
            "lang_source": F.when(better, "page_metadata").otherwise(F.col("lang_source")),
        }
    )
    return out.drop("_p_page_title", "_p_page_title_lang", "_p_page_langs")


MERGE_KEYS = ("celex", "nim_celex", "national_measure_id")


def join_fulltext(measures: DataFrame, texts: DataFrame, keyed: bool = False) -> DataFrame:
    """Left join of measure texts on act, measure identifier and measure number; where both
    tables have a column the text table's value wins if it is present. Rows whose keys are all blank
    match nothing. ``keyed`` texts come from ``with_merge_keys`` and stay in the buckets they are in."""
    left, right = with_merge_keys(measures), texts if keyed else with_merge_keys(texts)
    kinds = dict(right.dtypes)
    cols = [c for c in right.columns if c not in MERGE_KEYS and c != "ord"]
    # blank measures get a key of their own each: no text has it, and no task gets them all
    alone = F.concat(F.lit("\0"), F.xxhash64(*left.columns).cast("string"))
    left = left.withColumn("_act", F.when(F.concat(*MERGE_KEYS) == "", alone).otherwise(F.col("celex")))
    own = F.when(F.startswith(F.col("_act"), F.lit("\0")), empty()).otherwise(F.col("_act"))
    order = left.drop("_act").columns
    joined = left.drop("celex").join(  # read back from the key, not moved beside it
        right.select(
            F.col("celex").alias("_act"), *MERGE_KEYS[1:], *[F.col(c).alias(f"_t_{c}") for c in cols]
        ),
        ["_act", *MERGE_KEYS[1:]],
        "left",
    ).withColumn("celex", own)
    joined = joined.select(*order, *[f"_t_{c}" for c in cols])
    present = lambda c: (
        F.when(strip(F.col(f"_t_{c}")) != "", F.col(f"_t_{c}"))
        if kinds[c] == "string" else F.col(f"_t_{c}")
    )
    merged = {
        c: F.coalesce(present(c), F.col(c)) if c in left.columns else F.col(f"_t_{c}") for c in cols
    }
    return joined.withColumns(merged).drop(*[f"_t_{c}" for c in cols])


def to_records(measures: DataFrame, source_name: str) -> DataFrame:
    """Document columns and the raw record of national measures."""
    names = (
        "national_measure_id", "nim_celex", "nim_title", "nim_title_notice", "eurlex_url",
        "member_state_name", "member_state_iso3", "lang", "nim_title_lang", "nim_date",
        "nim_resource_uri", "text_source_url", "source_url", "full_text_clean", "full_text_raw",
        "text_path", "celex", "eu_act_title", "eu_act_type", "retrieved_at",
    )
    df = schemas.with_missing(measures, names)
    df = schemas.with_missing(df, (*RAW_TEXTS, *RAW_OTHER))
    raw = F.to_json(
        F.struct(*[blank_to_null(F.col(c)).alias(c) for c in RAW_TEXTS], *RAW_OTHER)
    )
    t = lambda c: blank_to_null(F.col(c))
    number = F.coalesce(t("national_measure_id"), t("nim_celex"))
    captured = F.coalesce(t("text_source_url"), t("source_url"))
    link = F.coalesce(t("eurlex_url"), t("nim_resource_uri"))
    about = F.lit("National implementation measure for ")
    return df.withColumns(
        {
            "raw_record": raw,
            "document_id": F.concat(
                F.lit(f"{source_name}:NIM:"),
                F.coalesce(t("member_state_iso3"), F.lit("UNK")),
                F.lit(":"),
                F.coalesce(number, F.lit("unknown")),
            ),
            "source_document_id": number,
            "title": F.coalesce(t("nim_title"), t("nim_title_notice"), number, t("eurlex_url")),
            "summary": F.when(
                t("celex").isNotNull() | t("eu_act_title").isNotNull(),
                F.concat(about, F.concat_ws(": ", t("celex"), t("eu_act_title"))),
            ),
            "document_type": F.lit("national_implementation_measure"),
            "language": F.coalesce(t("lang"), t("nim_title_lang")),
            "jurisdiction": F.coalesce(t("member_state_name"), t("member_state_iso3")),
            "publication_date": t("nim_date"),
            "effective_date": F.lit(None).cast("string"),
            "url": link,
            "download_url": F.coalesce(F.when(captured != "CACHE", captured), link),
            "full_text": F.coalesce(t("full_text_clean"), t("full_text_raw")),
            "content_path": t("text_path"),
        }
    )


# ---- roll-ups --------------------------------------------------------------------------


def act_summary(measures: DataFrame) -> DataFrame:
    """Member states, measures and mean scores per act."""
    df = schemas.with_missing(measures, SCORES, kind="double")
    return df.groupBy("celex", "eu_act_title", "eu_act_type", "year").agg(
        F.countDistinct(F.nullif("member_state_name", empty())).alias("member_states_with_measures"),
        F.countDistinct("national_measure_id").alias("total_national_measures"),
        F.avg("governance_gap_score").alias("mean_gap_score"),
        F.avg("ecological_ambition_score").alias("mean_ambition_score"),
        F.avg("design_specificity_score").alias("mean_design_score"),
    )


def member_states(spark) -> DataFrame:
    """The fixed list of member state names, one row each."""
    names = F.array(*[F.lit(n) for n in sorted(set(L.MEMBER_STATES.values()))])
    return spark.range(1).select(F.explode(names).alias("member_state"))


def country_summary(measures: DataFrame) -> DataFrame:
    """Acts and measures per member state; states without any count as zero."""
    counted = (
        measures.groupBy(F.col("member_state_name").alias("member_state"))
        .agg(
            F.countDistinct("celex").alias("acts"),
            F.countDistinct("national_measure_id").alias("measures"),
        )
    )
    states = member_states(measures.sparkSession)
    acts, total = F.coalesce("acts", F.lit(0)), F.coalesce("measures", F.lit(0))
    return counted.join(F.broadcast(states), "member_state", "right").select(
        "member_state",
        acts.alias("acts_with_measures"),
        total.alias("total_national_measures"),
        F.when(F.col("acts").isNull(), F.lit(0.0))
        .otherwise(total / F.greatest(acts, F.lit(1)))
        .alias("average_measures_per_act"),
    )


def top_acts(measures: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` acts with most measures, numbered from 1. An act that is listed with several
    titles, types or years counts once, with those that most measures have."""
    total, states = -F.col("total_national_measures"), -F.col("member_states_with_measures")
    variant = F.struct(
        total.alias("total"), states.alias("states"), "eu_act_title", "eu_act_type", "year"
    )
    best = act_summary(measures).groupBy("celex").agg(F.min(variant).alias("a"))
    top = best.orderBy("a.total", "a.states", "celex").limit(k)
    rank = F.struct("a.total", "a.states", "celex", "a.eu_act_title")
    listed = top.agg(F.array_sort(F.collect_list(rank)).alias("l"))  # k rows
    return listed.select(F.posexplode("l").alias("pos", "a")).select(
        (F.col("pos") + 1).alias("act_rank"), F.col("a.celex").alias("celex"),
        F.coalesce("a.eu_act_title", "a.celex").alias("act_display"),
    )


def country_act_matrix(measures: DataFrame, k: int = 10) -> DataFrame:
    """Distinct measures per member state and top act, one row for each pair that has any.
    ``act_place`` is the place of the act's column: most measures over all states first."""
    top = F.broadcast(top_acts(measures, k).select("celex", "act_display"))
    known = F.broadcast(member_states(measures.sparkSession))
    cells = written(
        measures.join(top, "celex")
        .groupBy(F.col("member_state_name").alias("member_state"), "celex", "act_display")
        .agg(F.countDistinct("national_measure_id").alias("measures"))
        .where("measures > 0")
        .join(known, "member_state", "left_semi")
    )
    totals = cells.groupBy("celex").agg(F.sum("measures").alias("total"))  # k rows
    place = F.row_number().over(Window.orderBy(F.col("total").desc(), "celex"))
    return cells.join(F.broadcast(totals.select("celex", place.alias("act_place"))), "celex")


def country_act_table(measures: DataFrame, k: int = 10, named: bool = True) -> DataFrame:
    """The matrix itself: a row for each member state with any measure of the top acts, a column for
    each of them, most measures first, 0 where there is none. Columns have the acts' titles, with
    the identifier where two share one; without ``named`` they are act_1 to act_k."""
    cells = country_act_matrix(measures, k)
    acts = cells.select("act_place", "celex", "act_display").distinct().orderBy("act_place").collect()  # k rows
    shown = [a["act_display"] for a in acts]
    titles = [t if shown.count(t) == 1 else f"{t} ({a['celex']})" for t, a in zip(shown, acts, strict=True)]
    places = [a["act_place"] for a in acts] if named else list(range(1, k + 1))
    table = cells.groupBy("member_state").pivot("act_place", places).agg(F.sum("measures"))
    names = titles if named else [f"act_{i}" for i in places]
    zero = lambda i: F.coalesce(F.col(f"`{i}`"), F.lit(0))
    return table.select("member_state", *[zero(i).alias(n) for i, n in zip(places, names, strict=True)])


def country_counts(measures: DataFrame) -> DataFrame:
    """Measures per act and member state, missing states included."""
    return measures.groupBy("celex", F.col("member_state_name").alias("member_state")).agg(
        F.count("*").alias("number_of_national_measures")
    )
