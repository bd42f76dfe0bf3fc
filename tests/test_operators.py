"""Jobs on small tables: dedup, audit, skew, extraction, caches, builds, writers, streams."""

import json
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexcorpus import session
from lexcorpus.functions import markup
from lexcorpus.operators import audit, cache, dedup, extract, matching, nim, noneu, records, skew
from lexcorpus.plans import build
from lexcorpus.sinks import writers
from lexcorpus.sources import records as sources
from lexcorpus.streaming import ingest

DOC = (
    "ord long, document_id string, source_name string, title string, source_document_id string, "
    "jurisdiction string, publication_date string, url string, download_url string"
)


def docs(spark, rows):
    return spark.createDataFrame(rows, DOC)


def test_clean_keeps_what_it_changed(spark):
    df = spark.createDataFrame(
        [("d", "  Proposal\n for a Regulation\xa0", "Regulation", "EN", "eu", "2024", "23.07.2014")],
        "document_id string, title string, document_type string, language string, "
        "jurisdiction string, publication_date string, effective_date string",
    )
    row = records.clean(df, "EU").first()
    assert (row["document_type"], row["language"], row["jurisdiction"]) == (
        "eu_regulation", "en", "European Union")
    assert (row["publication_date"], row["_publication_date_precision"]) == ("2024-01-01", "year")
    assert row["_original_effective_date"] == "23.07.2014"
    assert row["_original_title"].startswith("  Proposal")


def test_audit_finds_variants_and_ranks_them(spark):
    rows = [
        (1, "a", "s", "Marine   Spatial PLANNING act", "32014L0089", "EU", "2014", "https://www.example.org/legal/doc?b=2&a=1#f", None),
        (2, "b", "s", " marine spatial planning Act ", " 32014l0089 ", "EU", "2014", "https://example.org/legal/doc?a=1&b=2", None),
        (3, "c", "t", "Other title of a document", None, "UK", None, "https://example.org/other", None),
    ]
    got = audit.duplicate_rows(docs(spark, rows)).collect()
    assert {r["signal"] for r in got} == {"celex", "normalized_title", "normalized_url", "source_document_id"}
    assert {r["document_id"] for r in got} == {"A", "B"}
    assert {r["duplicate_group_id"] for r in got} == {f"dup-00000{i}" for i in range(1, 5)}


def test_audit_score(spark):
    title = "Shared Marine Planning Policy"
    rows = [
        (1, "x", "source-a", title, None, "United Kingdom", "2020-01-01", None, None),
        (2, "y", "source-b", title, None, "Canada", "2021-01-01", None, None),
        (3, "z", "source-b", title, None, "Canada", "2021-01-01", None, None),
    ]
    row = audit.group_summary(docs(spark, rows)).first()
    assert (row["group_size"], row["review_interest_score"], row["review_rank"]) == (3, 9, 1)
    assert row["jurisdictions"] == "Canada | United Kingdom"
    members = {r["document_id"] for r in audit.group_members(docs(spark, rows)).collect()}
    assert members == {"X", "Y", "Z"}


def test_audit_names_every_member_of_a_large_group(spark):
    rows = [
        (i, f"d{i}", "s", "One title of very many documents", None, "EU", None, None, None)
        for i in range(1500)
    ]
    members = audit.group_members(docs(spark, rows))
    assert members.count() == members.select("document_id").distinct().count() == 1500
    assert audit.group_summary(docs(spark, rows)).first()["group_size"] == 1500


def test_audit_of_unique_documents_is_empty(spark):
    rows = [(1, "a", "s", "t", None, "EU", None, None, None), (2, "b", "s", "u", None, "EU", None, None, None)]
    assert audit.duplicate_rows(docs(spark, rows)).count() == 0
    assert audit.group_summary(docs(spark, rows)).count() == 0


def test_join_sized_with_a_hot_key(spark):
    facts = spark.range(3000).select(
        F.col("id").alias("row"), F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 50).alias("k")
    )
    dims = facts.groupBy("k").agg(F.count("*").alias("n"))
    joined = skew.join_sized(facts, dims, ["k"])
    assert joined.count() == 3000
    plain = facts.join(dims, "k")
    assert joined.select("row", "k", "n").exceptAll(plain.select("row", "k", "n")).count() == 0


@pytest.mark.parametrize("partitions", ["1", "64"])
def test_numbering_does_not_depend_on_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(500).select((F.col("id") * 7919 % 500).alias("v"), (F.col("id") % 3).alias("g"))
        rows = skew.number_rows(df, [F.col("v")], "no").collect()
        assert all(r["no"] == r["v"] + 1 for r in rows)
        inside = skew.number_within(df, ["g"], [F.col("v")], "no").collect()
        for g in range(3):
            mine = sorted((r["v"], r["no"]) for r in inside if r["g"] == g)
            assert [n for _, n in mine] == list(range(len(mine)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", None])), min_size=1, max_size=20))
def test_keep_first_is_python_first(spark, keys):
    rows = [(i, k, v) for i, (k, v) in enumerate(keys)]
    df = spark.createDataFrame(rows, "ord long, k string, v string").repartition(5)
    want, seen = set(), set()
    for i, k, v in rows:
        if (k, v) not in seen:
            seen.add((k, v))
            want.add(i)
    assert {r["ord"] for r in dedup.keep_first(df, ["k", "v"]).collect()} == want
    assert {r["ord"] for r in dedup.keep_first_narrow(df, ["k", "v"]).collect()} == want


def test_match_queries(spark):
    rows = [("doc-1", '["Energy security "]'), ("doc-2", "other"), ("doc-3", None)]
    df = spark.createDataFrame(rows, "id string, queries string")
    got = matching.match_queries(df, matching.inline_queries(["energy security", "x"])).collect()
    assert Counter((r["id"], r["query_text"]) for r in got) == Counter(
        [("doc-1", "energy security"), ("doc-3", "energy security"), ("doc-3", "x")]
    )


def test_hits_become_documents(spark):
    hits = spark.createDataFrame(
        [
            (0, "EU", "ALL_ALL", "en", "planning", "Directive", "32014L0089", "2014-07-23", "u"),
            (1, "EU", "ALL_ALL", "fr", "repair", "Directive Example", "32014L0089", "", "u"),
            (2, "EU", "ALL_ALL", "fr", "repair", "Directive Samples", "32014L0089", "", "u"),
            (3, "EU", "ALL_ALL", "en", "planning", "Measure", "732014L0089DNK_1", "", "u"),
        ],
        "ord long, source string, scope string, lang string, term_group string, title string, "
        "celex string, date string, url string",
    )
    texts = spark.createDataFrame(
        [("32014L0089", "32014L0089", "", "CACHE", "  ", "Article  1", 200)],
        "celex_full string, celex string, celex_version string, text_source_url string, "
        "full_text_clean string, full_text_raw string, retrieval_status int",
    )
    row = build.eu_documents(hits, texts, "eurlex-source").collect()
    assert len(row) == 1
    assert row[0]["document_id"] == "eurlex-source:EU:32014L0089"
    assert row[0]["title"] == "Directive Example" and row[0]["full_text"] == "Article 1"
    raw = json.loads(row[0]["raw_record"])
    assert raw["query_langs"] == ["en", "fr"] and raw["fulltext_support"] == "supported"
    assert "date" not in raw


def test_measure_record(spark):
    df = spark.createDataFrame(
        [(0, "32014L0089", "Directive", "72014L0089DNK_270540", "270540", "DNK", "Denmark", "dan", "da", "Lov", "2016-06-01")],
        "ord long, celex string, eu_act_title string, nim_celex string, national_measure_id string, "
        "member_state_iso3 string, member_state_name string, available_expr_langs3 string, "
        "nim_title_lang string, nim_title string, nim_date string",
    )
    row = nim.to_records(nim.enrich(df), "eurlex-nim-source").first()
    assert row["document_id"] == "eurlex-nim-source:NIM:DNK:270540"
    assert (row["jurisdiction"], row["language"]) == ("Denmark", "da")
    assert row["nim_resource_uri"].endswith("/nim/270540")


def test_non_eu_record_types(spark):
    df = spark.createDataFrame(
        [("k", "", "True", "18", "2024", '["biodiversity"]', "UK")],
        "doc_id string, title string, has_text string, text_len string, year string, "
        "matched_terms string, source string",
    )
    raw = json.loads(noneu.to_records(df, "uk").first()["raw_record"])
    assert (raw["has_text"], raw["text_len"], raw["year"], raw["matched_terms"]) == (True, 18, 2024, ["biodiversity"])


def test_cache_states(spark):
    log = cache.conform(
        spark.createDataFrame(
            [(0, "A", "en", "x" * 600, "200", None, "t1"), (1, "B", "en", "", "404", "bad", "t1"), (2, "B", "en", "", "404", "3", "t2")],
            "ord long, celex_full string, lang string, text string, retrieval_status string, text_len string, timestamp string",
        )
    )
    files = spark.createDataFrame(
        [("C", "C", "", 700, "/c", True)],
        "celex_full string, celex string, celex_version string, file_text_len int, text_path string, file_exists boolean",
    )
    wanted = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "celex_full string")
    states = {r["celex_full"]: r["cache_state"] for r in cache.state(wanted, log, files).collect()}
    assert states == {"A": "successful", "B": "failed", "C": "successful", "D": "pending"}
    left = cache.worklist(wanted, cache.state(wanted, log, files), retry_failures=False)
    assert [r["celex_full"] for r in left.collect()] == ["D"]


def test_page_reader():
    page = (
        "<html><head><title>My &amp; title</title><style>p{}</style></head><body><p>One<br>two"
        "<!-- no --><script>var t='</p>';</script><noscript>hidden<a href='/n.pdf'>n</a></noscript>"
        "<svg><text>pic</text></svg><h1 class='title'>A heading that is long enough</h1>"
        "<meta name='DC.title' content='meta'><a href='b.html#x'> link <b>text</b></a>"
    )
    read = markup.read_page(page, "https://e.org/a/c.html")
    assert read["text_visible"] == "My & title One two A heading that is long enough link text"
    assert read["text_plain"] == "My & title One two pic A heading that is long enough link text"
    assert [x["url"] for x in read["links"]] == ["https://e.org/n.pdf", "https://e.org/a/b.html#x"]
    assert read["links"][1]["label"] == "link text"
    assert read["metas"] == [{"name": "DC.title", "property": "", "content": "meta"}]


def test_legislation_text(spark):
    xml = "<L xmlns='u'><Metadata>m<a>n</a></Metadata>t<Body><P>one</P> two<Contents>c</Contents>three</Body></L>"
    df = spark.createDataFrame([(1, xml), (2, "<broken"), (3, None)], "ord long, body string")
    assert {r["ord"]: r["text"] for r in extract.legislation_texts(df).collect()} == {1: "t one two three", 2: "", 3: ""}


def test_download_ranking(spark):
    body = json.dumps(
        {
            "data": {"attributes": {"fileFormats": [{"fileUrl": "u.pdf", "format": "pdf"}, {"fileUrl": "u.htm", "format": "htm"}]}},
            "included": [{"type": "attachments", "attributes": {"title": "A", "docOrder": 1, "fileFormats": [{"fileUrl": "a.pdf", "format": "pdf"}]}}],
        }
    )
    df = extract.us_detail(spark.createDataFrame([(1, body)], "ord long, body string"))
    got = [r["file_url"] for r in extract.us_downloads(df, "ord").orderBy("rank").collect()]
    assert got == ["u.htm", "u.pdf", "a.pdf"]


def test_broken_search_answer_gives_no_hits(spark):
    df = spark.createDataFrame([(1, "<searchResults><result>")], "ord long, body string")
    assert extract.parse_hits(df).count() == 0


def test_record_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"records": [{"id": "1", "title": "t", "queries": ["q"]}]}))
    (tmp_path / "b.json").write_text(json.dumps([{"id": "2", "title": "u"}]))
    (tmp_path / "c.jsonl").write_text('{"id": "3", "title": "v"}\n\n')
    (tmp_path / "bad.jsonl").write_text('{"id": "3"\n')
    got = sources.read_records(spark, str(tmp_path / "a.json"), "json").first()
    assert got["queries"] == '["q"]'
    assert sources.read_records(spark, str(tmp_path / "b.json"), "json").count() == 1
    assert sources.read_records(spark, str(tmp_path / "c.jsonl")).count() == 1
    with pytest.raises(Exception):
        sources.read_records(spark, str(tmp_path / "bad.jsonl")).collect()


def test_inventory(spark, tmp_path):
    (tmp_path / "q.txt").write_text("# head\ncritical infrastructure\n\n energy security \n")
    got = sources.read_inventory(spark, str(tmp_path / "q.txt")).orderBy("query_id").collect()
    assert [(r["query_id"], r["text"]) for r in got] == [
        ("inventory-002", "critical infrastructure"), ("inventory-004", "energy security")]


def test_text_files(spark, tmp_path):
    (tmp_path / "32014L0089-2020.txt").write_text("x" * 10)
    got = sources.eu_files(sources.text_files(sources.read_text_files(spark, str(tmp_path)))).first()
    assert (got["celex"], got["celex_version"], got["file_text_len"]) == ("32014L0089", "2020", 10)


def test_stored_tables_and_logs(spark, tmp_path):
    (tmp_path / "t.csv").write_text('celex,text\n32014L0089,"two\nlines ""quoted"""\n')
    schema = spark.createDataFrame([], "celex string, text string").schema
    rows = sources.read_table(spark, str(tmp_path / "t.csv"), schema)
    assert rows.first()["text"] == 'two\nlines "quoted"'
    first = writers.replace_log(rows, str(tmp_path / "log"), 1)
    writers.replace_log(spark.read.parquet(first), str(tmp_path / "log"), 2)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    with pytest.raises(Exception):
        writers.replace_log(rows, str(tmp_path / "log"), 1)
    ordered = sources.with_order(spark.createDataFrame([("b",), ("a",)], "id string"), ["id"])
    assert {r["id"]: r["ord"] for r in ordered.collect()} == {"a": 0, "b": 1}
    (tmp_path / "txt").mkdir()
    (tmp_path / "txt" / "270540.txt").write_text("abc")
    files = sources.nim_files(sources.text_files(sources.read_text_files(spark, str(tmp_path / "txt"))))
    assert files.first()["cache_key"] == "270540"


def test_whole_run(spark, tmp_path):
    base = docs(
        spark,
        [
            (0, "eu:1", "eu", "Maritime planning directive", "32014L0089", None, "2014", "https://www.e.org/a?x=1&y=2#f", None),
            (1, "eu:2", "eu", "Maritime planning directive", "52022AR4206", None, None, "https://e.org/a?y=2&x=1", None),
            (2, "eu:1", "eu", "again", None, None, None, None, None),
        ],
    ).withColumn("full_text", F.lit("text"))
    uk = docs(spark, [(0, "uk:1", "uk", "Act", None, None, "2024", None, None)]).withColumn("full_text", F.lit(None).cast("string"))
    measures = spark.createDataFrame(
        [(0, "32014L0089", "72014L0089DNK_1", "1", "DNK", "Denmark", "Lov")],
        "ord long, celex string, nim_celex string, national_measure_id string, member_state_iso3 string, member_state_name string, nim_title string",
    )
    out = str(tmp_path / "out")
    manifest = build.run_corpus({"EU": base, "UK": uk}, out, ["planning"], measures)
    assert (manifest["merged_document_count"], manifest["final_document_count"]) == (4, 3)
    assert (manifest["nim_status"], manifest["nim_eligible_seed_count"], manifest["nim_document_count"]) == ("ran", 1, 1)
    final = spark.read.json(f"{out}/final")
    assert final.count() == 3 and final.where("jurisdiction = 'United Kingdom'").count() == 1
    rows = spark.read.csv(f"{out}/audit/likely_duplicates_csv", header=True)
    assert {r["signal"] for r in rows.collect()} == {"normalized_url", "normalized_title"}
    stored = json.loads("\n".join(r["value"] for r in spark.read.text(f"{out}/run-manifest").collect()))
    assert stored["duplicates_removed"] == 1
    with pytest.raises(ValueError):
        build.run_corpus({"XX": base}, out, ["planning"])


def test_country_files(spark, tmp_path):
    df = spark.createDataFrame([("UK_GOVUK", ["a"]), ("AU", ["b"])], "source string, terms array<string>")
    writers.write_countries(df, str(tmp_path / "c"), "csv")
    assert {p.name for p in (tmp_path / "c").iterdir() if p.is_dir()} == {"country=UK", "country=Australia"}


def test_streams(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"document_id": "1", "title": " A  b "}\n{"document_id": "1", "title": "c"}\n')
    query = (
        ingest.clean_documents(ingest.read_documents(spark, str(folder)), "EU")
        .writeStream.format("memory").queryName("cleaned").outputMode("append").start()
    )
    query.processAllAvailable()
    query.stop()
    assert [r["document_id"] for r in spark.sql("select * from cleaned").collect()] == ["1"]
    schema = "ord long, celex_full string, lang string, text string, retrieval_status string, text_len string, timestamp string"
    log = tmp_path / "log"
    log.mkdir()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(log))
    (log / "1.json").write_text('{"ord": 5, "celex_full": "A", "lang": "en", "text": "old"}\n')
    query = ingest.keep_log(stream, str(tmp_path / "state")).option(
        "checkpointLocation", str(tmp_path / "check")).start()
    query.processAllAvailable()
    (log / "2.json").write_text('{"ord": 1, "celex_full": "A", "lang": "en", "text": "new"}\n')
    query.processAllAvailable()
    query.stop()
    assert [r["text"] for r in ingest.newest_log(spark, str(tmp_path / "state"), 1).collect()] == ["new"]


def test_shared_folder_follows_the_session(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_without_a_shared_folder_jobs_fail():
    class Session:
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session)


def test_rows_without_a_key_stay_out_of_the_join(spark):
    rows = spark.createDataFrame([(1, ""), (2, None), (3, "a"), (4, "b")], "ord long, k string")
    facts = spark.createDataFrame([("", "x"), ("a", "y")], "k string, v string")
    got = {r["ord"]: r["v"] for r in nim._join_known(rows, facts, "k").collect()}
    assert got == {1: None, 2: None, 3: "y", 4: None}


def test_one_row_per_key_with_missing_values(spark):
    rows = [(1, "a", None), (2, "a", None), (3, None, None), (4, None, None), (5, "b", 2), (6, "b", 9), (7, "c", 1)]
    df = spark.createDataFrame(rows, "ord long, k string, size int")
    ids = lambda x: sorted(r["ord"] for r in x.collect())
    assert ids(dedup.keep_first(df, ["k"])) == [1, 3, 5, 7]
    assert ids(dedup.keep_last(df, ["k"])) == [2, 4, 6, 7]
    assert ids(dedup.keep_best(df, ["k"], [-F.col("size")])) == [2, 4, 5, 7]


def test_stacked_tables_of_different_kinds(spark):
    parts = [spark.createDataFrame([(1, 200)], "ord long, status int"), spark.createDataFrame([(2, "ok")], "ord long, status string")]
    assert [r["status"] for r in dedup.merge_sources(parts).orderBy("ord").collect()] == ["200", "ok"]


@pytest.mark.parametrize("cap", [3, dedup.GROUP_LIMIT + 1])
def test_caps_are_the_same_on_both_sides_of_the_limit(spark, cap):
    df = spark.range(3 * cap).select(F.col("id").alias("ord"), (F.col("id") % 2).alias("k"))
    got = dedup.cap_per_key(df, ["k"], [F.col("ord")], cap)
    assert sorted(r["ord"] for r in got.collect()) == list(range(2 * cap))


def test_documents_as_json_nest_their_record(spark, tmp_path):
    df = spark.createDataFrame([("d", "q1", 4, '{"a": {"b": [1, 2]}}')], "document_id string, _query_id string, _adapter_result_index long, raw_record string")
    writers.write_documents(df, str(tmp_path / "out"))
    (row,) = [json.loads(x.read_text()) for x in (tmp_path / "out").glob("part-*") if x.stat().st_size]
    assert row["raw_metadata"] == {"_query_id": "q1", "_adapter_result_index": 4, "raw_record": {"a": {"b": [1, 2]}}}


def test_matrix_of_states_and_acts(spark):
    rows = [("A", "First", "Austria", "1"), ("A", "First", "Austria", "2"), ("A", "First", "Belgium", "3"), ("B", "Same", "Austria", "4")]
    rows += [("C", "Same", "Spain", str(i)) for i in range(5)] + [("C", "Same", "Nowhere", "9"), ("D", None, "Sweden", None)]
    measures = spark.createDataFrame(rows, "celex string, eu_act_title string, member_state_name string, national_measure_id string")
    measures = measures.selectExpr("*", "'L' AS eu_act_type", "2000 AS year", "monotonically_increasing_id() AS ord")
    table = nim.country_act_table(measures, 3)
    assert table.columns == ["member_state", "Same (C)", "First", "Same (B)"]
    assert sorted(map(tuple, table.collect())) == [("Austria", 0, 2, 1), ("Belgium", 0, 1, 0), ("Spain", 5, 0, 0)]
    assert nim.country_act_table(measures, 3, named=False).columns == ["member_state", "act_1", "act_2", "act_3"]
    assert nim.country_act_table(measures.limit(0), 3).count() == 0


def test_corpus_run_counts_while_writing(spark, tmp_path, monkeypatch):
    docs = [(i, f"d{i % 8}", "s", f"t{i}", "text" if i % 2 else " ") for i in range(10)]
    part = spark.createDataFrame(docs, "ord long, document_id string, source_name string, title string, full_text string")
    read = []
    plain = type(part).count
    monkeypatch.setattr(type(part), "count", lambda self: read.append(1) or plain(self))
    made = build.run_corpus({"UK": part, "CA": part.limit(0)}, str(tmp_path), ["nature"])
    assert read == []
    by_code = {j["jurisdiction_code"]: (j["document_count"], j["full_text_document_count"]) for j in made["jurisdictions"]}
    assert by_code == {"UK": (10, 5), "CA": (0, 0)}
    assert (made["merged_document_count"], made["final_document_count"], made["duplicates_removed"]) == (10, 8, 2)
    assert spark.read.parquet(f"{tmp_path}/work/final").select("document_id").distinct().count() == 8
