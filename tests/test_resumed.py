"""Resumed documents: a text is cleaned once, however many documents share its identifier."""

from lexcorpus.operators import cache, dedup


def test_texts_are_cleaned_before_they_meet_the_documents(spark):
    docs = spark.range(40).selectExpr("id AS ord", "'32014L0089' AS celex_full", "'' AS lang")
    states = spark.createDataFrame(
        [("32014L0089", "32014L0089", "", "successful", " fr ", 200, "", " ", f"/{i}.txt") for i in range(3)]
        + [("32014L0091", "32014L0091", "", "successful", "", 200, "", "", "/2.txt")],
        "celex_full string, celex string, celex_version string, cache_state string, lang string, "
        "retrieval_status int, retrieval_error string, source_url string, text_path string",
    )
    texts = spark.createDataFrame([("/0.txt", " a \r\n b"), ("/1.txt", "  "), ("/2.txt", "c"), ("/2.txt", None)],
                                  "text_path string, text string")
    rows = cache.resumed(docs, states, texts)
    got = sorted((r["ord"], r["full_text_clean"], r["text_len"], r["lang"], r["text_source_url"]) for r in rows.collect())
    assert got == sorted((i, t, len(t), "fr", "CACHE") for i in range(40) for t in ("a\nb", "c"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("regexp_replace") > plan.index("Generate explode") > plan.index("Join Inner")


def test_rows_are_held_against_their_keys_where_most_lose(spark, monkeypatch):
    names = []
    save = dedup.saved
    monkeypatch.setattr(dedup, "saved", lambda df, name: (names.append(name), save(df, name))[1])
    log = spark.range(300).selectExpr("id AS ord", "nullif(id % 4, 3) AS k", "if(id < 290, 'x', concat('y', id)) AS v")
    kept = dedup.keep_last(log, ["k", "v"])
    last = {(None if i % 4 == 3 else i % 4, "x" if i < 290 else f"y{i}"): i for i in range(300)}
    assert kept.columns == log.columns and {(r["k"], r["v"]): r["ord"] for r in kept.collect()} == last
    assert kept.count() == len(last) and names == ["best"]
    best = dedup.keep_best(log, ["k"], [(log.ord % 7)])
    assert {r["ord"] for r in best.collect()} == {
        max((i for i in range(300) if i % 4 == k), key=lambda i: (i % 7, i)) for k in range(4)}


def test_rows_of_a_text_come_together(spark, tmp_path):
    docs = spark.range(60).selectExpr("id AS ord", "concat('32014L00', id % 2) AS celex_full", "'' AS lang")
    states = spark.range(40).selectExpr(
        "concat('32014L00', id % 2) AS celex_full", "concat('32014L00', id % 2) AS celex", "'' AS celex_version",
        "'successful' AS cache_state", "'' AS lang", "200 AS retrieval_status", "'' AS retrieval_error", "'' AS source_url",
        "concat('/', id) AS text_path")
    texts = spark.range(40).selectExpr("concat('/', id) AS text_path", "repeat(sha2(string(id), 512), 40) AS text")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = cache.resumed(docs, states, texts)
        assert rows.columns[:4] == ["celex_full", "celex", "celex_version", "ord"]
        got = rows.coalesce(1).select("ord", "full_text_clean").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(set(got)) == len(got) == 60 * 20
    assert sum(a["full_text_clean"] != b["full_text_clean"] for a, b in zip(got, got[1:])) == 39


def test_tasks_follow_the_rows_that_they_make(spark, monkeypatch):
    docs = spark.range(90).selectExpr("id AS ord", "concat('32014L00', if(id < 60, 0, id % 3)) AS celex_full", "'' AS lang")
    states = spark.range(50).selectExpr(
        "concat('32014L00', if(id < 40, 0, id % 4)) AS celex_full", "concat('32014L00', if(id < 40, 0, id % 4)) AS celex",
        "'' AS celex_version", "'successful' AS cache_state", "'' AS lang", "200 AS retrieval_status", "'' AS retrieval_error",
        "'' AS source_url", "concat('/', id) AS text_path")
    texts = spark.range(49).selectExpr("concat('/', id) AS text_path", "concat('text ', id) AS text")
    want = sorted((r["ord"], r["full_text_clean"]) for r in cache.resumed(docs, states, texts).collect())
    ids = [0 if i < 60 else i % 3 for i in range(90)]
    assert want == sorted((i, f"text {t}") for i, k in enumerate(ids) for t in range(49) if k == (0 if t < 40 else t % 4))
    monkeypatch.setattr(cache, "ROWS", 100, raising=False)
    rows = cache.resumed(docs, states, texts)
    assert sorted((r["ord"], r["full_text_clean"]) for r in rows.collect()) == want
    parts = rows.selectExpr("spark_partition_id() AS p", "celex_full AS id").groupBy("p", "id").count().collect()
    assert len(parts) > 12 and max(r["count"] for r in parts if r["id"] == "32014L000") < len(want) / 3
