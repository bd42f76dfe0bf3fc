"""Joins with captured texts leave bucketed texts where they are, and keep blank keys out."""

import pytest

from lexcorpus.catalog import registry
from lexcorpus.operators import nim
from lexcorpus.sinks.texts import open_texts, store_texts

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def above_texts(df):
    """The names of the operators from each bucketed scan up to the join that reads it."""
    found = []

    def walk(node, above):
        name = node.nodeName()
        if name.startswith("Scan") and "Bucketed: true" in node.simpleString(1000):
            joins = [i for i, a in enumerate(above) if "Join" in a]
            found.append(above[joins[-1] if joins else 0 :])
        children = node.initialPlan() if name == "AdaptiveSparkPlan" else None
        below = [children] if children else [node.children().apply(i) for i in range(node.children().size())]
        for child in below:
            walk(child, [*above, name])

    walk(df._jdf.queryExecution().executedPlan(), [])
    return found


@pytest.mark.parametrize("name", ["eu_build", "nim_build", "non_eu_build", "nim_join_fulltext"])
def test_texts_are_not_dealt_anew(spark, no_broadcast, name):
    chains = above_texts(registry.QUERIES[name](spark, SF))
    assert chains and all(c[0] == "SortMergeJoin" and "Exchange" not in c for c in chains), chains


def test_blank_measures_meet_no_text(spark):
    measures = [(i, "", " ", None, f"m{i}") for i in range(50)] + [(90, "32014L0089", "", "1", "m"), (91, "", "72014L0089DNK_1", None, "n")]
    texts = [("", "", "", "lost")] * 50 + [("32014L0089", " ", "1", "one"), (None, "72014L0089DNK_1", "", "two"), ("32014L0089", "", "2", "no")]
    left = spark.createDataFrame(measures, "ord long, celex string, nim_celex string, national_measure_id string, nim_title string")
    right = spark.createDataFrame(texts, "celex string, nim_celex string, national_measure_id string, full_text_clean string")
    stored = store_texts(nim.with_merge_keys(right), nim.MERGE_KEYS, buckets=3)
    for joined in (nim.join_fulltext(left, right), nim.join_fulltext(left, stored, keyed=True)):
        rows = joined.collect()
        assert len(rows) == 52 and {r["ord"]: r["full_text_clean"] for r in rows if r["full_text_clean"]} == {90: "one", 91: "two"}
        assert {r["nim_title"] for r in rows} == {m[4] for m in measures}


def test_stored_texts_are_opened_again(spark, no_broadcast, tmp_path):
    texts = spark.createDataFrame([(str(i % 40), f"text {i}") for i in range(80)], "doc_key string, full_text string")
    store_texts(texts, ["doc_key"], 8, str(tmp_path / "t"))
    again = open_texts(spark, str(tmp_path / "t"), texts.schema, ["doc_key"], 8)
    keys = spark.createDataFrame([("1",), ("39",), ("x",)], "doc_key string")
    joined = keys.join(again, "doc_key", "left")
    assert sorted(r["full_text"] or "" for r in joined.collect()) == ["", "text 1", "text 39", "text 41", "text 79"]
    assert all("Exchange" not in c for c in above_texts(joined)) and above_texts(joined)
