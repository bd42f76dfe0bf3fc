"""Joins with captured measure texts move each key once, and buckets grow with the tables."""

from lexcorpus.catalog import inputs, measures
from lexcorpus.operators import nim
from lexcorpus.sinks.texts import store_texts

SF = "/root/testdata/sf0.001"


def test_buckets_grow_with_the_measures(spark, monkeypatch):
    monkeypatch.setattr(inputs, "_bucketed", {})
    monkeypatch.setattr(measures, "BUCKET_ROWS", 400)
    plan = measures.measure_texts(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 15 out of 15" in plan or "Bucketed: false" in plan
    described = dict(r[:2] for r in spark.sql(f"DESCRIBE EXTENDED {_only_table(spark, inputs)}").collect())
    assert described["Num Buckets"] == "15"


def _only_table(spark, module):
    (df,) = module._bucketed.values()
    files = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    tables = [t.name for t in spark.catalog.listTables() if t.name.startswith("texts_")]
    return next(t for t in tables if {f.rsplit("/", 1)[0] for f in spark.table(t).inputFiles()} == files)


def test_texts_are_made_from_dealt_rows(spark):
    seen = []

    def derive(dealt):
        seen.append(dealt._jdf.queryExecution().optimizedPlan().toString())
        return dealt.selectExpr("k", "repeat(k, 3) AS text")

    stored = store_texts(spark.range(20).selectExpr("cast(id AS string) AS k"), ["k"], 4, derive=derive)
    assert seen[0].startswith("RepartitionByExpression")
    assert sorted(r["text"] for r in stored.collect()) == sorted(str(i) * 3 for i in range(20))


def test_the_act_is_moved_once(spark):
    left = spark.range(30).selectExpr("id AS ord", "if(id % 3 = 0, '', '32014L0089') AS celex", "'' AS nim_celex",
                                      "if(id % 3 < 2, null, cast(id AS string)) AS national_measure_id", "'m' AS nim_title")
    right = spark.range(30).selectExpr("'32014L0089' AS celex", "'' AS nim_celex", "cast(id AS string) AS national_measure_id",
                                       "concat('t', id) AS full_text_clean")
    joined = nim.join_fulltext(left, right)
    assert joined.columns[:5] == left.columns
    rows = {r["ord"]: (r["celex"], r["full_text_clean"]) for r in joined.collect()}
    assert rows == {i: ("" if i % 3 == 0 else "32014L0089", f"t{i}" if i % 3 == 2 else None) for i in range(30)}
    moved = next(line for line in joined._jdf.queryExecution().optimizedPlan().toString().split("\n") if " AS _act#" in line)
    assert "celex#" not in moved.replace("nim_celex#", "").split(" AS _act#")[0].split("CASE")[0]
