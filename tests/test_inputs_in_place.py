"""Wide derived inputs are computed where they are read, with the columns that a query uses."""

from lexcorpus.catalog import inputs

SF = "/root/testdata/sf0.001"


def test_measures_and_documents_are_not_written(spark, monkeypatch):
    monkeypatch.setattr(inputs, "_written", {})
    assert inputs.load(spark, SF, "measures").groupBy("celex").count().count() > 0
    assert inputs.run(spark, SF, "SELECT ord, document_type FROM [[docs]]").count() > 0
    assert not inputs._written


def test_only_used_columns_are_read(spark):
    plan = inputs.load(spark, SF, "docs").select("ord", "document_type")._jdf.queryExecution().executedPlan().toString()
    assert "doc_id" in plan and "text" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_source_rows_are_dealt_before_they_are_derived(spark):
    wide = inputs.spread(spark, SF, "SELECT o_orderkey, repeat('x', 5000) AS body FROM [[orders]]")
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("body") < plan.index("RebalancePartitions") and "body" not in plan[plan.index("RebalancePartitions"):]
