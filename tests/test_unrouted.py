from __spark_entry__ import queries


def test_sources_are_counted_before_any_record_is_made(spark):
    rest = queries()["corpus_unrouted"](spark, "/root/testdata/sf0.001")
    plan = rest._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan and "to_json" not in plan
    assert [(r["source"], r["documents"] > 0) for r in rest.collect()] == [("Norway", True)]
