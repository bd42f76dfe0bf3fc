from pyspark.sql import functions as F

from lexcorpus.operators import extract


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_identifiers_of_hits_are_worked_out_once(spark):
    payloads = spark.createDataFrame([(1, 2, "<x/>")], "ord int, job int, body string")
    hits = extract.parse_hits(payloads).withColumn("place", F.struct("ord", "result_idx"))
    assert _plan(extract.found_hits(hits, ["job"], "place")).count("celex:|/celex/") == 1


def test_identifiers_of_notices_are_not_worked_out_again_by_the_filter_on_them(spark):
    payloads = spark.createDataFrame([(1, "32014L0089", "<x/>")], "ord int, act string, body string")
    # the search for elements stood in the plan seven times
    assert _plan(extract.parse_notices(payloads, act="act")).count("WORK_CREATED_BY_AGENT)") <= 3
