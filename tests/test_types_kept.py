from __spark_entry__ import queries
from lexcorpus.operators import eu


def test_several_requests_keep_what_each_keeps_alone(spark):
    ids = [(0, "32014L0089"), (1, "02014L0089-20200101"), (2, "61999CJ0123"), (3, "52012PC0001"), (4, ""), (5, None), (6, "x"), (7, "32014R0001R(01)")]
    ids = spark.createDataFrame(ids, "ord int, celex_full string")
    asked = {"a": ("all", [" r", "cj"]), "b": ("sector_3_only", ()), "c": (" Supported_Only", ()), "d": ("other", ())}
    got = {(r["mode"], r["ord"]) for r in eu.types_kept(ids, asked).collect()}
    assert got == {(name, r["ord"]) for name, of in asked.items() for r in eu.filter_types(ids, *of).collect()}


def test_identifiers_are_read_once_for_all_modes(spark):
    plan = queries()["filter_celex"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
