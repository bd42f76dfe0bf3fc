"""Roll-ups of review groups: one aggregate, groups without values, several values."""

from lexcorpus.operators import audit


def test_rollups_count_single_values_and_combinations(spark):
    rows = [("celex", ["A", "B"], ["s"]), ("celex", ["A"], []), ("url", [], ["s"])]
    summary = spark.createDataFrame(rows, "signal string, _lands array<string>, _sources array<string>")
    counts = audit.rollups(summary)
    got = {name: {r[0]: r[1] for r in audit.rollup(counts, name).collect()} for name in audit.ROLLUPS}
    assert got["groups_by_signal"] == {"celex": 2, "url": 1}
    assert got["groups_by_jurisdiction"] == {"A": 2, "B": 1, "(missing)": 1}
    assert got["groups_by_jurisdiction_combination"] == {"A | B": 1, "A": 1, "(missing)": 1}
    assert got["groups_by_source_name"] == got["groups_by_source_name_combination"] == {"s": 2, "(missing)": 1}
    assert audit.rollups(summary.limit(0)).count() == 0


def test_rollups_read_the_groups_once(spark, tmp_path):
    path = str(tmp_path / "groups")
    rows = [("celex", ["A"], ["s"])]
    spark.createDataFrame(rows, "signal string, _lands array<string>, _sources array<string>").write.parquet(path)
    plan = audit.rollups(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
