"""Queries over measures and documents store no wide input and move few bytes of a row."""

import pytest

import __spark_entry__ as entry
from lexcorpus.catalog import inputs

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["lang_candidates", "country_act_matrix", "dup_top"])
def test_no_wide_input_is_stored(spark, monkeypatch, name):
    monkeypatch.setattr(inputs, "_written", {})
    assert entry.queries()[name](spark, SF).count() > 0
    assert not inputs._written


def test_measures_are_not_dealt_for_their_languages(spark):
    plan = entry.queries()["lang_candidates"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and "Exchange" not in plan.replace("BroadcastExchange", "")
