"""Label tables pinned by values written out here, so that the SQL forms, which are made from the
same tables, can't share a mistake with the jobs."""

import pytest

from lexcorpus import lookups as L

PAIRS = [
    (L.JURISDICTION_LABELS, {"EU": "European Union", "UK": "United Kingdom", "CA": "Canada", "AUS": "Australia", "NZ": "New Zealand", "US": "United States"}),
    (L.MEMBER_STATES, {"AUT": "Austria", "BEL": "Belgium", "DEU": "Germany", "FIN": "Finland", "FRA": "France", "IRL": "Ireland", "SWE": "Sweden", "DNK": "Denmark", "POL": "Poland", "PRT": "Portugal"}),
    (L.LANG3_TO_LANG2, {"dan": "DA", "deu": "DE", "eng": "EN", "fra": "FR", "swe": "SV", "spa": "ES", "ita": "IT"}),
]


@pytest.mark.parametrize("table,expected", PAIRS)
def test_labels(table, expected):
    assert {k: table.get(k) for k in expected} == expected


def test_member_states_are_known_once():
    assert len(set(L.MEMBER_STATES.values())) == len(L.MEMBER_STATES) >= 27
