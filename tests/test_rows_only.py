"""Every registered query has a DuckDB text."""

from verification.registry import ORACLE, QUERIES


def test_all_have_a_text():
    assert set(QUERIES) == set(ORACLE)
