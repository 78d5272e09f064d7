"""Every registered query with a DuckDB text gives the same rows on both engines."""

import pytest

from verification.compare import differences
from verification.registry import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, folder, name):
    assert differences(spark, folder, QUERIES[name], ORACLE[name]) == []


def test_every_text_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
