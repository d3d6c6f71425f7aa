"""Corpus queries that SQL can express, against their oracle."""

from __future__ import annotations

import compare
import fixtures_llm as X
import pytest

from terrafold.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    assert compare.differences(QUERIES[name](spark, X.SF), compare.connect(X.SF), ORACLES[name]) == []
