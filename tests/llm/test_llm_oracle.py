"""The text queries against their SQL, row by row."""

import pytest

from compare import compare, duck
from tremorlake.llm.oracles import LLM_ORACLES
from tremorlake.llm.queries import LLM_QUERIES

from fixtures import SF_DIR


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(LLM_QUERIES[name](spark, SF_DIR), con, LLM_ORACLES[name]) == ""
