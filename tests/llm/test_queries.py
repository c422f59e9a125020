"""Each dealt operator's query against its DuckDB SQL."""

import pytest
from compare import connect, differences

from phrasegrove.llm.oracles import ORACLES
from phrasegrove.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) == []
