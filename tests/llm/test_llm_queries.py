import os

import pytest

from commitlake.llm import queries
from tests.oracle import DATA, compare, connection

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    if name in queries.SQL:
        compare(spark, connection(), queries.QUERIES[name], queries.SQL[name])
    else:
        df = queries.QUERIES[name](spark, DATA)
        found = df.collect()
        assert found
        if name.endswith("_found"):
            assert len(found) == len(set(found)) and set(dict(df.dtypes).values()) <= {"bigint", "string"}
