from collections import Counter

import pytest

from checks.compare import _TYPES, _rows, connect
from tidemark.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_equal_to_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    relation = connect(SF_DIR).sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(relation.columns)
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: _TYPES[t] for c, t in df.dtypes} == types
    mine, theirs = _rows(df.columns, df.collect()), _rows(relation.columns, relation.fetchall())
    assert mine == theirs and isinstance(mine, Counter)
