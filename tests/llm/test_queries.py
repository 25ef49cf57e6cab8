import re

import pytest
from compare import oracle_rows, spark_rows
from newslake.llm import queries

import __spark_entry__ as entry_points


def test_one_query_per_operator():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows_as_sql(spark, sf, name):
    assert spark_rows(queries.QUERIES[name](spark, sf)) == oracle_rows(queries.ORACLE[name], sf)
