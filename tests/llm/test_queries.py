import pytest

from tests.oracle import compare
from tidemark.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    assert compare(spark, SF, queries.queries()[name], queries.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_one_row_per_document(spark, small, name):
    df = queries.queries()[name](spark, small)
    assert df.count() == spark.read.parquet(f"{small}/documents.parquet").count()
