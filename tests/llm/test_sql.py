import pytest

from halocline.llm.registry import ORACLE_SQL, QUERIES
from tests.compare import compare, connect

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, con, name):
    assert compare(spark, con, SF, QUERIES[name], ORACLE_SQL[name]) is None
