import pytest

from halocline.plans.registry import ORACLE_SQL, QUERIES, flagship
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, con, name):
    assert compare(spark, con, SF, QUERIES[name], ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_flagship(spark):
    assert flagship(spark, SF).count() > 0


#: Result columns that have one value by what they tell, so that nothing can be told from them.
FIXED = {
    "area_edge_query": {"n"}, "area_query": {"n"}, "grid_index": {"n"}, "attribute_changes": {"attribute"}, "data_file_names": {"level", "version"}, "failed_manifest": {"upload_status"},
    "file_name_parts": {"dataset", "level"}, "filename_parse": {"temporal"}, "hotspots_greedy": {"spacing_m"}, "read_area_hits": {"variable"}, "read_line_hits": {"variable"},
    "sigma_table": {"n_faces"}, "streamed_monthly": {"month"}, "time_delta_check": {"n_duplicates"}, "version_disagreements": {"n_levels"},
}


@pytest.fixture(scope="module")
def larger():
    return connect("/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_results_can_tell_right_from_wrong(con, larger, name):
    """Rows at both sizes, and no column that is null or the same in all rows of the larger one."""
    assert con.sql(ORACLE_SQL[name]).limit(1).fetchall()
    found = larger.sql(ORACLE_SQL[name])
    rows = found.fetchall()
    assert rows
    if len(rows) > 1:
        same = {c for k, c in enumerate(found.columns) if len({repr(r[k]) for r in rows}) == 1}
        assert same <= FIXED.get(name, set())
