import pytest

import __spark_entry__ as registered
from compare import differences, duckdb_over

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb_over(SF)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(registered.lakehouse_queries()) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", list(registered.lakehouse_queries()))
def test_query_equals_oracle(spark, oracle, name):
    frame = registered.queries()[name](spark, SF)
    assert differences(frame, oracle, registered.oracle_sql()[name]) == []


def test_entry(spark):
    result = registered.entry(spark)
    assert result.columns == ["nconst", "role", "name", "average_rating", "total_run_time_minutes", "total_titles_as_principal"]
    assert result.count() == 106


# Rows of the views and operators at sf0.001, counted independently.
COUNTS = {
    "dim_names": 106,
    "dim_titles": 1026,
    "fact_principals": 1996,
    "principal_kpis": 996,
    "role_kpis": 208,
    "top_people": 102,
    "top_people_both": 106,
    "needs_refresh": 36,
    "upsert": 1250,
    "upsert_composite_key": 5138,
    "latest_success": 35,
    "status_on_date": 26,
}


@pytest.mark.parametrize("name, count", COUNTS.items())
def test_row_counts(spark, name, count):
    assert registered.queries()[name](spark, SF).count() == count
