"""Every query with a check, against DuckDB; those without must give rows."""

import pytest
from conftest import DATA

import __spark_entry__ as contract
from compare import differences

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
# On the smallest data these select nothing.
EMPTY_IS_FINE = {"benchmark_annotations", "filter_articles_journal_type_date", "filter_articles_mesh_language", "proteomes"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, DATA)
    if name not in ORACLES:
        assert df.count() > 0
        return
    found = differences(df, duck, ORACLES[name])
    if found == "both are empty" and name in EMPTY_IS_FINE:
        return
    assert found is None, found


def test_entry(spark):
    assert contract.entry(spark).columns == ["doi", "pmid", "pmcid", "title", "score"]


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
