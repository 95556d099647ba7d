import pytest

import __spark_entry__ as entry
from caseloom.plans.oracles import ORACLES
from caseloom.plans.registry import all_queries
from tests.oracle_check import compare

QUERIES = all_queries()


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["disease_name", "decade", "total_cases", "avg_incidence"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    # The smallest scale has no rows for some parameters; larger scales are run by the script.
    assert compare(spark, sf_dir, name, QUERIES[name], ORACLES[name], allow_empty=True) == []
