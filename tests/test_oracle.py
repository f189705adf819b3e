"""Every query of the library against its SQL on the small tables."""

import pytest

from kinfold.plans import catalogue
from tests.compare import assert_same


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(name, spark, small, duck):
    assert_same(catalogue.queries()[name](spark, small), duck, catalogue.oracle_sql()[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns and set(catalogue.queries()) <= set(__spark_entry__.queries())


def test_queries_without_sql():
    """Ordered merges are beyond one statement; ``test_forest`` holds them against an ordered union-find."""
    assert set(catalogue.queries()) - set(catalogue.oracle_sql()) == {"q48_merge_events"}
