import pytest

import __spark_entry__ as entry
from kinfold.plans import catalogue, catalogue_sql

SQL = catalogue_sql.oracle_sql()


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query(spark, sf_dir, duck, same_rows, name):
    same_rows(catalogue.queries()[name](spark, sf_dir).toPandas(), duck.sql(SQL[name]).df())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
