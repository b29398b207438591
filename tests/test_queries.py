"""Every query of the core on the smallest tables, against its SQL in DuckDB where it has one."""

import compare
import pytest

from clonewell import plans

#: SQL that has no place in a quick run: all pairs of sequences.
NO_SQL = sorted(set(plans.QUERIES) - set(plans.SQL))


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_same_rows_as_sql(spark, small_tables, name):
    folder, con = small_tables
    assert compare.spark_rows(plans.QUERIES[name](spark, folder)) == compare.sql_rows(con, plans.SQL[name])


@pytest.mark.parametrize("name", NO_SQL)
def test_gives_rows(spark, small_tables, name):
    assert plans.QUERIES[name](spark, small_tables[0]).count() > 0


def test_entry_and_names(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
