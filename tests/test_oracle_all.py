"""Every registered query: SQL-checked ones equal their DuckDB oracle on sf0.001,
the others run and return rows."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.helpers import assert_same
from tests.test_naive_bayes_eval import NB_KEYS

SQL = E.oracle_sql()
ALL = E.queries()
CHECKED = sorted(k for k in SQL if k not in NB_KEYS)
ROWS_ONLY = sorted(k for k in ALL if k not in SQL)


@pytest.mark.parametrize("key", CHECKED)
def test_query_matches_oracle(spark, duck, key):
    assert_same(ALL[key](spark, SF_SMALL), duck, SQL[key])


@pytest.mark.parametrize("key", ROWS_ONLY)
def test_query_runs(spark, key):
    df = ALL[key](spark, SF_SMALL)
    assert df.count() > 0


def test_every_query_has_distinct_output_names():
    for key, fn in ALL.items():
        assert fn.__name__.startswith("q_"), key
