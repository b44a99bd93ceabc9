"""Every query with check SQL, against the checking engine on the smallest sample."""

import pytest
from oracle import compare, connect

from delaylens.catalog import CHECKS, QUERIES
from delaylens.catalog.base import Tables

from conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, tables, con, name):
    def run(_spark, folder):
        return QUERIES[name](Tables(spark, folder, tables.flights))

    assert compare(spark, con, name, run, CHECKS[name], SMALL) is None


def test_view_without_persisting_equals_persisted(spark, tables):
    fresh = Tables(spark, SMALL).flights
    assert fresh.exceptAll(tables.flights).isEmpty() and fresh.count() == tables.flights.count()


def test_entry_and_registration():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_outlier_fences_on_every_numeric_column(tables):
    from delaylens.catalog.cleaning import NUMERIC

    rows = tables.flights.select("FLIGHT_ID", *NUMERIC).toPandas()
    for c in NUMERIC:
        low, high = rows[c].quantile(0.25), rows[c].quantile(0.75)
        rows = rows[(rows[c] >= low - 1.5 * (high - low)) & (rows[c] <= high + 1.5 * (high - low))]
    found = QUERIES["b14_remove_outliers_iqr_all_columns"](tables)
    assert found.columns == ["FLIGHT_ID", *NUMERIC] and len(NUMERIC) == 23
    assert sorted(r.FLIGHT_ID for r in found.select("FLIGHT_ID").collect()) == sorted(rows.FLIGHT_ID) != []
