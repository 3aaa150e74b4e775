"""Every registered query against its SQL on the smallest tables."""

from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry
from bindings import ORACLES, QUERIES
from comparing import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outcomes(spark):
    connection = connect(SF_DIR)

    def outcome(name):
        return differences(QUERIES[name](spark, SF_DIR), connection.cursor(), ORACLES[name])

    with ThreadPoolExecutor(6) as pool:
        yield {name: pool.submit(outcome, name) for name in ORACLES}


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(outcomes, name):
    assert outcomes[name].result() is None


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["dataType", "messageDate", "value"]
    assert frame.limit(1).count() == 1
