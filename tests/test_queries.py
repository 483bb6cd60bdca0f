"""Every registered query against its SQL check."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import database, same
from linepulse.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert same(spark, con, queries()[name], oracle_sql()[name], FOLDER) == ""


def test_entry(spark):
    assert entry(spark).count() > 0


def test_no_hints_or_local_work():
    """No forced broadcast, no local checkpoint, no row-at-a-time function in the library."""
    import pathlib

    for path in pathlib.Path(__file__).parent.parent.joinpath("linepulse").rglob("*.py"):
        text = path.read_text()
        for word in ("broadcast(", "localCheckpoint", "crossJoin", "@F.udf", "toPandas"):
            assert word not in text, (path, word)
