"""Every registered query against its SQL oracle on the smallest data set."""

import pytest

import __spark_entry__ as driver
from bindings import ORACLES, QUERIES
from tests.compare import compare



@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, sf_dir, name):
    verdict, _ = compare(spark, duck, QUERIES[name], ORACLES[name], sf_dir)
    assert verdict == "ok"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry_labels_every_row(spark):
    rows = driver.entry(spark).collect()
    assert rows and {r.kaviar_rare for r in rows} <= {"Y", "N"} and {r.clin_patho for r in rows} <= {"Y", "N"}
