"""Every query with a SQL twin gives the twin's rows; the rest give rows."""

import check_oracle
import pytest

import __spark_entry__ as contract

#: A report of faults that the tables don't have, and tile sets of over 10^8 pixels, run at the scale whose cells they miss.
LARGE = [f"{p}_{kind}_tiles" for p in ("p03_night_lights", "p07_urbanisation") for kind in ("visual", "value")]
EMPTY = ["j13_unmatched", *LARGE]
SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
#: Their area holds no cell of the smallest scale.
PRODUCTS = ("p0", "p10", "p11", "p12", "p13", "p14", "p15", "p18", "p19")


@pytest.fixture(scope="module")
def dbs():
    return {folder: check_oracle.connect(folder) for folder in (SMALL, LARGER)}


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, dbs, name):
    folder = LARGER if name.startswith(PRODUCTS) and name not in LARGE else SMALL
    status, note = check_oracle.compare(spark, dbs[folder], name, folder)
    assert status == "ok" or status == "rows" and name not in contract.oracle_sql() or status == "EMPTY" and name in EMPTY, note


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_twins_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
