"""Every registered query against its SQL oracle, on whole tables."""

import pytest

import __spark_entry__
from testbed.compare import database, difference
from testbed.oracles import ORACLES
from testbed.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    with database(SF_DIR) as connection:
        yield connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(__spark_entry__.queries())


#: The smallest tables hold no near pairs of stations and points for these.
MAY_BE_EMPTY = {"station_point_pairs", "poi_within_10km"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, db, name):
    assert difference(spark, db, SF_DIR, name) in ((None, "no rows") if name in MAY_BE_EMPTY else (None,))


def test_entry(spark):
    found = __spark_entry__.entry(spark)
    assert found.columns == ["od", "n_trains"]
    assert found.count() > 0


def test_weekend_filter_reaches_the_scan_side_of_the_shuffle(spark, plan):
    """Predicates on key columns pass below the dedup; the seat flag must not."""
    text = plan(__spark_entry__.queries()["weekend_seats_by_od"](spark, SF_DIR))
    above, below = text.split("WindowGroupLimit", 1)
    assert "OUI" in above
    assert "1998-07-04" in below and "1998-07-04" not in above
