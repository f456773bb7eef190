"""Every registered query of the library against its SQL on the smallest data set."""

import pytest
from compare import compare, connect
from conftest import SF_DIR

import __spark_entry__ as contract
from tickforge.plans.oracle import ORACLE
from tickforge.plans.queries import QUERIES

# No paused symbol and no unlisted symbol exists at this scale; both sides are empty.
EMPTY_HERE = {"f16_status", "j05_unlisted_symbols"}
#: Statements that join many results; they are checked on the next larger data set, too.
WIDE = ["s10_serving_scan", "p07_disjoint_join", "j01_daily_outer_join", "j02_record_day_join", "a16_sparse_rows_merged",
        "k08_daily_upsert", "m01_daily_stream_coalesced", "v01_daily_analysis"]


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys() and ORACLE.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    difference = compare(QUERIES[name](spark, SF_DIR), con, ORACLE[name])
    assert difference == ("no rows" if name in EMPTY_HERE else None)


@pytest.mark.parametrize("name", WIDE)
def test_wide_statements_on_more_rows(spark, name):
    sf = "/root/testdata/sf0.01"
    assert compare(QUERIES[name](spark, sf), connect(sf), ORACLE[name]) is None


def test_statements_hold_what_they_need_only():
    assert "volumes AS" not in ORACLE["s12_active_symbols"] and ORACLE["s12_active_symbols"].count(" AS (") == 1


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
