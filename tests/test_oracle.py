"""Registered queries against their SQL on the smallest data set.

By default a sample that touches every module; WAYBILL_ORACLE=all runs every query.
"""

import os

import pytest

import __spark_entry__ as entry_module
from check import compare, oracle
from waybill import catalog

FOLDER = os.environ.get("WAYBILL_SF_DIR", "/root/testdata/sf0.001")
SAMPLE = """gld_1_orders_daily gld_2_orders_by_sla gld_7_sla_per_order gld_9_transit_delays
gld_13_warehouse_productivity gld_16_revenue_recognition rpt_5_top_customers kpi_8_transit_time_by_week
dim_1_customer_history mtr_1_shipments_daily msg_9_growth_by_type msg_22_alerts ts_3_moving_average
dq_ord_005 dqa_1_score rls_1_visible_counts msk_1_carrier_portal qry_1_filter_tree
qry_4_keyset_page ext_16_warehouse_children win_1_latest_version win_4_event_sequence
gov_9_response_times mnt_1_upsert str_4_tumbling""".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
SQL = entry_module.oracle_sql()
NAMES = list(catalog.SQL) if os.environ.get("WAYBILL_ORACLE") == "all" else SAMPLE


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(spark, con, name):
    problems = compare(entry_module.queries()[name](spark, FOLDER), con, SQL[name])
    assert [p for p in problems if not p.startswith("note")] == []


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_query_of_the_catalog_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)
