"""Contract and plans of the named queries."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
from oracles import ORACLES
from patronage.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"
COMPARED = ["s1_valid_trades", "w5_shop_rfm", "w13_daily_rfm_latest_versions", "r9_segmentation_report_rf", "v6_sales_structure_month", "b7_comparable_categories", "m13_grade_matrix_report", "o7_shop_sale_rate", "l2_influence", "t7_tenant_label", "d5_funnel_report", "e6_exclude_rebought_all_days"]
PLANNED = ["w7_all_levels", "r6_rm_matrix", "v6_sales_structure_year", "m11_point_grade_report", "m20_life_cycle_report", "t7_tenant_label", "e6_exclude_rebought", "o12_consumption_report", "c2_assets_view"]

needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_a_counterpart():
    assert set(ORACLES) == set(QUERIES) and set(QUERIES) <= set(contract.queries())


@needs_data
def test_entry(spark):
    assert contract.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize("name", COMPARED)
def test_rows_match_sql(spark, name):
    df = contract.queries()[name](spark, FOLDER)
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{FOLDER}/{file}'")
    found = con.execute(contract.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted(map(str, found.fetchall()))
    assert sorted(str(tuple(r)) for r in df.select(*[f"`{c}`" for c in names]).collect()) == expected


@needs_data
@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_joins_or_python_in_plans(spark, name):
    plan = plan_of(contract.queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "CollectLimit"):
        assert operator not in plan


@needs_data
def test_ranked_rows_are_limited_before_the_shuffle(spark):
    plan = plan_of(contract.queries()["w1_first_second_purchase"](spark, FOLDER))
    shuffle = plan.index("Exchange hashpartitioning(uni_id")
    assert "WindowGroupLimit" in plan[:shuffle] and "WindowGroupLimit" in plan[shuffle:]


@needs_data
def test_periods_and_widths_scan_once(spark):
    for name in ("m5_point_change_members", "m3_point_distribution"):
        assert plan_of(contract.queries()[name](spark, FOLDER)).count("orders.parquet") == 1


@needs_data
def test_columns_are_pruned_and_filters_pushed(spark):
    plan = plan_of(contract.queries()["v1_customer_period_day"](spark, FOLDER))
    assert "l_tax" not in plan and "o_totalprice" not in plan
    assert "GreaterThanOrEqual(o_orderdate" in plan


@needs_data
def test_customers_grow_with_the_tables(spark):
    """Ten times the tables, about ten times the customer rows: prospects are one shop a customer."""
    from patronage.sources.testtables import Tables

    small, large = (Tables(spark, f"/root/testdata/{sf}").shop_customer.count() for sf in ("sf0.01", "sf0.1"))
    assert 5 <= large / small <= 20


def test_grade_matrix_is_registered_over_all_periods(spark):
    test_rows_match_sql(spark, "m12_grade_matrix_all_periods")
    found = QUERIES["m12_grade_matrix_all_periods"](spark, FOLDER).select("rangetype").distinct().collect()
    assert sorted(r[0] for r in found) == [1, 2, 3, 4, 5]


@needs_data
def test_every_member_of_a_caring_shop_is_reached(spark):
    """The SQL without contacts and accounts: each member is a customer of the shop that opened the card."""
    test_rows_match_sql(spark, "e8_festival_members")
    assert "EXISTS" not in contract.oracle_sql()["e8_festival_members"]


@needs_data
def test_members_on_platforms_are_looked_up_among_customers(spark):
    """The SQL looks for contact and account among all customers, those by trades too, and still has every caring member."""
    test_rows_match_sql(spark, "e8_festival_members_on_platforms")
    found = contract.oracle_sql()["e8_festival_members_on_platforms"]
    assert "lineitem" in found and found.count("EXISTS") == 2


def test_card_holders_have_an_account_without_a_trade(spark, tmp_path):
    """A member of the nation's first shop, whose only trades and prospect shop are elsewhere."""
    from patronage.sources.testtables import Tables

    rows = {
        "nation": ([(1, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(1, "S1", 1), (2, "S2", 1)], "s_suppkey long, s_name string, s_nationkey int"),
        "customer": ([(1, "C1", 1)], "c_custkey long, c_name string, c_nationkey int"),
        "orders": ([], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz, o_totalprice double"),
        "lineitem": ([], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp_ntz"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    t = Tables(spark, str(tmp_path))
    assert [r.uni_shop_id for r in t.shop_customer.collect()] == ["N|2"]
    assert sorted(r.uni_shop_id for r in t.customer_account.collect()) == ["N|1", "N|2"]
    assert [(r.tenant, r.uni_id) for r in t.customer_contact.collect()] == [("T0", "1")]


@needs_data
@pytest.mark.parametrize("name", ["k5_publish_all_reports", "w13_final_of_parts"])
def test_shared_stages_are_read_from_storage(spark, name):
    """Without stored stages each reader of the wide rows, or of the aged ones, would scan the raw lines again."""
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert plan.count("lineitem.parquet") <= 2


def exchanges(df) -> list[str]:
    return [line for line in plan_of(df).splitlines() if "Exchange hashpartitioning" in line]


@needs_data
@pytest.mark.parametrize("name", ["m19_life_cycle_totals", "m20_life_cycle_report", "v6_sales_structure_year", "w13_daily_rfm_latest_versions"])
def test_order_lines_are_put_together_once(spark, name):
    """The plan starts from stored trades and shops, and no trade moves to look up its shop; levels are made behind the shuffle."""
    df = contract.queries()[name](spark, FOLDER)
    assert "l_orderkey" not in plan_of(df)
    assert not [line for line in exchanges(df) if re.search(r"hashpartitioning\((shop_id#|plat_code#\d+, [a-z])|level_shop", line)]


@needs_data
def test_nightly_step_moves_no_stored_trade_to_meet_the_delta(spark):
    moved = [line for line in exchanges(contract.queries()["w13_daily_rfm_latest_versions"](spark, FOLDER)) if "trade_id" in line]
    assert all("uni_id" in line for line in moved)  # the trades of the boundary days
