"""The stored chain: slices, rebuilt month ends and the manifest of all reports; variants of reports."""

from oracles import labels, members, reports, wide
from oracles.base import STAT, cte, snapshot_rows, sql

O: dict[str, str] = {}
HELD = {**wide.O, **reports.O, **members.O, **labels.O}

#: Statements whose rows each report has for the day.
REPORTED = {
    "cix_online_active_customer_rm": ("r9_segmentation_report_rm",),
    "cix_online_active_customer_rf": ("r9_segmentation_report_rf",),
    "cix_online_customer_purchase_interval": ("r10_repeat_interval", "r11_new_customer_interval"),
    "cix_online_customer_assets_view": ("c2_assets_view",),
    "cix_online_customer_repurchase_anlyze": ("c3_repurchase_view",),
    "cix_online_customer_retention_analyze": ("c4_retention_view",),
    "cix_online_sales_structs_day": ("v6_sales_structure_day",),
    "cix_online_sales_structs_month": ("v6_sales_structure_month",),
    "cix_online_sales_structs_year": ("v6_sales_structure_year",),
    "cix_online_shop_has_permission_category": ("b7_comparable_categories",),
    "cix_online_category_customer_assets": ("b10_category_assets",),
    "cix_online_category_purchase_interval": ("b11_category_interval",),
    "cix_online_member_point_grade_change": ("m11_point_grade_report",),
    "cix_online_member_grade_transform": ("m13_grade_matrix_report",),
    "cix_online_card_store_point": ("m3_point_distribution",),
    "cix_online_point_store_trend": ("m4_point_stock",),
    "cix_online_member_life_cycle": ("m20_life_cycle_report",),
    "cix_online_member_consume_transform": ("m15_consume_transform",),
    "cix_offline_shop_member_change_statistic": ("o8_member_growth",),
    "cix_offline_plat_member_sale_rate": ("o6_member_sale_rate",),
    "cix_offline_sale_shops_of_card": ("o7_shop_sale_rate",),
    "cix_offline_member_consume_statistic": ("o12_consumption_report",),
}


def counted(names: tuple[str, ...]) -> str:
    return " + ".join(f"(SELECT count(*) FROM ({HELD[n]}))" for n in names)


O["k5_publish_all_reports"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '1' AS available, {STAT}, CAST({counted(names)} AS BIGINT) AS row_num" for table, names in REPORTED.items()
)
O["k8_replace_slices"] = HELD["k8_replace_in_serving_store"]
O["w13_final_of_parts"] = HELD["w13_final_daily_rfm"]
cte("late_holders", "SELECT DISTINCT tenant, plat_code, uni_shop_id, uni_id FROM late_delta WHERE created < (SELECT max(stat_date) + 1 FROM ends)", "late_delta", "ends")
SAME = " AND ".join(f"w.{c} = k.{c}" for c in ("tenant", "plat_code", "uni_shop_id", "uni_id"))
cte(
    "rebuilt",
    f"""SELECT w.* FROM complete w WHERE w.type = 3 AND (EXISTS (SELECT 1 FROM customers_last_run k WHERE {SAME})
    OR EXISTS (SELECT 1 FROM late_holders k WHERE {SAME}))""",
    "complete",
    "customers_last_run",
    "late_holders",
)
O["w18_rebuild_month_ends"] = sql(snapshot_rows("rebuilt", False), "rebuilt")

# The year-anchored week of 30 June 2001 starts a day before its Monday week.
for name in ("m11_point_grade_report", "m13_grade_matrix_report", "o12_consumption_report"):
    O[f"{name}_anchored_week"] = HELD[name].replace("(2, DATE '2001-06-25')", "(2, DATE '2001-06-24')")
ON_PLATFORMS = "plat_code IN ('NATION_1', 'NATION_6', 'NATION_12', 'NATION_20')"
for name in ("o6_member_sale_rate", "o8_member_growth", "o11_member_stock"):
    O[f"{name}_on_platforms"] = f"SELECT * FROM ({HELD[name]}) WHERE {ON_PLATFORMS}"

# Contact and account are looked up: those of customers, by trades and at home, and of members in the shop of their card.
cte(
    "reachable",
    """SELECT tenant, plat_code, uni_shop_id, uni_id FROM customers
    UNION SELECT t.tenant, m.plat_code, m.uni_shop_id, m.member_id FROM member m JOIN tenant_shop t ON t.uni_shop_id = m.uni_shop_id""",
    "customers", "member", "tenant_shop",
)
O["e8_festival_members_on_platforms"] = sql(
    f"""SELECT e.* FROM ({HELD['e8_festival_members']}) e WHERE {ON_PLATFORMS}
    AND EXISTS (SELECT 1 FROM reachable k WHERE k.tenant = e.tenant AND k.uni_id = e.uni_id)
    AND EXISTS (SELECT 1 FROM reachable k WHERE k.plat_code = e.plat_code AND k.uni_shop_id = e.uni_shop_id AND k.uni_id = e.uni_id)""",
    "reachable",
)
