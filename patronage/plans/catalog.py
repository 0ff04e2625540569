"""Named queries, one or more per operator, over a folder of test tables."""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.constants import CUSTOMER_KEYS, LEVEL_KEYS, PLATFORM, SHOP, TENANT
from patronage.functions import calendar
from patronage.functions.buckets import point_bucket
from patronage.functions.expressions import count_if, present, rounded, valid_timestamp, with_tokens_null
from patronage.operators import (
    assets,
    audience,
    category,
    conversion,
    dashboard,
    life_cycle,
    lifetime,
    offline,
    points,
    rfm_daily,
    rfm_late,
    rfm_wide,
    sales,
    segmentation,
    social,
)
from patronage.plans import reports
from patronage.plans.marts import Marts, snapshot_rows
from patronage.session import stored_once, work_folder
from patronage.sinks import manifest, writers
from patronage.sinks.versions import VersionedTable, days
from patronage.sources import cleaning
from patronage.sources.testtables import EVENT_METRICS, LAST_RUN

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Marts], DataFrame]) -> Callable[[Marts], DataFrame]:
    """Register a report under its function name."""

    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return present(build(Marts(spark, folder)))

    QUERIES[build.__name__] = run
    return build


def stored(m: Marts, name: str, rows: DataFrame) -> DataFrame:
    return stored_once(m.spark, name, rows)


TRADE_COLUMNS = ["tenant", "plat_code", "uni_shop_id", "uni_id", "trade_id", "receive_payment", "product_num", "created"]

# Scans, cleaning, calendar


@query
def s1_valid_trades(m: Marts) -> DataFrame:
    return m.valid.select(*TRADE_COLUMNS)


@query
def s2_daily_increment(m: Marts) -> DataFrame:
    return m.delta.select(*TRADE_COLUMNS)


@query
def s3_boundary_day_trades_year(m: Marts) -> DataFrame:
    return cleaning.boundary_day_trades(m.valid, m.day, 12).select(*TRADE_COLUMNS)


@query
def s3_boundary_day_trades_two_years(m: Marts) -> DataFrame:
    return cleaning.boundary_day_trades(m.valid, m.day, 24).select(*TRADE_COLUMNS)


@query
def s4_trades_since(m: Marts) -> DataFrame:
    recent = cleaning.trades_since(m.t.trade, m.day, months=14)
    return cleaning.clean_trades(recent, m.t.tenant_shop).select(*TRADE_COLUMNS)


@query
def s5_active_or_month_scan(m: Marts) -> DataFrame:
    rows = cleaning.active_or_month_scan(m.t.top_trade, m.day, 180)
    return rows.select("dp_id", "tid", "status", "part", "created", "payment")


@query
def s6_actions_since(m: Marts) -> DataFrame:
    return cleaning.actions_since(m.t.action, m.action_day).groupBy("subject_id", "sub_id", "user_id", "action").agg(
        F.count("*").alias("action_num"), F.max("action_time").alias("last_time")
    )


@query
def s6_actions_since_open_share(m: Marts) -> DataFrame:
    rows = cleaning.actions_since(m.t.action, m.action_day, action="OPEN_SHARE")
    return rows.select("user_id", "subject_id", "sub_id", "relate_userid", "business_id", "action_time")


@query
def s7_period_flags(m: Marts) -> DataFrame:
    names = list(calendar.PERIOD_NAMES.values()) + ["this_year", "last_year"]
    flagged = calendar.period_flags(m.valid, "created", m.day, yearly=True)
    return flagged.select("uni_shop_id", "trade_id", "created", *names)


@query
def s7_period_flags_anchored_week(m: Marts) -> DataFrame:
    hits = calendar.explode_periods(m.valid, "created", m.day, inclusive=True, anchored_week=True)
    return hits.groupBy("plat_code", "rangetype").agg(F.count("*").alias("trades"))


@query
def s8_period_bounds(m: Marts) -> DataFrame:
    days = m.t.read("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return calendar.period_bounds(days, "day", anchored_week=True)


@query
def s9_month_ends(m: Marts) -> DataFrame:
    days = m.t.read("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select("day", F.explode(calendar.month_ends_col(F.col("day"))).alias("month_end"))


@query
def s10_is_month_end(m: Marts) -> DataFrame:
    days = m.t.read("orders").select(F.to_date("o_orderdate").alias("day")).groupBy("day").agg(F.count("*").alias("orders"))
    return days.withColumn("end_month", calendar.is_month_end(F.col("day")))


@query
def s11_with_tokens_null(m: Marts) -> DataFrame:
    return with_tokens_null(m.t.item_config, ["sku_id"]).select("shop_id", "item_id", "sku_id")


# Sinks


@query
def k1_write_snapshot(m: Marts) -> DataFrame:
    path, rows = work_folder(m.spark, "wide"), stored(m, "shop_rows", m.shop_rows.drop("first_trade_id"))
    for _ in range(2):
        writers.write_snapshot(rows, path, ["stat_date", "type"])
    return snapshot_rows(m.spark.read.parquet(path))


@query
def k2_append_snapshot(m: Marts) -> DataFrame:
    path = work_folder(m.spark, "report")
    report = stored(m, "repurchase", assets.repurchase_view(m.wide, m.t.tenant_shop))
    writers.write_snapshot(report.filter(F.col("type") != TENANT), path, ["stat_date"])
    writers.append_snapshot(report.filter(F.col("type") == TENANT), path, ["stat_date"])
    return m.spark.read.parquet(path)


@query
def k3_compact_for_export(m: Marts) -> DataFrame:
    return writers.compact_for_export(assets.retention_view(m.wide, m.t.tenant_shop))


@query
def k4_cluster_by_snapshot(m: Marts) -> DataFrame:
    rows = rfm_wide.month_end_rfm(m.t.shop_customer, m.valid, m.ends)
    return writers.cluster_by_snapshot(rows, ["stat_date"]).groupBy("stat_date").agg(
        F.count("*").alias("customers"), F.sum("year_buy_times").alias("orders")
    )


@query
def k5_publish_manifest(m: Marts) -> DataFrame:
    views = (assets.assets_view, assets.repurchase_view, assets.retention_view)
    reports = {name: view(m.wide, m.t.tenant_shop) for name, view in zip(manifest.REPORTS["assets"], views)}
    return manifest.publish_manifest(reports, m.day).drop("modified")


@query
def k5_publish_all_reports(m: Marts) -> DataFrame:
    """The manifest of all reports, with the rows that each has for the day. What several reports read is stored once, as in
    the stored chain."""
    t = m.t
    m.keep_trades()
    wide = stored(m, "wide", m.wide)
    shop = wide.filter(F.col("type") == SHOP)
    built = {"category_shops": stored(m, "category_shops", m.benchmark_shops), "offline_trades": stored(m, "offline_trades", m.offline)}
    inputs = {"wide": wide, "wide_today": wide, "shop_rows": shop, "shop_today": shop}
    rows = {}
    for report in reports.registry():
        if report.published:
            frame = report.build(*[inputs.get(n, built.get(n)) if n in inputs or n in built else getattr(t, n) for n in report.needs], m.day)
            rows[report.name] = frame if "stat_date" in frame.columns else frame.withColumn("stat_date", F.lit(m.day))
    return manifest.publish_manifest(rows, m.day).drop("modified")


@query
def k6_publish_from_registry(m: Marts) -> DataFrame:
    registry = m.t.item_category.select(
        F.concat_ws("_", F.lit("shop"), "dp_id", F.lower("cid")).alias("table_name"),
        F.when(F.col("is_parent") == "true", "1").otherwise("0").alias("status"),
    ).distinct()
    return manifest.publish_from_registry(registry, "1", m.day).drop("modified")


@query
def k7_export_delimited(m: Marts) -> DataFrame:
    path = work_folder(m.spark, "export")
    report = present(assets.repurchase_view(m.wide, m.t.tenant_shop))
    writers.export_delimited(report, path)
    reader = m.spark.read.schema(report.schema).option("sep", "\u0001").option("nullValue", "\\N")
    return reader.option("quote", "").option("escape", "\\").csv(path)


@query
def k8_replace_in_serving_store(m: Marts) -> DataFrame:
    path = work_folder(m.spark, "serving")
    rows = stored(m, "shop_rows", m.shop_rows.drop("first_trade_id"))
    writers.replace_in_serving_store(rows, path, ["stat_date", "tenant"])
    writers.replace_in_serving_store(rows.filter(F.col("tenant") == "T1"), path, ["stat_date", "tenant"])
    return snapshot_rows(m.spark.read.parquet(path))


@query
def k8_replace_slices(m: Marts) -> DataFrame:
    """Slices by snapshot and tenant: one tenant's replaced, another's cleared and written again, a stray date cleared."""
    table = VersionedTable(m.spark, work_folder(m.spark, "slices"), ("stat_date", "tenant"))
    rows = stored(m, "shop_rows", m.shop_rows.drop("first_trade_id"))
    table.commit(rows, days([m.day]))
    table.commit(table.read().withColumn("stat_date", F.lit(m.yesterday)), days([m.yesterday]))
    table.commit(rows.filter(F.col("tenant") == "T1"), days([m.day], ["T1"]))
    table.commit(rows.limit(0), days([m.day], ["T2"]))
    table.commit(rows.filter(F.col("tenant") == "T2"), days([m.day], ["T2"]))
    table.commit(rows.limit(0), days([m.yesterday]))
    return snapshot_rows(table.read())


@query
def k9_merge_month_end_results(m: Marts) -> DataFrame:
    report = assets.assets_view(m.history, m.t.tenant_shop)
    return writers.merge_month_end_results(report, m.ends)


@query
def k9_merge_month_end_results_tenant(m: Marts) -> DataFrame:
    report = assets.retention_view(m.history, m.t.tenant_shop)
    return writers.merge_month_end_results(report, m.ends, tenant="T2")


# Wide table


@query
def w1_first_second_purchase(m: Marts) -> DataFrame:
    return rfm_wide.first_second_purchase(m.valid, CUSTOMER_KEYS, m.day)


@query
def w1_first_second_purchase_tenant(m: Marts) -> DataFrame:
    return rfm_wide.first_second_purchase(m.valid, ["tenant", "uni_id"], m.day).drop("first_trade_id")


@query
def w2_last_year_metrics(m: Marts) -> DataFrame:
    return rfm_wide.last_year_metrics(m.valid, CUSTOMER_KEYS, m.day)


@query
def w3_prev_year_metrics(m: Marts) -> DataFrame:
    return rfm_wide.prev_year_metrics(m.valid, CUSTOMER_KEYS, m.day)


@query
def w4_older_metrics(m: Marts) -> DataFrame:
    return rfm_wide.older_metrics(m.valid, CUSTOMER_KEYS, m.day)


@query
def w5_shop_rfm(m: Marts) -> DataFrame:
    return m.shop.drop("first_trade_id")


@query
def w6_rollup_first_second_platform(m: Marts) -> DataFrame:
    return rfm_wide.rollup_first_second(m.shop, ["tenant", "plat_code", "uni_id"], ["uni_shop_id"])


@query
def w6_rollup_first_second_tenant(m: Marts) -> DataFrame:
    return rfm_wide.rollup_first_second(m.shop, ["tenant", "uni_id"], ["plat_code", "uni_shop_id"])


@query
def w7_rollup_rfm_platform(m: Marts) -> DataFrame:
    return rfm_wide.rollup_rfm(m.shop, PLATFORM)


@query
def w7_rollup_rfm_tenant(m: Marts) -> DataFrame:
    return rfm_wide.rollup_rfm(rfm_wide.rollup_rfm(m.shop, PLATFORM), TENANT)


@query
def w7_all_levels(m: Marts) -> DataFrame:
    return snapshot_rows(m.wide_whole)


@query
def w8_increment_rfm(m: Marts) -> DataFrame:
    return m.increment


@query
def w9_boundary_metrics_year(m: Marts) -> DataFrame:
    return m.year_out


@query
def w9_boundary_metrics_two_years(m: Marts) -> DataFrame:
    return m.tyear_out


@query
def w10_age_rfm(m: Marts) -> DataFrame:
    return m.aged.drop("first_trade_id")


@query
def w11_merge_changed(m: Marts) -> DataFrame:
    return rfm_daily.merge_changed(m.increment, m.aged)


@query
def w12_insert_new(m: Marts) -> DataFrame:
    return rfm_daily.insert_new(m.increment, m.aged)


@query
def w13_final_daily_rfm(m: Marts) -> DataFrame:
    m.keep_trades()
    return rfm_daily.settle(m.t.customers_by(m.day), m.increment, m.aged, m.day).drop("first_trade_id")


@query
def w13_daily_rfm_latest_versions(m: Marts) -> DataFrame:
    """The delta and the customers to rebuild are stored, as in the stored chain: their sizes are known then, so that on a
    common night no stored trade moves to meet them."""
    m.keep_trades()
    delta = stored(m, "delta", m.delta)
    redelivered = stored(m, "redelivered", rfm_daily.redelivered_customers(m.base, delta, delta.select(*cleaning.TRADE_KEY)))
    rows = rfm_daily.daily_rfm(m.t.customers_by(m.day), m.previous, m.base, delta, m.day, redelivered=redelivered)
    return snapshot_rows(rows)


@query
def w13_final_of_parts(m: Marts) -> DataFrame:
    """Changed, new and untouched customers put together, each a part of its own. The aged rows, which all three read, and the
    increment are stored."""
    aged, increment = stored(m, "aged", m.aged), stored(m, "increment", m.increment)
    changed, new = rfm_daily.merge_changed(increment, aged), rfm_daily.insert_new(increment, aged)
    return rfm_daily.final_daily_rfm(m.t.customers_by(m.day), changed, new, aged, m.day).drop("first_trade_id")


@query
def w14_late_flags(m: Marts) -> DataFrame:
    flagged = rfm_late.late_flags(m.late_delta, m.ends)
    return flagged.select("uni_shop_id", "uni_id", "trade_id", "created", "stat_date", "window")


@query
def w15_late_metrics(m: Marts) -> DataFrame:
    return rfm_late.late_metrics(rfm_late.late_flags(m.late_delta, m.ends)).fillna(0)


@query
def w16_late_assemble(m: Marts) -> DataFrame:
    return m.late


@query
def w17_late_new_customers(m: Marts) -> DataFrame:
    return m.late_new


@query
def w18_late_patch(m: Marts) -> DataFrame:
    return snapshot_rows(m.patched)


@query
def w18_rebuild_month_ends(m: Marts) -> DataFrame:
    """Month ends with the rows of the customers of late trades derived again, as the stored chain does."""
    trades = m.arrived_by(LAST_RUN).unionByName(m.late_delta)
    touched = rfm_late.touched_customers(m.arrived_by(LAST_RUN), m.late_delta, m.late_delta.select(*cleaning.TRADE_KEY), max(m.ends))
    return snapshot_rows(rfm_late.rebuild_month_ends(m.snapshots, trades, touched, m.t.customers_by(m.day), m.ends))


@query
def w19_late_patch_rollup(m: Marts) -> DataFrame:
    return snapshot_rows(rfm_late.late_patch_rollup(m.patched))


@query
def w20_month_end_rfm(m: Marts) -> DataFrame:
    return snapshot_rows(m.history)


@query
def w21_new_tenant_history(m: Marts) -> DataFrame:
    return snapshot_rows(rfm_wide.new_tenant_history(m.t.shop_customer, m.valid, m.t.known_tenants, m.day))


@query
def w22_recompute_tenant(m: Marts) -> DataFrame:
    return snapshot_rows(rfm_wide.recompute_tenant(m.t.shop_customer, m.valid, "T1", m.day))


@query
def w23_tenant_card_plans(m: Marts) -> DataFrame:
    return rfm_wide.tenant_card_plans(m.t.tenant_shop, m.t.card_shop)


# Segmentation and rhythm


@query
def r1_recency_bucket(m: Marts) -> DataFrame:
    return segmentation.buyers(m.wide).groupBy(*LEVEL_KEYS, "recency").agg(F.count("*").alias("customer_num"))


@query
def r2_frequency_bucket(m: Marts) -> DataFrame:
    return segmentation.buyers(m.wide).groupBy(*LEVEL_KEYS, "frequency").agg(F.count("*").alias("customer_num"))


@query
def r3_monetary_bucket(m: Marts) -> DataFrame:
    marked = segmentation.with_monetary(segmentation.buyers(m.wide))
    return marked.groupBy(*LEVEL_KEYS, "interval_type", "monetary").agg(F.count("*").alias("customer_num"))


@query
def r4_rf_matrix(m: Marts) -> DataFrame:
    return segmentation.rf_matrix(m.wide)


@query
def r5_rf_share(m: Marts) -> DataFrame:
    return segmentation.rf_share(segmentation.rf_matrix(m.wide)).select(*segmentation.KEYS, "recency", "frequency", "customer_rate")


@query
def r6_rm_matrix(m: Marts) -> DataFrame:
    return segmentation.rm_matrix(m.wide_whole)


@query
def r7_rm_share(m: Marts) -> DataFrame:
    share = segmentation.rm_share(segmentation.rm_matrix(m.wide_whole))
    return share.select(*segmentation.KEYS, "interval_type", "recency", "monetary", "customer_rate")


@query
def r8_segmentation_history_rf(m: Marts) -> DataFrame:
    return segmentation.segmentation_report(m.history)[0]


@query
def r8_segmentation_history_rm(m: Marts) -> DataFrame:
    return segmentation.segmentation_report(m.history)[1]


@query
def r9_segmentation_report_rf(m: Marts) -> DataFrame:
    return segmentation.segmentation_report(m.wide_whole)[0]


@query
def r9_segmentation_report_rm(m: Marts) -> DataFrame:
    return segmentation.segmentation_report(m.wide_whole)[1]


@query
def r10_repeat_interval(m: Marts) -> DataFrame:
    return segmentation.repeat_interval(m.wide)


@query
def r11_new_customer_interval(m: Marts) -> DataFrame:
    return segmentation.new_customer_interval(m.wide_whole)


@query
def r11_purchase_interval_history(m: Marts) -> DataFrame:
    return segmentation.purchase_interval(m.history)


# Assets


@query
def c1_life_stage(m: Marts) -> DataFrame:
    return m.wide.select(*LEVEL_KEYS, "uni_id", assets.life_stage().alias("stage"))


@query
def c2_assets_view(m: Marts) -> DataFrame:
    return assets.assets_view(m.wide, m.t.tenant_shop)


@query
def c3_repurchase_view(m: Marts) -> DataFrame:
    return assets.repurchase_view(m.wide, m.t.tenant_shop)


@query
def c3_repurchase_history(m: Marts) -> DataFrame:
    return assets.repurchase_view(m.history, m.t.tenant_shop)


@query
def c4_retention_view(m: Marts) -> DataFrame:
    return assets.retention_view(m.wide, m.t.tenant_shop)


# Sales structure


@query
def v1_customer_period_day(m: Marts) -> DataFrame:
    return m.customer_period("day")


@query
def v1_customer_period_month(m: Marts) -> DataFrame:
    return m.customer_period("month")


@query
def v1_customer_period_year(m: Marts) -> DataFrame:
    return m.customer_period("year")


@query
def v2_customer_period_rollup(m: Marts) -> DataFrame:
    return m.customer_levels("month")


@query
def v3_period_kpi(m: Marts) -> DataFrame:
    return sales.period_kpi(m.customer_levels("month"))


@query
def v4_new_customer_kpi(m: Marts) -> DataFrame:
    return sales.new_customer_kpi(m.marked("month"))


@query
def v5_returning_customer_kpi(m: Marts) -> DataFrame:
    return sales.returning_customer_kpi(m.marked("month"))


@query
def v6_sales_structure_day(m: Marts) -> DataFrame:
    return m.sales_report("day")


@query
def v6_sales_structure_month(m: Marts) -> DataFrame:
    return m.sales_report("month")


@query
def v6_sales_structure_year(m: Marts) -> DataFrame:
    return m.sales_report("year")


# Category benchmarks


@query
def b1_eligible_shops(m: Marts) -> DataFrame:
    return m.eligible


@query
def b2_shop_category_payment(m: Marts) -> DataFrame:
    return m.category_payment


@query
def b3_dominant_category_shops(m: Marts) -> DataFrame:
    return m.dominant


@query
def b4_top_n_shops(m: Marts) -> DataFrame:
    return m.top_shops


@query
def b5_complete_groups(m: Marts) -> DataFrame:
    return m.full_top


@query
def b6_shop_category_units(m: Marts) -> DataFrame:
    return m.category_units


@query
def b7_comparable_categories(m: Marts) -> DataFrame:
    return category.comparable_categories(m.category_units)


@query
def b8_category_repurchase(m: Marts) -> DataFrame:
    return rounded(category.category_repurchase(m.benchmark_shops, m.shop_rows), "rate", "new_rate", "old_rate")


@query
def b9_category_retention(m: Marts) -> DataFrame:
    return rounded(category.category_retention(m.benchmark_shops, m.shop_rows), "retention_rate")


@query
def b10_category_assets(m: Marts) -> DataFrame:
    report = category.category_report(m.benchmark_shops, m.shop_rows, m.day)
    return rounded(report, "active_customer_rate", "new_customer_rate", "old_customer_rate", "retention_rate")


@query
def b11_category_interval(m: Marts) -> DataFrame:
    return category.category_interval(m.benchmark_shops, m.shop_rows, m.day)


# Points, grades


@query
def m1_valid_points(m: Marts) -> DataFrame:
    return points.valid_points(m.t.effective_point, m.day).select("card_plan_id", "member_id", "point", "effective_date", "overdue_date")


@query
def m2_point_bucket(m: Marts) -> DataFrame:
    rows = m.t.point_change
    value = F.col("change_value")
    names = {f"mp{w}": point_bucket(value, F.lit(w)) for w in (100, 200, 500)}
    return rows.withColumns(names).groupBy(*names, "card_plan_id").agg(F.count("*").alias("changes"))


@query
def m3_point_distribution(m: Marts) -> DataFrame:
    return points.point_distribution(m.t.effective_point, m.day)


@query
def m4_point_stock(m: Marts) -> DataFrame:
    return points.point_stock(m.t.effective_point, m.day).withColumn("day", F.lit(m.day))


@query
def m5_point_change_members(m: Marts) -> DataFrame:
    return points.point_change_members(m.t.point_change, m.day)


@query
def m6_point_flow(m: Marts) -> DataFrame:
    return points.point_flow(m.t.point_change, m.day)


@query
def m7_overdue_points(m: Marts) -> DataFrame:
    return points.overdue_points(m.t.effective_point, m.day)


@query
def m8_new_members(m: Marts) -> DataFrame:
    return points.new_members(m.t.member, m.day)


@query
def m9_grade_moves(m: Marts) -> DataFrame:
    return points.grade_moves(m.t.grade_change, m.day)


@query
def m10_plan_period_scaffold(m: Marts) -> DataFrame:
    return points.plan_period_scaffold(m.t.member)


@query
def m11_point_grade_report(m: Marts) -> DataFrame:
    return points.point_grade_report(m.t.member, m.t.point_change, m.t.effective_point, m.t.grade_change, m.day)


@query
def m11_point_grade_report_anchored_week(m: Marts) -> DataFrame:
    t = m.t
    return points.point_grade_report(t.member, t.point_change, t.effective_point, t.grade_change, m.day, anchored_week=True)


@query
def m12_grade_matrix(m: Marts) -> DataFrame:
    return points.grade_matrix(m.t.member, m.t.grade_change, m.day, periods=[5])


@query
def m12_grade_matrix_all_periods(m: Marts) -> DataFrame:
    return points.grade_matrix(m.t.member, m.t.grade_change, m.day)


@query
def m13_grade_matrix_report_anchored_week(m: Marts) -> DataFrame:
    return points.grade_matrix_report(m.t.member, m.t.grade_change, m.day, anchored_week=True)


@query
def m13_grade_matrix_report(m: Marts) -> DataFrame:
    return points.grade_matrix_report(m.t.member, m.t.grade_change, m.day)


# Conversion and life cycle


@query
def m14_member_year_value(m: Marts) -> DataFrame:
    return m.member_value


@query
def m15_consume_transform(m: Marts) -> DataFrame:
    return conversion.consume_transform(m.member_value)


@query
def m15_consume_transform_history(m: Marts) -> DataFrame:
    m.keep_trades()
    shop = rfm_wide.month_end_rfm(m.t.shop_customer, m.valid, m.ends, ["uni_id"])
    values = conversion.member_year_value(shop, m.t.member, m.t.card_shop, m.t.customer_member)
    return conversion.consume_transform(values)


@query
def m16_life_cycle_class(m: Marts) -> DataFrame:
    return m.wide.select(*LEVEL_KEYS, "uni_id", life_cycle.life_cycle_class().alias("class"))


@query
def m17_customer_member_link(m: Marts) -> DataFrame:
    return life_cycle.customer_member_link(m.wide, m.t.card_shop, m.t.member, m.t.customer_member)


@query
def m18_life_cycle_by_grade(m: Marts) -> DataFrame:
    return life_cycle.life_cycle_by_grade(m.cards(m.wide))


@query
def m19_life_cycle_totals(m: Marts) -> DataFrame:
    return life_cycle.life_cycle_totals(m.cards(m.wide))


@query
def m20_life_cycle_report(m: Marts) -> DataFrame:
    return life_cycle.life_cycle_report(m.wide, m.t.card_shop, m.t.member, m.t.customer_member)


@query
def m20_life_cycle_history(m: Marts) -> DataFrame:
    m.keep_trades()
    return life_cycle.life_cycle_history(m.t.shop_customer, m.valid, m.ends, m.t.card_shop, m.t.member, m.t.customer_member)


@query
def m21_life_cycle_simple(m: Marts) -> DataFrame:
    return life_cycle.life_cycle_simple(m.shop_rows, m.t.card_shop, m.t.member, m.t.customer_member)


# Stores


@query
def o1_offline_trades(m: Marts) -> DataFrame:
    names = list(calendar.PERIOD_NAMES.values())
    return m.offline.select("card_plan_id", "uni_shop_id", "uni_id", "member_id", "trade_id", "receive_payment", "created", *names)


@query
def o2_member_trades(m: Marts) -> DataFrame:
    cols = ["card_plan_id", "uni_shop_id", "member_id", "trade_id", "grade", "open_shop_id", "receive_payment", "created"]
    return m.own_trades.select(*cols)


@query
def o2_member_trades_any_shop(m: Marts) -> DataFrame:
    cols = ["card_plan_id", "uni_shop_id", "member_id", "trade_id", "grade", "open_shop_id", "receive_payment", "created"]
    return m.any_trades.select(*cols)


@query
def o3_sales_by_period(m: Marts) -> DataFrame:
    return offline.sales_by_period(m.offline, m.day)


@query
def o3_platform_sales(m: Marts) -> DataFrame:
    return offline.platform_sales(offline.sales_by_period(m.offline, m.day))


@query
def o4_member_sales_by_period(m: Marts) -> DataFrame:
    return offline.member_sales_by_period(m.any_trades, m.day)


@query
def o4_member_platform_sales(m: Marts) -> DataFrame:
    return offline.member_platform_sales(offline.member_sales_by_period(m.any_trades, m.day))


@query
def o5_grade_sales_by_period(m: Marts) -> DataFrame:
    return offline.grade_sales_by_period(m.any_trades, m.day)


@query
def o6_member_sale_rate(m: Marts) -> DataFrame:
    sold = offline.sales_by_period(m.offline, m.day)
    return offline.member_sale_rate(sold, offline.grade_sales_by_period(m.any_trades, m.day), m.day)


@query
def o7_shop_sale_rate(m: Marts) -> DataFrame:
    sold = offline.sales_by_period(m.offline, m.day)
    return offline.shop_sale_rate(sold, offline.grade_sales_by_period(m.own_trades, m.day), m.t.tenant_shop, m.day)


@query
def o8_member_growth(m: Marts) -> DataFrame:
    return offline.member_growth(m.t.member, m.t.tenant_shop, m.day)


@query
def o9_open_shop_consumption(m: Marts) -> DataFrame:
    return offline.open_shop_consumption(m.any_trades, m.day)


@query
def o10_all_shop_consumption(m: Marts) -> DataFrame:
    return offline.all_shop_consumption(m.any_trades, m.day)


@query
def o11_member_stock(m: Marts) -> DataFrame:
    return offline.member_stock(m.t.member, m.t.tenant_shop, m.day)


@query
def o12_consumption_report(m: Marts) -> DataFrame:
    stock = offline.member_stock(m.t.member, m.t.tenant_shop, m.day)
    own, everywhere = offline.open_shop_consumption(m.any_trades, m.day), offline.all_shop_consumption(m.any_trades, m.day)
    return offline.consumption_report(stock, own, everywhere, m.day)


@query
def o12_consumption_report_anchored_week(m: Marts) -> DataFrame:
    t = m.t
    trades = offline.offline_trades(t.trade, t.tenant_shop, t.card_shop, t.customer_member, m.day, anchored_week=True)
    mt = offline.member_trades(trades, t.member, any_shop=True)
    own, everywhere = offline.open_shop_consumption(mt, m.day, anchored_week=True), offline.all_shop_consumption(mt, m.day, anchored_week=True)
    return offline.consumption_report(offline.member_stock(t.member, t.tenant_shop, m.day), own, everywhere, m.day)


#: Platforms of the reports that leave out the others.
SOME_PLATFORMS = ("NATION_1", "NATION_6", "NATION_12", "NATION_20")


@query
def o6_member_sale_rate_on_platforms(m: Marts) -> DataFrame:
    t = m.t
    trades = offline.offline_trades(t.trade, t.tenant_shop, t.card_shop, t.customer_member, m.day, platforms=SOME_PLATFORMS)
    mt = offline.member_trades(trades, t.member, any_shop=True)
    return offline.member_sale_rate(offline.sales_by_period(trades, m.day), offline.grade_sales_by_period(mt, m.day), m.day)


@query
def o8_member_growth_on_platforms(m: Marts) -> DataFrame:
    return offline.member_growth(m.t.member, m.t.tenant_shop, m.day, platforms=SOME_PLATFORMS)


@query
def o11_member_stock_on_platforms(m: Marts) -> DataFrame:
    return offline.member_stock(m.t.member, m.t.tenant_shop, m.day, platforms=SOME_PLATFORMS)


# Social labels


@query
def l1_communication(m: Marts) -> DataFrame:
    return rounded(m.communication, "communication")


@query
def l2_influence(m: Marts) -> DataFrame:
    return rounded(m.influence, "influence")


@query
def l3_activity(m: Marts) -> DataFrame:
    return rounded(m.activity, "activity")


@query
def l4_interest_type(m: Marts) -> DataFrame:
    return m.interest


@query
def l5_shop_label(m: Marts) -> DataFrame:
    return m.shop_labels


@query
def l6_company_label(m: Marts) -> DataFrame:
    return social.company_label(m.t.union_member, m.shop_labels, m.action_day)


# Lifetime label


@query
def t1_lifetime_totals(m: Marts) -> DataFrame:
    return lifetime.lifetime_totals(m.valid)


@query
def t2_daily_merge(m: Marts) -> DataFrame:
    return lifetime.daily_merge(m.valid)


@query
def t3_first_last_payment(m: Marts) -> DataFrame:
    return lifetime.first_last_payment(lifetime.daily_merge(m.valid))


@query
def t4_year_totals(m: Marts) -> DataFrame:
    return lifetime.year_totals(m.valid, m.day)


@query
def t5_customer_type7(m: Marts) -> DataFrame:
    label = lifetime.shop_label_rfm(m.t.shop_customer, m.valid, m.day)
    return label.groupBy("tenant", "plat_code", "uni_shop_id", "customer_type").agg(F.count("*").alias("customers"))


@query
def t6_shop_label_rfm(m: Marts) -> DataFrame:
    return lifetime.shop_label_rfm(m.t.shop_customer, m.valid, m.day)


@query
def t7_platform_label(m: Marts) -> DataFrame:
    return lifetime.platform_label(lifetime.shop_label_rfm(m.t.shop_customer, m.valid, m.day), m.day)


@query
def t7_tenant_label(m: Marts) -> DataFrame:
    return lifetime.tenant_label(lifetime.shop_label_rfm(m.t.shop_customer, m.valid, m.day), m.day)


# Dashboard and channel


@query
def d1_channel_members(m: Marts) -> DataFrame:
    return dashboard.channel_members(m.t.tenant_shop, m.t.top_member)


@query
def d2_channel_trades(m: Marts) -> DataFrame:
    return dashboard.channel_trades(m.t.tenant_shop, m.t.top_trade, m.day)


@query
def d3_day_summary(m: Marts) -> DataFrame:
    return dashboard.day_summary(m.t.top_trade, m.t.refund, m.day)


@query
def d4_order_funnel(m: Marts) -> DataFrame:
    funnel = dashboard.order_funnel(m.t.top_trade, m.day)
    return rounded(funnel, *[f"rate_shiping_time_{step}" for step in ("paytime", "sends", "finished")])


@query
def d5_funnel_report(m: Marts) -> DataFrame:
    return dashboard.funnel_report(dashboard.order_funnel(m.t.top_trade, m.day), m.day)


@query
def d6_grade_distribution(m: Marts) -> DataFrame:
    return dashboard.grade_distribution(m.t.top_member, m.day)


@query
def d7_root_categories(m: Marts) -> DataFrame:
    return dashboard.root_categories(m.t.item_category, m.day)


@query
def d8_base_trades_yesterday(m: Marts) -> DataFrame:
    rows = dashboard.yesterday_trades(m.t.top_trade, m.day)
    return rows.select("dp_id", "tid", "status", "created", "buyer_nick", "pay_time", "payment", "consign_time", "end_time")


@query
def d8_base_trades(m: Marts) -> DataFrame:
    rows = dashboard.base_trades(m.t.top_trade, m.day)
    return rows.select("dp_id", "tid", "status", "created", "buyer_nick", "pay_time", "payment", "consign_time", "end_time")


# Audiences

AUDIENCE = ["dp_id", "tid", "buyer_nick", "status", "created", "pay_time", "end_time", "payment"]


@query
def e1_latest_trade_per_buyer(m: Marts) -> DataFrame:
    return m.latest_trades.select(*AUDIENCE)


@query
def e2_enrich_audience(m: Marts) -> DataFrame:
    return m.enriched.select(*AUDIENCE, "member_status", "member_grade", "period", *EVENT_METRICS)


@query
def e3_nest_rfm(m: Marts) -> DataFrame:
    rows = m.latest_trades.select("dp_id", "tid", "buyer_nick").join(m.t.rfm_event, ["dp_id", "buyer_nick"])
    nested = audience.nest_rfm(rows, EVENT_METRICS)
    flat = nested.select("dp_id", "tid", "buyer_nick", F.size("rfm").alias("rfm_size"), F.explode("rfm").alias("r"))
    return flat.select("dp_id", "tid", "buyer_nick", "rfm_size", "r.period", "r.trade_tidcount", "r.trade_amount")


@query
def e4_nest_orders(m: Marts) -> DataFrame:
    nested = audience.nest_orders(m.latest_trades.select("dp_id", "tid"), m.t.top_order, m.day)
    flat = nested.select("dp_id", "tid", F.size("orders").alias("order_size"), F.explode("orders").alias("o"))
    return flat.select("dp_id", "tid", "order_size", "o.*")


DUE = ["dp_id", "tid", "oid", "buyer_nick", "cid", "num_iid", "sku_id", "num", "created", "config_period", "config_exclude_customer"]


@query
def e5_repurchase_due(m: Marts) -> DataFrame:
    return m.due_items.select(*DUE)


@query
def e6_exclude_rebought(m: Marts) -> DataFrame:
    return m.kept_items.select(*DUE)


@query
def e6_exclude_rebought_all_days(m: Marts) -> DataFrame:
    """Every order line of the horizon checked for a later purchase within 30 days, in each mode."""
    recent = audience.recent_orders(m.t.top_order, m.day)
    mode = F.explode(F.array(*[F.lit(c) for c in ("0", "1", "2", "3")]))
    due = recent.withColumns({"config_period": F.lit(30), "config_exclude_customer": mode})
    kept = audience.exclude_rebought(due, m.t.top_order, m.day)
    return kept.groupBy("dp_id", "config_exclude_customer").agg(F.count("*").alias("kept"))


@query
def e7_dedup_audience(m: Marts) -> DataFrame:
    lines = m.t.top_order.withColumn("config_exclude_flag", F.lit(None).cast("string"))
    return audience.dedup_audience(lines).select("oid", "dp_id", "num_iid", "num", "sku_id", "created")


@query
def e7_item_audience(m: Marts) -> DataFrame:
    """Due items with trade, member and metrics, without flagged trades, one row per line item."""
    flags = m.t.top_trade.select("tid", "seller_flag")
    rows = audience.drop_flagged(m.kept_items.join(flags, "tid", "left"))
    enriched = audience.enrich_audience(rows, m.t.top_member, m.t.rfm_event)
    return audience.dedup_audience(enriched).select(*DUE, "member_grade", "trade_tidcount", "trade_amount")


@query
def e8_festival_members(m: Marts) -> DataFrame:
    t = m.t
    return audience.festival_members(t.festival_config, t.member, t.customer_member, t.tenant_shop, t.customer_contact, t.customer_account, m.day)


@query
def e8_festival_members_on_platforms(m: Marts) -> DataFrame:
    t = m.t
    return audience.festival_members(
        t.festival_config, t.member, t.customer_member, t.tenant_shop, t.customer_contact, t.customer_account, m.day, platforms=SOME_PLATFORMS
    )


@query
def e9_publish_events(m: Marts) -> DataFrame:
    path = work_folder(m.spark, "events")
    messages = audience.event_messages(m.latest_trades.select(*AUDIENCE), "tid")
    writers.publish_events(messages, path)
    sent = m.spark.read.schema("key string, value string").json(path)
    body = F.from_json("value", "dp_id string, buyer_nick string, payment double")
    return sent.select("key", body.alias("b")).select("key", "b.*")


@query
def e10_valid_timestamp(m: Marts) -> DataFrame:
    """Usable times per status among the text forms of payment times."""
    text = F.coalesce(F.date_format("pay_time", "yyyy-MM-dd HH:mm:ss"), F.lit("NULL"))
    rows = m.t.top_trade.select("status", valid_timestamp(text).alias("usable"))
    return rows.groupBy("status").agg(count_if(F.col("usable")).alias("usable"), count_if(~F.col("usable")).alias("unusable"))
