"""Lazily built shared stages over one folder of test tables."""

from datetime import timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.constants import SHOP
from patronage.functions.calendar import month_ends, until
from patronage.operators import audience, category, conversion, life_cycle, offline, rfm_daily, rfm_late, rfm_wide, sales, social
from patronage.session import stored_once
from patronage.sources import cleaning
from patronage.sources.testtables import ACTION_DAY, COMMERCE_DAY, LAST_RUN, Tables


class Marts:
    """Stages that several reports start from. In production the wide table among them is stored."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.t = Tables(spark, folder)
        self.day = COMMERCE_DAY
        self.action_day = ACTION_DAY
        self._kept = False

    def keep_trades(self) -> None:
        """Write shops and trades once, for stages that read them several times. In production both are stored tables.

        The size of a stored shop table is known, so Spark need not move trades to look a shop up as long as shops are few.
        """
        if not self._kept:
            self._kept = True
            self.t.tenant_shop = stored_once(self.spark, "shops", self.t.tenant_shop)
            self.t.trade = stored_once(self.spark, "trade", self.t.trade)

    # wide table

    @cached_property
    def valid(self) -> DataFrame:
        return cleaning.valid_trades(self.t.trade, self.t.tenant_shop, self.day)

    @cached_property
    def shop(self) -> DataFrame:
        self.keep_trades()
        return rfm_wide.shop_rfm(self.t.shop_customer, self.valid, self.day)

    @cached_property
    def wide(self) -> DataFrame:
        return rfm_wide.all_levels(self.shop)

    @cached_property
    def wide_whole(self) -> DataFrame:
        """The same rows for readers of the second purchase, and where a task should hold little."""
        return rfm_wide.whole_levels(self.shop)

    @cached_property
    def shop_rows(self) -> DataFrame:
        """Shop level with its type, where upper levels are not needed."""
        return self.shop.withColumn("type", F.lit(SHOP))

    @cached_property
    def history(self) -> DataFrame:
        self.keep_trades()
        return rfm_wide.month_end_history(self.t.shop_customer, self.valid, self.day)

    # daily and late maintenance

    def arrived_by(self, day) -> DataFrame:
        rows = self.t.trade.filter(until(F.col("arrived"), day))
        return cleaning.valid_trades(rows, self.t.tenant_shop, day)

    @cached_property
    def yesterday(self):
        return self.day - timedelta(days=1)

    @cached_property
    def base(self) -> DataFrame:
        return self.arrived_by(self.yesterday)

    @cached_property
    def delta(self) -> DataFrame:
        return cleaning.daily_increment(self.t.trade, self.t.tenant_shop, self.day)

    @cached_property
    def previous(self) -> DataFrame:
        """The snapshot that yesterday's run left; in production a stored table."""
        return rfm_wide.shop_rfm(self.t.customers_by(self.yesterday), self.base, self.yesterday)

    @cached_property
    def increment(self) -> DataFrame:
        return rfm_daily.increment_rfm(self.delta, self.day)

    @cached_property
    def year_out(self) -> DataFrame:
        return rfm_daily.boundary_metrics(cleaning.boundary_day_trades(self.base, self.day, 12))

    @cached_property
    def tyear_out(self) -> DataFrame:
        return rfm_daily.boundary_metrics(cleaning.boundary_day_trades(self.base, self.day, 24))

    @cached_property
    def aged(self) -> DataFrame:
        self.keep_trades()
        bounds = rfm_daily.year_bounds(self.base, self.year_out, self.day)
        return rfm_daily.age_rfm(self.previous, self.year_out, self.tyear_out, bounds, self.t.customers_by(self.day), self.day)

    @cached_property
    def late_delta(self) -> DataFrame:
        rows = self.t.trade.filter(~until(F.col("arrived"), LAST_RUN) & until(F.col("arrived"), self.day))
        return cleaning.clean_trades(rows, self.t.tenant_shop)

    @cached_property
    def ends(self):
        return month_ends(self.day)

    @cached_property
    def snapshots(self) -> DataFrame:
        """The month ends that the last run left; in production a stored table."""
        self.keep_trades()
        return rfm_wide.month_end_rfm(self.t.customers_by(LAST_RUN), self.arrived_by(LAST_RUN), self.ends)

    @cached_property
    def late(self) -> DataFrame:
        return rfm_late.late_rows(self.late_delta, self.ends)

    @cached_property
    def late_new(self) -> DataFrame:
        return rfm_late.late_new_customers(self.late, self.snapshots, self.t.customers_by(self.day))

    @cached_property
    def patched(self) -> DataFrame:
        return rfm_late.patch_month_ends(self.snapshots, self.late_delta, self.t.customers_by(self.day), self.ends)

    # sales

    def customer_period(self, grain: str) -> DataFrame:
        trades = sales.period_trades(self.t.trade, self.t.tenant_shop, self.day, grain)
        return sales.customer_period(trades, grain)

    def customer_levels(self, grain: str) -> DataFrame:
        return sales.customer_period_rollup(self.customer_period(grain))

    def marked(self, grain: str) -> DataFrame:
        self.keep_trades()
        return sales.with_kind(self.customer_levels(grain), self.wide, grain)

    def sales_report(self, grain: str) -> DataFrame:
        self.keep_trades()
        return sales.sales_report(self.t.trade, self.t.tenant_shop, self.wide, self.day, grain)

    # categories

    @cached_property
    def category_trades(self) -> DataFrame:
        return category.benchmark_trades(self.t.trade, self.day)

    @cached_property
    def eligible(self) -> DataFrame:
        return category.eligible_shops(self.category_trades, self.day)

    @cached_property
    def category_payment(self) -> DataFrame:
        t = self.t
        return category.shop_category_payment(self.eligible, self.category_trades, t.order_item, t.product, t.category, self.day)

    @cached_property
    def dominant(self) -> DataFrame:
        return category.dominant_category_shops(self.category_payment, share=0.25)

    @cached_property
    def top_shops(self) -> DataFrame:
        return category.top_n_shops(self.category_payment, self.dominant)

    @cached_property
    def full_top(self) -> DataFrame:
        return category.complete_groups(self.top_shops)

    @cached_property
    def benchmark_shops(self) -> DataFrame:
        """The rows of `full_top` in one pass."""
        return category.benchmark_groups(self.category_payment, share=0.25)

    @cached_property
    def category_units(self) -> DataFrame:
        t = self.t
        return category.shop_category_units(self.category_trades, t.order_item, t.product, t.category, self.day)

    # members

    @cached_property
    def member_value(self) -> DataFrame:
        return conversion.member_year_value(self.shop, self.t.member, self.t.card_shop, self.t.customer_member)

    def cards(self, wide: DataFrame) -> DataFrame:
        return life_cycle.customers_with_cards(wide, self.t.card_shop, self.t.member, self.t.customer_member)

    # stores

    @cached_property
    def offline(self) -> DataFrame:
        t = self.t
        return offline.offline_trades(t.trade, t.tenant_shop, t.card_shop, t.customer_member, self.day)

    @cached_property
    def own_trades(self) -> DataFrame:
        return offline.member_trades(self.offline, self.t.member)

    @cached_property
    def any_trades(self) -> DataFrame:
        return offline.member_trades(self.offline, self.t.member, any_shop=True)

    # social

    @cached_property
    def communication(self) -> DataFrame:
        return social.communication(self.t.action, self.action_day)

    @cached_property
    def influence(self) -> DataFrame:
        return social.influence(self.t.action, self.communication, self.action_day)

    @cached_property
    def activity(self) -> DataFrame:
        return social.activity(self.t.action, self.action_day)

    @cached_property
    def interest(self) -> DataFrame:
        return social.interest_type(self.t.action, self.action_day)

    @cached_property
    def shop_labels(self) -> DataFrame:
        t = self.t
        return social.shop_label(t.social_member, t.social_profile, self.communication, self.influence, self.activity, self.interest)

    # audiences

    @cached_property
    def latest_trades(self) -> DataFrame:
        return audience.latest_trade_per_buyer(self.t.top_trade, self.t.care_shop, self.day)

    @cached_property
    def enriched(self) -> DataFrame:
        return audience.enrich_audience(self.latest_trades, self.t.top_member, self.t.rfm_event)

    @cached_property
    def due_items(self) -> DataFrame:
        return audience.repurchase_due(self.t.top_order, self.t.item_config, self.day)

    @cached_property
    def kept_items(self) -> DataFrame:
        return audience.exclude_rebought(self.due_items, self.t.top_order, self.day)


def snapshot_rows(rows: DataFrame) -> DataFrame:
    """Whole snapshot rows, with their level where they have one."""
    return rows.select(*[c for c in ("type",) if c in rows.columns], *rfm_wide.WIDE_COLUMNS)
