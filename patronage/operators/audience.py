"""Audiences for care after a purchase, item re-purchase and festivals."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.constants import FINISHED_STATUS
from patronage.functions.calendar import until
from patronage.functions.expressions import null_if_token, with_valid_times
from patronage.operators.offline import on_platforms

# Exclusion modes of item re-purchase.
KEEP_ALL, SAME_SHOP, SAME_CATEGORY, SAME_ITEM = "0", "1", "2", "3"

HORIZON = 180
FULL_PERIOD = 6


def recent_orders(orders: DataFrame, day: date, days: int = HORIZON) -> DataFrame:
    """Open partition and closed months of the last days; finished or paid orders only. Times that arrive as text count
    where they are usable times."""
    orders = with_valid_times(orders, ["created", "pay_time", "end_time"])
    first = day - timedelta(days=days)
    in_part = (F.col("part") == "active") | (F.col("part") >= f"{first:%Y-%m}")
    usable = (F.col("status") == FINISHED_STATUS) | F.col("pay_time").isNotNull()
    return orders.filter(in_part & (F.col("created") >= F.lit(first)) & until(F.col("created"), day) & usable)


def due_on(time: Column, days: Column, day: date) -> Column:
    return F.coalesce(F.date_add(F.to_date(time), days) == F.lit(day), F.lit(False))


def latest_trade_per_buyer(trades: DataFrame, subscribed: DataFrame, day: date, days: int = HORIZON) -> DataFrame:
    """Latest trade of each buyer in each subscribed shop, when its care day is today.

    Of trades placed at the same latest time, one that is due is taken. The rank filter keeps only
    the latest rows per buyer on the map side.
    """
    shops = subscribed.select(F.col("shop_id").alias("dp_id"), "care_days")
    buyer = Window.partitionBy("dp_id", "buyer_nick")
    recent = recent_orders(trades, day, days).withColumn("rank", F.rank().over(buyer.orderBy(F.col("created").desc())))
    latest = recent.filter(F.col("rank") == 1).drop("rank").join(shops, "dp_id")
    wait = F.col("care_days")
    due = latest.filter(due_on(F.col("pay_time"), wait, day) | due_on(F.col("end_time"), wait, day)).drop("care_days")
    return due.withColumn("rank", F.row_number().over(buyer.orderBy(F.col("tid").desc()))).filter(F.col("rank") == 1).drop("rank")


def enrich_audience(rows: DataFrame, members: DataFrame, rfm_event: DataFrame, period: int = FULL_PERIOD) -> DataFrame:
    """Add member state and the trade metrics of the period; buyers without metrics are dropped."""
    keys = ["dp_id", "buyer_nick"]
    state = members.select(*keys, F.col("status").alias("member_status"), F.col("grade").alias("member_grade"))
    return rows.join(state, keys, "left").join(rfm_event.filter(F.col("period") == period), keys)


def nest_rfm(rows: DataFrame, metrics: list[str]) -> DataFrame:
    """One row per audience entry with its metric rows as an array; there is one per period."""
    keys = [c for c in rows.columns if c not in ("period", *metrics)]
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("period", *metrics))).alias("rfm"))


def nest_orders(rows: DataFrame, orders: DataFrame, day: date, days: int = HORIZON) -> DataFrame:
    """Add the line items of each trade as an array; trades without lines are dropped."""
    first = day - timedelta(days=days)
    in_part = (F.col("part") == "active") | (F.col("part") >= f"{first:%Y-%m}")
    lines = orders.filter(in_part & (F.col("created") >= F.lit(first)) & until(F.col("created"), day))
    own = lines.join(rows.select("tid"), "tid", "left_semi")
    item = F.struct("oid", "cid", "num", "num_iid", F.col("status").alias("order_status"))
    return rows.join(own.groupBy("tid").agg(F.array_sort(F.collect_list(item)).alias("orders")), "tid")


def repurchase_due(orders: DataFrame, config: DataFrame, day: date, days: int = HORIZON) -> DataFrame:
    """Line items whose finishing or payment day plus period × quantity is today."""
    rules = config.select(
        F.col("shop_id").alias("dp_id"),
        F.col("item_id").alias("num_iid"),
        null_if_token(F.col("sku_id")).alias("rule_sku"),
        "period",
        F.col("exclude_flag").alias("config_exclude_flag"),
        F.col("exclude_customer").alias("config_exclude_customer"),
        "trigger_status",
    )
    joined = recent_orders(orders, day, days).join(rules, ["dp_id", "num_iid"])
    wait = F.col("period") * F.col("num")
    by_finish = (F.col("trigger_status") == "0") & (F.col("status") == FINISHED_STATUS) & due_on(F.col("end_time"), wait, day)
    by_payment = (F.col("trigger_status") == "1") & due_on(F.col("pay_time"), wait, day)
    sku = F.col("rule_sku").isNull() | (F.col("rule_sku") == F.col("sku_id"))
    return joined.filter((by_finish | by_payment) & sku).withColumn("config_period", wait).drop("rule_sku", "period", "trigger_status")


def exclude_rebought(due: DataFrame, orders: DataFrame, day: date, days: int = HORIZON) -> DataFrame:
    """Drop items bought again within their period, by the rule's mode.

    A later order counts when it was placed after the item and at most `config_period` days after
    it. Orders are first reduced to one row per buyer, shop, item and day; each due item then meets
    one row that holds the days of the horizon, so a busy buyer never forms pairs of orders.
    """
    buyer = ["dp_id", "buyer_nick"]
    bought = recent_orders(orders, day, days).filter(F.col("pay_time").isNotNull())
    bought = bought.join(due.select(*buyer), buyer, "left_semi")
    daily = bought.groupBy(*buyer, "cid", "num_iid", F.to_date("created").alias("day")).agg(
        F.min("created").alias("first"), F.max("created").alias("last")
    )
    shop, cid, item = F.lit(None).cast("string"), F.col("cid"), F.col("num_iid")
    modes = F.array(
        F.struct(F.lit(SAME_SHOP).alias("mode"), shop.alias("scope")),
        F.struct(F.lit(SAME_CATEGORY).alias("mode"), cid.alias("scope")),
        F.struct(F.lit(SAME_ITEM).alias("mode"), item.alias("scope")),
    )
    scoped = daily.withColumn("m", F.explode(modes)).select(*buyer, "m.*", "day", "first", "last")
    scope_key = F.coalesce("scope", F.lit(""))
    per_day = scoped.groupBy(*buyer, "mode", scope_key.alias("scope"), "day").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    calendar = per_day.groupBy(*buyer, "mode", "scope").agg(F.collect_list(F.struct("first", "last")).alias("days"))
    mode = F.col("config_exclude_customer")
    wanted = F.when(mode == SAME_CATEGORY, F.col("cid")).when(mode == SAME_ITEM, F.col("num_iid")).otherwise("")
    marked = due.withColumns({"mode": mode, "scope": wanted})
    joined = marked.join(calendar, [*buyer, "mode", "scope"], "left")
    latest = F.col("created") + F.make_dt_interval(days=F.col("config_period"))
    # A row holds the first and last order of a day, so an empty window must be ruled out on its own.
    again = (F.col("config_period") > 0) & F.exists("days", lambda d: (d["last"] > F.col("created")) & (d["first"] <= latest))
    known = F.col("mode").isin(KEEP_ALL, SAME_SHOP, SAME_CATEGORY, SAME_ITEM)
    kept = joined.filter(known & ((F.col("mode") == KEEP_ALL) | ~F.coalesce(again, F.lit(False))))
    return kept.select(*due.columns)


def drop_flagged(rows: DataFrame) -> DataFrame:
    """Drop trades whose seller flag is among the rule's excluded flags (comma-separated)."""
    flags = F.split(null_if_token(F.col("config_exclude_flag")), ",")
    hit = F.array_contains(flags, F.col("seller_flag").cast("string"))
    return rows.filter(~F.coalesce(hit, F.lit(False)))


def dedup_audience(rows: DataFrame) -> DataFrame:
    """One row per line item: the latest version, then the smallest item."""
    w = Window.partitionBy("oid").orderBy(F.col("created").desc(), "num_iid", "dp_id", "num", "sku_id")
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") == 1).drop("rank")


def festival_members(
    config: DataFrame,
    members: DataFrame,
    relation: DataFrame,
    tenant_shop: DataFrame,
    contacts: DataFrame,
    accounts: DataFrame,
    day: date,
    platforms: tuple[str, ...] | None = None,
) -> DataFrame:
    """Members of shops whose care window holds the day, with contact and account; of some platforms where named."""
    shops = config.filter((F.col("care_from") <= F.lit(day)) & (F.col("care_to") >= F.lit(day))).select("shop_id").distinct()
    known = on_platforms(members, platforms).filter(F.col("card_plan_id").isNotNull() & F.col("member_id").isNotNull())
    caring = tenant_shop.select("tenant", "plat_code", "shop_id", "uni_shop_id").join(shops, "shop_id")
    rows = known.select("card_plan_id", "uni_shop_id", "member_id", "grade").join(caring, "uni_shop_id")
    linked = rows.join(relation.select("card_plan_id", "member_id", "uni_id"), ["card_plan_id", "member_id"])
    reachable = contacts.filter(F.col("full_name").isNotNull() & F.col("mobile").isNotNull())
    named = linked.join(reachable.select("tenant", "uni_id", "full_name", "mobile"), ["tenant", "uni_id"])
    account = accounts.filter(F.col("plat_account").isNotNull()).select("plat_code", "uni_shop_id", "uni_id", "plat_account")
    return named.join(account, ["plat_code", "uni_shop_id", "uni_id"]).select(
        "tenant", "plat_code", "uni_shop_id", "shop_id", "member_id", "grade", "uni_id", "full_name", "mobile", "plat_account"
    )


def event_messages(rows: DataFrame, key: str) -> DataFrame:
    """One JSON message per audience row, keyed for the topic."""
    return rows.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"))
