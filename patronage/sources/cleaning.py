"""Scans and cleaning of trades, day deltas, boundary days and action logs."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.constants import ACCEPTED_STATUSES, MONEY_DIGITS
from patronage.functions.calendar import shift_months, until, windows
from patronage.functions.expressions import number

TRADE_KEY = ["tenant", "plat_code", "uni_shop_id", "trade_id"]
#: Columns of a clean trade that wide rows are made of.
CLEAN = [*TRADE_KEY, "uni_id", "receive_payment", "product_num", "created"]


def clean_trades(
    trades: DataFrame, tenant_shop: DataFrame, statuses: tuple[str, ...] | None = ACCEPTED_STATUSES, presale: bool = True
) -> DataFrame:
    """Net payment, item count, purchase time and tenant of the usable trades.

    A pre-sale order counts from its payment; `ordered` keeps the time it was placed. The shop table
    is joined without a hint: Spark broadcasts it when its size allows and splits hot shops otherwise.
    """
    usable = F.col("created").isNotNull() & F.col("uni_id").isNotNull() & F.col("payment").isNotNull()
    if statuses is not None:
        usable = usable & F.col("order_status").isin(*statuses)
    net = F.round(number(trades, "payment") - F.coalesce(number(trades, "refund_fee"), F.lit(0.0)), MONEY_DIGITS)
    time: Column = F.col("created")
    if presale:
        time = F.when(F.lower("trade_type") == "step", F.coalesce("pay_time", "created")).otherwise(time)
    kept = ["arrived"] if "arrived" in trades.columns else []
    step = F.coalesce(F.lower("trade_type") == "step", F.lit(False)).cast("int")
    cleaned = trades.filter(usable).select(
        "plat_code",
        "shop_id",
        "uni_shop_id",
        "uni_id",
        "trade_id",
        net.alias("receive_payment"),
        F.coalesce(F.col("product_num"), F.lit(1)).cast("int").alias("product_num"),
        time.alias("created"),
        F.col("created").alias("ordered"),
        step.alias("presale"),
        *kept,
    )
    shops = tenant_shop.filter(F.col("tenant").isNotNull()).select("tenant", "plat_code", "shop_id")
    return cleaned.join(shops, ["plat_code", "shop_id"])


def valid_trades(trades: DataFrame, tenant_shop: DataFrame, day: date) -> DataFrame:
    """All usable trades placed up to the day."""
    return clean_trades(trades.filter(until(F.col("created"), day)), tenant_shop)


def daily_increment(delta: DataFrame, tenant_shop: DataFrame, day: date) -> DataFrame:
    """Usable trades that arrived on the day; they may have been placed at any time before."""
    arrived = delta.filter((F.col("arrived") >= F.lit(day)) & until(F.col("arrived"), day))
    return clean_trades(arrived, tenant_shop)


def boundary_day_trades(trades: DataFrame, day: date, months: int) -> DataFrame:
    """Cleaned trades that leave the window of `months` months between the day before and the day.

    This is one day, except around a month end, where it can be none or several.
    """
    now, before = windows(day), windows(day - timedelta(days=1))
    start, end = (before.year_start, now.year_start) if months == 12 else (before.tyear_start, now.tyear_start)
    leaving = trades.filter((F.col("created") >= F.lit(start)) & (F.col("created") < F.lit(end)))
    return leaving.dropDuplicates([*TRADE_KEY, "uni_id"])


def trades_since(trades: DataFrame, day: date, months: int | None = None, days: int | None = None) -> DataFrame:
    """Raw trades of the last months or days; the month partition is pruned before the exact filter."""
    first = shift_months(day, -months) + timedelta(days=1) if months else day - timedelta(days=days - 1)
    recent = trades.filter((F.col("created") >= F.lit(first)) & until(F.col("created"), day))
    if "part" in trades.columns:
        recent = recent.filter((F.col("part") >= f"{first:%Y-%m}") & (F.col("part") <= f"{day:%Y-%m}"))
    return recent


def active_or_month_scan(trades: DataFrame, day: date, days: int) -> DataFrame:
    """Open orders plus the closed month partitions that can hold the last days, then the exact filter."""
    first = day - timedelta(days=days)
    in_part = (F.col("part") == "active") | (F.col("part") >= f"{first:%Y-%m}")
    return trades.filter(in_part & (F.col("created") >= F.lit(first)) & until(F.col("created"), day))


def actions_since(actions: DataFrame, day: date, weeks: int = 12, action: str | None = None) -> DataFrame:
    """Action log of the last weeks; opens of one's own share are dropped."""
    recent = actions.filter((F.col("action_time") >= F.lit(day - timedelta(weeks=weeks))) & until(F.col("action_time"), day))
    if action:
        recent = recent.filter(F.col("action") == action)
    if action == "OPEN_SHARE":
        recent = recent.filter(F.col("relate_userid").isNotNull() & (F.col("user_id") != F.col("relate_userid")))
    return recent


def delivered_keys(delta: DataFrame, tenant_shop: DataFrame, day: date) -> DataFrame:
    """Keys of all trades that arrived on the day, usable or not, as their stored versions no longer hold; with the month
    they were placed in and whether they are pre-sale orders."""
    arrived = delta.filter((F.col("arrived") >= F.lit(day)) & until(F.col("arrived"), day))
    shops = tenant_shop.filter(F.col("tenant").isNotNull()).select("tenant", "plat_code", "shop_id")
    step = F.coalesce(F.lower("trade_type") == "step", F.lit(False)).cast("int")
    found = arrived.join(shops, ["plat_code", "shop_id"])
    return found.select(*TRADE_KEY, F.date_format("created", "yyyy-MM").alias("placed"), step.alias("presale")).distinct()


def located(trades: DataFrame) -> DataFrame:
    """Clean trades with the month of purchase, by which they are stored."""
    return trades.select(*CLEAN, "presale", F.date_format("created", "yyyy-MM").alias("part"))


def months_of(start: date, end: date) -> list[dict[str, object]]:
    """Stored months that hold the days from start to before end."""
    months, month = [], start.replace(day=1)
    while month < end:
        months.append({"part": f"{month:%Y-%m}"})
        month = shift_months(month, 1)
    return months if start < end else []


def latest_versions(base: DataFrame, delta: DataFrame, delivered: DataFrame | None = None) -> DataFrame:
    """Base trades with the redelivered ones replaced by the version in the delta, or dropped where that is unusable."""
    gone = delta.select(*TRADE_KEY) if delivered is None else delivered
    return base.join(gone, TRADE_KEY, "left_anti").unionByName(delta)


def unseen_trades(delta: DataFrame, base: DataFrame) -> DataFrame:
    """Delta trades that the base does not hold yet, so that a second run adds nothing."""
    return delta.join(base.select(*TRADE_KEY), TRADE_KEY, "left_anti")
