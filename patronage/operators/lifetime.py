"""Lifetime label of each customer at shop, platform and tenant level."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.constants import CUSTOMER_KEYS
from patronage.functions.calendar import shift_months, until
from patronage.functions.expressions import money_sum, ratio


def lifetime_totals(trades: DataFrame, keys: list[str] = CUSTOMER_KEYS) -> DataFrame:
    """Amount, orders and average order value."""
    totals = trades.groupBy(*keys).agg(
        money_sum(F.col("receive_payment")).alias("all_payment"), F.count("created").alias("all_count_buy")
    )
    return totals.withColumn("all_avg_payment", ratio(F.col("all_payment"), F.col("all_count_buy")))


def daily_merge(trades: DataFrame, keys: list[str] = CUSTOMER_KEYS) -> DataFrame:
    """Amount, orders and times per customer, shop and day."""
    return trades.groupBy(*keys, F.to_date("created").alias("buy_day")).agg(
        money_sum(F.col("receive_payment")).alias("day_payment"),
        F.count("created").alias("day_count"),
        F.min("created").alias("day_first"),
        F.max("created").alias("day_last"),
    )


def first_last_payment(daily: DataFrame, keys: list[str] = CUSTOMER_KEYS) -> DataFrame:
    """First and last purchase time and the amounts of those days."""
    return daily.groupBy(*keys).agg(
        F.min("day_first").alias("first_created"),
        F.max("day_last").alias("last_created"),
        F.min_by("day_payment", "buy_day").alias("first_payment"),
        F.max_by("day_payment", "buy_day").alias("last_payment"),
    )


def in_last_year(time: Column, day: date) -> Column:
    return (time >= F.lit(shift_months(day, -12) + timedelta(days=1))) & until(time, day)


def year_totals(trades: DataFrame, day: date, keys: list[str] = CUSTOMER_KEYS) -> DataFrame:
    recent = trades.filter(in_last_year(F.col("created"), day))
    totals = recent.groupBy(*keys).agg(
        F.count("created").alias("year_count_buy"), money_sum(F.col("receive_payment")).alias("year_payment")
    )
    return totals.withColumn("year_avg_payment", ratio(F.col("year_payment"), F.col("year_count_buy")))


def customer_type7(first: Column, last: Column, orders: Column, day: date) -> Column:
    """Never; one order, new or old; several, new or old; last bought in the year before; earlier."""
    year, two = F.lit(shift_months(day, -12)), F.lit(shift_months(day, -24))
    new, last_day = F.to_date(first) > year, F.to_date(last)
    return (
        F.when(first.isNull(), "1")
        .when(new & (orders == 1), "2")
        .when(~new & (orders == 1), "3")
        .when(new & (orders >= 2), "4")
        .when(~new & (orders >= 2), "5")
        .when((last_day <= year) & (last_day > two), "6")
        .when(last_day <= two, "7")
    )


def shop_label_rfm(customers: DataFrame, trades: DataFrame, day: date) -> DataFrame:
    """Shop label of every known customer.

    All figures come from the day-merged rows: one shuffle of trades, reduced on the map side.
    """
    daily = daily_merge(trades.filter(until(F.col("created"), day)))
    year = in_last_year(F.col("buy_day"), day)
    metrics = daily.groupBy(*CUSTOMER_KEYS).agg(
        money_sum(F.col("day_payment")).alias("all_payment"),
        F.sum("day_count").alias("all_count_buy"),
        F.min("day_first").alias("first_created"),
        F.min_by("day_payment", "buy_day").alias("first_payment"),
        F.max("day_last").alias("last_created"),
        F.max_by("day_payment", "buy_day").alias("last_payment"),
        money_sum(F.when(year, F.col("day_payment"))).alias("year_payment"),
        F.sum(F.when(year, F.col("day_count"))).alias("year_count_buy"),
    )
    return _finish(customers.select(*CUSTOMER_KEYS).join(metrics, CUSTOMER_KEYS, "left"), CUSTOMER_KEYS, day)


def _finish(df: DataFrame, keys: list[str], day: date, extra: tuple[str, ...] = ()) -> DataFrame:
    money = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("all_payment", "first_payment", "last_payment", "year_payment")}
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("all_count_buy", "year_count_buy")}
    filled = df.withColumns(money | counts)
    averages = {
        f"{p}_avg_payment": F.coalesce(ratio(F.col(f"{p}_payment"), F.col(f"{p}_count_buy")), F.lit(0.0)) for p in ("all", "year")
    }
    kind = customer_type7(F.col("first_created"), F.col("last_created"), F.col("year_count_buy"), day)
    return filled.withColumns(averages).select(
        *keys,
        *extra,
        "all_payment",
        "all_count_buy",
        "all_avg_payment",
        "first_created",
        "first_payment",
        "last_created",
        "last_payment",
        "year_payment",
        "year_count_buy",
        "year_avg_payment",
        kind.alias("customer_type"),
        F.lit(day).alias("stat_date"),
    )


def _rolled() -> list[Column]:
    return [
        money_sum(F.col("all_payment")).alias("all_payment"),
        F.sum("all_count_buy").alias("all_count_buy"),
        F.min("first_created").alias("first_created"),
        F.max("last_created").alias("last_created"),
        money_sum(F.col("year_payment")).alias("year_payment"),
        F.sum("year_count_buy").alias("year_count_buy"),
    ]


def _pick(place: list[str]) -> list[Column]:
    """Amount and place of the first and last purchase; equal times fall to the smaller place first."""
    bought = F.col("first_created").isNotNull()
    first = F.struct("first_created", *place)
    last = F.struct("last_created", *place)
    out = [
        F.min_by("first_payment", F.when(bought, first)).alias("first_payment"),
        F.max_by("last_payment", F.when(bought, last)).alias("last_payment"),
    ]
    for c in place:
        out.append(F.min_by(c, F.when(bought, first)).alias(f"first_{c}"))
        out.append(F.max_by(c, F.when(bought, last)).alias(f"last_{c}"))
    return out


def _visited(c: str) -> Column:
    """Places with a purchase, sorted; the list is as long as the customer's places."""
    seen = F.collect_set(F.when(F.col("first_created").isNotNull(), F.col(c)))
    return F.concat_ws(",", F.array_sort(seen)).alias(f"all_{c}")


def platform_label(shop: DataFrame, day: date) -> DataFrame:
    keys = ["tenant", "plat_code", "uni_id"]
    rolled = shop.groupBy(*keys).agg(*_rolled(), *_pick(["uni_shop_id"]), _visited("uni_shop_id"))
    return _finish(rolled, keys, day, ("all_uni_shop_id", "first_uni_shop_id", "last_uni_shop_id"))


def tenant_label(shop: DataFrame, day: date) -> DataFrame:
    keys = ["tenant", "uni_id"]
    place = ["plat_code", "uni_shop_id"]
    rolled = shop.groupBy(*keys).agg(*_rolled(), *_pick(place), _visited("plat_code"), _visited("uni_shop_id"))
    extra = ("all_plat_code", "all_uni_shop_id", "first_plat_code", "first_uni_shop_id", "last_plat_code", "last_uni_shop_id")
    return _finish(rolled, keys, day, extra)
