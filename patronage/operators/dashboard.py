"""Shop dashboard and channel reports."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.constants import FINISHED_STATUS, PAID_STATUSES, SENT_STATUSES
from patronage.functions.calendar import until
from patronage.functions.expressions import count_if, money_sum, number, rate

# Seconds in the units of the three funnel steps.
MINUTE, HOUR, DAY = 60, 3600, 86400

FUNNEL_PERIODS = (1, 7, 30)


def on_day(time: Column, day: date) -> Column:
    return (time >= F.lit(day)) & until(time, day)


def channel_members(shops: DataFrame, members: DataFrame) -> DataFrame:
    """Distinct customers per tenant, also for tenants without any."""
    shop = shops.select("tenant", F.col("shop_id").alias("dp_id"))
    # An inner join, so that a hot shop's members can be split; tenants without members come back afterwards.
    counted = members.select("dp_id", "buyer_nick").join(shop, "dp_id").groupBy("tenant").agg(F.countDistinct("buyer_nick").alias("n"))
    return shop.select("tenant").distinct().join(counted, "tenant", "left").select(
        F.col("tenant").alias("tenant_id"), F.coalesce("n", F.lit(0).cast("long")).alias("cal_number")
    )


def channel_trades(shops: DataFrame, trades: DataFrame, day: date, periods: tuple[int, ...] = (365, 30)) -> DataFrame:
    """Finished orders, buyers and amount per tenant for the last days."""
    first = day - timedelta(days=max(periods))
    in_part = (F.col("part") == "active") | (F.col("part") >= f"{first:%Y-%m}")
    finished = trades.filter(
        in_part & (F.col("status") == FINISHED_STATUS) & (F.col("created") >= F.lit(first)) & until(F.col("created"), day)
    ).select("dp_id", "tid", "buyer_nick", number(trades, "payment").alias("payment"), "created")
    shop = shops.select("tenant", F.col("shop_id").alias("dp_id"))
    rows = finished.join(shop, "dp_id")  # an inner join, so that a hot shop's orders can be split
    orders = rows.groupBy("tenant", "tid", "buyer_nick", "payment").agg(F.max("created").alias("created"))
    marks = F.array(*[F.struct(F.lit(p).alias("period"), F.lit(day - timedelta(days=p)).alias("start")) for p in periods])
    marked = orders.withColumn("mark", F.explode(marks))
    hit = F.coalesce(F.col("created") >= F.col("mark.start"), F.lit(False))
    per_buyer = marked.groupBy("tenant", "mark.period", "buyer_nick").agg(
        count_if(hit).alias("orders"), F.sum(F.when(hit, F.coalesce("payment", F.lit(0.0)))).alias("paid")
    )
    counted = per_buyer.groupBy("tenant", "period").agg(
        F.sum("orders").alias("orders"),
        count_if((F.col("orders") > 0) & F.col("buyer_nick").isNotNull()).alias("customers"),
        F.sum("paid").alias("paid"),
    )
    every = shop.select("tenant").distinct().withColumn("period", F.explode(F.array(*map(F.lit, periods))))
    return every.join(counted, ["tenant", "period"], "left").select(
        F.col("tenant").alias("tenant_id"),
        "period",
        F.coalesce("orders", F.lit(0).cast("long")).alias("cal_trade_number"),
        F.coalesce("customers", F.lit(0).cast("long")).alias("cal_customer_number"),
        F.coalesce("paid", F.lit(0.0)).cast("decimal(20,2)").alias("cal_payment"),
    )


def yesterday_trades(trades: DataFrame, day: date) -> DataFrame:
    """Orders placed or paid on the day."""
    in_part = (F.col("part") >= f"{day:%Y-%m}") | (F.col("part") == "active")
    return trades.filter(in_part & (on_day(F.col("created"), day) | on_day(F.col("pay_time"), day)))


def base_trades(trades: DataFrame, day: date, days: int = 30) -> DataFrame:
    """Orders placed in the last days."""
    first = day - timedelta(days=days - 1)
    in_part = (F.col("part") >= f"{first:%Y-%m}") | (F.col("part") == "active")
    return trades.filter(in_part & (F.col("created") >= F.lit(first)) & until(F.col("created"), day))


def day_summary(trades: DataFrame, refunds: DataFrame, day: date) -> DataFrame:
    """Orderers, payers, pay rate, paid amount and refunds of each shop with orders on the day."""
    pay = number(trades, "payment")
    placed, paid = on_day(F.col("created"), day), on_day(F.col("pay_time"), day) & (pay > 0)
    per_buyer = yesterday_trades(trades, day).groupBy("dp_id", "buyer_nick").agg(
        F.max(placed.cast("int")).alias("placed"),
        F.max((placed & paid).cast("int")).alias("payer"),
        F.sum(F.when(paid, pay)).alias("paid"),
    )
    shops = per_buyer.groupBy("dp_id").agg(
        F.sum("placed").alias("buyernick_count_created"),
        F.coalesce(F.sum("payer"), F.lit(0)).alias("buyernick_count_paytime"),
        F.coalesce(money_sum(F.col("paid")), F.lit(0.0)).alias("payment"),
    ).filter(F.col("buyernick_count_created") > 0)
    fee = number(refunds, "refund_fee")
    back = refunds.filter(on_day(F.col("created"), day) & (F.col("status") == "SUCCESS") & (fee > 0))
    refunded = back.groupBy("dp_id").agg(money_sum(fee).alias("refund_payment"))
    return shops.join(refunded, "dp_id", "left").withColumns(
        {
            "payment_rate": rate(F.col("buyernick_count_paytime"), F.col("buyernick_count_created"), 0),
            "refund_payment": F.coalesce("refund_payment", F.lit(0.0)),
            "stat_date": F.lit(day),
        }
    )


def elapsed(start: str, end: str, unit: int) -> Column:
    """Time between two steps, zero when a step is missing or out of order."""
    seconds = F.unix_timestamp(F.col(end).cast("timestamp")) - F.unix_timestamp(F.col(start).cast("timestamp"))
    return F.when(F.col(end) > F.col(start), seconds / unit).otherwise(0.0)


def order_funnel(trades: DataFrame, day: date, periods: tuple[int, ...] = FUNNEL_PERIODS) -> DataFrame:
    """Orders placed, paid, sent and finished per shop and period with the mean time per step.

    Paying takes minutes, sending hours and finishing days. All periods come from one scan.
    """
    base = base_trades(trades, day, max(periods))
    codes = F.array_compact(
        F.array(*[F.when(F.col("created") >= F.lit(day - timedelta(days=p - 1)), F.lit(p)) for p in periods])
    )
    orders = base.groupBy("dp_id", "tid").agg(
        *[F.max(c).alias(c) for c in ("created", "pay_time", "consign_time", "end_time", "status")]
    ).withColumn("period", F.explode(codes))
    paid, sent = F.col("status").isin(*PAID_STATUSES), F.col("status").isin(*SENT_STATUSES)
    finished = F.col("status") == FINISHED_STATUS
    return orders.groupBy("dp_id", "period").agg(
        F.count("tid").alias("tid_count_created"),
        count_if(paid).alias("tid_count_paytime"),
        count_if(sent).alias("tid_count_sends"),
        count_if(finished).alias("tid_count_finished"),
        F.avg(F.when(paid, elapsed("created", "pay_time", MINUTE))).alias("rate_shiping_time_paytime"),
        F.avg(F.when(sent, elapsed("pay_time", "consign_time", HOUR))).alias("rate_shiping_time_sends"),
        F.avg(F.when(finished, elapsed("consign_time", "end_time", DAY))).alias("rate_shiping_time_finished"),
    )


def funnel_report(funnel: DataFrame, day: date) -> DataFrame:
    """Step-to-step conversion and mean times of all periods."""
    steps = [("paytime", "created"), ("sends", "paytime"), ("finished", "sends")]
    rates = {
        f"rate_shiping_{a}": F.round(rate(F.col(f"tid_count_{a}"), F.col(f"tid_count_{b}"), 0), 6) for a, b in steps
    }
    digits = {"paytime": 0, "sends": 6, "finished": 6}
    times = {
        f"rate_shiping_time_{s}": F.coalesce(F.round(f"rate_shiping_time_{s}", d), F.lit(0.0)) for s, d in digits.items()
    }
    return funnel.withColumns(rates | times).withColumnRenamed("dp_id", "shop_id").withColumn("stat_date", F.lit(day))


def grade_distribution(members: DataFrame, day: date) -> DataFrame:
    """Members and share per shop and grade."""
    known = members.filter(F.col("dp_id").isNotNull() & F.col("grade").isNotNull())
    cells = known.groupBy(F.col("dp_id").alias("shop_id"), "grade").agg(F.count("buyer_nick").alias("buyernick_count"))
    total = F.sum("buyernick_count").over(Window.partitionBy("shop_id"))
    return cells.withColumns({"buyernick_rate": rate(F.col("buyernick_count"), total, 0), "stat_date": F.lit(day)})


def root_categories(cats: DataFrame, day: date) -> DataFrame:
    """Top-level categories of each shop."""
    roots = cats.filter(
        (F.col("part") == F.lit(day))
        & (F.col("is_parent") == "true")
        & (F.col("parent_cid") == "0")
        & (F.col("status") == "normal")
        & F.col("dp_id").isNotNull()
        & F.col("cid").isNotNull()
        & F.col("name").isNotNull()
    )
    named = roots.select(F.col("dp_id").alias("shop_id"), F.col("cid").alias("root_cid"), F.col("name").alias("root_cid_name"))
    return named.distinct().withColumn("stat_date", F.lit(day))
