"""Daily maintenance of the wide table: age yesterday's rows, add the day's trades."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.constants import CUSTOMER_KEYS, MONEY_DIGITS
from patronage.functions.calendar import windows
from patronage.functions.expressions import money_sum
from patronage.operators.rfm_wide import (
    MEASURES,
    PERIODS,
    WIDE_COLUMNS,
    YEAR_TIMES,
    earliest,
    first_second_purchase,
    in_window,
    window_metrics,
    zero_measures,
)
from patronage.sources.cleaning import CLEAN, TRADE_KEY, boundary_day_trades, latest_versions

STATE_COLUMNS = [*WIDE_COLUMNS, "first_trade_id"]
UNITS = ("payment", "buy_times", "buy_num")


def increment_rfm(delta: DataFrame, day: date) -> DataFrame:
    """First and second purchase and window metrics of the delta alone."""
    buys = first_second_purchase(delta, CUSTOMER_KEYS, day).drop("first_buy_time")
    joined = buys.join(window_metrics(delta, CUSTOMER_KEYS, day), CUSTOMER_KEYS)
    return joined.withColumns(
        {"earliest_time": F.col("first_buy_time"), "stat_date": F.lit(day), **zero_measures()}
    ).select(*STATE_COLUMNS)


def boundary_metrics(boundary: DataFrame, keys: list[str] = CUSTOMER_KEYS) -> DataFrame:
    """Sums per customer of the trades that leave a window."""
    return boundary.groupBy(*keys).agg(
        money_sum(F.col("receive_payment")).alias("payment"),
        F.count("created").alias("buy_times"),
        F.sum("product_num").alias("buy_num"),
        F.min("created").alias("first_time"),
        F.max("created").alias("last_time"),
    )


def year_bounds(trades: DataFrame, touched: DataFrame, day: date) -> DataFrame:
    """First and last purchase within the year for the customers whose year lost a trade."""
    recent = trades.filter(in_window(F.col("created"), windows(day), "year"))
    affected = recent.join(touched.select(*CUSTOMER_KEYS), CUSTOMER_KEYS, "left_semi")
    return affected.groupBy(*CUSTOMER_KEYS).agg(
        F.min("created").alias("new_first"), F.max("created").alias("new_last")
    )


def age_rfm(
    previous: DataFrame, year_out: DataFrame, tyear_out: DataFrame, bounds: DataFrame, customers: DataFrame | None, day: date
) -> DataFrame:
    """Slide the previous snapshot to the day.

    Sums are invertible, so what left one window moves to the next. First and last times are not, so
    customers that lost a trade take them from `bounds`. Without customers their own times are left to `settle`.
    """
    out12 = year_out.select(*CUSTOMER_KEYS, *[F.col(u).alias(f"out12_{u}") for u in UNITS])
    out24 = tyear_out.select(*CUSTOMER_KEYS, *[F.col(u).alias(f"out24_{u}") for u in UNITS])
    joined = (
        previous.join(out12, CUSTOMER_KEYS, "left")
        .join(out24, CUSTOMER_KEYS, "left")
        .join(bounds, CUSTOMER_KEYS, "left")
    )
    if customers is not None:
        joined = joined.join(customers.select(*CUSTOMER_KEYS, "modified"), CUSTOMER_KEYS, "left")
    changed = F.col("out12_buy_times").isNotNull()
    moved = {}
    for unit in UNITS:
        left, older = F.coalesce(f"out12_{unit}", F.lit(0)), F.coalesce(f"out24_{unit}", F.lit(0))
        moved[f"year_{unit}"] = F.col(f"year_{unit}") - left
        moved[f"tyear_{unit}"] = F.col(f"tyear_{unit}") + left - older
        moved[f"btyear_{unit}"] = F.col(f"btyear_{unit}") + older
        if unit == "payment":
            for p in PERIODS:
                moved[f"{p}_payment"] = F.round(moved[f"{p}_payment"], MONEY_DIGITS)
    return joined.withColumns(
        {
            **moved,
            "year_first_time": F.when(changed, F.col("new_first")).otherwise(F.col("year_first_time")),
            "year_last_time": F.when(changed, F.col("new_last")).otherwise(F.col("year_last_time")),
            "earliest_time": F.col("earliest_time") if customers is None else F.least("earliest_time", "modified"),
            "stat_date": F.lit(day),
        }
    ).select(*STATE_COLUMNS)


def two_smallest(a: str, b: str) -> dict[str, Column]:
    """First and second purchase out of two ordered pairs; equal times fall to the smaller trade."""
    fa, fb = F.col(f"{a}.first_buy_time"), F.col(f"{b}.first_buy_time")
    tie = (fa == fb) & (F.col(f"{a}.first_trade_id") <= F.col(f"{b}.first_trade_id"))
    a_first = fb.isNull() | (fa < fb) | tie
    a_first = F.coalesce(a_first, F.lit(False))

    def choose(name: str) -> Column:
        return F.when(a_first, F.col(f"{a}.{name}")).otherwise(F.col(f"{b}.{name}"))

    second = F.when(a_first, F.least(F.col(f"{a}.second_buy_time"), fb)).otherwise(
        F.least(F.col(f"{b}.second_buy_time"), fa)
    )
    return {
        "first_buy_time": choose("first_buy_time"),
        "first_payment": choose("first_payment"),
        "first_trade_id": choose("first_trade_id"),
        "second_buy_time": second,
    }


def merged_columns(a: str, b: str) -> dict[str, Column]:
    """Wide-row columns of two disjoint sets of trades of one customer."""
    cols = two_smallest(a, b)
    for m in MEASURES:
        total = F.coalesce(F.col(f"{a}.{m}"), F.lit(0)) + F.coalesce(F.col(f"{b}.{m}"), F.lit(0))
        cols[m] = F.round(total, MONEY_DIGITS) if m.endswith("payment") else total
    cols["year_first_time"] = F.least(F.col(f"{a}.year_first_time"), F.col(f"{b}.year_first_time"))
    cols["year_last_time"] = F.greatest(F.col(f"{a}.year_last_time"), F.col(f"{b}.year_last_time"))
    cols["earliest_time"] = F.least(F.col(f"{a}.earliest_time"), F.col(f"{b}.earliest_time"))
    return cols


def merge_changed(increment: DataFrame, aged: DataFrame) -> DataFrame:
    """Customers with rows on both sides: two smallest of up to four times, sums of measures."""
    joined = increment.alias("i").join(aged.alias("a"), CUSTOMER_KEYS)
    cols = merged_columns("i", "a")
    return joined.select(*CUSTOMER_KEYS, F.col("a.stat_date"), *[c.alias(n) for n, c in cols.items()]).select(*STATE_COLUMNS)


def insert_new(increment: DataFrame, aged: DataFrame) -> DataFrame:
    """Customers that only the increment knows."""
    return increment.join(aged.select(*CUSTOMER_KEYS), CUSTOMER_KEYS, "left_anti")


def final_daily_rfm(customers: DataFrame, changed: DataFrame, new: DataFrame, aged: DataFrame, day: date) -> DataFrame:
    """Today's rows of all known customers."""
    untouched = aged.join(changed.select(*CUSTOMER_KEYS), CUSTOMER_KEYS, "left_anti")
    rows = changed.unionByName(new).unionByName(untouched).drop("stat_date")
    joined = customers.select(*CUSTOMER_KEYS, "modified").join(rows, CUSTOMER_KEYS, "left")
    return joined.withColumns(
        {
            "earliest_time": earliest(F.col("earliest_time"), F.col("modified")),
            "stat_date": F.lit(day),
            **zero_measures(),
        }
    ).select(*STATE_COLUMNS)


def settle(customers: DataFrame, increment: DataFrame, aged: DataFrame, day: date) -> DataFrame:
    """Today's rows of all known customers in one pass.

    Gives the rows of `merge_changed`, `insert_new` and `final_daily_rfm` without computing the aged
    snapshot and the increment once for each of them.
    """
    joined = (
        customers.select(*CUSTOMER_KEYS, "modified").alias("c")
        .join(aged.alias("a"), CUSTOMER_KEYS, "left")
        .join(increment.alias("i"), CUSTOMER_KEYS, "left")
    )
    cols = merged_columns("a", "i")
    cols["earliest_time"] = earliest(cols["earliest_time"], F.col("modified"))
    rows = joined.select(*CUSTOMER_KEYS, F.lit(day).alias("stat_date"), *[c.alias(n) for n, c in cols.items()])
    return rows.withColumn("first_payment", F.coalesce("first_payment", F.lit(0.0))).select(*STATE_COLUMNS)


def redelivered_customers(base: DataFrame, delta: DataFrame, delivered: DataFrame) -> DataFrame:
    """Holders of the old and the new versions of trades that arrived again."""
    known = base.select(*TRADE_KEY, F.col("uni_id").alias("old_uni_id"))
    again = known.join(delivered, TRADE_KEY).join(delta.select(*TRADE_KEY, "uni_id"), TRADE_KEY, "left")
    holders = F.explode(F.array_distinct(F.array_compact(F.array("uni_id", "old_uni_id")))).alias("uni_id")
    return again.select("tenant", "plat_code", "uni_shop_id", holders).distinct()


def daily_rfm(
    customers: DataFrame,
    previous: DataFrame,
    base: DataFrame,
    delta: DataFrame,
    day: date,
    delivered: DataFrame | None = None,
    redelivered: DataFrame | None = None,
) -> DataFrame:
    """One nightly step from the previous snapshot, the trades it was built from and the day's delta.

    Adding a trade that is delivered again would count it twice, so customers with such trades are
    rebuilt from the latest versions; everybody else is aged and merged. `delivered` has the keys of
    all trades that arrived, with those that became unusable; without it they are the delta's.
    `redelivered` has the customers to rebuild, where an earlier run may have replaced the trades.
    """
    delivered = delta.select(*TRADE_KEY) if delivered is None else delivered
    redelivered = redelivered_customers(base, delta, delivered) if redelivered is None else redelivered
    added = delta.join(redelivered, CUSTOMER_KEYS, "left_anti")
    return daily_step(customers, previous, base, base, latest_versions(base, delta, delivered), added, redelivered, day)


def daily_step(
    customers: DataFrame, previous: DataFrame, leaving: DataFrame, year: DataFrame, latest: DataFrame, added: DataFrame, rebuilt: DataFrame, day: date
) -> DataFrame:
    """The nightly step from parts of the stored trades: `leaving` has those that leave a window, `year` those of the
    year, `latest` the latest versions of the rebuilt customers' trades; `added` are new trades of all others."""
    year_out = boundary_metrics(boundary_day_trades(leaving, day, 12))
    tyear_out = boundary_metrics(boundary_day_trades(leaving, day, 24))
    aged = age_rfm(previous, year_out, tyear_out, year_bounds(year, year_out, day), None, day)
    own = latest.join(rebuilt, CUSTOMER_KEYS, "left_semi")
    kept = aged.join(rebuilt, CUSTOMER_KEYS, "left_anti")
    return settle(customers, increment_rfm(added.unionByName(own, allowMissingColumns=True), day), kept, day)


def changed_versions(replaced: DataFrame, delta: DataFrame) -> DataFrame:
    """Trades of only one side: old versions that differ from the new one or have none, and new ones likewise."""
    sides = replaced.select(*CLEAN, F.lit(1).alias("old"), F.lit(0).alias("new")).unionByName(delta.select(*CLEAN, F.lit(0).alias("old"), F.lit(1).alias("new")))
    return sides.groupBy(*CLEAN).agg(F.max("old").alias("old"), F.max("new").alias("new")).filter(F.col("old") + F.col("new") == 1)


def holders(replaced: DataFrame, delta: DataFrame) -> DataFrame:
    """Customers with an old or a new version of a trade that arrived again and differs."""
    again = changed_versions(replaced, delta).join(replaced.select(*TRADE_KEY), TRADE_KEY, "left_semi")
    return again.select(*CUSTOMER_KEYS).distinct()
