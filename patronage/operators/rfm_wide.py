"""The wide customer value table: first and second purchase and metrics of three time windows."""

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.constants import CUSTOMER_KEYS, MONEY_DIGITS, PLATFORM
from patronage.functions.calendar import Windows, month_ends, until, windows
from patronage.functions.expressions import money_sum
from patronage.operators.levels import LEVELED_CUSTOMER, at_shop, decoded, per_level, upper_levels
from patronage.session import laid_by

PERIODS = ("year", "tyear", "btyear")
PERIOD_MEASURES = {p: [f"{p}_{m}" for m in ("payment", "buy_times", "buy_num")] for p in PERIODS}
MEASURES = [m for p in PERIODS for m in PERIOD_MEASURES[p]]
YEAR_TIMES = ["year_first_time", "year_last_time"]
WIDE_COLUMNS = [
    "tenant",
    "plat_code",
    "uni_shop_id",
    "uni_id",
    "earliest_time",
    "first_buy_time",
    "first_payment",
    "second_buy_time",
    *MEASURES[:3],
    *YEAR_TIMES,
    *MEASURES[3:],
    "stat_date",
]


def in_window(time: Column, w: Windows, period: str) -> Column:
    if period == "year":
        return (time >= F.lit(w.year_start)) & (time < F.lit(w.end))
    if period == "tyear":
        return (time >= F.lit(w.tyear_start)) & (time < F.lit(w.year_start))
    return time < F.lit(w.tyear_start)


def first_second_purchase(trades: DataFrame, keys: list[str], day: date) -> DataFrame:
    """First time, payment and trade and second time per key.

    The rank filter lets Spark keep two rows per key on the map side, so one very active customer
    does not move to a single task; the aggregation reuses the partitioning of the window.
    """
    order = [c for c in ("created", "plat_code", "uni_shop_id", "trade_id") if c not in keys]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    slim = trades.filter(until(F.col("created"), day)).select(*keys, *order, "receive_payment")
    ranked = slim.withColumn("rank", rank).filter(F.col("rank") <= 2)
    first, second = F.col("rank") == 1, F.col("rank") == 2
    return ranked.groupBy(*keys).agg(
        F.max(F.when(first, F.col("created"))).alias("first_buy_time"),
        F.max(F.when(first, F.col("receive_payment"))).alias("first_payment"),
        F.max(F.when(first, F.col("trade_id"))).alias("first_trade_id"),
        F.max(F.when(second, F.col("created"))).alias("second_buy_time"),
    )


def _sums(period: str, condition: Column | None = None) -> list[Column]:
    def pick(c: str) -> Column:
        return F.col(c) if condition is None else F.when(condition, F.col(c))

    return [
        money_sum(pick("receive_payment")).alias(f"{period}_payment"),
        F.count(pick("created")).alias(f"{period}_buy_times"),
        F.sum(pick("product_num")).alias(f"{period}_buy_num"),
    ]


def last_year_metrics(trades: DataFrame, keys: list[str], day: date) -> DataFrame:
    rows = trades.filter(in_window(F.col("created"), windows(day), "year"))
    return rows.groupBy(*keys).agg(
        *_sums("year"), F.min("created").alias("year_first_time"), F.max("created").alias("year_last_time")
    )


def prev_year_metrics(trades: DataFrame, keys: list[str], day: date) -> DataFrame:
    return trades.filter(in_window(F.col("created"), windows(day), "tyear")).groupBy(*keys).agg(*_sums("tyear"))


def older_metrics(trades: DataFrame, keys: list[str], day: date) -> DataFrame:
    return trades.filter(in_window(F.col("created"), windows(day), "btyear")).groupBy(*keys).agg(*_sums("btyear"))


def window_metrics(trades: DataFrame, keys: list[str], day: date) -> DataFrame:
    """First purchase and the three metric sets in one pass."""
    return trades.filter(until(F.col("created"), day)).groupBy(*keys).agg(*_window_aggregates(day))


def _window_aggregates(day: date) -> list[Column]:
    return [F.min("created").alias("first_buy_time"), *[c.alias(n) for n, c in _of_windows(day).items()]]


def _of_windows(day: date) -> dict[str, Column]:
    """Measures of the three windows, and the first and last time of the year's."""
    w, time = windows(day), F.col("created")
    year = in_window(time, w, "year")
    sums = {n: c for p in PERIODS for n, c in zip(PERIOD_MEASURES[p], _sums(p, in_window(time, w, p)), strict=True)}
    return sums | {"year_first_time": F.min(F.when(year, time)), "year_last_time": F.max(F.when(year, time))}


def zero_measures() -> dict[str, Column]:
    filled = {m: F.coalesce(F.col(m), F.lit(0.0 if m.endswith("payment") else 0)) for m in MEASURES}
    return filled | {"first_payment": F.coalesce("first_payment", F.lit(0.0))}


def earliest(first: Column, modified: Column) -> Column:
    """First purchase or the customer's own time, whichever came earlier."""
    return F.when(first.isNull() | (first > modified), modified).otherwise(first)


def shop_rfm(customers: DataFrame, trades: DataFrame, day: date) -> DataFrame:
    """Wide rows of every known customer of a shop; prospects have zero measures.

    Customers and trades meet in one aggregation, without a sort. The first time comes with the sums: reports that need no
    payment of the first and no second purchase leave the ranking out. There is one customer row per key.
    """
    known = customers.select(*CUSTOMER_KEYS, "modified", F.lit(True).alias("known"))
    placed = trades.filter(until(F.col("created"), day)).dropna(subset=CUSTOMER_KEYS)
    rows = known.unionByName(placed.select(*CUSTOMER_KEYS, "created", "receive_payment", "product_num"), allowMissingColumns=True)
    summed = rows.groupBy(*CUSTOMER_KEYS).agg(F.max("known").alias("known"), F.min("modified").alias("modified"), *_window_aggregates(day))
    ranked = first_second_purchase(trades, CUSTOMER_KEYS, day).drop("first_buy_time")
    joined = summed.filter("known").join(ranked, CUSTOMER_KEYS, "left")
    return joined.withColumns(
        {
            "earliest_time": earliest(F.col("first_buy_time"), F.col("modified")),
            "stat_date": F.lit(day),
            **zero_measures(),
        }
    ).select(*WIDE_COLUMNS, "first_trade_id")


def rollup_first_second(lower: DataFrame, keys: list[str], tie: list[str]) -> DataFrame:
    """First and second purchase one level up.

    The second purchase is the earlier of the first row's own second and the next row's first.
    There is at most one row per customer and shop here, so groups are as small as the shop list.
    """
    return _ranked(lower, keys, tie).groupBy(*keys).agg(*_first_second())


def _ranked(lower: DataFrame, keys: list[str], tie: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("first_buy_time").asc_nulls_last(), *tie)
    return lower.withColumn("rank", F.row_number().over(w))


def _first_second() -> list[Column]:
    """The first time needs no rank, so reports that use only that one skip the ranking."""
    first, second = F.col("rank") == 1, F.col("rank") == 2
    own = F.max(F.when(first, F.col("second_buy_time")))
    following = F.max(F.when(second, F.col("first_buy_time")))
    return [
        F.min("first_buy_time").alias("first_buy_time"),
        F.max(F.when(first, F.col("first_payment"))).alias("first_payment"),
        F.least(own, following).alias("second_buy_time"),
    ]


def _measures() -> list[Column]:
    return [
        F.min("earliest_time").alias("earliest_time"),
        *[(money_sum(F.col(m)) if m.endswith("payment") else F.sum(m)).alias(m) for m in MEASURES],
        F.min("year_first_time").alias("year_first_time"),
        F.max("year_last_time").alias("year_last_time"),
    ]


def rollup_rfm(lower: DataFrame, level: int) -> DataFrame:
    """Wide rows of the platform level out of shop rows, or of the tenant level out of platform rows.

    Ranking and aggregation share one shuffle.
    """
    keys = ["uni_id", *(["plat_code"] if level == PLATFORM else []), "tenant", "stat_date"]
    dropped = [c for c in ("plat_code", "uni_shop_id") if c not in keys]
    rolled = _ranked(lower, keys, dropped).groupBy(*keys).agg(*_measures(), *_first_second())
    return rolled.withColumns({c: F.lit(None).cast("string") for c in dropped}).select(*WIDE_COLUMNS)


def all_levels(shop: DataFrame) -> DataFrame:
    """Wide rows of the three levels, told apart by `type`, in one pass over the shop rows, for reports on some columns.

    Shop rows are brought together by customer before they are repeated for the levels, so the shuffle
    moves each once. A customer has at most one row per shop and snapshot, so no customer is a hot key.
    """
    keys = [*LEVELED_CUSTOMER, "stat_date"]
    leveled = per_level(shop.select(*WIDE_COLUMNS).repartition("uni_id"))
    rolled = _ranked(leveled, keys, ["plat_code", "uni_shop_id"]).groupBy(*keys).agg(*_measures(), *_first_second())
    return decoded(rolled).select("type", *WIDE_COLUMNS)


def whole_levels(shop: DataFrame) -> DataFrame:
    """The rows of `all_levels`, where first and second purchase are wanted too.

    They need a customer's rows in order, so the same sort adds them up: a task holds no table of its customers beside it.
    """
    leveled = per_level(shop.select(*WIDE_COLUMNS).repartition("uni_id"))
    order = Window.partitionBy(*LEVELED_CUSTOMER, "stat_date").orderBy(F.col("first_buy_time").asc_nulls_last(), "plat_code", "uni_shop_id")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = {m: F.sum(m).over(whole) for m in MEASURES}
    rolled = leveled.select(
        *LEVELED_CUSTOMER,
        "stat_date",
        "first_buy_time",
        "first_payment",
        F.least("second_buy_time", F.lead("first_buy_time").over(order)).alias("second_buy_time"),
        F.min("earliest_time").over(whole).alias("earliest_time"),
        *[(F.round(s, MONEY_DIGITS) if m.endswith("payment") else s).alias(m) for m, s in sums.items()],
        F.min("year_first_time").over(whole).alias("year_first_time"),
        F.max("year_last_time").over(whole).alias("year_last_time"),
        F.row_number().over(order).alias("place"),
    )
    return decoded(rolled.filter("place = 1")).select("type", *WIDE_COLUMNS)


def month_end_rfm(customers: DataFrame, trades: DataFrame, days: list[date], together: list[str] = CUSTOMER_KEYS) -> DataFrame:
    """Shop-level wide rows of several month ends in one pass, laid together by the columns `together`.

    The snapshots are derived from one row per customer without another shuffle.
    """
    rows = _customer_rows(customers, trades, days, CUSTOMER_KEYS, together)
    return each_day(rows, days).select(*WIDE_COLUMNS, "first_trade_id")


def month_end_levels(customers: DataFrame, trades: DataFrame, days: list[date]) -> DataFrame:
    """Wide rows of several month ends at the three levels.

    First and second purchase do not depend on the snapshot, and its windows are columns, so the levels are put together
    before the snapshots are spread out.
    """
    shop, upper = month_end_parts(customers, trades, days)
    return decoded(each_day(shop, days).unionByName(each_day(upper, days))).select("type", *WIDE_COLUMNS)


SLOTS = 16


def month_end_parts(customers: DataFrame, trades: DataFrame, days: list[date], beside: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of `_customer_rows` of the shop level, and of the levels above, with what `beside` makes of further columns of
    the customers, told by their names.

    Rows of the levels above lie together by customer. Those of a shop lie in a few slots of its customers, so that a report
    counts nearly all of a shop's customers before it moves the counts: by customer, each task would have some of every shop.
    """
    slot = F.pmod(F.hash("uni_id"), F.lit(SLOTS)).alias("slot")
    slotted = [df.select("*", slot) for df in (customers, trades)]
    shop = _customer_rows(*slotted, days, [*CUSTOMER_KEYS, "slot"], ["uni_shop_id", "slot"], beside=beside).drop("slot")
    upper = _customer_rows(customers, trades, days, LEVELED_CUSTOMER, ["uni_id"], upper_levels, beside)
    return at_shop(shop), upper


def _customer_rows(
    customers: DataFrame,
    trades: DataFrame,
    days: list[date],
    keys: list[str],
    together: list[str],
    spread: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    beside: dict[str, Column] | None = None,
) -> DataFrame:
    """A row per known customer and `keys` with the first two purchases and the measures of each day's windows.

    Customers and trades of the shop level are laid together by the columns `together`, among `keys`, in one shuffle, and
    `spread` over levels there. A second purchase is the time behind the first in order, so one sort gives both. Sums are
    columns of their own: those that a report leaves out are not made, nor is the order where no second purchase is read.
    """
    shared = [k for k in keys if k in customers.columns and k not in CUSTOMER_KEYS]
    beside = beside or {}
    known = customers.select(*CUSTOMER_KEYS, *shared, "modified", *beside, F.lit(True).alias("known"))
    time = F.col("created")
    bought = trades.filter(until(time, max(days))).select(*CUSTOMER_KEYS, *shared, "trade_id", "receive_payment", "product_num", "created")
    laid = spread(laid_by(known.unionByName(bought, allowMissingColumns=True), *together))
    ties = [c for c in ("plat_code", "uni_shop_id", "trade_id") if c not in keys]
    order = Window.partitionBy(*keys).orderBy(time.asc_nulls_last(), *ties)
    ranked = laid.withColumns({"place": F.row_number().over(order), "next": F.lead(time).over(order)})
    first = F.col("place") == 1
    found = ranked.groupBy(*keys).agg(
        F.max("known").alias("known"),
        F.min("modified").alias("modified"),
        F.min(time).alias("first_buy_time"),
        F.max(F.when(first, F.col("trade_id"))).alias("first_trade_id"),
        F.max(F.when(first, F.col("receive_payment"))).alias("first_payment"),
        F.max(F.when(first, F.col("next"))).alias("second_buy_time"),
        *[c.alias(f"{n}_{i}") for i, d in enumerate(sorted(days)) for n, c in _of_windows(d).items()],
        *[c.alias(n) for n, c in beside.items()],
    )
    return found.filter("known")


def each_day(rows: DataFrame, days: list[date]) -> DataFrame:
    """Rows of `_customer_rows`, with whatever columns were put beside them, as wide rows of each of the days, month ends.

    Only these rows are repeated, without sorting or moving what comes of it.
    """
    held = [*MEASURES, *YEAR_TIMES]
    lists = {n: F.array(*[F.col(f"{n}_{i}") for i in range(len(days))]) for n in held}
    listed = rows.withColumns(lists).drop(*[f"{n}_{i}" for n in held for i in range(len(days))])
    spans = [windows(d) for d in sorted(days)]
    snaps = F.array(*[F.struct(F.lit(w.stat_date).alias("stat_date"), F.lit(w.end).alias("end"), F.lit(i).alias("at")) for i, w in enumerate(spans)])
    each = listed.withColumn("snap", F.explode(snaps)).select("*", "snap.*").drop("snap")
    bought = F.col("first_buy_time") < F.col("end")
    shown = {c: F.when(bought, F.col(c)) for c in ("first_buy_time", "first_payment", "first_trade_id")}
    shown |= {"second_buy_time": F.when(F.col("second_buy_time") < F.col("end"), F.col("second_buy_time"))}
    wide = each.withColumns(shown | {n: F.get(n, F.col("at")) for n in held})
    return wide.withColumns({"earliest_time": earliest(F.col("first_buy_time"), F.col("modified")), **zero_measures()}).drop("end", "at")


def month_end_history(customers: DataFrame, trades: DataFrame, day: date, n: int = 13) -> DataFrame:
    """Wide rows of the last n month ends at the three levels."""
    return month_end_levels(customers, trades, month_ends(day, n))


def new_tenant_history(customers: DataFrame, trades: DataFrame, known_tenants: DataFrame, day: date) -> DataFrame:
    """History of the tenants that appear for the first time."""
    known = known_tenants.select("tenant")
    fresh = trades.join(known, "tenant", "left_anti")
    return month_end_history(customers.join(known, "tenant", "left_anti"), fresh, day)


def recompute_tenant(customers: DataFrame, trades: DataFrame, tenant: str, day: date, n: int = 13) -> DataFrame:
    """Wide rows of one tenant for the day and its last n month ends."""
    own_customers = customers.filter(F.col("tenant") == tenant)
    own_trades = trades.filter(F.col("tenant") == tenant)
    today = whole_levels(shop_rfm(own_customers, own_trades, day))
    return today.unionByName(month_end_history(own_customers, own_trades, day, n))


def tenant_card_plans(tenant_shop: DataFrame, card_shop: DataFrame) -> DataFrame:
    """Membership plans used by the shops of each tenant."""
    shops = tenant_shop.select("tenant", "plat_code", "shop_id")
    plans = card_shop.filter(F.col("card_plan_id").isNotNull())
    return shops.join(plans, ["plat_code", "shop_id"]).select("tenant", "card_plan_id").distinct()
