"""Sales and members of physical stores over the last thirty days.

Weeks start on Monday, or with `anchored_week` on the year-anchored weekday.
"""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.constants import TOTAL
from patronage.functions.calendar import explode_periods, period_flags, period_starts, until
from patronage.functions.expressions import count_if, money_sum, rate, ratio
from patronage.sources.cleaning import clean_trades, trades_since

PERIOD = "date_type"
SHOP = ["card_plan_id", "plat_code", "shop_id", "uni_shop_id"]
PLAT = ["card_plan_id", "plat_code"]
SPEND = ["members", "total_payment", "total_times"]


def on_platforms(df: DataFrame, platforms: tuple[str, ...] | None) -> DataFrame:
    return df.filter(F.col("plat_code").isin(*platforms)) if platforms else df


def offline_trades(
    trades: DataFrame,
    tenant_shop: DataFrame,
    card_shop: DataFrame,
    relation: DataFrame,
    day: date,
    platforms: tuple[str, ...] | None = None,
    anchored_week: bool = False,
) -> DataFrame:
    """Valid trades of all reporting periods with plan, member and period flags.

    The scan starts at the earlier of the month start and thirty days back.
    """
    first = min(period_starts(day, anchored_week=anchored_week).values())
    recent = trades_since(on_platforms(trades, platforms), day, days=(day - first).days + 1)
    plans = card_shop.select("card_plan_id", "plat_code", "shop_id")
    members = relation.select("card_plan_id", "member_id", "uni_id")
    cleaned = clean_trades(recent, tenant_shop)
    planned = cleaned.join(plans, ["plat_code", "shop_id"]).join(members, ["card_plan_id", "uni_id"], "left")
    return period_flags(planned, "created", day, anchored_week=anchored_week)


def member_trades(offline: DataFrame, members: DataFrame, any_shop: bool = False) -> DataFrame:
    """Member trades with grade and card-opening shop; by default only trades in that shop.

    `any_shop` keeps a member's trades in all shops, for comparing own-shop with all-shop spending.
    """
    card = members.filter(F.col("grade").isNotNull() & F.col("shop_id").isNotNull())
    keys = ["card_plan_id", "member_id"] if any_shop else ["card_plan_id", "plat_code", "uni_shop_id", "member_id"]
    card = card.select(*keys, "grade", F.col("shop_id").alias("open_shop_id"), F.col("plat_code").alias("open_plat"))
    return offline.filter(F.col("member_id").isNotNull()).join(card, keys)


def _totals(prefix: str = "") -> list[Column]:
    return [
        money_sum(F.col("receive_payment")).alias(f"{prefix}total_payment"),
        F.count("created").alias(f"{prefix}total_times"),
    ]


def _rolled(rows: DataFrame, prefix: str = "") -> list[Column]:
    return [
        money_sum(F.col(f"{prefix}total_payment")).alias(f"{prefix}total_payment"),
        F.sum(f"{prefix}total_times").alias(f"{prefix}total_times"),
    ]


def sales_by_period(offline: DataFrame, day: date, anchored_week: bool = False) -> DataFrame:
    """Payment and orders per plan, shop and period. Trades of a shop's buyers without card count too."""
    return explode_periods(offline, "created", day, anchored_week=anchored_week, name=PERIOD).groupBy(*SHOP, PERIOD).agg(*_totals())


def platform_sales(shop_sales: DataFrame) -> DataFrame:
    return shop_sales.groupBy(*PLAT, PERIOD).agg(*_rolled(shop_sales))


def member_sales_by_period(mt: DataFrame, day: date, anchored_week: bool = False) -> DataFrame:
    """Member part of the sales per shop."""
    return explode_periods(mt, "created", day, anchored_week=anchored_week, name=PERIOD).groupBy(*SHOP, PERIOD).agg(*_totals("m"))


def member_platform_sales(shop_sales: DataFrame) -> DataFrame:
    return shop_sales.groupBy(*PLAT, PERIOD).agg(*_rolled(shop_sales, "m"))


def with_grade_total(cells: DataFrame, keys: list[str], sums: list[Column]) -> DataFrame:
    """Add a row over all grades to each group of small cells."""
    key_cols, grade = [F.col(k) for k in keys], F.col("grade")
    grouped = cells.groupingSets([[*key_cols, grade], key_cols], *key_cols, grade).agg(*sums, F.grouping("grade").alias("all"))
    return grouped.withColumn("grade", F.when(F.col("all") == 1, TOTAL).otherwise(grade)).drop("all")


def grade_sales_by_period(mt: DataFrame, day: date, anchored_week: bool = False) -> DataFrame:
    """Member sales per grade with a total row."""
    cells = explode_periods(mt, "created", day, anchored_week=anchored_week, name=PERIOD).groupBy(*SHOP, PERIOD, "grade").agg(*_totals("m"))
    return with_grade_total(cells, [*SHOP, PERIOD], _rolled(cells, "m"))


def grade_platform_sales(shop_sales: DataFrame) -> DataFrame:
    return shop_sales.groupBy(*PLAT, PERIOD, "grade").agg(*_rolled(shop_sales, "m"))


def member_sale_rate(shop_sales: DataFrame, grade_sales: DataFrame, day: date) -> DataFrame:
    """Share of members in a platform's payments and orders per grade."""
    joined = platform_sales(shop_sales).join(grade_platform_sales(grade_sales), [*PLAT, PERIOD])
    return joined.select(
        *PLAT,
        PERIOD,
        "total_payment",
        "mtotal_payment",
        F.round(rate(F.col("mtotal_payment"), F.col("total_payment")), 4).alias("sale_rate"),
        "total_times",
        "mtotal_times",
        F.round(rate(F.col("mtotal_times"), F.col("total_times")), 4).alias("times_rate"),
        "grade",
        F.lit(day).alias("stat_date"),
    )


def shop_sale_rate(shop_sales: DataFrame, grade_sales: DataFrame, tenant_shop: DataFrame, day: date) -> DataFrame:
    """The same per shop with its name; shops without member sales get one zero row."""
    names = tenant_shop.select("plat_code", "shop_id", "shop_name").distinct()
    members = grade_sales.drop("uni_shop_id")
    joined = shop_sales.join(names, ["plat_code", "shop_id"], "left").join(
        members, ["card_plan_id", "plat_code", "shop_id", PERIOD], "left"
    )
    pay, times = F.coalesce("mtotal_payment", F.lit(0.0)), F.coalesce("mtotal_times", F.lit(0))
    return joined.select(
        *PLAT,
        "uni_shop_id",
        "shop_name",
        PERIOD,
        F.coalesce("grade", F.lit(TOTAL)).alias("grade"),
        "total_payment",
        pay.alias("mtotal_payment"),
        rate(pay, F.col("total_payment")).alias("sale_rate"),
        "total_times",
        times.alias("mtotal_times"),
        rate(times, F.col("total_times")).alias("times_rate"),
        F.lit(day).alias("stat_date"),
    )


def member_growth(
    members: DataFrame, tenant_shop: DataFrame, day: date, platforms: tuple[str, ...] | None = None, anchored_week: bool = False
) -> DataFrame:
    """Members of each shop and how many joined in each period."""
    known = on_platforms(members, platforms).filter(until(F.col("created"), day))
    flagged = period_flags(known, "created", day, anchored_week=anchored_week, yearly=True)
    flags = ["yesterday", "this_week", "this_month", "this_year", "last_7_days", "last_30_days", "last_year"]
    counts = flagged.groupBy(*SHOP).agg(F.count("member_id").alias("members"), *[F.sum(f).alias(f) for f in flags])
    names = tenant_shop.select("plat_code", "shop_id", "shop_name").distinct()
    return counts.join(names, ["plat_code", "shop_id"], "left").drop("shop_id").withColumn("stat_date", F.lit(day))


def _consumption(rows: DataFrame, keys: list[str], day: date, anchored_week: bool = False) -> DataFrame:
    """Members, payment and visits (member, shop and day) per grade, with a total row.

    Visits are grouped before members are counted, so no distinct set is held per shop.
    """
    visits = explode_periods(rows, "created", day, anchored_week=anchored_week, name=PERIOD).groupBy(
        *keys, PERIOD, "grade", "member_id", F.to_date("created").alias("visit_day")
    ).agg(money_sum(F.col("receive_payment")).alias("paid"))
    per_member = visits.groupBy(*keys, PERIOD, "grade", "member_id").agg(
        money_sum(F.col("paid")).alias("paid"), F.count("*").alias("visits")
    )
    cells = per_member.groupBy(*keys, PERIOD, "grade").agg(
        F.count("member_id").alias("members"),
        money_sum(F.col("paid")).alias("total_payment"),
        F.sum("visits").alias("total_times"),
    )
    sums = [F.sum("members").alias("members"), money_sum(F.col("total_payment")).alias("total_payment"), F.sum("total_times").alias("total_times")]
    total = with_grade_total(cells, [*keys, PERIOD], sums)
    pay, members, times = F.col("total_payment"), F.col("members"), F.col("total_times")
    return total.withColumns(
        {"avg_price": ratio(pay, members), "avg_times": ratio(times, members), "single_price": ratio(pay, times)}
    )


def open_shop_consumption(mt: DataFrame, day: date, anchored_week: bool = False) -> DataFrame:
    """Spending of members in the shop that opened their card."""
    own = mt.filter((F.col("shop_id") == F.col("open_shop_id")) & (F.col("plat_code") == F.col("open_plat")))
    return _consumption(own, SHOP, day, anchored_week)


def all_shop_consumption(mt: DataFrame, day: date, anchored_week: bool = False) -> DataFrame:
    """Spending of members in all shops, reported for the shop that opened their card."""
    opened = mt.withColumns({"plat_code": F.col("open_plat")})
    return _consumption(opened, ["card_plan_id", "plat_code", "open_shop_id"], day, anchored_week)


def member_stock(members: DataFrame, tenant_shop: DataFrame, day: date, platforms: tuple[str, ...] | None = None) -> DataFrame:
    """Members per shop and grade with a total row."""
    known = on_platforms(members, platforms).filter(until(F.col("created"), day))
    cells = known.groupBy("card_plan_id", "plat_code", "uni_shop_id", "grade").agg(F.count("member_id").alias("members"))
    counts = with_grade_total(cells, ["card_plan_id", "plat_code", "uni_shop_id"], [F.sum("members").alias("members")])
    names = tenant_shop.select("plat_code", "uni_shop_id", "shop_id", "shop_name")
    return counts.join(names, ["plat_code", "uni_shop_id"], "left")


def consumption_report(stock: DataFrame, own: DataFrame, everywhere: DataFrame, day: date) -> DataFrame:
    """Member stock with own-shop and all-shop spending.

    Every period with spending anywhere appears; a shop and grade without any gets one row without period.
    """
    values = [*SPEND[:2], "avg_price", "avg_times", "single_price"]
    s = own.select("card_plan_id", "plat_code", "shop_id", "grade", PERIOD, *[F.col(v).alias(f"own_{v}") for v in values])
    a = everywhere.select(
        "card_plan_id", "plat_code", F.col("open_shop_id").alias("shop_id"), "grade", PERIOD, *[F.col(v).alias(f"all_{v}") for v in values]
    )
    keys = ["card_plan_id", "plat_code", "shop_id", "grade"]
    spending = a.join(s, [*keys, PERIOD], "left")
    joined = stock.join(spending, keys, "left")

    def zero(prefix: str, v: str, name: str) -> Column:
        return F.coalesce(f"{prefix}_{v}", F.lit(0)).alias(name)

    names = {"members": "members", "total_payment": "payment", "avg_price": "avg_price", "avg_times": "avg_times", "single_price": "single_price"}
    share = F.when(F.col("all_total_payment").isNull(), -1.0).when(F.col("own_total_payment").isNull(), 0.0)
    return joined.select(
        "card_plan_id",
        "uni_shop_id",
        "shop_name",
        PERIOD,
        "grade",
        F.col("members").alias("store_members"),
        *[zero("own", v, f"shop_{n}") for v, n in names.items()],
        *[zero("all", v, f"all_{n}") for v, n in names.items()],
        share.otherwise(rate(F.col("own_total_payment"), F.col("all_total_payment"))).alias("payment_rate"),
        F.lit(day).alias("stat_date"),
    )
