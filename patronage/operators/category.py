"""Category benchmarks: which shops represent a category, and how their customers behave."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.constants import MONEY_DIGITS
from patronage.functions.calendar import shift_months
from patronage.functions.expressions import money_sum, number, rate
from patronage.operators.assets import repurchase_columns, repurchase_counts, retention_columns, retention_counts, with_repurchase_rates
from patronage.operators.segmentation import purchase_interval
from patronage.sources.cleaning import trades_since

SHOP_KEYS = ["plat_code", "uni_shop_id"]
TRADE = [*SHOP_KEYS, "trade_id"]


def benchmark_trades(trades: DataFrame, day: date, months: int = 24) -> DataFrame:
    """Trades of the last months in any status, by placing time."""
    usable = F.col("uni_id").isNotNull() & F.col("payment").isNotNull()
    net = F.round(number(trades, "payment") - F.coalesce(number(trades, "refund_fee"), F.lit(0.0)), MONEY_DIGITS)
    return trades_since(trades.filter(usable), day, months=months).select(
        *TRADE, net.alias("payment"), "created", F.date_format("created", "yyyy-MM").alias("month")
    )


def last_year(day: date) -> Column:
    return F.col("created") >= F.lit(shift_months(day, -12) + timedelta(days=1))


def eligible_shops(trades: DataFrame, day: date, months: int = 24, min_amount: float = 10000) -> DataFrame:
    """Shops that sold in every month and reached the amount in the last twelve."""
    monthly = trades.groupBy(*SHOP_KEYS, "month").agg(money_sum(F.when(last_year(day), F.col("payment"))).alias("paid"))
    shops = monthly.groupBy(*SHOP_KEYS).agg(F.count("month").alias("month_num"), money_sum(F.col("paid")).alias("total_payment"))
    return shops.filter((F.col("month_num") == months) & (F.col("total_payment") >= min_amount))


def _by_category(items: DataFrame, product: DataFrame, category: DataFrame, value: Column) -> DataFrame:
    """Sum per shop and product first, so that only those rows meet the product tables."""
    on_product = [c for c in ("plat_code", "shop_id", "product_id") if c in product.columns]
    on_category = [c for c in ("plat_code", "shop_id", "category_id") if c in category.columns]
    small = items.groupBy(*SHOP_KEYS, *(["shop_id"] if "shop_id" in on_product + on_category else []), "product_id").agg(
        value.alias("value")
    )
    known = product.filter(F.col("category_id").isNotNull())
    parents = category.filter(F.col("parent_category_id").isNotNull())
    return small.join(known, on_product).join(parents, on_category)


def shop_category_payment(
    shops: DataFrame, trades: DataFrame, items: DataFrame, product: DataFrame, category: DataFrame, day: date
) -> DataFrame:
    """Amount per eligible shop and parent category in the last twelve months."""
    recent = trades.filter(last_year(day)).join(shops.select(*SHOP_KEYS), SHOP_KEYS, "left_semi").select(*TRADE)
    sold = items.filter(F.col("product_id").isNotNull()).join(recent, TRADE)
    value = money_sum(F.coalesce("payment", F.lit(0.0)))
    grouped = _by_category(sold, product, category, value).groupBy(*SHOP_KEYS, "parent_category_id")
    return grouped.agg(money_sum(F.col("value")).alias("total_payment"))


def dominant_category_shops(scp: DataFrame, share: float = 0.5) -> DataFrame:
    """Shops whose largest category reaches the share of their sales."""
    totals = scp.groupBy(*SHOP_KEYS).agg(
        F.max("total_payment").alias("top_payment"), money_sum(F.col("total_payment")).alias("shop_payment")
    )
    return totals.filter(F.col("top_payment") / F.col("shop_payment") >= share)


def top_n_shops(scp: DataFrame, shops: DataFrame, n: int = 5) -> DataFrame:
    """Best-selling shops per category. The rank filter keeps n rows per category on the map side."""
    w = Window.partitionBy("parent_category_id").orderBy(F.col("total_payment").desc(), *SHOP_KEYS)
    kept = scp.join(shops.select(*SHOP_KEYS), SHOP_KEYS, "left_semi")
    return kept.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def complete_groups(top: DataFrame, n: int = 5) -> DataFrame:
    """Categories that have the full number of shops."""
    full = top.groupBy("parent_category_id").agg(F.count("*").alias("shop_num")).filter(F.col("shop_num") == n)
    return top.join(full, "parent_category_id", "left_semi")


def benchmark_groups(scp: DataFrame, share: float = 0.5, n: int = 5) -> DataFrame:
    """Rows of `dominant_category_shops`, `top_n_shops` and `complete_groups` in turn, with windows over one relation: the
    shop's share, the rank in the category, and the category's number of shops, none of them reading the rows again."""
    shop = Window.partitionBy(*SHOP_KEYS)
    top, whole = F.max("total_payment").over(shop), F.round(F.sum("total_payment").over(shop), MONEY_DIGITS)
    dominated = scp.withColumns({"top_payment": top, "shop_payment": whole}).filter(F.col("top_payment") / F.col("shop_payment") >= share)
    best = Window.partitionBy("parent_category_id").orderBy(F.col("total_payment").desc(), *SHOP_KEYS)
    ranked = dominated.select(*scp.columns).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)
    sized = ranked.withColumn("shop_num", F.count("*").over(Window.partitionBy("parent_category_id")))
    return sized.filter(F.col("shop_num") == n).drop("shop_num")


def shop_category_units(trades: DataFrame, items: DataFrame, product: DataFrame, category: DataFrame, day: date) -> DataFrame:
    """Items sold per shop and parent category in the last twelve months."""
    recent = trades.filter(last_year(day)).select(*TRADE)
    sold = items.filter(F.col("product_id").isNotNull() & F.col("product_num").isNotNull()).join(recent, TRADE)
    grouped = _by_category(sold, product, category, F.sum("product_num"))
    return grouped.groupBy(*SHOP_KEYS, "parent_category_id").agg(F.sum("value").alias("product_nums"))


def comparable_categories(units: DataFrame, min_share: float = 0.1, n: int = 10) -> DataFrame:
    """Categories that reach the share of a shop's items, best first."""
    shop = Window.partitionBy(*SHOP_KEYS)
    total = F.sum("product_nums").over(shop)
    kept = units.withColumn("shop_nums", total).filter(
        (F.col("shop_nums") > 0) & (F.col("product_nums") / F.col("shop_nums") >= min_share)
    )
    order = shop.orderBy(F.col("product_nums").desc(), "parent_category_id")
    ranked = kept.withColumn("sortno", F.row_number().over(order)).filter(F.col("sortno") <= n)
    return ranked.drop("shop_nums")


def _of_top(top: DataFrame, metrics: DataFrame) -> DataFrame:
    return top.select("parent_category_id", *SHOP_KEYS).join(metrics, SHOP_KEYS)


def category_repurchase(top: DataFrame, shop_wide: DataFrame) -> DataFrame:
    """Mean repurchase rates of the category's shops."""
    rates = with_repurchase_rates(repurchase_counts(shop_wide, ["tenant", *SHOP_KEYS]), 0)
    return _of_top(top, rates).groupBy("parent_category_id").agg(*[F.avg(c).alias(c) for c in ("rate", "new_rate", "old_rate")])


def category_retention(top: DataFrame, shop_wide: DataFrame) -> DataFrame:
    """Mean retention rate of the category's shops."""
    rates = retention_counts(shop_wide, ["tenant", *SHOP_KEYS], 0)
    return _of_top(top, rates).groupBy("parent_category_id").agg(F.avg("rate").alias("retention_rate"))


def category_assets(repurchase: DataFrame, retention: DataFrame, day: date) -> DataFrame:
    return repurchase.join(retention, "parent_category_id").select(
        "parent_category_id",
        F.col("rate").alias("active_customer_rate"),
        F.col("new_rate").alias("new_customer_rate"),
        F.col("old_rate").alias("old_customer_rate"),
        "retention_rate",
        F.lit(day).alias("stat_date"),
    )


def category_report(top: DataFrame, shop_wide: DataFrame, day: date) -> DataFrame:
    """Rows of `category_assets` with one aggregation of the wide rows for repurchase and retention."""
    counts = shop_wide.groupBy("tenant", *SHOP_KEYS).agg(*repurchase_columns(), *retention_columns())
    rates = with_repurchase_rates(counts, 0).withColumn("retention_rate", rate(F.col("last_year_num"), F.col("prev_year_num"), 0))
    names = {"rate": "active_customer_rate", "new_rate": "new_customer_rate", "old_rate": "old_customer_rate", "retention_rate": "retention_rate"}
    means = _of_top(top, rates).groupBy("parent_category_id").agg(*[F.avg(c).alias(n) for c, n in names.items()])
    return means.withColumn("stat_date", F.lit(day))


def category_interval(top: DataFrame, shop_wide: DataFrame, day: date) -> DataFrame:
    """Mean number of customers per interval length over the category's shops."""
    counts = purchase_interval(shop_wide)
    grouped = _of_top(top, counts).groupBy("parent_category_id", "customer_type", "interval_days")
    mean = F.round(F.avg("customer_num")).cast("long")
    return grouped.agg(mean.alias("customer_num")).withColumn("stat_date", F.lit(day))
