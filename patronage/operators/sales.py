"""Sales structure by day, month or year: all, new and returning customers."""

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.constants import CUSTOMER_KEYS, LEVEL_KEYS
from patronage.functions.calendar import until
from patronage.functions.expressions import count_if, money_sum, ratio
from patronage.operators.levels import LEVELED_CUSTOMER, coded, decoded, per_level
from patronage.sources.cleaning import clean_trades, trades_since

# Text forms of the periods, and how far back each report looks.
FORMATS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
HORIZONS = {"day": {"days": 32}, "month": {"months": 14}, "year": None}

KEYS = [*LEVEL_KEYS, "date_col"]
KINDS = {"new": "new", "old": "returning"}
SHORT = ("cus_num", "payments", "avg_price")
DETAIL = ("avg_times", "repeat_num", "repeat_rate", "one_price", "muti_price", "muti_avg_times")


def period_trades(trades: DataFrame, tenant_shop: DataFrame, day: date, grain: str) -> DataFrame:
    """Valid trades of the report's horizon."""
    horizon = HORIZONS[grain]
    recent = trades_since(trades, day, **horizon) if horizon else trades.filter(until(F.col("created"), day))
    return clean_trades(recent, tenant_shop)


def customer_period(trades: DataFrame, grain: str) -> DataFrame:
    """Payment and orders per customer, shop and period."""
    return trades.groupBy(*CUSTOMER_KEYS, F.date_format("created", FORMATS[grain]).alias("date_col")).agg(
        money_sum(F.col("receive_payment")).alias("payments"), F.count("created").alias("buy_times")
    )


def customer_period_rollup(cp: DataFrame) -> DataFrame:
    """The same per customer at the three levels. Shop rows move once, by customer, and are repeated behind that shuffle."""
    leveled = per_level(cp.repartition("uni_id")).groupBy(*LEVELED_CUSTOMER, "date_col").agg(
        money_sum(F.col("payments")).alias("payments"), F.sum("buy_times").alias("buy_times")
    )
    return decoded(leveled)


def with_kind(cp: DataFrame, wide: DataFrame, grain: str) -> DataFrame:
    """Mark rows of customers that first bought in the period or before it.

    The wide table has one row per customer and level. Both sides come by customer, so they are laid together as they are and
    one window hands the first purchase to the periods; a join by customer and level would move both once more.
    """
    bought = coded(wide.filter(F.col("first_buy_time").isNotNull()))
    first = bought.select(*LEVELED_CUSTOMER, F.date_format("first_buy_time", FORMATS[grain]).alias("first"))
    laid = coded(cp).withColumn("in_period", F.lit(True)).unionByName(first, allowMissingColumns=True)
    period, start = F.col("date_col"), F.max("first").over(Window.partitionBy(*LEVELED_CUSTOMER))
    kind = F.when(period == F.col("start"), "new").when(period > F.col("start"), "returning")
    marked = laid.withColumn("start", start).filter("in_period").withColumn("kind", kind)
    return decoded(marked.drop("in_period", "first", "start"))


def _kpis(prefix: str, hit: Column) -> list[Column]:
    times, pay = F.col("buy_times"), F.col("payments")
    many = hit & (times >= 2)
    return [
        count_if(hit).alias(f"{prefix}cus_num"),
        money_sum(F.when(hit, pay)).alias(f"{prefix}payments"),
        F.sum(F.when(hit, times)).alias(f"{prefix}times"),
        count_if(many).alias(f"{prefix}repeat_num"),
        count_if(hit & (times == 1)).alias(f"{prefix}one_num"),
        money_sum(F.when(hit & (times == 1), pay)).alias(f"{prefix}one_pay"),
        money_sum(F.when(many, pay)).alias(f"{prefix}many_pay"),
        F.sum(F.when(many, times)).alias(f"{prefix}many_times"),
    ]


def _derived(p: str) -> dict[str, Column]:
    def c(name: str) -> Column:
        return F.col(f"{p}{name}")

    return {
        f"{p}avg_price": ratio(c("payments"), c("times")),
        f"{p}avg_times": ratio(c("times"), c("cus_num")),
        f"{p}repeat_rate": ratio(c("repeat_num"), c("cus_num")),
        f"{p}one_price": ratio(c("one_pay"), c("one_num")),
        f"{p}muti_price": ratio(c("many_pay"), c("repeat_num")),
        f"{p}muti_avg_times": ratio(c("many_times"), c("repeat_num")),
    }


def _shares(p: str) -> dict[str, Column]:
    return {
        f"{p}rate": ratio(F.col(f"{p}cus_num"), F.col("cus_num")),
        f"{p}payments_rate": ratio(F.col(f"{p}payments"), F.col("payments")),
    }


def period_kpi(cp: DataFrame) -> DataFrame:
    """Customers, payments, average order value and average orders."""
    return cp.groupBy(*KEYS).agg(*_kpis("", F.lit(True))).withColumns(_derived("")).select(*KEYS, *SHORT, "avg_times")


def _kind_kpi(marked: DataFrame, prefix: str) -> DataFrame:
    hit = F.coalesce(F.col("kind") == KINDS[prefix], F.lit(False))
    p = f"{prefix}_"
    grouped = marked.groupBy(*KEYS).agg(
        F.count("*").alias("cus_num"), money_sum(F.col("payments")).alias("payments"), *_kpis(p, hit)
    )
    names = [f"{p}{n}" for n in (*SHORT, *DETAIL, "rate", "payments_rate")]
    return grouped.filter(F.col(f"{p}cus_num") > 0).withColumns(_derived(p)).withColumns(_shares(p)).select(*KEYS, *names)


def new_customer_kpi(marked: DataFrame) -> DataFrame:
    return _kind_kpi(marked, "new")


def returning_customer_kpi(marked: DataFrame) -> DataFrame:
    return _kind_kpi(marked, "old")


def sales_structure(marked: DataFrame, grain: str) -> DataFrame:
    """Wide report of all, new and returning customers in one aggregation, zero-filled."""
    aggs, derived, names = _kpis("", F.lit(True)), _derived(""), [*SHORT]
    for prefix, kind in KINDS.items():
        p = f"{prefix}_"
        aggs += _kpis(p, F.coalesce(F.col("kind") == kind, F.lit(False)))
        derived |= _derived(p) | _shares(p)
        names += [f"{p}{n}" for n in (*SHORT, "rate", "payments_rate")]
        if grain != "day":
            names += [f"{p}{n}" for n in DETAIL]
    if grain != "day":
        names.append("avg_times")
    return marked.groupBy(*KEYS).agg(*aggs).withColumns(derived).select(*KEYS, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names])


def sales_report(trades: DataFrame, tenant_shop: DataFrame, wide: DataFrame, day: date, grain: str) -> DataFrame:
    cp = customer_period_rollup(customer_period(period_trades(trades, tenant_shop, day, grain), grain))
    report = sales_structure(with_kind(cp, wide, grain), grain)
    return report.withColumn("stat_date", F.lit(day))
