"""Customer assets: life stages, repurchase and retention per level and snapshot."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.constants import LEVEL_KEYS, SHOP, UNDEFINED_RATE
from patronage.functions.calendar import is_month_end, shift_months_col
from patronage.functions.expressions import count_if, rate

KEYS = ["stat_date", *LEVEL_KEYS]
STAGES = ("prospective", "active", "silent", "loss")


def bought_by(day: Column) -> Column:
    return F.coalesce(F.to_date("first_buy_time") <= day, F.lit(False))


def life_stage() -> Column:
    year, tyear, btyear = F.col("year_buy_times"), F.col("tyear_buy_times"), F.col("btyear_buy_times")
    return (
        F.when(~bought_by(F.col("stat_date")), "prospective")
        .when(year >= 1, "active")
        .when((year == 0) & (tyear >= 1), "silent")
        .when((year == 0) & (tyear == 0) & (btyear >= 1), "loss")
        .otherwise("prospective")
    )


def new_in_year() -> Column:
    """First purchase within the year; null for customers that never bought."""
    return F.to_date("first_buy_time") > shift_months_col(F.col("stat_date"), -12)


def with_shop_name(report: DataFrame, tenant_shop: DataFrame) -> DataFrame:
    """Add shop names to shop rows; rows of unknown shops are dropped."""
    names = tenant_shop.select("tenant", "plat_code", "uni_shop_id", "shop_name")
    joined = report.join(names, ["tenant", "plat_code", "uni_shop_id"], "left")
    return joined.filter((F.col("type") != SHOP) | F.col("shop_name").isNotNull())


def assets_view(wide: DataFrame, tenant_shop: DataFrame) -> DataFrame:
    counts = wide.withColumn("stage", life_stage()).groupBy(*KEYS).agg(
        *[count_if(F.col("stage") == s).alias(f"{s}_num") for s in STAGES], F.count("*").alias("whole_num")
    )
    return with_shop_name(counts, tenant_shop).withColumn("end_month", is_month_end(F.col("stat_date")))


def repurchase_columns() -> list[Column]:
    active, repeat = F.col("year_buy_times") >= 1, F.col("year_buy_times") >= 2
    new = new_in_year()
    return [
        count_if(active).alias("active"),
        count_if(repeat).alias("repurchase"),
        count_if(active & new).alias("active_new"),
        count_if(repeat & new).alias("new_repurchase"),
        count_if(active & ~new).alias("active_old"),
        count_if(repeat & ~new).alias("old_repurchase"),
    ]


def repurchase_counts(wide: DataFrame, keys: list[str]) -> DataFrame:
    return wide.groupBy(*keys).agg(*repurchase_columns())


def with_repurchase_rates(counts: DataFrame, undefined: float = UNDEFINED_RATE) -> DataFrame:
    pairs = {"rate": ("repurchase", "active"), "new_rate": ("new_repurchase", "active_new"), "old_rate": ("old_repurchase", "active_old")}
    return counts.withColumns({name: rate(F.col(n), F.col(d), undefined) for name, (n, d) in pairs.items()})


def repurchase_view(wide: DataFrame, tenant_shop: DataFrame) -> DataFrame:
    report = with_repurchase_rates(repurchase_counts(wide, KEYS))
    return with_shop_name(report, tenant_shop).withColumn("end_month", is_month_end(F.col("stat_date")))


def retention_columns() -> list[Column]:
    before, now = F.col("tyear_buy_times") >= 1, F.col("year_buy_times") >= 1
    return [count_if(before).alias("prev_year_num"), count_if(before & now).alias("last_year_num")]


def retention_counts(wide: DataFrame, keys: list[str], undefined: float = UNDEFINED_RATE) -> DataFrame:
    counts = wide.groupBy(*keys).agg(*retention_columns())
    return counts.withColumn("rate", rate(F.col("last_year_num"), F.col("prev_year_num"), undefined))


def retention_view(wide: DataFrame, tenant_shop: DataFrame) -> DataFrame:
    report = with_shop_name(retention_counts(wide, KEYS), tenant_shop)
    return report.withColumn("end_month", is_month_end(F.col("stat_date")))
