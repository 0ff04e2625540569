"""Recency × frequency and recency × monetary matrices and purchase rhythm.

The input is the wide table at one or more levels and snapshot dates; both stay grouping keys.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.constants import LEVEL_KEYS, MONETARY_WIDTHS, TOTAL
from patronage.functions.buckets import frequency_bucket, monetary_bucket, recency_bucket
from patronage.functions.calendar import shift_months_col
from patronage.functions.expressions import money_sum, rate, ratio

KEYS = ["stat_date", *LEVEL_KEYS]
MEASURES = ["customer_num", "total_payment", "total_times", "total_num"]


def buyers(wide: DataFrame) -> DataFrame:
    """Customers with purchases in the year, with their recency and frequency."""
    rows = wide.filter(
        F.col("year_last_time").isNotNull() & F.col("year_buy_times").isNotNull() & F.col("year_payment").isNotNull()
    )
    return rows.withColumns(
        {
            "recency": recency_bucket(F.datediff("stat_date", "year_last_time")),
            "frequency": frequency_bucket(F.col("year_buy_times")),
        }
    )


def _cells(rows: DataFrame, axes: list[str]) -> DataFrame:
    return rows.groupBy(*KEYS, *axes).agg(
        F.count("uni_id").alias("customer_num"),
        money_sum(F.col("year_payment")).alias("total_payment"),
        F.sum("year_buy_times").alias("total_times"),
        F.sum("year_buy_num").alias("total_num"),
    )


def _with_totals(cells: DataFrame, fixed: list[str], x: str, y: str) -> DataFrame:
    """Row, column and grand totals over the small table of cells; a null bucket stays a bucket.

    Cells come together by snapshot and entity, of which each has a bounded number; totals and shares follow in place.
    """
    sums = [(money_sum(F.col(m)) if m == "total_payment" else F.sum(m)).alias(m) for m in MEASURES]
    marks = [F.struct(F.lit(i).alias(f"{x}_total"), F.lit(j).alias(f"{y}_total")) for i in (False, True) for j in (False, True)]
    marked = cells.withColumn("mark", F.explode(F.array(*marks))).select("*", "mark.*").drop("mark")

    def code(axis: str) -> Column:
        return F.when(F.col(f"{axis}_total"), F.lit(TOTAL)).otherwise(F.col(axis))

    grouped = marked.withColumns({x: code(x), y: code(y)}).groupBy(*KEYS, *fixed, x, y, f"{x}_total", f"{y}_total").agg(*sums)
    return grouped.drop(f"{x}_total", f"{y}_total")


def _averages(matrix: DataFrame) -> DataFrame:
    pay, times = F.col("total_payment"), F.col("total_times")
    return matrix.withColumns(
        {
            "avg_payment": ratio(pay, F.col("customer_num")),
            "avg_guest_pay": ratio(pay, times),
            "avg_guest_item": ratio(F.col("total_num"), times),
            "avg_item_pay": ratio(pay, F.col("total_num")),
        }
    ).drop("total_payment", "total_times", "total_num")


def _share(matrix: DataFrame, fixed: list[str], x: str, y: str) -> DataFrame:
    is_total = (F.col(x) == TOTAL) & (F.col(y) == TOTAL)
    total = F.max(F.when(is_total, F.col("customer_num"))).over(Window.partitionBy(*KEYS, *fixed))
    return matrix.withColumn("customer_rate", rate(F.col("customer_num"), total))


def rf_matrix(wide: DataFrame) -> DataFrame:
    cells = _cells(buyers(wide), ["recency", "frequency"]).repartition(*KEYS)
    return _averages(_with_totals(cells, [], "recency", "frequency"))


def rf_share(matrix: DataFrame) -> DataFrame:
    return _share(matrix, [], "recency", "frequency")


def with_monetary(rows: DataFrame, widths: tuple[int, ...] = MONETARY_WIDTHS) -> DataFrame:
    """Repeat each buyer for the interval widths, numbered from 1."""
    amount = F.col("year_payment")
    marks = [
        F.struct(F.lit(i).alias("interval_type"), monetary_bucket(amount, F.lit(w)).alias("monetary"))
        for i, w in enumerate(widths, 1)
    ]
    return rows.withColumn("mark", F.explode(F.array(*marks))).select("*", "mark.*").drop("mark")


def rm_matrix(wide: DataFrame, widths: tuple[int, ...] = MONETARY_WIDTHS) -> DataFrame:
    """Buyers are counted by their buckets of all widths at once, and the counts, not the buyers, repeated for the widths."""
    amount, names = F.col("year_payment"), [f"by_{w}" for w in widths]
    found = buyers(wide).withColumns({n: monetary_bucket(amount, F.lit(w)) for n, w in zip(names, widths, strict=True)})
    marks = [F.struct(F.lit(i).alias("interval_type"), F.col(n).alias("monetary")) for i, n in enumerate(names, 1)]
    spread = _cells(found, ["recency", *names]).repartition(*KEYS).withColumn("axis", F.explode(F.array(*marks))).select("*", "axis.*")
    return _averages(_with_totals(spread.drop("axis", *names), ["interval_type"], "recency", "monetary"))


def rm_share(matrix: DataFrame) -> DataFrame:
    return _share(matrix, ["interval_type"], "recency", "monetary")


def segmentation_report(wide: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both matrices with shares, for all levels and snapshots of the input."""
    return rf_share(rf_matrix(wide)), rm_share(rm_matrix(wide))


def _repeat_days() -> Column:
    """Mean number of days between purchases, for two or more orders in the year."""
    days = F.datediff("year_last_time", "year_first_time") / (F.col("year_buy_times") - 1)
    return F.when(F.col("year_buy_times") >= 2, F.struct(F.lit(1).alias("customer_type"), F.ceil(days).cast("int").alias("interval_days")))


def _second_days() -> Column:
    """Days from the first to the second purchase, for customers new in the year."""
    new = F.to_date("first_buy_time") > shift_months_col(F.col("stat_date"), -12)
    wanted = new & F.col("second_buy_time").isNotNull() & (F.col("year_buy_times") > 1)
    return F.when(wanted, F.struct(F.lit(2).alias("customer_type"), F.datediff("second_buy_time", "first_buy_time").alias("interval_days")))


def _histogram(wide: DataFrame, *intervals: Column) -> DataFrame:
    rows = wide.select(*KEYS, "uni_id", F.explode(F.array_compact(F.array(*intervals))).alias("interval")).select("*", "interval.*")
    return rows.groupBy(*KEYS, "customer_type", "interval_days").agg(F.count("uni_id").alias("customer_num"))


def repeat_interval(wide: DataFrame) -> DataFrame:
    """Customers per mean number of days between purchases, for two or more orders in the year."""
    return _histogram(wide.filter(F.col("year_buy_times") >= 2), _repeat_days())


def new_customer_interval(wide: DataFrame) -> DataFrame:
    """Customers per number of days from the first to the second purchase, for customers new in the year."""
    return _histogram(wide.filter(F.col("year_buy_times") >= 2), _second_days())


def purchase_interval(wide: DataFrame) -> DataFrame:
    """Both in one pass over the customers."""
    return _histogram(wide.filter(F.col("year_buy_times") >= 2), _repeat_days(), _second_days())
