"""Late trades: correct the stored month-end snapshots without recomputing all of them.

Only the delta is multiplied by the month ends; history is never expanded.
"""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.constants import CUSTOMER_KEYS
from patronage.functions.calendar import until, windows
from patronage.functions.expressions import money_sum
from patronage.operators.rfm_daily import STATE_COLUMNS, changed_versions, merged_columns
from patronage.operators.rfm_wide import (
    PERIODS,
    earliest,
    first_second_purchase,
    month_end_rfm,
    whole_levels,
    zero_measures,
)
from patronage.sources.cleaning import TRADE_KEY

SNAPSHOT_KEYS = [*CUSTOMER_KEYS, "stat_date"]


def late_flags(delta: DataFrame, month_ends: list[date]) -> DataFrame:
    """Each late trade with the month ends it precedes and the window it falls in there."""
    marks = []
    for w in map(windows, month_ends):
        time = F.col("created")
        window = F.when(time < F.lit(w.tyear_start), "btyear").when(time < F.lit(w.year_start), "tyear").otherwise("year")
        mark = F.struct(F.lit(w.stat_date).alias("stat_date"), window.alias("window"))
        marks.append(F.when(time < F.lit(w.end), mark))
    return delta.withColumn("mark", F.explode(F.array_compact(F.array(*marks)))).select(*delta.columns, "mark.*")


def late_metrics(flagged: DataFrame) -> DataFrame:
    """Window metrics of the late trades per customer and month end."""
    aggs = []
    for p in PERIODS:
        hit = F.col("window") == p
        aggs += [
            money_sum(F.when(hit, F.col("receive_payment"))).alias(f"{p}_payment"),
            F.count(F.when(hit, 1)).alias(f"{p}_buy_times"),
            F.sum(F.when(hit, F.col("product_num"))).alias(f"{p}_buy_num"),
        ]
    year = F.col("window") == "year"
    return flagged.groupBy(*SNAPSHOT_KEYS).agg(
        *aggs,
        F.min(F.when(year, F.col("created"))).alias("year_first_time"),
        F.max(F.when(year, F.col("created"))).alias("year_last_time"),
    )


def late_assemble(first_second: DataFrame, metrics: DataFrame) -> DataFrame:
    """Late metrics with the first and second late purchase up to each month end."""
    end = F.date_add("stat_date", 1)
    joined = metrics.join(first_second, CUSTOMER_KEYS)
    return joined.withColumns(
        {
            "second_buy_time": F.when(F.col("second_buy_time") < end, F.col("second_buy_time")),
            "earliest_time": F.col("first_buy_time"),
            **zero_measures(),
        }
    ).select(*STATE_COLUMNS)


def late_rows(delta: DataFrame, month_ends: list[date]) -> DataFrame:
    flagged = late_flags(delta, month_ends)
    return late_assemble(first_second_purchase(delta, CUSTOMER_KEYS, max(month_ends)), late_metrics(flagged))


def late_new_customers(late: DataFrame, snapshots: DataFrame, customers: DataFrame) -> DataFrame:
    """Late rows without a stored row, with the customer's own earliest time.

    Of the stored rows only those of customers with late rows are compared. They are found by customer, as snapshots lie
    that were just derived, and without sorting: only the late customers are held in memory, a part in each task.
    """
    of_late = late.select(*CUSTOMER_KEYS).distinct().hint("shuffle_hash")
    held = snapshots.select(*SNAPSHOT_KEYS).join(of_late, CUSTOMER_KEYS, "left_semi")
    missing = late.join(held, SNAPSHOT_KEYS, "left_anti")
    joined = missing.join(customers.select(*CUSTOMER_KEYS, "modified"), CUSTOMER_KEYS, "left")
    own = F.coalesce("modified", "first_buy_time")
    return joined.withColumn("earliest_time", earliest(F.col("first_buy_time"), own)).select(*STATE_COLUMNS)


def late_patch(snapshots: DataFrame, late: DataFrame, new: DataFrame) -> DataFrame:
    """Stored rows merged with the late ones, plus the new rows.

    A customer's late rows, at most one a month end, come as a list. So stored rows meet them by customer, without being
    sorted, and without being moved where they lie by customer as snapshots that were just derived do.
    """
    lists = late.groupBy(*CUSTOMER_KEYS).agg(F.collect_list(F.struct(*[c for c in STATE_COLUMNS if c not in CUSTOMER_KEYS])).alias("late"))
    of_day = F.filter("late", lambda row: row["stat_date"] == F.col("s.stat_date"))
    joined = snapshots.alias("s").join(lists.hint("shuffle_hash"), CUSTOMER_KEYS, "left").withColumn("l", F.explode_outer(of_day))
    cols = merged_columns("s", "l")
    patched = joined.select(*CUSTOMER_KEYS, F.col("s.stat_date"), *[c.alias(n) for n, c in cols.items()]).select(*STATE_COLUMNS)
    return patched.unionByName(new.select(*STATE_COLUMNS))


def patch_month_ends(snapshots: DataFrame, delta: DataFrame, customers: DataFrame, month_ends: list[date]) -> DataFrame:
    """Shop-level snapshots after the late trades.

    `snapshots` should be a stored table: it is read twice, once with its key columns only. `delta`
    must hold only trades unseen so far.
    """
    late = late_rows(delta, month_ends)
    return late_patch(snapshots, late, late_new_customers(late, snapshots, customers))


def touched_customers(base: DataFrame, delta: DataFrame, delivered: DataFrame, last_end: date) -> DataFrame:
    """Customers whose month ends change: holders of new or of replaced versions that lie before the last end."""
    old = base.join(delivered, TRADE_KEY, "left_semi").filter(until(F.col("created"), last_end))
    new = delta.filter(until(F.col("created"), last_end))
    return old.select(*CUSTOMER_KEYS).union(new.select(*CUSTOMER_KEYS)).distinct()


def changed_customers(replaced: DataFrame, delta: DataFrame) -> DataFrame:
    """Customers whose trades changed, and the earliest time at which they did: snapshots that end before it stay."""
    return changed_versions(replaced, delta).groupBy(*CUSTOMER_KEYS).agg(F.min("created").alias("changed_from"))


def rebuild_month_ends(
    snapshots: DataFrame, trades: DataFrame, touched: DataFrame, customers: DataFrame, month_ends: list[date], of_slices: list[dict] | None = None
) -> DataFrame:
    """Snapshots with the rows of the touched customers derived again from their trades.

    Gives the same result however often it runs, and also covers trades whose amount or time
    changed. Only the touched customers' history is read into the computation. `of_slices` limits the rebuilt rows to
    pairs of a snapshot date and a tenant, those that `snapshots` holds.
    """
    keys = touched.select(*CUSTOMER_KEYS).distinct()
    own_trades = trades.join(keys, CUSTOMER_KEYS, "left_semi")
    own_customers = customers.join(keys, CUSTOMER_KEYS, "left_semi")
    rebuilt = month_end_rfm(own_customers, own_trades, month_ends)
    if of_slices is not None:
        wanted = snapshots.sparkSession.createDataFrame([(s["stat_date"], s["tenant"]) for s in of_slices], "stat_date date, tenant string")
        rebuilt = rebuilt.join(wanted, ["stat_date", "tenant"], "left_semi")
    untouched = snapshots.join(keys, CUSTOMER_KEYS, "left_anti")
    return untouched.select(*STATE_COLUMNS).unionByName(rebuilt.select(*STATE_COLUMNS))


def late_patch_rollup(patched: DataFrame) -> DataFrame:
    """The three levels derived from the patched shop rows."""
    return whole_levels(patched)
