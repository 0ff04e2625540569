"""Matrices and purchase rhythm against plain counts, and what they move."""

import random
from collections import Counter
from datetime import date

from pyspark.sql import functions as F

from patronage.constants import MONETARY_WIDTHS, TOTAL
from patronage.functions.calendar import month_ends
from patronage.operators import rfm_wide, segmentation
from rows import CUSTOMER, TRADE, at

DAY = date(2019, 6, 30)
WIDE = (
    "stat_date date, type int, tenant string, plat_code string, uni_shop_id string, uni_id string, year_payment double, year_buy_times long, "
    "year_buy_num long, year_first_time timestamp_ntz, year_last_time timestamp_ntz, first_buy_time timestamp_ntz, second_buy_time timestamp_ntz"
)


def wide_rows(spark):
    rng = random.Random(5)
    rows = [(DAY, 3, "T", "P", f"P|{i % 3}", f"c{i}", rng.choice([0.0, 50.0, 100.0, 250.01, 1999.99, 25000.0, -3.0]), rng.choice([1, 2, 3, 7]), 2,
             at("2018-09-01"), at(f"2019-0{rng.randrange(1, 7)}-15"), at(rng.choice(["2018-09-01", "2017-01-01"])), rng.choice([None, at("2018-10-01")]))
            for i in range(60)]
    # A null shop, a purchase outside all recency buckets and no purchase in the year.
    rows += [(DAY, 1, "T", None, None, "x", 10.0, 1, 1, at("2015-01-01"), at("2015-01-01"), at("2015-01-01"), None), (DAY, 3, "T", "P", "P|0", "y", 0.0, 0, 0, None, None, None, None)]
    return spark.createDataFrame(rows, WIDE), rows


def recency(row):
    days = (DAY - row[10].date()).days
    return next((i for i, most in enumerate((30, 90, 180, 365), 1) if days <= most), None)


def test_rm_matrix_equals_plain_counts(spark):
    wide, rows = wide_rows(spark)
    expected = Counter()
    for row in rows:
        if row[10] is None:
            continue
        for i, width in enumerate(MONETARY_WIDTHS, 1):
            bucket = min(max(-int(-row[6] // width), 1), 11)
            for x in (recency(row), TOTAL):
                for y in (bucket, TOTAL):
                    expected[(*row[1:5], i, x, y)] += 1
    got = segmentation.rm_matrix(wide).collect()
    assert Counter({(r.type, r.tenant, r.plat_code, r.uni_shop_id, r.interval_type, r.recency, r.monetary): r.customer_num for r in got}) == expected
    assert len(got) == len(expected)


def test_purchase_interval_is_both_histograms(spark):
    wide, _ = wide_rows(spark)
    both = segmentation.purchase_interval(wide).collect()
    apart = segmentation.repeat_interval(wide).collect() + segmentation.new_customer_interval(wide).collect()
    assert both and Counter(map(str, both)) == Counter(map(str, apart))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def history(spark):
    trades = spark.createDataFrame([("T", "P", "P|1", "c", 1, 5.0, 1, at("2019-01-01"))], TRADE)
    known = spark.createDataFrame([("T", "P", "P|1", "c", at("2018-01-01"))], CUSTOMER)
    return rfm_wide.month_end_levels(known, trades, month_ends(DAY))


def test_month_ends_are_spread_behind_all_sorts_and_shuffles(spark):
    """Rows of the snapshots would be thirteen times as many to sort, to hash or to move."""
    plan = plan_of(history(spark))
    first = plan[: plan.index("explode([[")] if "explode([[" in plan else plan[: plan.index("Generate explode")]
    assert not any(op in first for op in ("Exchange", "Sort", "Aggregate"))


def test_history_is_read_once_for_both_intervals(spark):
    wide = history(spark)
    assert plan_of(segmentation.purchase_interval(wide)).count("Window") == plan_of(wide).count("Window")


def test_totals_and_shares_of_cells_share_one_shuffle(spark):
    wide, _ = wide_rows(spark)
    plan = plan_of(segmentation.rm_share(segmentation.rm_matrix(wide)))
    assert plan.count("Exchange") == 2 and "Expand" not in plan
    assert {r[0] for r in segmentation.rm_matrix(wide).select(F.col("stat_date")).distinct().collect()} == {DAY}
