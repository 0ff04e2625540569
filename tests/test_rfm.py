"""The wide table and its maintenance, on hand-made rows and against full recomputes."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from patronage.constants import CUSTOMER_KEYS, PLATFORM, TENANT
from patronage.functions.calendar import month_ends
from patronage.operators import rfm_daily, rfm_late, rfm_wide
from patronage.sources.cleaning import unseen_trades
from rows import TRADE, at, same

DAY = date(2019, 6, 30)


def random_trades(spark, seed, n=250, last=DAY, first_id=0, shops=("P|1", "P|2", "Q|1")):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        shop = rng.choice(shops)
        day = datetime(last.year, last.month, last.day) - timedelta(days=int(rng.triangular(0, 1100, 0)))
        when = day + timedelta(hours=rng.choice([0, 9, 23]))
        rows.append(("T", shop[0], shop, f"c{rng.randrange(25)}", first_id + i, rng.randrange(1, 9999) / 100, rng.randrange(1, 4), when))
    return spark.createDataFrame(rows, TRADE)


def test_window_bounds(trades, customers):
    times = {1: "2019-06-30 22:00:00", 2: "2018-07-01", 3: "2018-06-30 23:00:00", 4: "2017-07-01", 5: "2017-06-30", 6: "2019-07-01"}
    df = trades([("P|1", "c", i, 2 ** i, t) for i, t in times.items()])
    r = rfm_wide.shop_rfm(customers([("P|1", "c")]), df, DAY).collect()[0]
    assert (r.year_payment, r.tyear_payment, r.btyear_payment) == (2 + 4, 8 + 16, 32)
    assert (r.year_buy_times, r.tyear_buy_times, r.btyear_buy_times) == (2, 2, 1)
    assert (r.year_first_time, r.year_last_time) == (at("2018-07-01"), at("2019-06-30 22:00:00"))
    assert (r.first_buy_time, r.first_payment, r.second_buy_time) == (at("2017-06-30"), 32, at("2017-07-01"))
    separate = [f(df, CUSTOMER_KEYS, DAY).drop(*CUSTOMER_KEYS).collect()[0] for f in (rfm_wide.last_year_metrics, rfm_wide.prev_year_metrics, rfm_wide.older_metrics)]
    assert [s[0] for s in separate] == [6, 24, 32]


def test_prospects_single_buyers_and_ties(trades, customers):
    df = trades([("P|1", "one", 1, 5, "2019-01-01"), ("P|1", "tie", 8, 7, "2019-01-01"), ("P|1", "tie", 3, 9, "2019-01-01")])
    rows = {r.uni_id: r for r in rfm_wide.shop_rfm(customers([("P|1", c) for c in ("none", "one", "tie")], "2019-03-01"), df, DAY).collect()}
    assert (rows["none"].first_buy_time, rows["none"].year_buy_times, rows["none"].earliest_time) == (None, 0, at("2019-03-01"))
    assert rows["one"].second_buy_time is None and rows["one"].earliest_time == at("2019-01-01")
    assert (rows["tie"].first_payment, rows["tie"].second_buy_time) == (9, at("2019-01-01"))


@pytest.mark.parametrize(
    "rows, second",
    [
        ([("P|1", "2019-01-01"), ("P|2", "2019-02-01")], "2019-02-01"),
        ([("P|1", "2019-01-01"), ("P|1", "2019-01-15"), ("P|2", "2019-02-01")], "2019-01-15"),
        ([("P|1", "2019-01-01"), ("P|1", "2019-03-01"), ("Q|1", "2019-02-01")], "2019-02-01"),
        ([("P|1", "2019-01-01")], None),
    ],
)
def test_second_purchase_over_shops_and_platforms(trades, customers, rows, second):
    df = trades([(shop, "c", i, 1, t) for i, (shop, t) in enumerate(rows)])
    wide = rfm_wide.all_levels(rfm_wide.shop_rfm(customers({(s, "c") for s, _ in rows}), df, DAY))
    tenant = wide.filter("type = 1").collect()[0]
    assert tenant.second_buy_time == (at(second) if second else None)


def test_levels_agree_with_direct_computation(spark):
    df = random_trades(spark, 1)
    known = df.select(*CUSTOMER_KEYS).distinct().withColumn("modified", F.lit(at("2018-01-01")))
    shop = rfm_wide.shop_rfm(known, df, DAY)
    wide = rfm_wide.all_levels(shop)
    plat = rfm_wide.rollup_rfm(shop, PLATFORM)
    same(wide.filter("type = 2").drop("type"), plat)
    same(wide.filter("type = 1").drop("type"), rfm_wide.rollup_rfm(plat, TENANT))
    direct = rfm_wide.first_second_purchase(df, ["tenant", "uni_id"], DAY)
    cols = ["tenant", "uni_id", "first_buy_time", "first_payment", "second_buy_time"]
    same(wide.filter("type = 1"), direct, cols)
    sums = wide.groupBy("type").agg(F.round(F.sum("year_payment"), 2), F.sum("year_buy_times"), F.sum("btyear_buy_num")).drop("type")
    assert len({tuple(r) for r in sums.collect()}) == 1


def test_month_ends_in_one_pass_equal_single_runs(spark):
    df = random_trades(spark, 2)
    known = df.select(*CUSTOMER_KEYS).distinct().withColumn("modified", F.lit(at("2018-01-01")))
    days = month_ends(DAY, 6)
    singles = [rfm_wide.shop_rfm(known, df, d) for d in days]
    union = singles[0]
    for s in singles[1:]:
        union = union.unionByName(s)
    same(rfm_wide.month_end_rfm(known, df, days), union)
    same(rfm_wide.month_end_levels(known, df, days), rfm_wide.all_levels(union))


@pytest.mark.parametrize("day", [date(2019, 6, 30), date(2019, 2, 28), date(2020, 3, 1), date(2019, 6, 12)])
def test_daily_step_equals_full_run(spark, day):
    before = day - timedelta(days=1)
    history = random_trades(spark, day.toordinal(), 400, before)
    delta = random_trades(spark, 7, 60, day, first_id=1000)
    # Two trades arrive again with another amount; one of them moved to another time.
    again = history.filter(F.col("trade_id").isin(5, 17)).withColumns(
        {"receive_payment": F.lit(1.23), "created": F.when(F.col("trade_id") == 5, F.col("created") - F.expr("interval 40 days")).otherwise(F.col("created"))}
    )
    base = history
    everything = base.filter(~F.col("trade_id").isin(5, 17)).unionByName(again).unionByName(delta)
    known = everything.select(*CUSTOMER_KEYS).distinct().withColumn("modified", F.lit(at("2018-01-01")))
    previous = rfm_wide.shop_rfm(base.select(*CUSTOMER_KEYS).distinct().withColumn("modified", F.lit(at("2018-01-01"))), base, before)
    got = rfm_daily.daily_rfm(known, previous, base, delta.unionByName(again), day)
    same(got, rfm_wide.shop_rfm(known, everything, day))


def test_daily_parts_equal_the_fused_step(spark):
    before = DAY - timedelta(days=1)
    base, delta = random_trades(spark, 3, 200, before), random_trades(spark, 4, 40, DAY, 1000)
    known = base.unionByName(delta).select(*CUSTOMER_KEYS).distinct().withColumn("modified", F.lit(at("2018-01-01")))
    previous = rfm_wide.shop_rfm(base.select(*CUSTOMER_KEYS).distinct().withColumn("modified", F.lit(at("2018-01-01"))), base, before)
    out12 = rfm_daily.boundary_metrics(rfm_daily.boundary_day_trades(base, DAY, 12))
    out24 = rfm_daily.boundary_metrics(rfm_daily.boundary_day_trades(base, DAY, 24))
    aged = rfm_daily.age_rfm(previous, out12, out24, rfm_daily.year_bounds(base, out12, DAY), known, DAY)
    inc = rfm_daily.increment_rfm(delta, DAY)
    parts = rfm_daily.final_daily_rfm(known, rfm_daily.merge_changed(inc, aged), rfm_daily.insert_new(inc, aged), aged, DAY)
    same(parts, rfm_daily.settle(known, inc, aged, DAY))


def test_late_patch_equals_full_run_and_runs_again(spark):
    ends = month_ends(DAY, 5)
    base, delta = random_trades(spark, 5, 300), random_trades(spark, 6, 80, first_id=1000)
    old = base.select(*CUSTOMER_KEYS).distinct().withColumn("modified", F.lit(at("2018-01-01")))
    known = base.unionByName(delta).select(*CUSTOMER_KEYS).distinct().withColumn("modified", F.lit(at("2018-01-01")))
    snapshots = rfm_wide.month_end_rfm(old, base, ends)
    patched = rfm_late.patch_month_ends(snapshots, unseen_trades(delta, base), known, ends)
    full = rfm_wide.month_end_rfm(known, base.unionByName(delta), ends)
    stored = full.join(old.drop("modified"), CUSTOMER_KEYS, "left_semi")
    new = full.join(old.drop("modified"), CUSTOMER_KEYS, "left_anti").filter(F.col("first_buy_time").isNotNull())
    same(patched, stored.unionByName(new))
    nothing = unseen_trades(delta, base.unionByName(delta))
    same(rfm_late.patch_month_ends(patched, nothing, known, ends), patched)


def test_late_trade_before_between_and_long_ago(trades, customers):
    base = trades([("P|1", c, i, 10, t) for i, (c, t) in enumerate([("a", "2019-01-05"), ("a", "2019-03-05"), ("b", "2019-01-05"), ("b", "2019-03-05"), ("c", "2019-01-05")])])
    late = trades([("P|1", "a", 10, 7, "2019-01-01"), ("P|1", "b", 11, 7, "2019-02-01"), ("P|1", "c", 12, 7, "2015-01-01")])
    ends = month_ends(DAY, 3)
    known = customers([("P|1", c) for c in "abc"])
    got = rfm_late.patch_month_ends(rfm_wide.month_end_rfm(known, base, ends), late, known, ends)
    rows = {r.uni_id: r for r in got.filter(F.col("stat_date") == F.lit(ends[0])).collect()}
    assert (rows["a"].first_buy_time, rows["a"].first_payment, rows["a"].second_buy_time) == (at("2019-01-01"), 7, at("2019-01-05"))
    assert (rows["b"].first_payment, rows["b"].second_buy_time) == (10, at("2019-02-01"))
    assert (rows["c"].first_buy_time, rows["c"].btyear_payment, rows["c"].second_buy_time) == (at("2015-01-01"), 7, at("2019-01-05"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_snapshots_meet_late_rows_where_they_lie(spark, trades, customers):
    """Only the late rows move: no shuffle or sort by customer and snapshot."""
    known = customers([("P|1", "c"), ("P|2", "c")])
    snapshots = rfm_wide.month_end_rfm(known, trades([("P|1", "c", 1, 5, "2020-01-05")]), month_ends(DAY))
    late = spark.createDataFrame(snapshots.limit(1).collect(), snapshots.schema)
    patched = rfm_late.late_patch(snapshots, late, late.limit(0))
    plan = plan_of(patched)
    assert "SortMergeJoin" not in plan.split("ShuffledHashJoin")[0]
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "stat_date" in line]


def test_late_rows_of_one_customer_and_several_month_ends(spark, trades, customers):
    """A late customer without a stored row, one with a row at some month ends only, and one without late trades."""
    ends = month_ends(DAY, 3)
    known = customers([("P|1", "a"), ("P|1", "b"), ("P|2", "a")])
    base = trades([("P|1", "a", 1, 5, "2019-01-05"), ("P|2", "a", 2, 7, "2019-02-05")])
    delta = trades([("P|1", "a", 3, 2, "2018-01-05"), ("P|1", "b", 4, 3, "2019-03-05"), ("P|1", "a", 5, 1, "2019-04-05")])
    snapshots = rfm_wide.month_end_rfm(known, base, ends).filter((F.col("uni_id") != "b") | (F.col("stat_date") == F.lit(ends[0])))
    patched = rfm_late.patch_month_ends(snapshots, delta, known, ends)
    assert patched.count() == 9 == patched.select(*rfm_late.SNAPSHOT_KEYS).distinct().count()
    same(patched, rfm_wide.month_end_rfm(known, base.union(delta), ends))


def test_keys_of_month_ends_make_no_sums(trades, customers):
    days = month_ends(DAY)
    rows = rfm_wide.month_end_rfm(customers([("P|1", "c")]), trades([("P|1", "c", 1, 5, "2020-01-05")]), days)
    assert "lambdafunction" not in plan_of(rows.select("uni_id", "stat_date"))


def test_whole_levels_are_made_by_one_sort(spark, trades, customers):
    rows = [("P|1", "c", 1, 5, "2020-01-05"), ("P|2", "c", 2, 7, "2020-01-05"), ("Q|1", "c", 3, 1.1, "2019-02-05"), ("P|1", "c", 4, 2.2, "2020-02-05")]
    shop = rfm_wide.shop_rfm(customers([(s, c) for s in ("P|1", "P|2", "Q|1") for c in "cd"]), trades(rows), DAY)
    same(rfm_wide.whole_levels(shop), rfm_wide.all_levels(shop))
    stored = spark.createDataFrame(shop.collect(), shop.schema)
    assert "HashAggregate" not in plan_of(rfm_wide.whole_levels(stored))


def test_first_time_needs_no_ranking_and_no_sort(spark, trades, customers):
    shop = rfm_wide.shop_rfm(customers([("P|1", "a"), ("P|1", "b")]), trades([("P|1", "a", 1, 5, "2019-01-01"), ("P|9", "a", 2, 5, "2018-01-01")]), DAY)
    some = shop.select("uni_id", "first_buy_time", "year_buy_times")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert not any(op in plan for op in ("Window", "Sort", "Join"))
    assert {tuple(r) for r in some.collect()} == {("a", at("2019-01-01"), 1), ("b", None, 0)}


def test_trades_without_a_key_belong_to_nobody(spark, customers):
    """A customer without tenant is kept and gets no trades, as null keys are not equal."""
    df = spark.createDataFrame([(None, "P", "P|1", "a", 1, 5.0, 1, at("2019-01-01"))], TRADE)
    known = customers([("P|1", "a")]).withColumn("tenant", F.lit(None).cast("string"))
    (row,) = rfm_wide.shop_rfm(known, df, DAY).collect()
    assert (row.first_buy_time, row.year_buy_times, row.year_payment) == (None, 0, 0.0)
