import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from patronage.operators import audience, dashboard
from patronage.sinks import manifest, writers
from rows import at

DAY = date(2019, 6, 30)
ORDER = (
    "dp_id string, tid string, oid string, buyer_nick string, cid string, num_iid string, sku_id string, num int, status string, "
    "created timestamp_ntz, pay_time timestamp_ntz, end_time timestamp_ntz, part string"
)


def orders(spark, rows):
    full = []
    for i, (shop, buyer, cid, item, num, created) in enumerate(rows):
        t = at(created) if isinstance(created, str) else created
        full.append((shop, f"t{i}", f"o{i}", buyer, cid, item, "s", num, "TRADE_FINISHED", t, t, t, f"{t:%Y-%m}"))
    return spark.createDataFrame(full, ORDER)


@pytest.mark.parametrize("mode", ["0", "1", "2", "3"])
def test_exclusion_against_brute_force(spark, mode):
    rng = random.Random(int(mode))
    rows = [
        (rng.choice("XY"), rng.choice("ab"), rng.choice("cd"), rng.choice("123"), rng.randrange(1, 4), datetime(2019, 6, 30) - timedelta(hours=rng.randrange(0, 2400)))
        for _ in range(60)
    ]
    df = orders(spark, rows)
    due = df.withColumns({"config_period": F.col("num") * 3, "config_exclude_customer": F.lit(mode)})
    got = {r.oid for r in audience.exclude_rebought(due, df, DAY).collect()}
    expected = set()
    for i, (shop, buyer, cid, item, num, t) in enumerate(rows):
        later = [
            r for j, r in enumerate(rows)
            if j != i and r[0] == shop and r[1] == buyer and t < r[5] <= t + timedelta(days=num * 3)
            and (mode == "1" or (mode == "2" and r[2] == cid) or (mode == "3" and r[3] == item))
        ]
        if mode == "0" or not later:
            expected.add(f"o{i}")
    assert got == expected


def test_exclusion_at_the_edges(spark):
    df = orders(spark, [("X", "a", "c", "1", 1, "2019-06-01 10:00:00"), ("X", "a", "c", "1", 1, "2019-06-04 10:00:00"), ("X", "b", "c", "1", 1, "2019-06-01 10:00:00"), ("X", "b", "c", "1", 1, "2019-06-04 10:00:01"), ("X", "e", "c", "1", 1, "2019-06-01 10:00:00"), ("X", "e", "c", "1", 1, "2019-06-01 10:00:00")])
    due = df.withColumns({"config_period": F.lit(3), "config_exclude_customer": F.lit("1")})
    assert {r.oid for r in audience.exclude_rebought(due, df, DAY).collect()} == {"o1", "o2", "o3", "o4", "o5"}


def test_an_empty_period_drops_nothing(spark):
    """Orders before and after the item on its day lie in one row of that day, but not in a period of no days."""
    df = orders(spark, [("X", "a", "c", "1", 1, f"2019-06-01 {hour}:00:00") for hour in ("08", "10", "12")])
    due = df.withColumns({"config_period": F.lit(0), "config_exclude_customer": F.lit("1")})
    assert audience.exclude_rebought(due, df, DAY).count() == 3


def test_export_lines_hold_no_quotes(spark, tmp_path):
    rows = spark.createDataFrame([('Shop "A"', "a\\b", None, 1.5), ("x\u0001y", "", "z", 2.0)], "name string, note string, gap string, paid double")
    writers.export_delimited(rows, str(tmp_path / "out"))
    lines = {r.value for r in spark.read.text(str(tmp_path / "out")).collect()}
    assert lines == {'Shop "A"\u0001a\\\\b\u0001\\N\u00011.5', "x\\\u0001y\u0001\u0001z\u00012.0"}


def test_due_items(spark):
    df = orders(spark, [("X", "a", "c", "1", 2, "2019-06-20 10:00:00"), ("X", "a", "c", "2", 2, "2019-06-20"), ("X", "a", "c", "3", 1, "2019-06-20")])
    rules = [("X", "1", "NULL", 5, None, "0", "0"), ("X", "2", "other", 5, None, "0", "0"), ("X", "3", "s", 10, None, "1", "1")]
    config = spark.createDataFrame(rules, "shop_id string, item_id string, sku_id string, period int, exclude_flag string, exclude_customer string, trigger_status string")
    assert {r.oid for r in audience.repurchase_due(df, config, DAY).collect()} == {"o0", "o2"}


def test_latest_trade_prefers_a_due_one_among_ties(spark):
    base = [("X", "t1", "a", "TRADE_FINISHED", at("2019-06-10"), at("2019-06-10"), None, "2019-06"), ("X", "t2", "a", "TRADE_FINISHED", at("2019-06-10"), at("2019-06-11"), None, "2019-06"), ("X", "t0", "a", "TRADE_FINISHED", at("2019-06-01"), at("2019-06-10"), None, "2019-06")]
    df = spark.createDataFrame(base, "dp_id string, tid string, buyer_nick string, status string, created timestamp_ntz, pay_time timestamp_ntz, end_time timestamp_ntz, part string")
    shops = spark.createDataFrame([("X", 20)], "shop_id string, care_days int")
    assert [r.tid for r in audience.latest_trade_per_buyer(df, shops, DAY).collect()] == ["t1"]


def test_flags(spark):
    df = spark.createDataFrame([("1,2", 2), ("1", 2), ("NULL", 2), (None, 2), ("2", None)], "config_exclude_flag string, seller_flag int")
    assert audience.drop_flagged(df).count() == 4


def test_funnel_times_and_rates(spark):
    cols = "dp_id string, tid string, status string, created timestamp_ntz, pay_time timestamp_ntz, consign_time timestamp_ntz, end_time timestamp_ntz, part string"
    rows = [
        ("X", "1", "TRADE_FINISHED", at("2019-06-30 10:00:00"), at("2019-06-30 10:30:00"), at("2019-06-30 12:30:00"), at("2019-07-02 12:30:00"), "2019-06"),
        ("X", "2", "WAIT_BUYER_CONFIRM_GOODS", at("2019-06-30 10:00:00"), at("2019-06-30 09:00:00"), None, None, "2019-06"),
        ("X", "3", "WAIT_BUYER_PAY", at("2019-06-24"), None, None, None, "active"),
        ("Y", "4", "WAIT_BUYER_PAY", at("2019-06-23"), None, None, None, "active"),
    ]
    report = dashboard.funnel_report(dashboard.order_funnel(spark.createDataFrame(rows, cols), DAY), DAY)
    got = {(r.shop_id, r.period): r for r in report.collect()}
    one = got[("X", 1)]
    assert (one.tid_count_created, one.tid_count_paytime, one.rate_shiping_finished) == (2, 2, 0.5)
    assert (one.rate_shiping_time_paytime, one.rate_shiping_time_sends, one.rate_shiping_time_finished) == (15, 1, 2)
    assert got[("X", 7)].tid_count_created == 3 and ("Y", 7) not in got
    assert (got[("Y", 30)].rate_shiping_paytime, got[("Y", 30)].rate_shiping_finished) == (0, 0)


def test_snapshot_writes_run_again(spark, tmp_path):
    path = str(tmp_path / "snap")
    df = spark.createDataFrame([(date(2019, 1, 1), 1), (date(2019, 1, 2), 2)], "stat_date date, v int")
    for _ in range(2):
        writers.write_snapshot(df, path, ["stat_date"])
    writers.replace_in_serving_store(df.filter("v = 2").withColumn("v", F.lit(5)), path, ["stat_date"])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 5]
    writers.append_snapshot(df.filter("v = 1"), path, ["stat_date"])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 1, 5]


def test_delimited_export(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.export_delimited(spark.createDataFrame([("a", None, 1.5)], "x string, y string, z double"), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines == ["a\u0001\\N\u00011.5"]


def test_manifest_counts_rows(spark):
    df = spark.createDataFrame([(DAY, 1), (date(2019, 1, 1), 2)], "stat_date date, v int")
    rows = manifest.publish_manifest({"one": df, "none": df.limit(0)}, DAY).collect()
    assert {(r.table_name, r.available, r.row_num) for r in rows} == {("one", "1", 1), ("none", "1", 0)}


def test_times_that_arrive_as_text_count_where_they_are_usable(spark):
    rows = [("a", "WAIT", "2019-06-01 10:00:00", "2019-06-02 10:00:00", None), ("b", "WAIT", "2019-06-01 10:00:00", "NULL", "0000-00-00 00:00:00"), ("c", "TRADE_FINISHED", "2019-06-01 10:00:00", "", "2019-06-03 00:00:00"), ("d", "TRADE_FINISHED", "soon", None, None)]
    orders = spark.createDataFrame([(*r, "active") for r in rows], "tid string, status string, created string, pay_time string, end_time string, part string")
    found = {r.tid: (r.created, r.pay_time, r.end_time) for r in audience.recent_orders(orders, DAY).collect()}
    assert found == {"a": (at("2019-06-01 10:00:00"), at("2019-06-02 10:00:00"), None), "c": (at("2019-06-01 10:00:00"), None, at("2019-06-03"))}
