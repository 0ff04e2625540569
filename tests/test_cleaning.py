from datetime import date

import pytest
from pyspark.sql import functions as F

from patronage.functions.buckets import monetary_bucket, point_bucket
from patronage.functions.expressions import valid_timestamp
from patronage.sources import cleaning
from rows import at

SCHEMA = (
    "plat_code string, shop_id string, uni_shop_id string, uni_id string, trade_id long, payment double, refund_fee string, "
    "product_num int, trade_type string, created timestamp_ntz, pay_time timestamp_ntz, order_status string"
)
DAY = date(2019, 6, 30)


def row(trade_id, refund=None, kind="fixed", created="2019-06-01", paid=None, status="TRADE_PAID", num=2, payment=10.0, uni="c", shop="1"):
    return ("P", shop, f"P|{shop}", uni, trade_id, payment, refund, num, kind, at(created), at(paid) if paid else None, status)


@pytest.fixture
def shops(spark):
    return spark.createDataFrame([("T", "P", "1")], "tenant string, plat_code string, shop_id string")


def clean(spark, shops, *rows):
    df = cleaning.valid_trades(spark.createDataFrame(list(rows), SCHEMA), shops, DAY)
    return {r.trade_id: r for r in df.collect()}


def test_refund_tokens_and_full_refund(spark, shops):
    got = clean(spark, shops, row(1), row(2, "NULL"), row(3, "null"), row(4, ""), row(5, "10.0"), row(6, "2.5"))
    assert [got[i].receive_payment for i in range(1, 7)] == [10, 10, 10, 10, 0, 7.5]


def test_items_default_to_one(spark, shops):
    assert clean(spark, shops, row(1, num=None))[1].product_num == 1


def test_presale_orders_count_from_payment(spark, shops):
    got = clean(spark, shops, row(1, kind="STEP", paid="2019-06-05"), row(2, kind="step"), row(3, paid="2019-06-05"))
    assert got[1].created == at("2019-06-05") and got[2].created == got[3].created == at("2019-06-01")


def test_rows_that_do_not_count(spark, shops):
    rows = [
        row(1, status="TRADE_CLOSED"),
        row(2, created="2019-07-01"),
        row(3, uni=None),
        row(4, payment=None),
        row(5, shop="9"),
        row(6, created="2019-06-30 23:59:59"),
    ]
    assert set(clean(spark, shops, *rows)) == {6}


def test_boundary_days(trades):
    df = trades([("P|1", "c", 1, 1, "2018-06-30 12:00:00"), ("P|1", "c", 2, 1, "2018-07-01"), ("P|1", "c", 3, 1, "2017-06-30"), ("P|1", "c", 1, 1, "2018-06-30 12:00:00")])
    assert [r.trade_id for r in cleaning.boundary_day_trades(df, DAY, 12).collect()] == [1]
    assert [r.trade_id for r in cleaning.boundary_day_trades(df, DAY, 24).collect()] == [3]


def test_versions(trades):
    base = trades([("P|1", "c", 1, 5, "2019-01-01"), ("P|1", "c", 2, 5, "2019-01-02")])
    delta = trades([("P|1", "c", 2, 3, "2019-01-02"), ("P|1", "d", 3, 9, "2019-01-03")])
    got = {r.trade_id: r.receive_payment for r in cleaning.latest_versions(base, delta).collect()}
    assert got == {1: 5, 2: 3, 3: 9}
    assert [r.trade_id for r in cleaning.unseen_trades(delta, base).collect()] == [3]


def test_self_opens_are_dropped(spark):
    rows = [("a", "b", "OPEN_SHARE"), ("a", "a", "OPEN_SHARE"), ("a", None, "OPEN_SHARE"), ("a", "b", "READ")]
    df = spark.createDataFrame(rows, "user_id string, relate_userid string, action string").withColumn("action_time", F.lit(at("2019-06-01")))
    assert cleaning.actions_since(df, DAY, action="OPEN_SHARE").count() == 1
    assert cleaning.actions_since(df, DAY).count() == 4
    assert cleaning.actions_since(df, date(2019, 9, 1)).count() == 0


def test_usable_times(spark):
    texts = ["2019-06-01 10:00:00", "NULL", None, "2019-13-01 10:00:00", "2019-06-01", "2019-06-01 10:00:00.5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(valid_timestamp(F.col("t"))).collect()] == [True, False, False, False, False, True]


def test_buckets_agree_with_chained_limits(spark):
    values = sorted({round(float(w * k + d), 2) for w in (50, 100, 500) for k in range(-1, 13) for d in (-0.01, 0, 0.01)})
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for w in (50, 100, 500):
        got = df.select("v", monetary_bucket(F.col("v"), F.lit(w)).alias("m"), point_bucket(F.col("v"), F.lit(w)).alias("p")).collect()
        for r in got:
            assert r.m == next((i for i in range(1, 11) if r.v <= w * i), 11)
            assert r.p == (1 if r.v <= 0 else next((i + 1 for i in range(1, 11) if r.v <= w * i), 12))
