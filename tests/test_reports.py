from datetime import date

from pyspark.sql import functions as F

from patronage.constants import CUSTOMER_KEYS
from patronage.functions.calendar import month_ends
from patronage.operators import assets, category, conversion, life_cycle, offline, points, rfm_wide, sales, segmentation
from rows import at, same

DAY = date(2019, 6, 30)


def wide_of(trades, customers, rows, more=()):
    df = trades(rows)
    known = customers({(r[0], r[1]) for r in rows} | set(more))
    return rfm_wide.all_levels(rfm_wide.shop_rfm(known, df, DAY))


ROWS = [
    ("P|1", "a", 1, 60, "2019-06-01"),
    ("P|1", "a", 2, 40, "2019-06-20"),
    ("P|2", "a", 3, 10, "2018-06-30"),
    ("P|1", "b", 4, 30, "2018-07-01"),
    ("Q|1", "b", 5, 30, "2017-01-01"),
    ("Q|1", "d", 6, 30, "2018-01-01"),
]


def test_life_stages_and_rates(spark, trades, customers):
    wide = wide_of(trades, customers, ROWS, {("P|1", "x")})
    shops = spark.createDataFrame([("T", "P", "P|1", "one"), ("T", "Q", "Q|1", "two")], "tenant string, plat_code string, uni_shop_id string, shop_name string")
    view = {(r.type, r.plat_code, r.uni_shop_id): r for r in assets.assets_view(wide, shops).collect()}
    tenant = view[(1, None, None)]
    assert (tenant.prospective_num, tenant.active_num, tenant.silent_num, tenant.loss_num, tenant.whole_num) == (1, 2, 1, 0, 4)
    assert view[(3, "Q", "Q|1")].shop_name == "two" and view[(3, "Q", "Q|1")].end_month == 1
    assert (3, "P", "P|2") not in view  # unknown shop
    rates = {(r.type, r.plat_code, r.uni_shop_id): r for r in assets.repurchase_view(wide, shops).collect()}
    top = rates[(1, None, None)]
    # a first bought on d - 12 months and is an old customer; b first bought long ago on the other platform.
    assert (top.active, top.repurchase, top.active_new, top.active_old, top.new_rate) == (2, 1, 0, 2, -1)
    assert rates[(2, "P", None)].active_new == 1
    assert rates[(3, "Q", "Q|1")].rate == -1
    kept = {(r.type, r.plat_code): r for r in assets.retention_view(wide, shops).collect() if r.type < 3}
    assert (kept[(1, None)].prev_year_num, kept[(1, None)].last_year_num) == (2, 1)


def test_matrix_totals_and_null_bucket(trades, customers):
    wide = wide_of(trades, customers, ROWS + [("P|1", "e", 9, 5, "2018-07-05")])
    rf = segmentation.rf_share(segmentation.rf_matrix(wide)).filter("type = 1")
    cells = {(r.recency, r.frequency): r for r in rf.collect()}
    total = cells[(99, 99)]
    inner = [r for k, r in cells.items() if 99 not in k]
    assert total.customer_num == sum(r.customer_num for r in inner) == 3
    assert total.customer_rate == 1 and abs(sum(r.customer_rate for r in inner) - 1) < 1e-9
    assert sum(r.customer_num for k, r in cells.items() if k[0] == 99 and k[1] != 99) == 3
    leap = wide.withColumn("stat_date", F.date_add("stat_date", 2))
    shifted = {(r.recency, r.frequency): r.customer_num for r in segmentation.rf_matrix(leap).filter("type = 1").collect()}
    assert shifted[(None, 99)] == 1 and shifted[(99, 99)] == 3
    rm = segmentation.rm_matrix(wide).filter("type = 1 and recency = 99 and monetary = 99")
    assert rm.count() == 6 and {r.customer_num for r in rm.collect()} == {3}


def test_intervals(trades, customers):
    rows = [("P|1", "a", i, 1, t) for i, t in enumerate(["2019-01-01", "2019-01-04", "2019-01-12"])]
    wide = wide_of(trades, customers, rows).filter("type = 3")
    got = {r.customer_type: r.interval_days for r in segmentation.purchase_interval(wide).collect()}
    assert got == {1: 6, 2: 3}


def test_sales_structure(trades, customers):
    df = trades(ROWS)
    wide = wide_of(trades, customers, ROWS)
    cp = sales.customer_period_rollup(sales.customer_period(df, "month"))
    marked = sales.with_kind(cp, wide, "month")
    rows = {(r.type, r.plat_code, r.date_col): r for r in sales.sales_structure(marked, "month").filter("type < 3").collect()}
    june = rows[(2, "P", "2019-06")]
    assert (june.cus_num, june.payments, june.new_cus_num, june.old_cus_num, june.old_repeat_num) == (1, 100, 0, 1, 1)
    assert (june.old_muti_price, june.old_one_price, june.old_payments_rate) == (100, 0, 1)
    first = rows[(1, None, "2017-01")]
    assert (first.new_cus_num, first.new_one_price, first.new_rate) == (1, 30, 1)
    assert sales.period_kpi(cp).count() == sales.sales_structure(marked, "month").count()


PLANS = [("CP", "P", "1"), ("CP", "P", "2"), ("CP", "Q", "1"), ("OTHER", "P", "1")]


def members(spark, rows):
    base = spark.createDataFrame(
        [("CP", m, "P", "P|1", "1", g, at(t)) for m, g, t in rows],
        "card_plan_id string, member_id string, plat_code string, uni_shop_id string, shop_id string, grade int, created timestamp_ntz",
    )
    relation = base.select("card_plan_id", "member_id", F.col("member_id").alias("uni_id"))
    shops = spark.createDataFrame(PLANS, "card_plan_id string, plat_code string, shop_id string")
    return base, shops, relation


def test_conversion_counts_members_once(spark, trades, customers):
    wide = wide_of(trades, customers, ROWS)
    base, shops, relation = members(spark, [("a", 2, "2019-05-01"), ("b", 1, "2019-04-01"), ("d", 1, "2018-04-30")])
    shop = wide.filter("type = 3")
    report = conversion.consume_transform(conversion.member_year_value(shop, base, shops, relation))
    rows = {(r.type, r.plat_code, r.uni_shop_id, r.join_month): r for r in report.collect()}
    assert rows[(1, None, None, "all")].members == 2  # d joined on d - 14 months
    assert (rows[(1, None, None, "2019-05")].f2, rows[(1, None, None, "2019-05")].payments) == (1, 100)
    assert rows[(2, "P", None, "all")].members == 2 and rows[(3, "P", "P|2", "all")].f0 == 1
    tenant = rows[(1, None, None, "all")]
    assert sum(tenant[f"f{i}"] for i in range(6)) == tenant.members


def test_life_cycle_rows(spark, trades, customers):
    wide = wide_of(trades, customers, ROWS, {("P|1", "x")})
    base, shops, relation = members(spark, [("a", 2, "2019-05-01"), ("b", 1, "2019-07-01")])
    report = life_cycle.life_cycle_report(wide, shops, base, relation)
    rows = {(r.type, r.uni_shop_id, r.card_plan_id, r.grade): r for r in report.filter("type != 2").collect()}
    # P|1 belongs to two plans; its customers are counted once. b joins after the day.
    assert rows[(3, "P|1", "CP", 99)].whole == 3
    assert rows[(3, "P|1", "CP", 98)].whole == rows[(3, "P|1", "CP", 2)].whole == 1
    assert rows[(3, "P|1", "CP", -1)].whole == 2
    assert rows[(3, "Q|1", None, 99)].whole == rows[(3, "Q|1", None, -1)].whole == 2
    assert rows[(1, None, "CP", 99)].whole == 4 and rows[(1, None, "CP", -1)].whole == 3
    assert rows[(1, None, "CP", 2)].phurce_old == 1


def test_eligible_shops_need_both_keys(spark):
    rows = [(p, "S", i, 600.0, at(f"{2017 + (6 + i) // 12}-{(6 + i) % 12 + 1:02d}-15")) for p in ("P", "Q") for i in range(24 if p == "P" else 23)]
    df = spark.createDataFrame(rows, "plat_code string, uni_shop_id string, trade_id long, payment double, created timestamp_ntz")
    df = df.withColumn("month", F.date_format("created", "yyyy-MM"))
    assert [(r.plat_code, r.month_num) for r in category.eligible_shops(df, DAY, min_amount=7200).collect()] == [("P", 24)]
    assert category.eligible_shops(df, DAY).count() == 0


def test_top_groups(spark):
    rows = [("P", f"s{i}", c, float(100 - i)) for c, n in (("x", 6), ("y", 4)) for i in range(n)]
    scp = spark.createDataFrame(rows, "plat_code string, uni_shop_id string, parent_category_id string, total_payment double")
    top = category.top_n_shops(scp, scp)
    assert top.count() == 9
    full = category.complete_groups(top)
    assert {r.parent_category_id for r in full.collect()} == {"x"} and full.count() == 5


def test_point_report_has_empty_cells(spark):
    base, _, _ = members(spark, [("a", 1, "2019-06-30"), ("b", 2, "2018-01-01")])
    changes = spark.createDataFrame([("CP", "a", 5, at("2019-06-29 10:00:00")), ("CP", "a", -3, at("2019-06-30"))], "card_plan_id string, member_id string, change_value long, change_time timestamp_ntz")
    stock = spark.createDataFrame([("CP", "a", 9, at("2019-06-30"), at("2019-07-01"), 1), ("CP", "a", 7, at("2019-01-01"), at("2019-06-30"), 0)], "card_plan_id string, member_id string, point long, effective_date timestamp_ntz, overdue_date timestamp_ntz, valid int")
    log = spark.createDataFrame([("CP", "b", "UP", 1, at("2019-06-29"), 1), ("CP", "b", "DOWN", 3, at("2019-06-30"), 2)], "card_plan_id string, member_id string, change_type string, grade_before_change int, change_time timestamp_ntz, change_id long")
    rows = {r.rangetype: r for r in points.point_grade_report(base, changes, stock, log, DAY).collect()}
    assert len(rows) == 5
    assert (rows[1].send_points, rows[1].consume_points, rows[1].point_change_nums) == (5, 3, 1)
    assert (rows[1].effect_points, rows[1].overdue_points, rows[1].newmembers) == (9, 7, 1)
    assert (rows[1].upnums, rows[1].downnums) == (0, 1)
    matrix = {(r.nowgrade, r.oldgrade): r.members for r in points.grade_matrix(base, log, DAY, periods=[1]).collect()}
    assert matrix == {(1, -1): 1, (2, 1): 1, (1, 99): 1, (2, 99): 1, (99, -1): 1, (99, 1): 1, (99, 99): 2}


def test_store_shares(spark):
    cols = "card_plan_id string, plat_code string, shop_id string, uni_shop_id string, member_id string, receive_payment double, created timestamp_ntz, grade int, open_shop_id string, open_plat string"
    rows = [
        ("CP", "P", "1", "P|1", "a", 60.0, at("2019-06-30 10:00:00"), 1, "1", "P"),
        ("CP", "P", "1", "P|1", "a", 20.0, at("2019-06-30 12:00:00"), 1, "1", "P"),
        ("CP", "P", "2", "P|2", "a", 20.0, at("2019-06-30"), 1, "1", "P"),
        ("CP", "P", "2", "P|2", "b", 10.0, at("2019-06-30"), 2, "3", "P"),
    ]
    mt = spark.createDataFrame(rows, cols)
    own = {(r.shop_id, r.date_type, r.grade): r for r in offline.open_shop_consumption(mt, DAY).collect()}
    assert (own[("1", 1, 99)].members, own[("1", 1, 99)].total_times, own[("1", 1, 99)].avg_price) == (1, 1, 80)
    base, _, _ = members(spark, [("a", 1, "2019-01-01")])
    shops = spark.createDataFrame([("T", "P", "1", "P|1", "one")], "tenant string, plat_code string, shop_id string, uni_shop_id string, shop_name string")
    report = offline.consumption_report(offline.member_stock(base, shops, DAY), offline.open_shop_consumption(mt, DAY), offline.all_shop_consumption(mt, DAY), DAY)
    assert {r.payment_rate for r in report.collect()} == {0.8}
    stock = offline.member_stock(base, shops, DAY)
    empty = offline.consumption_report(stock, offline.open_shop_consumption(mt.limit(0), DAY), offline.all_shop_consumption(mt.limit(0), DAY), DAY)
    assert {(r.payment_rate, r.date_type) for r in empty.collect()} == {(-1.0, None)}


def test_first_purchases_meet_periods_without_a_join(trades, customers):
    df = trades(ROWS + [("P|2", "stranger", 9, 5, "2019-02-01")])
    wide = wide_of(trades, customers, ROWS)
    marked = sales.with_kind(sales.customer_period_rollup(sales.customer_period(df, "year")), wide, "year")
    kinds = {(r.type, r.uni_shop_id, r.uni_id, r.date_col): r.kind for r in marked.collect()}
    assert kinds[(3, "P|1", "a", "2019")] == "new" and kinds[(1, None, "a", "2019")] == "returning"
    assert kinds[(1, None, "stranger", "2019")] is None and kinds[(3, "P|2", "stranger", "2019")] is None
    assert len(kinds) == marked.count() == 3 * 6
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning(uni_id" in plan and "level_shop" not in "".join(l for l in plan.splitlines() if "Exchange" in l)


def test_cards_are_those_of_the_shops_below(spark, trades, customers):
    wide, shops, base, relation = cards_input(spark, trades, customers)
    held = life_cycle.customers_with_cards(wide, shops, base, relation)
    found = {(r.type, r.plat_code, r.uni_shop_id, r.uni_id): {(c.card_plan_id, c.member_id, c.grade) for c in r.cards} for r in held.collect()}
    assert len(found) == held.count()
    cp, other = ("CP", "a", 1), ("OTHER", "a2", 3)
    assert found[(3, "P", "P|1", "a")] == {cp, other} and found[(3, "P", "P|2", "a")] == {cp}
    assert found[(2, "P", None, "a")] == found[(1, None, None, "a")] == {cp, other}
    # Only the shop P|1 takes the other plan, and b is known there and on Q; the card of Q's own plan is of Q and above only.
    assert found[(2, "Q", None, "b")] == {("ONLY_Q", "b", 2)} and found[(2, "P", None, "b")] == set()
    assert found[(1, None, None, "b")] == {("ONLY_Q", "b", 2)}
    assert found[(1, None, None, "d")] == set()  # joined behind the snapshot
    assert (3, "Q", "Q|2", "e") not in found and found[(2, "Q", None, "e")] == set()  # a shop without a plan


def cards_input(spark, trades, customers):
    wide = wide_of(trades, customers, ROWS + [("Q|2", "e", 8, 5, "2019-01-01")])
    shops = spark.createDataFrame([*PLANS, ("ONLY_Q", "Q", "1")], "card_plan_id string, plat_code string, shop_id string")
    rows = [("CP", "a", 1, "2018-01-01"), ("OTHER", "a2", 3, "2018-01-01"), ("ONLY_Q", "b", 2, "2018-01-01"), ("CP", "d", 1, "2019-07-01"), ("CP", "e", 1, "2018-01-01")]
    base = spark.createDataFrame([(p, m, "P", "P|1", "1", g, at(t)) for p, m, g, t in rows], "card_plan_id string, member_id string, plat_code string, uni_shop_id string, shop_id string, grade int, created timestamp_ntz")
    relation = spark.createDataFrame([(p, m, m[0]) for p, m, _, _ in rows], "card_plan_id string, member_id string, uni_id string")
    return wide, shops, base, relation


def test_month_ends_carry_cards_like_their_wide_rows(spark, trades, customers):
    """The history puts cards beside customers before the days; a day gets those joined by then. Rows equal those of the wide table."""
    _, shops, base, relation = cards_input(spark, trades, customers)
    rows = ROWS + [("Q|2", "e", 8, 5, "2019-01-01")]
    df, known = trades(rows), customers(sorted({(s, c) for s, c, *_ in rows} | {("P|1", "d")}))
    days = month_ends(date(2019, 8, 15), 4)
    wide = rfm_wide.month_end_levels(known, df, days)
    report = life_cycle.life_cycle_history(known, df, days, shops, base, relation)
    same(report, life_cycle.life_cycle_report(wide, shops, base, relation))
    held = life_cycle.month_ends_with_cards(known, df, days, shops, base, relation)
    assert {(str(r.stat_date), len(r.cards)) for r in held.filter("uni_id = 'd' AND type = 3").collect()} == {("2019-07-31", 1), ("2019-06-30", 0), ("2019-05-31", 0), ("2019-04-30", 0)}
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(uni_id" in line and "stat_date" in line]
