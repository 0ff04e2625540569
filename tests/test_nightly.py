from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from patronage.functions.calendar import month_ends
from patronage.operators import rfm_wide
from patronage.plans import nightly, reports
from patronage.sinks import manifest
from patronage.sinks.versions import VersionedTable, days
from patronage.sources import cleaning
from patronage.sources.testtables import COMMERCE_DAY, Tables
from rows import at, same

SCHEMA = (
    "plat_code string, shop_id string, uni_shop_id string, uni_id string, trade_id long, payment double, refund_fee double, "
    "product_num int, trade_type string, created timestamp_ntz, pay_time timestamp_ntz, order_status string, arrived timestamp_ntz"
)


SHOPS = "tenant string, plat_code string, shop_id string, uni_shop_id string, shop_name string"
KNOWN = "tenant string, plat_code string, uni_shop_id string, uni_id string, modified timestamp_ntz"


def nights(monkeypatch, store, raw, shops, known, *days_):
    """Nights of which the last one publishes its reports."""
    with monkeypatch.context() as patch:
        patch.setattr(nightly, "publish", lambda *_: None)
        for day in days_[:-1]:
            nightly.nightly(store, raw, shops, known, day)
    nightly.nightly(store, raw, shops, known, days_[-1])


def test_moved_retimed_and_cancelled_trades_leave_their_old_place(spark, tmp_path, monkeypatch):
    """Nights with a pre-sale order paid in the next month, a cancelled one, one with a new holder, and no repeat customer."""
    rows = [
        ("a", 1, 10.0, "step", "2019-05-10", None, "TRADE_PAID", "2019-05-10"),
        ("b", 2, 20.0, "fixed", "2019-05-11", None, "TRADE_PAID", "2019-05-11"),
        ("c", 3, 30.0, "fixed", "2019-05-12", None, "TRADE_PAID", "2019-05-12"),
        ("a", 1, 10.0, "step", "2019-05-10", "2019-06-01", "TRADE_PAID", "2019-06-02"),  # paid in the next month
        ("b", 2, 20.0, "fixed", "2019-05-11", None, "TRADE_CLOSED", "2019-06-02"),  # cancelled
        ("d", 3, 30.0, "fixed", "2019-05-12", None, "TRADE_PAID", "2019-06-02"),  # another holder
    ]
    raw = spark.createDataFrame(
        [("P", "1", "P|1", c, i, p, None, 1, kind, at(t), at(paid) if paid else None, status, at(seen)) for c, i, p, kind, t, paid, status, seen in rows], SCHEMA
    )
    shops = spark.createDataFrame([("T", "P", "1", "P|1", "one")], SHOPS)
    known = spark.createDataFrame([("T", "P", "P|1", c, at("2016-01-01")) for c in "abcd"], KNOWN)
    store = nightly.Store(spark, str(tmp_path / "store"))
    nightly.init_history(store, raw.filter(F.col("arrived") < F.lit(date(2019, 6, 1))), shops, known, date(2019, 5, 31))
    nights(monkeypatch, store, raw, shops, known, date(2019, 6, 1), date(2019, 6, 2), date(2019, 6, 2))
    day = date(2019, 6, 2)
    latest = cleaning.clean_trades(raw.filter(F.col("arrived") >= F.lit(day)), shops)
    same(store.snapshot("shop_rfm", day), rfm_wide.shop_rfm(known, latest, day))
    same(store.snapshot("shop_rfm", *month_ends(day)), rfm_wide.month_end_rfm(known, latest, month_ends(day)))
    assert sorted((r.trade_id, r.uni_id) for r in store.read("trades").collect()) == [(1, "a"), (3, "d")]
    notes = store.read("reports/notify").filter(F.col("stat_date") == F.lit(day))
    assert notes.count() == 9  # what can be built without items and members


def test_two_nights_equal_a_full_load_and_run_again(spark, tmp_path, monkeypatch):
    rows = [
        ("a", 1, 10.0, "2017-01-05", "2017-01-05"),
        ("a", 2, 20.0, "2018-05-30", "2018-05-30"),
        ("b", 3, 30.0, "2019-05-01", "2019-05-01"),
        ("b", 4, 40.0, "2019-05-30", "2019-05-30"),
        ("c", 5, 50.0, "2019-05-31", "2019-05-31"),
        ("a", 6, 60.0, "2018-12-24", "2019-05-31"),  # late
        ("b", 4, 4.0, "2019-05-30", "2019-06-01"),  # delivered again with another amount
        ("d", 7, 70.0, "2019-06-01", "2019-06-01"),
    ]
    raw = spark.createDataFrame(
        [("P", "1", "P|1", c, i, p, None, 1, "fixed", at(t), None, "TRADE_PAID", at(seen)) for c, i, p, t, seen in rows], SCHEMA
    )
    shops = spark.createDataFrame([("T", "P", "1", "P|1", "one")], "tenant string, plat_code string, shop_id string, uni_shop_id string, shop_name string")
    known = spark.createDataFrame([("T", "P", "P|1", c, at("2016-01-01")) for c in "abcdx"], "tenant string, plat_code string, uni_shop_id string, uni_id string, modified timestamp_ntz")
    store = nightly.Store(spark, str(tmp_path / "store"))
    first = raw.filter(F.col("arrived") < F.lit(date(2019, 5, 31)))
    nightly.init_history(store, first, shops, known, date(2019, 5, 30))
    nights(monkeypatch, store, raw, shops, known, date(2019, 5, 31), date(2019, 6, 1), date(2019, 6, 1))
    latest = cleaning.clean_trades(raw.filter("not (trade_id = 4 and payment = 40)"), shops)
    day = date(2019, 6, 1)
    today = rfm_wide.shop_rfm(known, latest, day)
    same(store.snapshot("shop_rfm", day), today)
    ends = month_ends(day)
    past = rfm_wide.month_end_rfm(known, latest, ends)
    # The last month end was itself a nightly snapshot before; all others come from the first load.
    same(store.snapshot("shop_rfm", *ends), past)
    same(store.snapshot("wide", day), rfm_wide.all_levels(today))
    assert store.read("trades").count() == 7
    notes = {r.table_name: r.row_num for r in store.read("reports/notify").filter(F.col("stat_date") == F.lit(day)).collect()}
    assert len(notes) == 9 and notes["cix_online_customer_assets_view"] == 3


NAMES = {name for family in manifest.REPORTS.values() for name in family}
FURTHER = ("order_item", "product", "category", "member", "card_shop", "customer_member", "point_change", "effective_point", "grade_change")


def files(table):
    """Data files that the table's readers see, by slice."""
    return {tuple(sorted(s["values"].items())): s["folder"] for s in table.pointer()["slices"]}


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    """A night over the test tables, after a first load."""
    t = Tables(spark, "/root/testdata/sf0.001")
    store = nightly.Store(spark, str(tmp_path_factory.mktemp("store")))
    day, tables = COMMERCE_DAY, {name: getattr(t, name) for name in FURTHER}
    start = day - timedelta(days=1)
    nightly.init_history(store, t.trade.filter(F.col("arrived") < F.lit(day)), t.tenant_shop, t.customers_by(start), start)
    nightly.nightly(store, t.trade, t.tenant_shop, t.customers_by(day), day, tables, category_share=0.25)
    return t, store, tables


def test_a_night_announces_all_reports(chain):
    t, store, _ = chain
    notes = {r.table_name: r.row_num for r in store.read("reports/notify", days([COMMERCE_DAY])).collect()}
    assert set(notes) == NAMES and len(NAMES) == 22
    assert all(n > 0 for name, n in notes.items() if "category" not in name)  # few shops here dominate a category
    stages = {r.name for r in reports.registry() if not r.published}
    assert stages == {"category_shops", "offline_trades"}


def test_stored_rows_equal_a_full_load(chain):
    t, store, _ = chain
    arrived = cleaning.clean_trades(t.trade.filter(F.col("arrived") < F.lit(COMMERCE_DAY + timedelta(days=1))), t.tenant_shop)
    today = rfm_wide.shop_rfm(t.customers_by(COMMERCE_DAY), arrived, COMMERCE_DAY)
    same(store.snapshot("shop_rfm", COMMERCE_DAY), today)
    same(store.snapshot("wide", COMMERCE_DAY), rfm_wide.all_levels(today))
    same(store.read("trades").select(*cleaning.CLEAN), arrived.select(*cleaning.CLEAN))


def test_a_failed_report_leaves_the_manifest_unwritten(chain, monkeypatch):
    t, store, tables = chain
    day = COMMERCE_DAY + timedelta(days=1)
    store.table("shop_rfm").commit(store.snapshot("shop_rfm", COMMERCE_DAY).withColumn("stat_date", F.lit(day)), days([day]))
    nightly.write_levels(store, days([day]))
    sources = {"trade": t.trade, "tenant_shop": t.tenant_shop, **tables}

    def broken(*_):
        raise RuntimeError("broken")

    few = [r for r in reports.registry() if r.name in ("cix_online_card_store_point", "cix_online_point_store_trend", "cix_online_customer_retention_analyze")]
    monkeypatch.setattr(nightly, "registry", lambda *_: [r if "store_point" not in r.name else reports.Report(r.name, r.needs, broken) for r in few])
    with pytest.raises(RuntimeError):
        nightly.publish(store, sources, day, days([day]))
    assert store.read("reports/notify", days([day])).count() == 0
    monkeypatch.setattr(nightly, "registry", lambda *_: few)
    nightly.publish(store, sources, day, days([day]))
    assert store.read("reports/notify", days([day])).count() == 3


def test_reports_come_after_what_they_need():
    order = [r.name for r in reports.in_order(reports.registry()[::-1], {"trade", "tenant_shop", *FURTHER, *nightly.STORED})]
    assert set(order) >= NAMES
    for r in reports.registry():
        assert all(order.index(n) < order.index(r.name) for n in r.needs if n in order)
    assert {r.name for r in reports.in_order(reports.registry(), {"wide"})} == {*manifest.REPORTS["segmentation"]}


def test_one_tenant_is_recomputed_without_touching_others(chain):
    t, store, tables = chain
    day, tenant = COMMERCE_DAY, "T1"
    names = ["trades", "shop_rfm", "wide", *(f"reports/{r.name}" for r in reports.registry() if r.history)]
    open_ = lambda n: store.table(n, nightly.SLICES.get(n, ("stat_date", "tenant")))
    before = {n: files(open_(n)) for n in names}
    nightly.recompute_tenant(store, tenant, t.trade.filter(F.col("arrived") < F.lit(day + timedelta(days=1))), t.tenant_shop, t.customers_by(day), day, tables)
    for n in names:
        after = files(open_(n))
        mine = {k for k in after if ("tenant", tenant) in k}
        assert mine and {k: v for k, v in after.items() if k not in mine} == {k: v for k, v in before[n].items() if ("tenant", tenant) not in k}
        recomputed = {k for k in mine if n == "trades" or dict(k)["stat_date"] in {str(d) for d in (day, *month_ends(day))}}
        assert all(after[k] != before[n].get(k) for k in recomputed)
    own = cleaning.valid_trades(t.trade.filter(F.col("arrived") < F.lit(day + timedelta(days=1))), t.tenant_shop, day).filter(F.col("tenant") == tenant)
    expected = rfm_wide.recompute_tenant(t.customers_by(day), own, tenant, day)
    same(store.read("wide", days([day, *month_ends(day)], [tenant])), expected)


def test_a_new_tenant_joins_the_store(spark, tmp_path):
    raw = spark.createDataFrame(
        [(p, "1", f"{p}|1", "c", i, 5.0, None, 1, "fixed", at(t), None, "TRADE_PAID", at(t)) for i, (p, t) in enumerate([("P", "2019-03-05"), ("P", "2018-07-01"), ("Q", "2017-05-06"), ("Q", "2019-05-06")])], SCHEMA
    )
    shops = spark.createDataFrame([("T", "P", "1", "P|1", "one"), ("N", "Q", "1", "Q|1", "two")], SHOPS)
    known = spark.createDataFrame([("T", "P", "P|1", "c", at("2016-01-01")), ("N", "Q", "Q|1", "c", at("2016-01-01"))], KNOWN)
    store, day = nightly.Store(spark, str(tmp_path / "store")), date(2019, 6, 2)
    nightly.init_history(store, raw, shops.filter("tenant = 'T'"), known.filter("tenant = 'T'"), day)
    before = files(store.table("wide"))
    nightly.recompute_tenant(store, "N", raw, shops, known, day)
    after = files(store.table("wide"))
    assert {k: v for k, v in after.items() if ("tenant", "N") not in k} == before and len(after) == 2 * len(before)
    valid = cleaning.valid_trades(raw, shops, day)
    same(store.snapshot("wide", day), rfm_wide.all_levels(rfm_wide.shop_rfm(known, valid, day)))
    same(store.snapshot("wide", *month_ends(day)), rfm_wide.month_end_history(known, valid, day))


def night_store(spark, folder, raw, tenants=("T",)):
    shops = spark.createDataFrame([(t, "P", str(k), f"P|{k}", t) for k, t in enumerate(tenants, 1)], SHOPS)
    known = spark.createDataFrame([(t, "P", f"P|{k}", c, at("2016-01-01")) for k, t in enumerate(tenants, 1) for c in "abcx"], KNOWN)
    return nightly.Store(spark, str(folder / "store")), shops, known


def test_a_late_trade_rewrites_only_the_month_ends_behind_it(spark, tmp_path, monkeypatch):
    """Also not those of other tenants; a redelivery without a change rewrites none."""
    rows = [
        ("1", "a", 1, 10.0, "2018-01-05", "2018-01-05"),
        ("1", "b", 2, 20.0, "2019-05-20", "2019-05-20"),
        ("2", "c", 3, 30.0, "2019-01-12", "2019-01-12"),
        ("1", "a", 4, 40.0, "2019-05-12", "2019-06-03"),  # late by one month end
        ("2", "c", 3, 30.0, "2019-01-12", "2019-06-03"),  # again, the same
        ("1", "b", 2, 25.0, "2019-05-20", "2019-06-04"),  # again, another amount
        ("2", "a", 5, 50.0, "2019-04-30", "2019-06-04"),  # late by two month ends
    ]
    raw = spark.createDataFrame([("P", s, f"P|{s}", c, i, p, None, 1, "fixed", at(t), None, "TRADE_PAID", at(seen)) for s, c, i, p, t, seen in rows], SCHEMA)
    store, shops, known = night_store(spark, tmp_path, raw, ("T", "U"))
    nightly.init_history(store, raw.filter(F.col("arrived") < F.lit(date(2019, 6, 3))), shops, known, date(2019, 6, 2))
    written = []
    monkeypatch.setattr(nightly, "publish", lambda store, sources, day, scope, share: written.append(scope))
    for day in (date(2019, 6, 3), date(2019, 6, 4)):
        before = files(store.table("shop_rfm"))
        nightly.nightly(store, raw, shops, known, day)
        after = files(store.table("shop_rfm"))
        changed = {(dict(k)["stat_date"], dict(k)["tenant"]) for k in after if after[k] != before.get(k)} - {(str(day), t) for t in "TU"}
        assert changed == {(str(s["stat_date"]), s["tenant"]) for s in written[-1] if "tenant" in s}
        assert changed == ({("2019-05-31", "T")} if day.day == 3 else {("2019-05-31", "T"), ("2019-05-31", "U"), ("2019-04-30", "U")})
    day = date(2019, 6, 4)
    latest = cleaning.clean_trades(raw.filter("not (trade_id = 2 and payment = 20) and not (trade_id = 3 and arrived < '2019-06-01')"), shops)
    same(store.snapshot("shop_rfm", day), rfm_wide.shop_rfm(known, latest, day))
    same(store.snapshot("shop_rfm", *month_ends(day)), rfm_wide.month_end_rfm(known, latest, month_ends(day)))


def test_a_second_run_after_a_crash_gives_the_same_rows(spark, tmp_path, monkeypatch):
    """The first run dies behind the trades' replacement, or before it; a new trade, a moved and a cancelled one are in it."""
    rows = [
        ("a", 1, 10.0, "2019-05-10", "TRADE_PAID", "2019-05-10"),
        ("b", 2, 20.0, "2019-05-11", "TRADE_PAID", "2019-05-11"),
        ("c", 1, 10.0, "2019-05-10", "TRADE_PAID", "2019-06-01"),  # another holder
        ("b", 2, 20.0, "2019-05-11", "TRADE_CLOSED", "2019-06-01"),  # cancelled
        ("x", 3, 30.0, "2019-06-01", "TRADE_PAID", "2019-06-01"),
    ]
    raw = spark.createDataFrame([("P", "1", "P|1", c, i, p, None, 1, "fixed", at(t), None, status, at(seen)) for c, i, p, t, status, seen in rows], SCHEMA)
    day = date(2019, 6, 1)
    monkeypatch.setattr(nightly, "publish", lambda *_: None)
    for step in ("replace_trades", "patch_history"):
        store, shops, known = night_store(spark, tmp_path / step, raw)
        nightly.init_history(store, raw.filter(F.col("arrived") < F.lit(day)), shops, known, date(2019, 5, 31))

        def dies(*_):
            raise RuntimeError("lost")

        with monkeypatch.context() as patch, pytest.raises(RuntimeError):
            patch.setattr(nightly, step, dies)
            nightly.nightly(store, raw, shops, known, day)
        nightly.nightly(store, raw, shops, known, day)
        latest = cleaning.clean_trades(raw.filter(F.col("arrived") >= F.lit(day)), shops)
        same(store.snapshot("shop_rfm", day), rfm_wide.shop_rfm(known, latest, day))
        same(store.snapshot("shop_rfm", *month_ends(day)), rfm_wide.month_end_rfm(known, latest, month_ends(day)))
        same(store.read("trades").select(*cleaning.CLEAN), latest.select(*cleaning.CLEAN))


def test_a_night_reads_few_months_of_trades(chain, monkeypatch):
    """The daily step opens the months that leave a window and those of the year; old versions come from their months."""
    t, store, _ = chain
    read, scopes = nightly.Store.read, []
    monkeypatch.setattr(nightly.Store, "read", lambda self, name, scope=None: scopes.append((name, scope)) or read(self, name, scope))
    nightly.today(store, t.customers_by(COMMERCE_DAY), COMMERCE_DAY)
    months = {e.get("part") for name, scope in scopes if name == "trades" for e in scope if "part" in e}
    assert months <= {*(f"2000-{m:02d}" for m in range(6, 13)), *(f"2001-{m:02d}" for m in range(1, 7)), "1999-06", "1999-07"}
    files_read = store.read("trades", [{"part": "2001-05"}]).inputFiles()
    assert files_read and all("/part=2001-05/" in f for f in files_read)


def test_an_empty_commit_clears_a_slice_and_an_interrupted_one_changes_nothing(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"), ("stat_date", "tenant"))
    rows = lambda *r: spark.createDataFrame(r, "value int, stat_date date, tenant string")
    d, e = date(2019, 1, 31), date(2019, 2, 28)
    table.commit(rows((1, d, "T/1 é=%"), (2, d, "U"), (3, e, "U")), days([d, e]))
    same(table.read(days([d], ["T/1 é=%"])), rows((1, d, "T/1 é=%")))
    table.commit(rows(), days([d], ["U"]))
    same(table.read(), rows((1, d, "T/1 é=%"), (3, e, "U")))
    table.commit(table.read(days([e])).withColumn("value", F.col("value") + 1), days([e]))  # reads what it replaces
    with pytest.raises(ValueError):
        table.commit(rows((9, e, "V")), days([d]))

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(VersionedTable, "_point", lost)
    with pytest.raises(RuntimeError):
        table.commit(rows((7, d, "U")), [{}])
    monkeypatch.undo()
    same(table.read(), rows((1, d, "T/1 é=%"), (4, e, "U")))
    assert len(list((tmp_path / "t").glob("_version=*"))) == 5
    table.clean(keep=1)
    assert len(list((tmp_path / "t").glob("_version=*"))) == 2 and table.read().count() == 2
    table.commit(rows((5, None, None)), [{"stat_date": None}])
    assert table.read([{"stat_date": None}]).collect()[0].value == 5
