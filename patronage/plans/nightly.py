"""The chains that maintain the stored tables and publish the reports.

Stored below one folder, each table in slices that are replaced as a whole (`patronage.sinks.versions`):

* `landed`: raw rows by day of arrival; each night's rows are written once and read by that night alone
* `trades`: clean trades by tenant, month of purchase and whether they are pre-sale orders
* `shop_rfm`, `wide`: wide rows of the shop level and of all levels, by snapshot and tenant
* `delta`, `delivered`, `replaced`, `changes`: what a night brought, by day of arrival
* `reports/<name>`: each report by snapshot, those with a history by tenant too

Every step replaces the slices it declares and may run again.
"""

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.constants import CUSTOMER_KEYS, SHOP
from patronage.functions.calendar import month_ends, until, windows
from patronage.operators import rfm_daily, rfm_late, rfm_wide
from patronage.plans.reports import Report, in_order, registry
from patronage.sinks import manifest
from patronage.sinks.versions import Scope, VersionedTable, days
from patronage.sources import cleaning

SLICES = {
    "landed": ("arrived_on",),
    "trades": ("tenant", "part", "presale"),
    "shop_rfm": ("stat_date", "tenant"),
    "wide": ("stat_date", "tenant"),
    "delta": ("arrived_on",),
    "delivered": ("arrived_on",),
    "replaced": ("arrived_on",),
    "changes": ("arrived_on",),
}


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def table(self, name: str, parts: tuple[str, ...] | None = None) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{name}", parts or SLICES[name])

    def report(self, report: Report) -> VersionedTable:
        return self.table(f"reports/{report.name}", ("stat_date", "tenant") if report.history else ("stat_date",))

    def read(self, name: str, scope: Scope | None = None) -> DataFrame:
        return self.table(name, SLICES.get(name, ("stat_date",))).read(scope)

    def snapshot(self, name: str, *snapshots: date) -> DataFrame:
        return self.read(name, days(snapshots))

    def night(self, name: str, day: date) -> DataFrame:
        return self.read(name, [{"arrived_on": day}]).drop("arrived_on")

    def has_night(self, name: str, day: date) -> bool:
        return bool(self.table(name).slices([{"arrived_on": day}]))

    def keep_night(self, name: str, rows: DataFrame, day: date) -> None:
        self.table(name).commit(rows.withColumn("arrived_on", F.lit(day)), [{"arrived_on": day}])


def init_history(store: Store, raw: DataFrame, tenant_shop: DataFrame, customers: DataFrame, day: date) -> None:
    """First load: all trades up to the day, its wide rows and those of the month ends before."""
    store.table("trades").commit(cleaning.located(cleaning.valid_trades(raw, tenant_shop, day)), [{}])
    write_history(store, customers, day)


def write_history(store: Store, customers: DataFrame, day: date, tenants: list[str] | None = None) -> None:
    """Wide rows of the day and the month ends before, of all tenants or of some, from the stored trades."""
    scope = None if tenants is None else [{"tenant": t} for t in tenants]
    trades = store.read("trades", scope)
    known = customers if tenants is None else customers.filter(F.col("tenant").isin(tenants))
    ends = month_ends(day)
    rows = rfm_wide.shop_rfm(known, trades, day).unionByName(rfm_wide.month_end_rfm(known, trades, ends))
    written = days([day, *ends], tenants)
    store.table("shop_rfm").commit(rows, written)
    write_levels(store, written)


def write_levels(store: Store, scope: Scope) -> None:
    store.table("wide").commit(rfm_wide.whole_levels(store.read("shop_rfm", scope)), scope)


def land(store: Store, raw: DataFrame, day: date) -> DataFrame:
    """The raw rows that arrived on the day, stored once; what the night reads of the raw feed."""
    arrived = raw.filter((F.col("arrived") >= F.lit(day)) & until(F.col("arrived"), day))
    store.keep_night("landed", arrived, day)
    return store.night("landed", day)


def nightly(
    store: Store, raw: DataFrame, tenant_shop: DataFrame, customers: DataFrame, day: date, tables: Mapping[str, DataFrame] | None = None, category_share: float = 0.5
) -> None:
    """One day: wide rows of the day, trades, corrected month ends, reports. `tables` has the further source tables
    that reports name; reports without theirs are left out."""
    changes = store_delta(store, land(store, raw, day), tenant_shop, day)
    today(store, customers, day)
    replace_trades(store, day)
    dirty = patch_history(store, changes, customers, day)
    scope = days([day]) + dirty
    write_levels(store, scope)
    sources = {"trade": raw, "tenant_shop": tenant_shop, **(tables or {})}
    publish(store, sources, day, scope, category_share)


def store_delta(store: Store, landed: DataFrame, tenant_shop: DataFrame, day: date) -> DataFrame:
    """Store what the night brought, and return the customers whose trades changed with the earliest time that did.

    `delta` are the usable trades that arrived, `delivered` the keys of all that arrived, `replaced` the stored versions
    of those. All are stored before the trades are replaced. A second run of the night would find the new versions among
    the trades, so it keeps what the first run replaced and looks for the keys alone that the first run did not have.
    """
    store.keep_night("delta", cleaning.located(cleaning.daily_increment(landed, tenant_shop, day)), day)
    delta, delivered = store.night("delta", day), cleaning.delivered_keys(landed, tenant_shop, day)
    if store.has_night("delivered", day):
        fresh = delivered.join(store.night("delivered", day), cleaning.TRADE_KEY, "left_anti")
        replaced = store.night("replaced", day).unionByName(old_versions(store, fresh).select(*delta.columns))
    else:
        replaced = old_versions(store, delivered).select(*delta.columns)
    store.keep_night("replaced", replaced, day)
    store.keep_night("delivered", delivered, day)
    store.keep_night("changes", rfm_late.changed_customers(store.night("replaced", day), delta), day)
    return store.night("changes", day)


def old_versions(store: Store, delivered: DataFrame) -> DataFrame:
    """Stored versions of delivered trades.

    An order keeps the time it was placed and its type. So an ordinary one lies in the month it was placed in, and only
    a pre-sale one, which counts from its payment, can lie in any month.
    """
    found = delivered.select("placed", "presale").distinct().collect()  # a row a month
    scope: Scope = [{"part": r.placed, "presale": 0} for r in found if not r.presale]
    scope += [{"presale": 1}] if any(r.presale for r in found) else []
    return store.read("trades", scope).join(delivered.select(*cleaning.TRADE_KEY), cleaning.TRADE_KEY, "left_semi")


def today(store: Store, customers: DataFrame, day: date) -> None:
    """Wide rows of the day from those of the day before.

    Of the stored trades, the months that leave a window and, for the few customers that lost a trade of the year, the
    months of the year are read; customers with changed trades take all of theirs, of their tenants.
    """
    delta = store.night("delta", day).select(*cleaning.CLEAN)
    delivered, replaced = (store.night(n, day).select(*cleaning.TRADE_KEY) for n in ("delivered", "replaced"))
    again = rfm_daily.holders(store.night("replaced", day), delta)
    tenants = [r.tenant for r in again.select("tenant").distinct().collect()]
    w, before = windows(day), windows(day - timedelta(days=1))
    leaving = store.read("trades", cleaning.months_of(before.year_start, w.year_start) + cleaning.months_of(before.tyear_start, w.tyear_start))
    year = store.read("trades", cleaning.months_of(w.year_start, w.end))
    own = store.read("trades", [{"tenant": t} for t in tenants]).select(*cleaning.CLEAN)
    # A trade with an old version counts anew only if it differs, and then its customers are rebuilt.
    added = delta.join(again, CUSTOMER_KEYS, "left_anti").join(replaced, cleaning.TRADE_KEY, "left_anti")
    previous = store.snapshot("shop_rfm", day - timedelta(days=1))
    rows = rfm_daily.daily_step(customers, previous, leaving, year, cleaning.latest_versions(own, delta, delivered), added, again, day)
    store.table("shop_rfm").commit(rows, days([day]))


def replace_trades(store: Store, day: date) -> None:
    """Put the night's trades in the place of their old versions. Only the slices of either are read and written."""
    delta, delivered, replaced = (store.night(n, day) for n in ("delta", "delivered", "replaced"))
    slices = delta.select(*SLICES["trades"]).union(replaced.select(*SLICES["trades"])).distinct().collect()  # a row a slice
    scope = [r.asDict() for r in slices]
    if scope:
        held = store.read("trades", scope)
        kept = cleaning.latest_versions(held, delta.select(*held.columns), delivered.select(*cleaning.TRADE_KEY))
        store.table("trades").commit(kept, scope)


def dirty_snapshots(changes: DataFrame, ends: list[date]) -> Scope:
    """Month ends that differ: those of a tenant that do not end before its earliest changed trade."""
    first = changes.groupBy("tenant").agg(F.min("changed_from").alias("since")).collect()  # a row a tenant
    return [{"stat_date": e, "tenant": r.tenant} for r in first for e in ends if windows(e).end > r.since.date()]


def patch_history(store: Store, changes: DataFrame, customers: DataFrame, day: date) -> Scope:
    """Write the month ends that differ, for the customers whose trades changed; returns their slices. Runs after the
    trades are stored."""
    scope = dirty_snapshots(changes, month_ends(day))
    if scope:
        tenants = sorted({str(s["tenant"]) for s in scope})
        ends = sorted({s["stat_date"] for s in scope})
        trades = store.read("trades", [{"tenant": t} for t in tenants])
        patched = rfm_late.rebuild_month_ends(store.read("shop_rfm", scope), trades, changes, customers, ends, of_slices=scope)
        store.table("shop_rfm").commit(patched, scope)
    return scope


def recompute_tenant(
    store: Store, tenant: str, raw: DataFrame, tenant_shop: DataFrame, customers: DataFrame, day: date, tables: Mapping[str, DataFrame] | None = None
) -> None:
    """All stored rows of one tenant again from the raw trades: trades, wide rows and the reports kept by tenant. No
    other tenant's files are read or written. It also brings a new tenant's history into the store."""
    shops = tenant_shop.filter(F.col("tenant") == tenant)
    store.table("trades").commit(cleaning.located(cleaning.valid_trades(raw, shops, day)), [{"tenant": tenant}])
    write_history(store, customers, day, [tenant])
    own = {"trade": raw, "tenant_shop": shops, **(tables or {})}
    build(store, [r for r in in_order(registry(), set(own) | STORED) if r.history], own, day, days([day, *month_ends(day)], [tenant]))


STORED = {"wide", "wide_today", "shop_rows", "shop_today"}


def build(store: Store, reports: list[Report], sources: Mapping[str, DataFrame], day: date, scope: Scope) -> None:
    """Build and store reports in turn: those with a history over the slices of the scope, the others for the day."""
    wide, shop = store.table("wide"), store.table("shop_rfm")
    inputs = {
        "wide": wide.read(scope),
        "wide_today": wide.read(days([day])),
        "shop_rows": shop.read(scope).withColumn("type", F.lit(SHOP)),
        "shop_today": shop.read(days([day])).withColumn("type", F.lit(SHOP)),
        **sources,
    }
    for report in reports:
        table, own = store.report(report), scope if report.history else days([day])
        rows = report.build(*[inputs[n] for n in report.needs], day)
        table.commit(rows if "stat_date" in rows.columns else rows.withColumn("stat_date", F.lit(day)), own)
        if not report.published:
            inputs[report.name] = table.read(own).drop("stat_date")


def publish(store: Store, sources: Mapping[str, DataFrame], day: date, scope: Scope, category_share: float = 0.5) -> None:
    """Write the reports of the day and the corrected month ends, then the manifest, which is not written where a report
    fails."""
    reports = in_order(registry(category_share), set(sources) | STORED)
    build(store, reports, sources, day, scope)
    stored = {r.name: store.report(r).read(days([day])) for r in reports if r.published}
    store.table("reports/notify", ("stat_date",)).commit(manifest.publish_manifest(stored, day), days([day]))
