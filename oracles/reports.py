"""Segmentation, assets, sales structure, category benchmarks and sinks."""

from oracles.base import DAY, K, L, STAT, big, cte, div, dt, money, num, r6, sql, snapshot_rows, ts

O: dict[str, str] = {}

# Segmentation


def buyers(name: str, source: str) -> None:
    cte(
        name,
        f"""SELECT *, CASE WHEN age <= 30 THEN 1 WHEN age <= 90 THEN 2 WHEN age <= 180 THEN 3 WHEN age <= 365 THEN 4 END AS recency,
        CASE WHEN year_buy_times >= 5 THEN 5 ELSE year_buy_times END AS frequency
        FROM (SELECT *, date_diff('day', CAST(year_last_time AS DATE), stat_date) AS age FROM {source} WHERE year_last_time IS NOT NULL)""",
        source,
    )


buyers("buyers", "wide")
buyers("buyers_history", "history")
NUM = big("count(*)", "customer_num")
O["r1_recency_bucket"] = sql(f"SELECT {L}, CAST(recency AS INTEGER) AS recency, {NUM} FROM buyers GROUP BY {L}, recency", "buyers")
O["r2_frequency_bucket"] = sql(f"SELECT {L}, CAST(frequency AS INTEGER) AS frequency, {NUM} FROM buyers GROUP BY {L}, frequency", "buyers")
cte("widths", "SELECT * FROM (VALUES (1, 50), (2, 100), (3, 200), (4, 500), (5, 1000), (6, 2000)) v(interval_type, width)")
CASES = " ".join(f"WHEN year_payment <= width * {i} THEN {i}" for i in range(1, 11))
for suffix in ("", "_history"):
    cte(
        f"monetary{suffix}",
        f"SELECT b.*, interval_type, CASE {CASES} ELSE 11 END AS monetary FROM buyers{suffix} b CROSS JOIN widths",
        f"buyers{suffix}",
        "widths",
    )
O["r3_monetary_bucket"] = sql(f"SELECT {L}, interval_type, monetary, {NUM} FROM monetary GROUP BY {L}, interval_type, monetary", "monetary")


def matrix(name: str, source: str, y: str, extra: str = "") -> None:
    """Cells and hand-made totals coded 99."""
    keys = f"stat_date, {L}{extra}"
    sums = """count(*) AS customer_num, round(sum(year_payment), 2) AS pay, sum(year_buy_times) AS times, sum(year_buy_num) AS num"""
    parts = []
    for a, b in (("recency", y), ("99", y), ("recency", "99"), ("99", "99")):
        groups = [g for g in (a, b) if g != "99"]
        parts.append(
            f"SELECT {keys}, CAST({a} AS INTEGER) AS recency, CAST({b} AS INTEGER) AS {y}, {sums} FROM {source} GROUP BY {', '.join([keys, *groups])}"
        )
    cte(name, " UNION ALL ".join(parts), source)


KEYS = f"{dt('stat_date')}, {L}"
AVGS = ", ".join(
    num(div(a, b), n) for n, a, b in (
        ("avg_payment", "pay", "customer_num"), ("avg_guest_pay", "pay", "times"), ("avg_guest_item", "num", "times"), ("avg_item_pay", "pay", "num"),
    )
)


def share(y: str, extra: str = "") -> str:
    total = f"max(customer_num) FILTER (recency = 99 AND {y} = 99) OVER (PARTITION BY stat_date, {L}{extra})"
    return num(f"customer_num / {total}", "customer_rate")


for suffix in ("", "_history"):
    matrix(f"rf{suffix}", f"buyers{suffix}", "frequency")
    matrix(f"rm{suffix}", f"monetary{suffix}", "monetary", ", interval_type")
CELL = big("customer_num", "customer_num")
O["r4_rf_matrix"] = sql(f"SELECT {KEYS}, recency, frequency, {CELL}, {AVGS} FROM rf", "rf")
O["r5_rf_share"] = sql(f"SELECT {KEYS}, recency, frequency, {share('frequency')} FROM rf", "rf")
O["r6_rm_matrix"] = sql(f"SELECT {KEYS}, interval_type, recency, monetary, {CELL}, {AVGS} FROM rm", "rm")
O["r7_rm_share"] = sql(f"SELECT {KEYS}, interval_type, recency, monetary, {share('monetary', ', interval_type')} FROM rm", "rm")
for suffix, names in (("", "r9_segmentation_report"), ("_history", "r8_segmentation_history")):
    O[f"{names}_rf"] = sql(f"SELECT {KEYS}, recency, frequency, {CELL}, {AVGS}, {share('frequency')} FROM rf{suffix}", f"rf{suffix}")
    O[f"{names}_rm"] = sql(
        f"SELECT {KEYS}, interval_type, recency, monetary, {CELL}, {AVGS}, {share('monetary', ', interval_type')} FROM rm{suffix}", f"rm{suffix}"
    )


def intervals(source: str, shown: str, kinds: tuple[int, ...] = (1, 2)) -> str:
    repeat = f"""SELECT {shown}, 1 AS customer_type,
        CAST(ceil(date_diff('day', CAST(year_first_time AS DATE), CAST(year_last_time AS DATE)) / (year_buy_times - 1)) AS INTEGER) AS interval_days, {NUM}
        FROM {source} WHERE year_buy_times >= 2 GROUP BY ALL"""
    new = f"""SELECT {shown}, 2 AS customer_type,
        CAST(date_diff('day', CAST(first_buy_time AS DATE), CAST(second_buy_time AS DATE)) AS INTEGER) AS interval_days, {NUM}
        FROM {source} WHERE CAST(first_buy_time AS DATE) >= year_start AND second_buy_time IS NOT NULL AND year_buy_times > 1 GROUP BY ALL"""
    return " UNION ALL ".join([repeat, new][k - 1] for k in kinds)


O["r10_repeat_interval"] = sql(intervals("wide", KEYS, (1,)), "wide")
O["r11_new_customer_interval"] = sql(intervals("wide", KEYS, (2,)), "wide")
O["r11_purchase_interval_history"] = sql(intervals("history", KEYS), "history")

# Assets

STAGE = """CASE WHEN first_buy_time IS NULL OR CAST(first_buy_time AS DATE) > stat_date THEN 'prospective' WHEN year_buy_times >= 1 THEN 'active'
    WHEN tyear_buy_times >= 1 THEN 'silent' WHEN btyear_buy_times >= 1 THEN 'loss' ELSE 'prospective' END"""
O["c1_life_stage"] = sql(f"SELECT {L}, uni_id, {STAGE} AS stage FROM wide", "wide")
END = "CAST(last_day(stat_date) = stat_date AS INTEGER) AS end_month"
NAMED = f"stat_date, type, w.tenant, w.plat_code, w.uni_shop_id, shop_name"


def named(source: str) -> str:
    return f"""(SELECT w.*, shop_name FROM {source} w LEFT JOIN tenant_shop t
        ON w.tenant = t.tenant AND w.plat_code = t.plat_code AND w.uni_shop_id = t.uni_shop_id)"""


def assets(source: str) -> str:
    counts = ", ".join(big(f"count(*) FILTER ({STAGE} = '{s}')", f"{s}_num") for s in ("prospective", "active", "silent", "loss"))
    return f"SELECT {KEYS}, shop_name, {counts}, {big('count(*)', 'whole_num')}, {END} FROM {named(source)} GROUP BY stat_date, {L}, shop_name"


NEW, OLD = "CAST(first_buy_time AS DATE) >= year_start", "CAST(first_buy_time AS DATE) < year_start"


def n(cond: str) -> str:
    return f"count(*) FILTER ({cond})"


def repurchase(source: str) -> str:
    a, r = "year_buy_times >= 1", "year_buy_times >= 2"
    cols = [
        ("active", a), ("repurchase", r), ("active_new", f"{a} AND {NEW}"), ("new_repurchase", f"{r} AND {NEW}"),
        ("active_old", f"{a} AND {OLD}"), ("old_repurchase", f"{r} AND {OLD}"),
    ]
    inner = ", ".join(f"{n(c)} AS {k}" for k, c in cols)
    rates = ", ".join(
        num(f"coalesce({div(x, y)}, -1)", k) for k, x, y in (
            ("rate", "repurchase", "active"), ("new_rate", "new_repurchase", "active_new"), ("old_rate", "old_repurchase", "active_old"),
        )
    )
    shown = ", ".join(big(k, k) for k, _ in cols)
    return f"SELECT {KEYS}, shop_name, {shown}, {rates}, {END} FROM (SELECT stat_date, {L}, shop_name, {inner} FROM {named(source)} GROUP BY ALL)"


def retention(source: str) -> str:
    inner = f"{n('tyear_buy_times >= 1')} AS prev_year_num, {n('tyear_buy_times >= 1 AND year_buy_times >= 1')} AS last_year_num"
    shown = f"{big('prev_year_num', 'prev_year_num')}, {big('last_year_num', 'last_year_num')}"
    rate = num(f"coalesce({div('last_year_num', 'prev_year_num')}, -1)", "rate")
    return f"SELECT {KEYS}, shop_name, {shown}, {rate}, {END} FROM (SELECT stat_date, {L}, shop_name, {inner} FROM {named(source)} GROUP BY ALL)"


O["c2_assets_view"] = sql(assets("wide"), "wide", "tenant_shop")
O["c3_repurchase_view"] = sql(repurchase("wide"), "wide", "tenant_shop")
O["c3_repurchase_history"] = sql(repurchase("history"), "history", "tenant_shop")
O["c4_retention_view"] = sql(retention("wide"), "wide", "tenant_shop")

# Sinks

SHOP_ROWS = "(SELECT * FROM wide WHERE type = 3)"
O["k1_write_snapshot"] = sql(snapshot_rows(SHOP_ROWS, True), "wide")
O["k2_append_snapshot"] = sql(repurchase("wide"), "wide", "tenant_shop")
O["k3_compact_for_export"] = sql(retention("wide"), "wide", "tenant_shop")
O["k4_cluster_by_snapshot"] = sql(
    f"SELECT {dt('stat_date')}, {big('count(*)', 'customers')}, {big('sum(year_buy_times)', 'orders')} FROM history WHERE type = 3 GROUP BY stat_date", "history"
)
O["k5_publish_manifest"] = sql(
    f"""SELECT table_name, '1' AS available, {STAT}, {big("(SELECT count(*) FROM (SELECT DISTINCT type, tenant, plat_code, uni_shop_id FROM wide))", 'row_num')}
    FROM (VALUES ('cix_online_customer_assets_view'), ('cix_online_customer_repurchase_anlyze'), ('cix_online_customer_retention_analyze')) v(table_name)""",
    "wide",
)
O["k6_publish_from_registry"] = f"""SELECT DISTINCT 'shop_' || l_suppkey || '_' || lower(p_type) AS table_name, '1' AS available, {STAT}
    FROM lineitem JOIN part ON l_partkey = p_partkey"""
O["k7_export_delimited"] = sql(repurchase("wide"), "wide", "tenant_shop")
O["k8_replace_in_serving_store"] = sql(snapshot_rows(SHOP_ROWS, True), "wide")
O["k9_merge_month_end_results"] = sql(assets("history"), "history", "tenant_shop")
O["k9_merge_month_end_results_tenant"] = sql(f"SELECT * FROM ({retention('history')}) WHERE tenant = 'T2'", "history", "tenant_shop")

# Sales structure

GRAINS = {
    "day": ("%Y-%m-%d", f"ordered > {DAY} - 32"),
    "month": ("%Y-%m", "ordered >= DATE '2000-05-01'"),
    "year": ("%Y", "true"),
}
for grain, (fmt, horizon) in GRAINS.items():
    cte(
        f"cp_{grain}",
        f"""SELECT {K}, strftime(created, '{fmt}') AS date_col, round(sum(receive_payment), 2) AS payments, count(*) AS buy_times
        FROM valid WHERE {horizon} GROUP BY ALL""",
        "valid",
    )
    O[f"v1_customer_period_{grain}"] = sql(f"SELECT {K}, date_col, payments, {big('buy_times', 'buy_times')} FROM cp_{grain}", f"cp_{grain}")
    cte(
        f"cl_{grain}",
        f"""SELECT l.type, tenant, CASE WHEN l.type >= 2 THEN plat_code END AS plat_code, CASE WHEN l.type = 3 THEN uni_shop_id END AS uni_shop_id,
        uni_id, date_col, round(sum(payments), 2) AS payments, sum(buy_times) AS buy_times FROM cp_{grain} CROSS JOIN levels l GROUP BY ALL""",
        f"cp_{grain}",
        "levels",
    )
    same = " AND ".join(f"c.{x} IS NOT DISTINCT FROM w.{x}" for x in ("type", "tenant", "plat_code", "uni_shop_id", "uni_id"))
    cte(
        f"mk_{grain}",
        f"""SELECT c.*, CASE WHEN date_col = strftime(first_buy_time, '{fmt}') THEN 'new' WHEN date_col > strftime(first_buy_time, '{fmt}') THEN 'old' END AS kind
        FROM cl_{grain} c LEFT JOIN wide w ON {same}""",
        f"cl_{grain}",
        "wide",
    )

P = f"{L}, date_col"


def part(prefix: str, where: str) -> str:
    """One report part as its own aggregation."""
    p = prefix
    return f"""SELECT {P}, count(*) AS {p}cus_num, round(sum(payments), 2) AS {p}payments, sum(buy_times) AS {p}times,
        count(*) FILTER (buy_times >= 2) AS {p}repeat_num, count(*) FILTER (buy_times = 1) AS {p}one_num,
        round(sum(payments) FILTER (buy_times = 1), 2) AS {p}one_pay, round(sum(payments) FILTER (buy_times >= 2), 2) AS {p}many_pay,
        sum(buy_times) FILTER (buy_times >= 2) AS {p}many_times FROM {{source}} WHERE {where} GROUP BY {P}"""


def kpis(p: str, detail: bool, fill: bool) -> str:
    def f(x: str, name: str) -> str:
        return num(f"coalesce({x}, 0)" if fill else x, name)

    cols = [big(f"coalesce({p}cus_num, 0)", f"{p}cus_num"), f(f"{p}payments", f"{p}payments"), f(div(f"{p}payments", f"{p}times"), f"{p}avg_price")]
    if p:
        cols += [f(div(f"{p}cus_num", "cus_num"), f"{p}rate"), f(div(f"{p}payments", "payments"), f"{p}payments_rate")]
    if detail:
        cols.append(f(div(f"{p}times", f"{p}cus_num"), f"{p}avg_times"))
    if p and detail:
        cols += [
            big(f"coalesce({p}repeat_num, 0)", f"{p}repeat_num"), f(div(f"{p}repeat_num", f"{p}cus_num"), f"{p}repeat_rate"),
            f(div(f"{p}one_pay", f"{p}one_num"), f"{p}one_price"), f(div(f"{p}many_pay", f"{p}repeat_num"), f"{p}muti_price"),
            f(div(f"{p}many_times", f"{p}repeat_num"), f"{p}muti_avg_times"),
        ]
    return ", ".join(cols)


for grain in GRAINS:
    for name, prefix, where in (("all", "", "true"), ("new", "new_", "kind = 'new'"), ("old", "old_", "kind = 'old'")):
        cte(f"{name}_{grain}", part(prefix, where).replace("{source}", f"mk_{grain}"), f"mk_{grain}")


def on(b: str) -> str:
    return " AND ".join(f"a.{x} IS NOT DISTINCT FROM {b}.{x}" for x in ("type", "tenant", "plat_code", "uni_shop_id", "date_col"))


SHOWN = "a.type, a.tenant, a.plat_code, a.uni_shop_id, a.date_col"
O["v2_customer_period_rollup"] = sql(f"SELECT {L}, uni_id, date_col, payments, {big('buy_times', 'buy_times')} FROM cl_month", "cl_month")
O["v3_period_kpi"] = sql(f"SELECT {P}, {kpis('', True, False)} FROM all_month", "all_month")
O["v4_new_customer_kpi"] = sql(f"SELECT {SHOWN}, {kpis('new_', True, False)} FROM all_month a JOIN new_month n ON {on('n')}", "all_month", "new_month")
O["v5_returning_customer_kpi"] = sql(f"SELECT {SHOWN}, {kpis('old_', True, False)} FROM all_month a JOIN old_month n ON {on('n')}", "all_month", "old_month")
for grain in GRAINS:
    detail = grain != "day"
    base = kpis("", detail, True)
    O[f"v6_sales_structure_{grain}"] = sql(
        f"""SELECT {SHOWN}, {base}, {kpis('new_', detail, True)}, {kpis('old_', detail, True)}, {STAT}
        FROM all_{grain} a LEFT JOIN new_{grain} n ON {on('n')} LEFT JOIN old_{grain} o ON {on('o')}""",
        f"all_{grain}",
        f"new_{grain}",
        f"old_{grain}",
    )

# Category benchmarks

S = "plat_code, uni_shop_id"
YEAR = "DATE '2000-07-01'"
cte(
    "bt",
    f"""SELECT {S}, trade_id, round(payment - coalesce(refund_fee, 0), 2) AS payment, ordered AS created, strftime(ordered, '%Y-%m') AS month
    FROM trade WHERE ordered >= DATE '1999-07-01' AND ordered < {DAY} + 1""",
    "trade",
)
cte(
    "eligible",
    f"""SELECT {S}, count(DISTINCT month) AS month_num, round(sum(payment) FILTER (created >= {YEAR}), 2) AS total_payment
    FROM bt GROUP BY {S} HAVING count(DISTINCT month) = 24 AND round(sum(payment) FILTER (created >= {YEAR}), 2) >= 10000""",
    "bt",
)
O["b1_eligible_shops"] = sql(f"SELECT {S}, {big('month_num', 'month_num')}, total_payment FROM eligible", "eligible")
cte(
    "items",
    f"""SELECT {S}, p_type AS parent_category_id, quantity, CAST((net + 50) // 100 AS DOUBLE) / 100 AS payment
    FROM bt JOIN tenant_shop USING ({S}) JOIN lines ON trade_id = l_orderkey AND s_suppkey = l_suppkey JOIN part ON l_partkey = p_partkey
    WHERE created >= {YEAR}""",
    "bt",
    "tenant_shop",
    "lines",
)
cte(
    "scp",
    f"SELECT {S}, parent_category_id, round(sum(payment), 2) AS total_payment FROM items JOIN (SELECT {S} FROM eligible) USING ({S}) GROUP BY ALL",
    "items",
    "eligible",
)
O["b2_shop_category_payment"] = sql(f"SELECT {S}, parent_category_id, total_payment FROM scp", "scp")
cte(
    "dominant",
    f"""SELECT {S}, max(total_payment) AS top_payment, round(sum(total_payment), 2) AS shop_payment FROM scp GROUP BY {S}
    HAVING max(total_payment) / round(sum(total_payment), 2) >= 0.25""",
    "scp",
)
O["b3_dominant_category_shops"] = sql("SELECT * FROM dominant", "dominant")
cte(
    "top5",
    f"""SELECT * FROM (SELECT scp.*, row_number() OVER (PARTITION BY parent_category_id ORDER BY total_payment DESC, {S}) AS rank
    FROM scp JOIN (SELECT {S} FROM dominant) USING ({S})) WHERE rank <= 5""",
    "scp",
    "dominant",
)
TOP = f"{S}, parent_category_id, total_payment, CAST(rank AS INTEGER) AS rank"
O["b4_top_n_shops"] = sql(f"SELECT {TOP} FROM top5", "top5")
cte("full5", "SELECT * FROM top5 WHERE parent_category_id IN (SELECT parent_category_id FROM top5 GROUP BY 1 HAVING count(*) = 5)", "top5")
O["b5_complete_groups"] = sql(f"SELECT {TOP} FROM full5", "full5")
cte("units", f"SELECT {S}, parent_category_id, sum(quantity) AS product_nums FROM items GROUP BY ALL", "items")
O["b6_shop_category_units"] = sql(f"SELECT {S}, parent_category_id, {big('product_nums', 'product_nums')} FROM units", "units")
O["b7_comparable_categories"] = sql(
    f"""SELECT {S}, parent_category_id, {big('product_nums', 'product_nums')}, CAST(sortno AS INTEGER) AS sortno FROM (
    SELECT *, row_number() OVER (PARTITION BY {S} ORDER BY product_nums DESC, parent_category_id) AS sortno
    FROM (SELECT *, sum(product_nums) OVER (PARTITION BY {S}) AS total FROM units) WHERE product_nums / total >= 0.1) WHERE sortno <= 10""",
    "units",
)
a, r = "year_buy_times >= 1", "year_buy_times >= 2"


def share0(x: str, y: str) -> str:
    return f"coalesce({div(x, y)}, 0)"


cte(
    "shop_rates",
    f"""SELECT {S}, {share0(n(r), n(a))} AS rate, {share0(n(f'{r} AND {NEW}'), n(f'{a} AND {NEW}'))} AS new_rate,
    {share0(n(f'{r} AND {OLD}'), n(f'{a} AND {OLD}'))} AS old_rate,
    {share0(n(f'tyear_buy_times >= 1 AND {a}'), n('tyear_buy_times >= 1'))} AS retention_rate FROM wide WHERE type = 3 GROUP BY tenant, {S}""",
    "wide",
)
cte(
    "category_rates",
    f"""SELECT parent_category_id, avg(rate) AS rate, avg(new_rate) AS new_rate, avg(old_rate) AS old_rate, avg(retention_rate) AS retention_rate
    FROM full5 JOIN shop_rates USING ({S}) GROUP BY 1""",
    "full5",
    "shop_rates",
)
O["b8_category_repurchase"] = sql(
    f"SELECT parent_category_id, {r6('rate', 'rate')}, {r6('new_rate', 'new_rate')}, {r6('old_rate', 'old_rate')} FROM category_rates", "category_rates"
)
O["b9_category_retention"] = sql(f"SELECT parent_category_id, {r6('retention_rate', 'retention_rate')} FROM category_rates", "category_rates")
O["b10_category_assets"] = sql(
    f"""SELECT parent_category_id, {r6('rate', 'active_customer_rate')}, {r6('new_rate', 'new_customer_rate')}, {r6('old_rate', 'old_customer_rate')},
    {r6('retention_rate', 'retention_rate')}, {STAT} FROM category_rates""",
    "category_rates",
)
cte("shop_intervals", intervals("(SELECT * FROM wide WHERE type = 3)", f"tenant, {S}"), "wide")
O["b11_category_interval"] = sql(
    f"""SELECT parent_category_id, customer_type, interval_days, {big('round(avg(customer_num))', 'customer_num')}, {STAT}
    FROM full5 JOIN shop_intervals USING ({S}) GROUP BY 1, 2, 3""",
    "full5",
    "shop_intervals",
)
