"""Scans, sinks and the wide table."""

from oracles.base import ACTION_DAY, DAY, K, L, LAST_RUN, MEASURES, WINDOW, big, cte, dt, money, sql, snapshot_rows, ts, wide_columns, wide_cte

O: dict[str, str] = {}

ROWS = f"tenant, plat_code, uni_shop_id, uni_id, trade_id, receive_payment, product_num, {ts('created')}"
O["s1_valid_trades"] = sql(f"SELECT {ROWS} FROM valid", "valid")
cte("delta", f"SELECT * FROM usable WHERE arrived >= {DAY} AND arrived < {DAY} + 1", "usable")
O["s2_daily_increment"] = sql(f"SELECT {ROWS} FROM delta", "delta")
for name, months in (("year", 12), ("two_years", 24)):
    day = f"CAST({DAY} - INTERVAL {months} MONTH AS DATE)"
    O[f"s3_boundary_day_trades_{name}"] = sql(f"SELECT {ROWS} FROM valid WHERE created >= {day} AND created < {day} + 1", "valid")
O["s4_trades_since"] = sql(f"SELECT {ROWS} FROM valid WHERE ordered >= DATE '2000-05-01'", "valid")

cte(
    "top_trade",
    """SELECT CAST(l_suppkey AS VARCHAR) AS dp_id, o_orderkey || '-' || l_suppkey AS tid,
       CASE o_orderstatus WHEN 'F' THEN 'TRADE_FINISHED' WHEN 'O' THEN 'WAIT_BUYER_CONFIRM_GOODS' ELSE 'WAIT_BUYER_PAY' END AS status,
       'nick' || o_custkey AS buyer_nick, o_orderdate AS created,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_minutes(CAST(floor(o_totalprice) AS BIGINT) % 2880) END AS pay_time,
       CAST((net + 50) // 100 AS DOUBLE) / 100 AS payment, CAST((discount + 50) // 100 AS DOUBLE) / 100 AS discount_fee,
       CASE WHEN o_orderstatus <> 'P' THEN first_ship END AS consign_time,
       CASE WHEN o_orderstatus = 'F' THEN last_ship + INTERVAL 7 DAY END AS end_time,
       CAST(o_orderkey % 6 AS INTEGER) AS seller_flag, product_num,
       CASE WHEN o_orderstatus = 'P' THEN 'active' ELSE strftime(o_orderdate, '%Y-%m') END AS part
       FROM order_shop JOIN orders ON l_orderkey = o_orderkey""",
    "order_shop",
)
O["s5_active_or_month_scan"] = sql(
    f"SELECT dp_id, tid, status, part, {ts('created')}, payment FROM top_trade WHERE created >= {DAY} - 180 AND created < {DAY} + 1",
    "top_trade",
)
cte(
    "action",
    """SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(user_id % 3 AS VARCHAR) AS subject_id, CAST(user_id % 10 AS VARCHAR) AS sub_id,
       CAST(user_id - user_id % 10 AS VARCHAR) AS relate_userid,
       CASE event_type WHEN 'view' THEN 'READ' WHEN 'click' THEN 'VISIT' WHEN 'purchase' THEN 'SHARE' WHEN 'signup' THEN 'OPEN_SHARE' ELSE 'OTHER' END AS action,
       CASE WHEN event_id % 2 = 0 THEN 'mp' ELSE 'mini' END AS source, json_extract_string(props, '$.k') AS business_id,
       event_type AS business_action, date_trunc('second', ts) AS action_time, event_id FROM events""",
)
cte("recent_action", f"SELECT * FROM action WHERE action_time >= {ACTION_DAY} - 84 AND action_time < {ACTION_DAY} + 1", "action")
O["s6_actions_since"] = sql(
    f"SELECT subject_id, sub_id, user_id, action, {big('count(*)', 'action_num')}, {ts('max(action_time)', 'last_time')} FROM recent_action GROUP BY 1, 2, 3, 4",
    "recent_action",
)
O["s6_actions_since_open_share"] = sql(
    f"""SELECT user_id, subject_id, sub_id, relate_userid, business_id, {ts('action_time')} FROM recent_action
    WHERE action = 'OPEN_SHARE' AND user_id <> relate_userid""",
    "recent_action",
)


def flag(start: str, name: str) -> str:
    return f"CAST(created >= {start} AND created < {DAY} + 1 AS INTEGER) AS {name}"


FLAGS = ", ".join(
    [
        flag("DATE '2001-06-30'", "yesterday"),
        flag("DATE '2001-06-25'", "this_week"),
        flag("DATE '2001-06-01'", "this_month"),
        flag("DATE '2001-06-24'", "last_7_days"),
        flag("DATE '2001-06-01'", "last_30_days"),
    ]
)
YEAR_FLAGS = ", ".join([flag("DATE '2001-01-01'", "this_year"), flag("DATE '2000-07-01'", "last_year")])
O["s7_period_flags"] = sql(f"SELECT uni_shop_id, trade_id, {ts('created')}, {FLAGS}, {YEAR_FLAGS} FROM valid", "valid")
STARTS = "(VALUES (1, DATE '2001-06-29'), (2, DATE '2001-06-24'), (3, DATE '2001-06-01'), (4, DATE '2001-06-23'), (5, DATE '2001-05-31')) p(rangetype, start_)"
O["s7_period_flags_anchored_week"] = sql(
    f"SELECT plat_code, rangetype, {big('count(*)', 'trades')} FROM valid JOIN {STARTS} ON created >= start_ AND created < {DAY} + 1 GROUP BY 1, 2",
    "valid",
)
DAYS = "(SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)"
O["s8_period_bounds"] = f"""SELECT {dt('day')}, {dt('day', 'yesterday_start')},
    {dt("day - CAST((date_diff('day', date_trunc('year', day), day) + 1) % 7 AS INTEGER)", 'week_start')},
    {dt("date_trunc('month', day)", 'month_start')}, {dt("date_trunc('year', day)", 'year_start')},
    {dt('day - 6', 'last_7_days_start')}, {dt('day - 29', 'last_30_days_start')},
    {dt("CASE WHEN last_day(day) = day THEN last_day(CAST(day - INTERVAL 1 YEAR AS DATE)) ELSE CAST(day - INTERVAL 1 YEAR AS DATE) END + 1", 'last_year_start')}
    FROM {DAYS}"""
O["s9_month_ends"] = f"SELECT {dt('day')}, {dt('last_day(CAST(day - INTERVAL (i) MONTH AS DATE))', 'month_end')} FROM {DAYS} CROSS JOIN range(1, 14) r(i)"
O["s10_is_month_end"] = f"""SELECT {dt('day')}, {big('count(*)', 'orders')}, CAST(extract(day FROM day + 1) = 1 AS INTEGER) AS end_month
    FROM (SELECT CAST(o_orderdate AS DATE) AS day FROM orders) GROUP BY day"""
cte(
    "item_config",
    """SELECT CAST(l_suppkey AS VARCHAR) AS shop_id, CAST(l_partkey AS VARCHAR) AS item_id,
       CASE WHEN p_size % 5 = 0 THEN CAST(max(l_linenumber) AS VARCHAR) END AS sku_id, 1 + p_size % 4 AS period,
       CASE WHEN p_size % 3 = 0 THEN '5' END AS exclude_flag, CAST((l_partkey + l_suppkey) % 4 AS VARCHAR) AS exclude_customer,
       CAST(l_partkey % 2 AS VARCHAR) AS trigger_status FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, l_partkey, p_size""",
)
O["s11_with_tokens_null"] = sql("SELECT shop_id, item_id, sku_id FROM item_config", "item_config")

# Wide table

first = f"{ts('min(created)', 'first_buy_time')}"
O["w1_first_second_purchase"] = sql(
    f"SELECT {K}, {ts('first_buy_time')}, first_payment, first_trade_id, {ts('second_buy_time')} FROM wide_m WHERE type = 3", "wide_m"
)
O["w1_first_second_purchase_tenant"] = sql(
    f"SELECT tenant, uni_id, {ts('first_buy_time')}, first_payment, {ts('second_buy_time')} FROM wide_m WHERE type = 1", "wide_m"
)
Y0, T0 = "DATE '2000-07-01'", "DATE '1999-07-01'"


def window_sums(p: str, extra: str = "") -> str:
    return f"{money('receive_payment')} AS {p}_payment, {big('count(*)', f'{p}_buy_times')}, {big('sum(product_num)', f'{p}_buy_num')}{extra}"


times = f", {ts('min(created)', 'year_first_time')}, {ts('max(created)', 'year_last_time')}"
O["w2_last_year_metrics"] = sql(
    f"SELECT {K}, {window_sums('year', times)} FROM valid WHERE created >= {Y0} AND created < {DAY} + 1 GROUP BY {K}", "valid"
)
O["w3_prev_year_metrics"] = sql(f"SELECT {K}, {window_sums('tyear')} FROM valid WHERE created >= {T0} AND created < {Y0} GROUP BY {K}", "valid")
O["w4_older_metrics"] = sql(f"SELECT {K}, {window_sums('btyear')} FROM valid WHERE created < {T0} GROUP BY {K}", "valid")
O["w5_shop_rfm"] = sql(f"SELECT {wide_columns()} FROM wide WHERE type = 3", "wide")
FIRST = f"uni_id, {ts('first_buy_time')}, first_payment, {ts('second_buy_time')}"
O["w6_rollup_first_second_platform"] = sql(f"SELECT tenant, plat_code, {FIRST} FROM wide WHERE type = 2", "wide")
O["w6_rollup_first_second_tenant"] = sql(f"SELECT tenant, {FIRST} FROM wide WHERE type = 1", "wide")
O["w7_rollup_rfm_platform"] = sql(f"SELECT {wide_columns()} FROM wide WHERE type = 2", "wide")
O["w7_rollup_rfm_tenant"] = sql(f"SELECT {wide_columns()} FROM wide WHERE type = 1", "wide")
O["w7_all_levels"] = sql(snapshot_rows("wide", True), "wide")

# Daily maintenance: the same rows from a full recompute

cte("base", f"SELECT * FROM usable WHERE arrived < {DAY} AND ordered < {DAY}", "usable")
cte("arrived_today", f"SELECT * FROM usable WHERE arrived < {DAY} + 1 AND ordered < {DAY} + 1", "usable")
wide_cte("inc", "delta", "customers_today", "snap_today")
wide_cte("prev", "base", "customers_yesterday", "snap_yesterday")
wide_cte("aged", "base", "customers_yesterday", "snap_today")
wide_cte("today", "arrived_today", "customers_today", "snap_today")

INC = ", ".join(
    [
        K, ts("first_buy_time", "earliest_time"), ts("first_buy_time"), "first_payment", "first_trade_id", ts("second_buy_time"),
        ts("year_first_time"), ts("year_last_time"), f"strftime({DAY}, '%Y-%m-%d') AS stat_date",
        *[f"coalesce({m}, 0) AS {m}" if m.endswith("payment") else big(f"coalesce({m}, 0)", m) for m in MEASURES],
    ]
)
O["w8_increment_rfm"] = sql(f"SELECT {INC} FROM inc_m WHERE type = 3", "inc_m")
for name, months in (("year", 12), ("two_years", 24)):
    day = f"CAST({DAY} - INTERVAL {months} MONTH AS DATE)"
    O[f"w9_boundary_metrics_{name}"] = sql(
        f"""SELECT {K}, {money('receive_payment')} AS payment, {big('count(*)', 'buy_times')}, {big('sum(product_num)', 'buy_num')},
        {ts('min(created)', 'first_time')}, {ts('max(created)', 'last_time')} FROM base WHERE created >= {day} AND created < {day} + 1 GROUP BY {K}""",
        "base",
    )
O["w10_age_rfm"] = sql(f"SELECT {wide_columns()} FROM aged WHERE type = 3", "aged")
SAME = " AND ".join(f"a.{c} = b.{c}" for c in ("type", "tenant", "plat_code", "uni_shop_id", "uni_id"))
# A customer with the increment and an aged row: both sets of trades together, earliest time of the stored row included.
cte(
    "changed",
    f"""SELECT b.* EXCLUDE (earliest_time), least(a.earliest_time, b.first_buy_time) AS earliest_time FROM aged a JOIN today b ON {SAME}
    JOIN inc_m i ON i.type = b.type AND i.tenant = b.tenant AND i.plat_code = b.plat_code AND i.uni_shop_id = b.uni_shop_id AND i.uni_id = b.uni_id
    WHERE b.type = 3""",
    "aged",
    "today",
    "inc_m",
)
O["w11_merge_changed"] = sql(f"SELECT {wide_columns()}, first_trade_id FROM changed", "changed")
O["w12_insert_new"] = sql(
    f"""SELECT {INC} FROM inc_m b WHERE type = 3 AND NOT EXISTS (SELECT 1 FROM aged a WHERE {SAME})""", "inc_m", "aged"
)
O["w13_final_daily_rfm"] = sql(f"SELECT {wide_columns()} FROM today WHERE type = 3", "today")
O["w13_daily_rfm_latest_versions"] = sql(snapshot_rows("(SELECT * FROM today WHERE type = 3)", False), "today")

# Late trades

cte("late_delta", f"SELECT * FROM usable WHERE arrived >= {LAST_RUN} + 1 AND arrived < {DAY} + 1", "usable")
cte(
    "late_flags",
    """SELECT d.*, stat_date, CASE WHEN created < tyear_start THEN 'btyear' WHEN created < year_start THEN 'tyear' ELSE 'year' END AS win
    FROM late_delta d JOIN snap_ends ON created < end_""",
    "late_delta",
    "snap_ends",
)
O["w14_late_flags"] = sql(f"SELECT uni_shop_id, uni_id, trade_id, {ts('created')}, {dt('stat_date')}, win AS \"window\" FROM late_flags", "late_flags")
late_sums = ", ".join(
    f"coalesce(round(sum(receive_payment) FILTER (win = '{p}'), 2), 0) AS {p}_payment, {big(f'''count(*) FILTER (win = '{p}')''', f'{p}_buy_times')}, "
    + big(f"coalesce(sum(product_num) FILTER (win = '{p}'), 0)", f"{p}_buy_num")
    for p in WINDOW
)
O["w15_late_metrics"] = sql(
    f"""SELECT {K}, {dt('stat_date')}, {late_sums}, {ts("min(created) FILTER (win = 'year')", 'year_first_time')},
    {ts("max(created) FILTER (win = 'year')", 'year_last_time')} FROM late_flags GROUP BY {K}, stat_date""",
    "late_flags",
)
wide_cte("late", "late_delta", "customers_today", "snap_ends")
LATE = ", ".join(
    [
        K, ts("first_buy_time", "earliest_time"), ts("first_buy_time"), "first_payment", "first_trade_id", ts("second_buy_time"),
        ts("year_first_time"), ts("year_last_time"), dt("stat_date"),
        *[f"coalesce({m}, 0) AS {m}" if m.endswith("payment") else big(f"coalesce({m}, 0)", m) for m in MEASURES],
    ]
)
O["w16_late_assemble"] = sql(f"SELECT {LATE} FROM late_m WHERE type = 3", "late_m")
cte("late_pairs", f"SELECT {K}, stat_date FROM late_m WHERE type = 3", "late_m")
# Rows the stored snapshots have (customers known at the last run) or gain (late pairs).
cte("arrived_run", "SELECT * FROM usable WHERE " + f"(arrived < {LAST_RUN} + 1 AND ordered < {LAST_RUN} + 1) OR (arrived >= {LAST_RUN} + 1 AND arrived < {DAY} + 1)", "usable")
wide_cte("complete", "arrived_run", "customers_today", "snap_ends")
KNOWN = " AND ".join(f"w.{c} = k.{c}" for c in ("tenant", "plat_code", "uni_shop_id", "uni_id"))
cte(
    "late_new",
    f"""SELECT w.* FROM complete w JOIN late_pairs k ON {KNOWN} AND w.stat_date = k.stat_date
    WHERE w.type = 3 AND NOT EXISTS (SELECT 1 FROM customers_last_run k WHERE {KNOWN})""",
    "complete",
    "late_pairs",
    "customers_last_run",
)
O["w17_late_new_customers"] = sql(f"SELECT {wide_columns()}, first_trade_id FROM late_new", "late_new")
cte(
    "patched",
    f"""SELECT w.* FROM complete w WHERE w.type = 3 AND EXISTS (SELECT 1 FROM customers_last_run k WHERE {KNOWN})
    UNION ALL SELECT * FROM late_new""",
    "complete",
    "customers_last_run",
    "late_new",
)
O["w18_late_patch"] = sql(snapshot_rows("patched", False), "patched")
# Upper levels out of the patched shop rows: sums, and of the first times the first two.
cte(
    "patched_lv",
    f"""SELECT levels.type, tenant, CASE WHEN levels.type >= 2 THEN plat_code END AS plat_code,
       CASE WHEN levels.type = 3 THEN uni_shop_id END AS uni_shop_id, uni_id, plat_code AS p0, uni_shop_id AS s0, stat_date,
       earliest_time, first_buy_time, first_payment, second_buy_time, {', '.join(MEASURES)}, year_first_time, year_last_time
       FROM patched CROSS JOIN levels""",
    "patched",
    "levels",
)
cte(
    "patched_first",
    f"""SELECT *, row_number() OVER (PARTITION BY stat_date, {L}, uni_id ORDER BY first_buy_time NULLS LAST, p0, s0) AS rn FROM patched_lv""",
    "patched_lv",
)
rolled = ", ".join(f"round(sum({m}), 2) AS {m}" if m.endswith("payment") else f"CAST(sum({m}) AS BIGINT) AS {m}" for m in MEASURES)
cte(
    "patched_levels",
    f"""SELECT stat_date, {L}, uni_id, min(earliest_time) AS earliest_time, min(first_buy_time) AS first_buy_time,
    max(first_payment) FILTER (rn = 1) AS first_payment,
    least(max(second_buy_time) FILTER (rn = 1), max(first_buy_time) FILTER (rn = 2)) AS second_buy_time, {rolled},
    min(year_first_time) AS year_first_time, max(year_last_time) AS year_last_time FROM patched_first GROUP BY stat_date, {L}, uni_id""",
    "patched_first",
)
O["w19_late_patch_rollup"] = sql(snapshot_rows("patched_levels", True), "patched_levels")
O["w20_month_end_rfm"] = sql(snapshot_rows("history", True), "history")
O["w21_new_tenant_history"] = sql(
    snapshot_rows("(SELECT * FROM history WHERE tenant NOT IN (SELECT tenant FROM trade WHERE accepted AND ordered < DATE '1995-01-02'))", True),
    "history",
    "trade",
)
wide_cte("now_and_ends", "valid", "customers", "snap_ends_today")
O["w22_recompute_tenant"] = sql(snapshot_rows("(SELECT * FROM now_and_ends WHERE tenant = 'T1')", True), "now_and_ends")
O["w23_tenant_card_plans"] = sql("SELECT DISTINCT tenant, 'CP' || substr(tenant, 2) AS card_plan_id FROM tenant_shop", "tenant_shop")
