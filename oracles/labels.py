"""Social and lifetime labels, dashboard, audiences."""

from oracles.base import ACTION_DAY, DAY, K, STAT, big, cte, div, dt, money, r6, sql, ts
from oracles import members  # noqa: F401  defines the shared expressions

O: dict[str, str] = {}

# Social

USER = "subject_id, sub_id, user_id"


def terms(total: str, spread: str, mean: str, peak: str) -> str:
    return f"(0.4::DOUBLE * ln({total} + 1) + 0.4::DOUBLE * ln({spread} + 1) + 0.1::DOUBLE * ln({mean} + 1) + 0.1::DOUBLE * ln({peak} + 1))"


cte("shares", "SELECT * FROM recent_action WHERE action = 'SHARE'", "recent_action")
cte(
    "communication",
    f"""SELECT {USER}, a.total AS share_total_times, a.contents AS share_content_num, a.total / a.contents AS avg_share_times, b.peak AS max_share_times
    FROM (SELECT {USER}, count(*) AS total, count(DISTINCT business_id || '/' || business_action) AS contents FROM shares GROUP BY {USER}) a
    JOIN (SELECT {USER}, max(times) AS peak FROM (SELECT {USER}, business_id, business_action, count(*) AS times FROM shares GROUP BY ALL) GROUP BY {USER}) b USING ({USER})""",
    "shares",
)
SHARE = terms("share_total_times", "share_content_num", "avg_share_times", "max_share_times")
O["l1_communication"] = sql(
    f"""SELECT {USER}, {big('share_total_times', 'share_total_times')}, {big('share_content_num', 'share_content_num')}, {big('max_share_times', 'max_share_times')},
    avg_share_times, {r6(f'pow({SHARE}, 2) * 10', 'communication')} FROM communication""",
    "communication",
)
OWNER = "subject_id, sub_id, relate_userid"
cte("opens", "SELECT * FROM recent_action WHERE action = 'OPEN_SHARE' AND user_id <> relate_userid", "recent_action")
cte(
    "opened",
    f"""SELECT subject_id, sub_id, relate_userid AS user_id, total AS open_times, people AS open_users, total / people AS avg_times, peak AS max_open_times
    FROM (SELECT {OWNER}, count(*) AS total, count(DISTINCT user_id) AS people FROM opens GROUP BY {OWNER})
    JOIN (SELECT {OWNER}, max(times) AS peak FROM (SELECT {OWNER}, business_id, business_action, count(*) AS times FROM opens GROUP BY ALL) GROUP BY {OWNER}) USING ({OWNER})""",
    "opens",
)
z = lambda c: f"coalesce({c}, 0)"
OPEN = terms(z("open_times"), z("open_users"), z("avg_times"), z("max_open_times"))
SHARED = terms(z("share_total_times"), z("share_content_num"), z("avg_share_times"), z("max_share_times"))
cte(
    "influence",
    f"""SELECT {USER}, open_times, open_users, avg_times, max_open_times, pow(0.95::DOUBLE * {OPEN} + 0.05::DOUBLE * {SHARED}, 2) * 10 AS influence
    FROM opened FULL JOIN communication USING ({USER})""",
    "opened", "communication",
)
O["l2_influence"] = sql(
    f"""SELECT {USER}, {big('open_times', 'open_times')}, {big('open_users', 'open_users')}, avg_times, {big('max_open_times', 'max_open_times')},
    {r6('influence', 'influence')} FROM influence""",
    "influence",
)
cte(
    "activity",
    f"""SELECT {USER}, count(*) AS active_days, sum(times) AS active_times, max(times) AS max_active_times, sum(times) / count(*) AS avg_active_times
    FROM (SELECT {USER}, CAST(action_time AS DATE) AS day, count(*) AS times FROM recent_action GROUP BY ALL) GROUP BY {USER}""",
    "recent_action",
)
ACTIVE = terms("active_days", "active_times", "avg_active_times", "max_active_times")
O["l3_activity"] = sql(
    f"""SELECT {USER}, {big('active_days', 'active_days')}, {big('active_times', 'active_times')}, {big('max_active_times', 'max_active_times')}, avg_active_times,
    {r6(f'pow({ACTIVE}, 2) * 10', 'activity')} FROM activity""",
    "activity",
)
cte(
    "interest",
    f"""SELECT {USER}, CASE WHEN reads = 1 OR visits = 1 THEN 2 WHEN reads > 1 OR visits > 1 OR shares >= 1 THEN 3 ELSE 1 END AS customer_type FROM (
    SELECT {USER}, count(*) FILTER (source = 'mp' AND action = 'READ') AS reads, count(*) FILTER (source = 'mini' AND action = 'VISIT') AS visits,
    count(*) FILTER (action = 'SHARE') AS shares FROM action
    WHERE action_time >= {ACTION_DAY} - 30 AND action_time < {ACTION_DAY} + 1 AND action IN ('READ', 'VISIT', 'SHARE') GROUP BY {USER})""",
    "action",
)
O["l4_interest_type"] = sql(f"SELECT {USER}, customer_type FROM interest", "interest")
cte(
    "profile",
    f"""SELECT {USER}, CAST(user_id AS BIGINT) AS u, max(first_time) AS first_time, max(last_time) AS last_time, max(business_action) FILTER (a = 1) AS first_scene,
    max(business_action) FILTER (b = 1) AS last_scene FROM (SELECT *, min(action_time) OVER (PARTITION BY {USER}) AS first_time, max(action_time) OVER (PARTITION BY {USER}) AS last_time,
    row_number() OVER (PARTITION BY {USER} ORDER BY action_time, event_id) AS a, row_number() OVER (PARTITION BY {USER} ORDER BY action_time DESC, event_id DESC) AS b FROM action)
    GROUP BY {USER}""",
    "action",
)
cte(
    "labels_shop",
    f"""SELECT p.subject_id AS company, 'U' || p.user_id AS uni_customer_id, p.sub_id AS shop_id, 'app' || p.subject_id AS appid, p.user_id AS openid, u,
    first_time, first_scene, last_time, last_scene, CASE WHEN u % 5 = 0 OR u % 4 = 0 OR u % 7 = 0 THEN 4 ELSE coalesce(customer_type, 1) END AS customer_type,
    coalesce(round(influence, 3), 0) AS influence, coalesce(round(pow({ACTIVE}, 2) * 10, 3), 0) AS activity, coalesce(round(pow({SHARE}, 2) * 10, 3), 0) AS communication
    FROM profile p LEFT JOIN interest USING ({USER}) LEFT JOIN influence USING ({USER}) LEFT JOIN activity USING ({USER}) LEFT JOIN communication USING ({USER})""",
    "profile", "interest", "influence", "activity", "communication",
)
TIMES = f"{ts('first_time', 'first_cognitive_time')}, first_scene AS first_cognitive_scene, {ts('last_time', 'last_active_time')}, last_scene AS last_active_scene"
O["l5_shop_label"] = sql(
    f"""SELECT company, uni_customer_id, shop_id, appid, openid, {TIMES}, CAST(u % 4 = 0 AS INTEGER) AS subscribe,
    {ts('CASE WHEN u % 4 = 0 THEN last_time END', 'last_subscribe_time')}, CASE WHEN u % 4 = 0 THEN last_scene END AS last_subscribe_scene,
    CAST(u % 8 = 0 AS INTEGER) AS first_subscribe, customer_type, influence, activity, communication FROM labels_shop""",
    "labels_shop",
)
O["l6_company_label"] = sql(
    f"""SELECT company AS company_id, uni_customer_id, CAST(CASE WHEN u % 6 <> 0 THEN u % 2 ELSE 0 END AS INTEGER) AS sex, 'P' || (u % 11) AS province, 'C' || (u % 17) AS city,
    customer_type, influence, activity, communication, {TIMES}, '2024-01-31' AS stat_date FROM labels_shop""",
    "labels_shop",
)

# Lifetime

O["t1_lifetime_totals"] = sql(
    f"SELECT {K}, {money('receive_payment')} AS all_payment, {big('count(*)', 'all_count_buy')}, {money('receive_payment')} / count(*) AS all_avg_payment FROM valid GROUP BY {K}", "valid"
)
cte(
    "daily",
    f"""SELECT {K}, CAST(created AS DATE) AS buy_day, round(sum(receive_payment), 2) AS day_payment, count(*) AS day_count, min(created) AS day_first, max(created) AS day_last
    FROM valid GROUP BY ALL""",
    "valid",
)
O["t2_daily_merge"] = sql(
    f"SELECT {K}, {dt('buy_day')}, day_payment, {big('day_count', 'day_count')}, {ts('day_first')}, {ts('day_last')} FROM daily", "daily"
)


def first_last(name: str, source: str) -> None:
    cte(
        name,
        f"""SELECT {K}, min(day_first) AS first_created, max(day_last) AS last_created, max(day_payment) FILTER (a = 1) AS first_payment, max(day_payment) FILTER (b = 1) AS last_payment,
        round(sum(day_payment), 2) AS all_payment, sum(day_count) AS all_count_buy,
        round(sum(day_payment) FILTER (buy_day >= DATE '2000-07-01'), 2) AS year_payment, sum(day_count) FILTER (buy_day >= DATE '2000-07-01') AS year_count_buy
        FROM (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY buy_day) AS a, row_number() OVER (PARTITION BY {K} ORDER BY buy_day DESC) AS b FROM {source}) GROUP BY {K}""",
        "daily",
    )


first_last("first_last", "daily")
first_last("by_day", f"(SELECT * FROM daily WHERE buy_day <= {DAY})")
O["t3_first_last_payment"] = sql(f"SELECT {K}, {ts('first_created')}, {ts('last_created')}, first_payment, last_payment FROM first_last", "first_last")
O["t4_year_totals"] = sql(
    f"""SELECT {K}, {big('count(*)', 'year_count_buy')}, {money('receive_payment')} AS year_payment, {money('receive_payment')} / count(*) AS year_avg_payment
    FROM valid WHERE created >= DATE '2000-07-01' AND created < {DAY} + 1 GROUP BY {K}""",
    "valid",
)
TYPE7 = """CASE WHEN first_created IS NULL THEN '1'
    WHEN first_created >= DATE '2000-07-01' AND year_count_buy = 1 THEN '2' WHEN first_created < DATE '2000-07-01' AND year_count_buy = 1 THEN '3'
    WHEN first_created >= DATE '2000-07-01' AND year_count_buy >= 2 THEN '4' WHEN first_created < DATE '2000-07-01' AND year_count_buy >= 2 THEN '5'
    WHEN last_created >= DATE '1999-07-01' THEN '6' ELSE '7' END"""
cte("shop_label", f"SELECT * FROM (SELECT {K} FROM customers) LEFT JOIN by_day USING ({K})", "customers", "by_day")


def label(keys: str, extra: str = "") -> str:
    return f"""SELECT {keys}{extra}, coalesce(all_payment, 0) AS all_payment, {big('coalesce(all_count_buy, 0)', 'all_count_buy')},
        coalesce({div('all_payment', 'all_count_buy')}, 0) AS all_avg_payment, {ts('first_created')}, coalesce(first_payment, 0) AS first_payment,
        {ts('last_created')}, coalesce(last_payment, 0) AS last_payment, coalesce(year_payment, 0) AS year_payment, {big('coalesce(year_count_buy, 0)', 'year_count_buy')},
        coalesce({div('year_payment', 'year_count_buy')}, 0) AS year_avg_payment, {TYPE7} AS customer_type, {STAT}"""


O["t5_customer_type7"] = sql(
    f"SELECT tenant, plat_code, uni_shop_id, {TYPE7} AS customer_type, {big('count(*)', 'customers')} FROM shop_label GROUP BY ALL", "shop_label"
)
O["t6_shop_label_rfm"] = sql(f"{label(K)} FROM shop_label", "shop_label")
for name, keys, place in (("platform", "tenant, plat_code, uni_id", ("uni_shop_id",)), ("tenant", "tenant, uni_id", ("plat_code", "uni_shop_id"))):
    spots = ", ".join(place)
    desc = ", ".join(f"{p} DESC" for p in place)
    picks = ", ".join(f"max({p}) FILTER (a = 1 AND first_created IS NOT NULL) AS first_{p}, max({p}) FILTER (b = 1 AND last_created IS NOT NULL) AS last_{p}" for p in place)
    lists = ", ".join(
        f"coalesce(list_aggregate(list_sort(list_distinct(list({p}) FILTER (first_created IS NOT NULL))), 'string_agg', ','), '') AS all_{p}" for p in place
    )
    cte(
        f"{name}_label",
        f"""SELECT {keys}, round(sum(all_payment), 2) AS all_payment, sum(all_count_buy) AS all_count_buy, round(sum(year_payment), 2) AS year_payment, sum(year_count_buy) AS year_count_buy,
        max(first_payment) FILTER (a = 1) AS first_payment, max(last_payment) FILTER (b = 1) AS last_payment, {picks}, {lists},
        min(first_created) AS first_created, max(last_created) AS last_created
        FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY first_created NULLS LAST, {spots}) AS a,
        row_number() OVER (PARTITION BY {keys} ORDER BY last_created DESC NULLS LAST, {desc}) AS b FROM shop_label) GROUP BY {keys}""",
        "shop_label",
    )
    extra = "".join(f", all_{p}, first_{p}, last_{p}" for p in place)
    O[f"t7_{name}_label"] = sql(f"{label(keys, extra)} FROM {name}_label", f"{name}_label")

# Dashboard

cte(
    "top_member",
    """SELECT DISTINCT dp_id, buyer_nick, CASE WHEN CAST(substr(buyer_nick, 5) AS BIGINT) % 10 = 0 THEN 'frozen' ELSE 'normal' END AS status,
       CASE WHEN CAST(substr(buyer_nick, 5) AS BIGINT) % 9 <> 0 THEN CAST(1 + CAST(substr(buyer_nick, 5) AS BIGINT) % 4 AS INTEGER) END AS grade FROM top_trade""",
    "top_trade",
)
O["d1_channel_members"] = sql(
    f"SELECT tenant AS tenant_id, {big('count(DISTINCT buyer_nick)', 'cal_number')} FROM tenant_shop LEFT JOIN top_member ON dp_id = shop_id GROUP BY tenant", "tenant_shop", "top_member"
)
O["d2_channel_trades"] = sql(
    f"""SELECT tenant AS tenant_id, period, {big('count(tid)', 'cal_trade_number')}, {big('count(DISTINCT buyer_nick)', 'cal_customer_number')},
    CAST(CAST(coalesce(sum(payment), 0) AS DECIMAL(20, 2)) AS DOUBLE) AS cal_payment
    FROM tenant_shop CROSS JOIN (VALUES (365), (30)) v(period)
    LEFT JOIN (SELECT * FROM top_trade WHERE status = 'TRADE_FINISHED' AND created < {DAY} + 1) ON dp_id = shop_id AND created >= {DAY} - period GROUP BY 1, 2""",
    "tenant_shop", "top_trade",
)
on_day = lambda c: f"{c} >= {DAY} AND {c} < {DAY} + 1"
O["d3_day_summary"] = sql(
    f"""SELECT a.dp_id, buyernick_count_created, coalesce(buyernick_count_paytime, 0) AS buyernick_count_paytime, coalesce(payment, 0) AS payment,
    coalesce(buyernick_count_paytime, 0) / buyernick_count_created AS payment_rate, coalesce(refund_payment, 0) AS refund_payment, {STAT}
    FROM (SELECT dp_id, count(DISTINCT buyer_nick) AS buyernick_count_created FROM top_trade WHERE {on_day('created')} GROUP BY 1) a
    LEFT JOIN (SELECT dp_id, round(sum(payment), 2) AS payment FROM top_trade WHERE {on_day('pay_time')} AND payment > 0 GROUP BY 1) b ON b.dp_id = a.dp_id
    LEFT JOIN (SELECT dp_id, count(DISTINCT buyer_nick) AS buyernick_count_paytime FROM top_trade WHERE {on_day('created')} AND {on_day('pay_time')} AND payment > 0 GROUP BY 1) c ON c.dp_id = a.dp_id
    LEFT JOIN (SELECT CAST(l_suppkey AS VARCHAR) AS dp_id, round(sum(CAST((net + 50) // 100 AS DOUBLE) / 100), 2) AS refund_payment FROM lines
      WHERE l_returnflag = 'R' AND l_linenumber <> 1 AND {on_day('l_shipdate')} GROUP BY 1) d ON d.dp_id = a.dp_id""",
    "top_trade", "lines",
)
PAID, SENT, DONE = "status IN ('WAIT_BUYER_CONFIRM_GOODS', 'TRADE_FINISHED')", "status IN ('WAIT_BUYER_CONFIRM_GOODS', 'TRADE_FINISHED')", "status = 'TRADE_FINISHED'"


def gap(a: str, b: str, unit: int) -> str:
    return f"CASE WHEN {b} > {a} THEN date_diff('second', {a}, {b}) / {unit} ELSE 0 END"


cte(
    "funnel",
    f"""SELECT dp_id, period, count(*) AS tid_count_created, count(*) FILTER ({PAID}) AS tid_count_paytime, count(*) FILTER ({SENT}) AS tid_count_sends,
    count(*) FILTER ({DONE}) AS tid_count_finished, avg({gap('created', 'pay_time', 60)}) FILTER ({PAID}) AS t1, avg({gap('pay_time', 'consign_time', 3600)}) FILTER ({SENT}) AS t2,
    avg({gap('consign_time', 'end_time', 86400)}) FILTER ({DONE}) AS t3
    FROM top_trade JOIN (VALUES (1), (7), (30)) v(period) ON created > {DAY} - period AND created < {DAY} + 1 GROUP BY 1, 2""",
    "top_trade",
)
COUNTS = "period, tid_count_created, tid_count_paytime, tid_count_sends, tid_count_finished"
O["d4_order_funnel"] = sql(
    f"SELECT dp_id, {COUNTS}, {r6('t1', 'rate_shiping_time_paytime')}, {r6('t2', 'rate_shiping_time_sends')}, {r6('t3', 'rate_shiping_time_finished')} FROM funnel", "funnel"
)
step = lambda a, b, n: f"round(coalesce({div(f'tid_count_{a}', f'tid_count_{b}')}, 0), 6) AS rate_shiping_{n}"
O["d5_funnel_report"] = sql(
    f"""SELECT dp_id AS shop_id, {COUNTS}, {step('paytime', 'created', 'paytime')}, {step('sends', 'paytime', 'sends')}, {step('finished', 'sends', 'finished')},
    coalesce(round(t1), 0) AS rate_shiping_time_paytime, coalesce(round(t2, 6), 0) AS rate_shiping_time_sends, coalesce(round(t3, 6), 0) AS rate_shiping_time_finished, {STAT} FROM funnel""",
    "funnel",
)
O["d6_grade_distribution"] = sql(
    f"""SELECT dp_id AS shop_id, grade, {big('count(*)', 'buyernick_count')}, count(*) / sum(count(*)) OVER (PARTITION BY dp_id) AS buyernick_rate, {STAT}
    FROM top_member WHERE grade IS NOT NULL GROUP BY dp_id, grade""",
    "top_member",
)
O["d7_root_categories"] = f"""SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS shop_id, p_type AS root_cid, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS root_cid_name, {STAT}
    FROM lineitem JOIN part ON l_partkey = p_partkey"""
BASE = f"dp_id, tid, status, {ts('created')}, buyer_nick, {ts('pay_time')}, payment, {ts('consign_time')}, {ts('end_time')}"
O["d8_base_trades"] = sql(f"SELECT {BASE} FROM top_trade WHERE created > {DAY} - 30 AND created < {DAY} + 1", "top_trade")
O["d8_base_trades_yesterday"] = sql(
    f"SELECT {BASE} FROM top_trade WHERE (({on_day('created')}) OR ({on_day('pay_time')})) AND (part >= '2001-06' OR part = 'active')", "top_trade"
)

# Audiences

RECENT = f"created >= {DAY} - 180 AND created < {DAY} + 1 AND (status = 'TRADE_FINISHED' OR pay_time IS NOT NULL)"
cte(
    "latest",
    f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dp_id, buyer_nick ORDER BY tid DESC) AS rn FROM (
    SELECT t.*, 20 + CAST(t.dp_id AS BIGINT) % 40 AS wait, rank() OVER (PARTITION BY dp_id, buyer_nick ORDER BY created DESC) AS rk FROM top_trade t WHERE {RECENT})
    WHERE rk = 1 AND (CAST(pay_time AS DATE) + CAST(wait AS INTEGER) = {DAY} OR CAST(end_time AS DATE) + CAST(wait AS INTEGER) = {DAY})) WHERE rn = 1""",
    "top_trade",
)
AUD = f"dp_id, tid, buyer_nick, status, {ts('created')}, {ts('pay_time')}, {ts('end_time')}, payment"
O["e1_latest_trade_per_buyer"] = sql(f"SELECT {AUD} FROM latest", "latest")
cte(
    "event_base",
    f"""SELECT t.*, period, date_diff('day', CAST(created AS DATE), {DAY}) AS age,
    row_number() OVER (PARTITION BY dp_id, buyer_nick, period ORDER BY created DESC, tid DESC) AS a, row_number() OVER (PARTITION BY dp_id, buyer_nick, period ORDER BY created, tid) AS b
    FROM top_trade t JOIN (VALUES (1, 30), (2, 60), (3, 90), (4, 180), (5, 365), (6, 100000)) v(period, days) ON date_diff('day', CAST(created AS DATE), {DAY}) BETWEEN 0 AND days - 1
    WHERE status <> 'WAIT_BUYER_PAY'""",
    "top_trade",
)
cte(
    "rfm_event",
    """SELECT dp_id, buyer_nick, period, count(DISTINCT created) AS trade_count, count(*) AS trade_tidcount, round(sum(payment), 2) AS trade_amount, CAST(sum(product_num) AS BIGINT) AS trade_item_num,
    count(*) FILTER (seller_flag = 0) AS trade_refund_count, coalesce(round(sum(payment) FILTER (seller_flag = 0), 2), 0) AS trade_refund_amount, max(created) AS trade_last_time,
    max(payment) FILTER (a = 1) AS trade_last_amount, CAST(min(age) AS INTEGER) AS trade_last_interval, min(created) AS trade_first_time, max(payment) FILTER (b = 1) AS trade_first_amount,
    CAST(max(age) AS INTEGER) AS trade_first_interval, round(sum(payment), 2) / count(*) AS trade_avg_amount, sum(product_num) / count(*) AS trade_avg_item_num,
    CASE WHEN count(DISTINCT created) > 1 THEN (max(age) - min(age)) / (count(DISTINCT created) - 1) END AS trade_avg_buy_interval,
    avg(date_diff('day', CAST(created AS DATE), CAST(end_time AS DATE))) AS trade_avg_confirm_interval, max(payment) AS trade_max_amount, round(sum(discount_fee), 2) AS trade_discount_fee,
    coalesce(round(sum(discount_fee) FILTER (status = 'TRADE_FINISHED'), 2), 0) AS trade_order_discount_fee
    FROM event_base GROUP BY dp_id, buyer_nick, period""",
    "event_base",
)
METRICS = f"""trade_count, trade_tidcount, trade_amount, trade_item_num, trade_refund_count, trade_refund_amount, {ts('trade_last_time')}, trade_last_amount, trade_last_interval,
    {ts('trade_first_time')}, trade_first_amount, trade_first_interval, trade_avg_amount, trade_avg_item_num, trade_avg_buy_interval, trade_avg_confirm_interval, trade_max_amount, trade_discount_fee, trade_order_discount_fee"""
O["e2_enrich_audience"] = sql(
    f"""SELECT {AUD.replace('dp_id,', 't.dp_id,').replace('buyer_nick,', 't.buyer_nick,').replace('status,', 't.status,')}, m.status AS member_status, m.grade AS member_grade, period, {METRICS}
    FROM latest t LEFT JOIN top_member m ON m.dp_id = t.dp_id AND m.buyer_nick = t.buyer_nick JOIN rfm_event r ON r.dp_id = t.dp_id AND r.buyer_nick = t.buyer_nick WHERE period = 6""",
    "latest", "top_member", "rfm_event",
)
O["e3_nest_rfm"] = sql(
    """SELECT dp_id, tid, buyer_nick, CAST(count(*) OVER (PARTITION BY tid) AS INTEGER) AS rfm_size, period, trade_tidcount, trade_amount
    FROM latest JOIN rfm_event USING (dp_id, buyer_nick)""",
    "latest", "rfm_event",
)
cte(
    "top_order",
    """SELECT CAST(l_suppkey AS VARCHAR) AS dp_id, l_orderkey || '-' || l_suppkey AS tid, l_orderkey || '-' || l_linenumber AS oid, 'nick' || o_custkey AS buyer_nick,
       p_type AS cid, CAST(l_partkey AS VARCHAR) AS num_iid, CAST(l_linenumber AS VARCHAR) AS sku_id, quantity AS num,
       CASE o_orderstatus WHEN 'F' THEN 'TRADE_FINISHED' WHEN 'O' THEN 'WAIT_BUYER_CONFIRM_GOODS' ELSE 'WAIT_BUYER_PAY' END AS status, o_orderdate AS created,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_minutes(CAST(floor(o_totalprice) AS BIGINT) % 2880) END AS pay_time,
       CASE WHEN o_orderstatus = 'F' THEN l_shipdate + INTERVAL 7 DAY END AS end_time
       FROM lines JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "lines",
)
O["e4_nest_orders"] = sql(
    f"""SELECT t.dp_id, tid, CAST(count(*) OVER (PARTITION BY tid) AS INTEGER) AS order_size, oid, cid, num, num_iid, o.status AS order_status
    FROM latest t JOIN (SELECT * FROM top_order WHERE created >= {DAY} - 180 AND created < {DAY} + 1) o USING (tid)""",
    "latest", "top_order",
)
cte(
    "due",
    f"""SELECT o.*, period * num AS config_period, exclude_customer AS config_exclude_customer, exclude_flag FROM top_order o JOIN item_config c ON c.shop_id = o.dp_id AND c.item_id = o.num_iid
    WHERE {RECENT} AND (c.sku_id IS NULL OR c.sku_id = o.sku_id)
    AND ((trigger_status = '0' AND status = 'TRADE_FINISHED' AND CAST(end_time AS DATE) + period * num = {DAY}) OR (trigger_status = '1' AND CAST(pay_time AS DATE) + period * num = {DAY}))""",
    "top_order", "item_config",
)
DUE = f"dp_id, tid, oid, buyer_nick, cid, num_iid, sku_id, num, {ts('created')}, config_period, config_exclude_customer"
O["e5_repurchase_due"] = sql(f"SELECT {DUE} FROM due", "due")
AGAIN = f"""SELECT 1 FROM (SELECT * FROM top_order WHERE {RECENT} AND pay_time IS NOT NULL) o WHERE o.dp_id = d.dp_id AND o.buyer_nick = d.buyer_nick AND o.tid <> d.tid
    AND o.created > d.created AND o.created <= d.created + to_days(CAST(d.config_period AS INTEGER))
    AND (d.config_exclude_customer = '1' OR (d.config_exclude_customer = '2' AND o.cid = d.cid) OR (d.config_exclude_customer = '3' AND o.num_iid = d.num_iid))"""
cte("kept", f"SELECT d.* FROM due d WHERE NOT EXISTS ({AGAIN})", "due", "top_order")
O["e6_exclude_rebought"] = sql(f"SELECT {DUE} FROM kept", "kept")
cte(
    "all_due",
    f"SELECT o.*, 30 AS config_period, config_exclude_customer FROM top_order o CROSS JOIN (VALUES ('0'), ('1'), ('2'), ('3')) v(config_exclude_customer) WHERE {RECENT}",
    "top_order",
)
O["e6_exclude_rebought_all_days"] = sql(
    f"SELECT dp_id, config_exclude_customer, {big('count(*)', 'kept')} FROM (SELECT d.* FROM all_due d WHERE NOT EXISTS ({AGAIN})) GROUP BY 1, 2", "all_due", "top_order"
)
O["e7_dedup_audience"] = sql(
    f"""SELECT oid, dp_id, num_iid, num, sku_id, {ts('created')} FROM (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY created DESC, num_iid, dp_id, num, sku_id) AS rn FROM top_order) WHERE rn = 1""",
    "top_order",
)
O["e7_item_audience"] = sql(
    f"""SELECT {DUE}, member_grade, trade_tidcount, trade_amount FROM (
    SELECT k.*, m.grade AS member_grade, trade_tidcount, trade_amount, row_number() OVER (PARTITION BY oid ORDER BY k.created DESC, num_iid, k.dp_id, num, sku_id) AS rn
    FROM kept k JOIN top_trade t ON t.tid = k.tid LEFT JOIN top_member m ON m.dp_id = k.dp_id AND m.buyer_nick = k.buyer_nick
    JOIN rfm_event r ON r.dp_id = k.dp_id AND r.buyer_nick = k.buyer_nick AND r.period = 6
    WHERE exclude_flag IS NULL OR exclude_flag <> CAST(t.seller_flag AS VARCHAR)) WHERE rn = 1""",
    "kept", "top_trade", "top_member", "rfm_event",
)
O["e8_festival_members"] = sql(
    f"""SELECT t.tenant, m.plat_code, m.uni_shop_id, m.shop_id, m.member_id, m.grade, m.member_id AS uni_id, c_name AS full_name, '139' || m.member_id AS mobile, 'nick' || m.member_id AS plat_account
    FROM member m JOIN tenant_shop t ON t.uni_shop_id = m.uni_shop_id JOIN customer ON CAST(c_custkey AS VARCHAR) = m.member_id
    WHERE {DAY} - CAST(s_suppkey % 30 AS INTEGER) <= {DAY} AND {DAY} + CAST(s_suppkey % 20 - 5 AS INTEGER) >= {DAY} AND c_custkey % 8 <> 0""",
    "member", "tenant_shop",
)
O["e9_publish_events"] = sql("SELECT tid AS key, dp_id, buyer_nick, payment FROM latest", "latest")
O["e10_valid_timestamp"] = sql(
    f"SELECT status, {big('count(pay_time)', 'usable')}, {big('count(*) - count(pay_time)', 'unusable')} FROM top_trade GROUP BY 1", "top_trade"
)
