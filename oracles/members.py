"""Points, grades, conversion, life cycle and stores."""

from oracles.base import DAY, K, L, STAT, big, cte, div, dt, money, num, sql, ts
from oracles.reports import KEYS, NEW, OLD
from oracles.wide import FLAGS

O: dict[str, str] = {}

cte(
    "member",
    """SELECT 'CP' || n_regionkey AS card_plan_id, CAST(c_custkey AS VARCHAR) AS member_id, n_name AS plat_code,
       n_name || '|' || first_shop AS uni_shop_id, CAST(first_shop AS VARCHAR) AS shop_id, CAST(1 + c_custkey % 4 AS INTEGER) AS grade,
       CAST(DATE '2000-01-01' + CAST(c_custkey % 545 AS INTEGER) AS TIMESTAMP) AS created
       FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN (SELECT s_nationkey, min(s_suppkey) AS first_shop FROM supplier GROUP BY 1) ON s_nationkey = c_nationkey WHERE c_custkey % 3 <> 0""",
)
cte("card_shop", "SELECT 'CP' || substr(tenant, 2) AS card_plan_id, plat_code, shop_id, uni_shop_id, shop_name FROM tenant_shop", "tenant_shop")
cte("member_orders", "SELECT card_plan_id, member_id, orders.* FROM orders JOIN member ON member_id = CAST(o_custkey AS VARCHAR)", "member")
cte(
    "point_change",
    """SELECT card_plan_id, member_id, o_orderdate AS change_time,
       CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END * CAST(round(o_totalprice / 1000) AS BIGINT) AS change_value FROM member_orders""",
    "member_orders",
)
cte(
    "points",
    f"""SELECT card_plan_id, member_id, CAST(round(o_totalprice / 1000) AS BIGINT) AS point, o_orderdate AS effective_date,
       o_orderdate + INTERVAL 365 DAY AS overdue_date, o_orderdate + INTERVAL 365 DAY > {DAY} AS valid FROM member_orders""",
    "member_orders",
)
cte("in_force", f"SELECT * FROM points WHERE effective_date < {DAY} + 1 AND overdue_date >= {DAY} + 1 AND valid", "points")
cte(
    "grade_change",
    """SELECT card_plan_id, member_id, CASE o_orderstatus WHEN 'F' THEN 'UP' WHEN 'O' THEN 'DOWN' ELSE 'KEEP' END AS change_type,
       CAST(1 + o_orderkey % 4 AS INTEGER) AS grade_before_change, o_orderdate AS change_time, o_orderkey AS change_id FROM member_orders""",
    "member_orders",
)
# Inclusive periods: yesterday, week, month, seven and thirty days back.
cte(
    "periods",
    "SELECT * FROM (VALUES (1, DATE '2001-06-29'), (2, DATE '2001-06-25'), (3, DATE '2001-06-01'), (4, DATE '2001-06-23'), (5, DATE '2001-05-31')) v(rangetype, start_)",
)


def within(col: str) -> str:
    return f"JOIN periods ON {col} >= start_ AND {col} < {DAY} + 1"


O["m1_valid_points"] = sql(f"SELECT card_plan_id, member_id, point, {ts('effective_date')}, {ts('overdue_date')} FROM in_force", "in_force")


def bucket(col: str, width: str) -> str:
    steps = " ".join(f"WHEN {col} <= {width} * {i} THEN {i + 1}" for i in range(1, 11))
    return f"CASE WHEN {col} <= 0 THEN 1 {steps} ELSE 12 END"


mp = ", ".join(f"{bucket('change_value', str(w))} AS mp{w}" for w in (100, 200, 500))
O["m2_point_bucket"] = sql(f"SELECT {mp}, card_plan_id, {big('count(*)', 'changes')} FROM point_change GROUP BY ALL", "point_change")
O["m3_point_distribution"] = sql(
    f"""SELECT card_plan_id, mptype, interval_type, {big('members', 'members')}, members / sum(members) OVER (PARTITION BY card_plan_id, interval_type) AS member_rate, {STAT}
    FROM (SELECT card_plan_id, {bucket('point', 'w')} AS mptype, w AS interval_type, count(*) AS members
    FROM in_force CROSS JOIN (VALUES (100), (200), (500)) v(w) GROUP BY ALL)""",
    "in_force",
)
cte("stock", "SELECT card_plan_id, CAST(sum(point) AS BIGINT) AS points FROM in_force GROUP BY 1", "in_force")
O["m4_point_stock"] = sql("SELECT card_plan_id, points, '2001-06-30' AS day FROM stock", "stock")
CELL = "card_plan_id, rangetype"
parts = {
    "m5_point_change_members": (f"{big('count(DISTINCT member_id)', 'members')}", "point_change", "change_time", ""),
    "m6_point_flow": (
        big("coalesce(sum(change_value) FILTER (change_value >= 0), 0)", "send_points") + ", "
        + big("-coalesce(sum(change_value) FILTER (change_value < 0), 0)", "consume_points"),
        "point_change", "change_time", "",
    ),
    "m7_overdue_points": (big("sum(point)", "overdue_points"), "points", "overdue_date", "WHERE NOT valid"),
    "m8_new_members": (big("count(*)", "newmembers"), "member", "created", ""),
}
for name, (aggs, source, col, where) in parts.items():
    cte(name, f"SELECT {CELL}, {aggs} FROM {source} {within(col)} {where} GROUP BY {CELL}", source, "periods")
    O[name] = sql(f"SELECT * FROM {name}", name)
cte(
    "m9_grade_moves",
    f"""SELECT {CELL}, count(*) FILTER (change_type = 'UP') AS upnums, count(*) FILTER (change_type = 'DOWN') AS downnums FROM (
    SELECT *, row_number() OVER (PARTITION BY {CELL}, member_id ORDER BY change_time DESC, change_id DESC) AS rn
    FROM grade_change {within('change_time')} WHERE change_type IN ('UP', 'DOWN')) WHERE rn = 1 GROUP BY {CELL}""",
    "grade_change",
    "periods",
)
O["m9_grade_moves"] = sql("SELECT * FROM m9_grade_moves", "m9_grade_moves")
cte("scaffold", "SELECT DISTINCT card_plan_id, rangetype FROM member CROSS JOIN periods", "member", "periods")
O["m10_plan_period_scaffold"] = sql("SELECT * FROM scaffold", "scaffold")
O["m11_point_grade_report"] = sql(
    f"""SELECT {CELL}, {', '.join(f'coalesce({x}, 0) AS {y}' for x, y in (('points', 'effect_points'), ('members', 'point_change_nums'), ('send_points', 'send_points'), ('consume_points', 'consume_points'), ('overdue_points', 'overdue_points'), ('newmembers', 'newmembers'), ('upnums', 'upnums'), ('downnums', 'downnums')))}, {STAT}
    FROM scaffold LEFT JOIN stock USING (card_plan_id) LEFT JOIN m5_point_change_members USING ({CELL}) LEFT JOIN m6_point_flow USING ({CELL})
    LEFT JOIN m7_overdue_points USING ({CELL}) LEFT JOIN m8_new_members USING ({CELL}) LEFT JOIN m9_grade_moves USING ({CELL})""",
    "scaffold", "stock", "m5_point_change_members", "m6_point_flow", "m7_overdue_points", "m8_new_members", "m9_grade_moves",
)
cte(
    "grades",
    f"""SELECT p.rangetype, m.card_plan_id, m.member_id, m.grade AS nowgrade,
    CASE WHEN m.created >= p.start_ THEN -1 ELSE coalesce(b.grade_before_change, m.grade) END AS oldgrade
    FROM (SELECT * FROM member WHERE created < {DAY} + 1) m CROSS JOIN periods p LEFT JOIN (
      SELECT *, row_number() OVER (PARTITION BY {CELL}, member_id ORDER BY change_time, change_id) AS rn FROM grade_change {within('change_time')}
    ) b ON b.rn = 1 AND b.rangetype = p.rangetype AND b.card_plan_id = m.card_plan_id AND b.member_id = m.member_id""",
    "member", "periods", "grade_change",
)
GRADES = " UNION ALL ".join(
    f"SELECT {CELL}, CAST({a} AS INTEGER) AS nowgrade, CAST({b} AS INTEGER) AS oldgrade, {big('count(*)', 'members')} FROM grades GROUP BY {', '.join([CELL, *[x for x in (a, b) if x != '99']])}"
    for a, b in (("nowgrade", "oldgrade"), ("99", "oldgrade"), ("nowgrade", "99"), ("99", "99"))
)
O["m12_grade_matrix"] = sql(f"SELECT * FROM ({GRADES}) WHERE rangetype = 5", "grades")
O["m12_grade_matrix_all_periods"] = sql(f"SELECT * FROM ({GRADES})", "grades")
O["m13_grade_matrix_report"] = sql(f"SELECT *, {STAT} FROM ({GRADES})", "grades")

# Conversion

for suffix in ("", "_history"):
    cte(
        f"myv{suffix}",
        f"""SELECT w.stat_date, card_plan_id, member_id, strftime(m.created, '%Y-%m') AS join_month, w.uni_id, tenant, w.plat_code, w.uni_shop_id,
        year_payment AS payment, year_buy_times AS orders FROM (SELECT * FROM {'history' if suffix else 'wide'} WHERE type = 3) w
        JOIN card_shop USING (uni_shop_id) JOIN member m USING (card_plan_id)
        WHERE m.member_id = w.uni_id AND m.created >= CASE WHEN last_day(stat_date) = stat_date THEN last_day(CAST(stat_date - INTERVAL 14 MONTH AS DATE)) ELSE stat_date - INTERVAL 14 MONTH END + INTERVAL 1 DAY
        AND m.created < stat_date + 1""",
        "history" if suffix else "wide", "card_shop", "member",
    )
    cte(
        f"myl{suffix}",
        f"""SELECT stat_date, {L}, card_plan_id, join_month, member_id, round(sum(payment), 2) AS payment, sum(orders) AS orders FROM (
        SELECT stat_date, l.type, tenant, CASE WHEN l.type >= 2 THEN plat_code END AS plat_code, CASE WHEN l.type = 3 THEN uni_shop_id END AS uni_shop_id,
        card_plan_id, join_month, member_id, payment, orders FROM myv{suffix} CROSS JOIN levels l) GROUP BY ALL""",
        f"myv{suffix}", "levels",
    )
    counts = ", ".join([big("count(*)", "members"), f"{money('payment')} AS payments", *[big(f"count(*) FILTER (least(orders, 5) = {i})", f"f{i}") for i in range(6)]])
    O[f"m15_consume_transform{suffix}"] = sql(
        " UNION ALL ".join(
            f"SELECT {KEYS}, card_plan_id, {month} AS join_month, {counts}, CAST(last_day(stat_date) = stat_date AS INTEGER) AS end_month FROM myl{suffix} GROUP BY stat_date, {L}, card_plan_id{group}"
            for month, group in (("join_month", ", join_month"), ("'all'", ""))
        ),
        f"myl{suffix}",
    )
O["m14_member_year_value"] = sql(
    f"""SELECT {dt('stat_date')}, card_plan_id, member_id, join_month, uni_id, tenant, plat_code, uni_shop_id, payment, {big('orders', 'orders')},
    CAST(least(orders, 5) AS INTEGER) AS frequency FROM myv""",
    "myv",
)

# Life cycle

CLASS = f"""CASE WHEN first_buy_time IS NULL OR CAST(first_buy_time AS DATE) > stat_date THEN 'prospective'
    WHEN year_buy_times = 1 AND {NEW} THEN 'active_new' WHEN year_buy_times >= 2 AND {NEW} THEN 'phurce_new'
    WHEN year_buy_times = 1 AND {OLD} THEN 'active_old' WHEN year_buy_times >= 2 AND {OLD} THEN 'phurce_old'
    WHEN year_buy_times = 0 AND tyear_buy_times >= 1 THEN 'silent'
    WHEN year_buy_times = 0 AND tyear_buy_times = 0 AND btyear_buy_times >= 1 THEN 'loss' ELSE 'prospective' END"""
CLASSES = ("prospective", "active_new", "phurce_new", "active_old", "phurce_old", "silent", "loss")
O["m16_life_cycle_class"] = sql(f"SELECT {L}, uni_id, {CLASS} AS class FROM wide", "wide")
for suffix, source in (("", "wide"), ("_history", "history")):
    cte(
        f"shop_link{suffix}",
        f"""SELECT w.stat_date, w.type, w.tenant, w.plat_code, w.uni_shop_id, w.uni_id, {CLASS} AS class, m.card_plan_id, m.member_id, m.grade
        FROM {source} w JOIN card_shop s ON s.uni_shop_id = w.uni_shop_id
        LEFT JOIN member m ON m.card_plan_id = s.card_plan_id AND m.member_id = w.uni_id AND m.created < w.stat_date + 1 WHERE w.type = 3""",
        source, "card_shop", "member",
    )
    cte(
        f"held{suffix}",
        f"""SELECT DISTINCT stat_date, l.type, tenant, CASE WHEN l.type = 2 THEN plat_code END AS plat_code, uni_id, card_plan_id, member_id, grade
        FROM shop_link{suffix} CROSS JOIN levels l WHERE grade IS NOT NULL AND l.type < 3""",
        f"shop_link{suffix}", "levels",
    )
    cte(
        f"link{suffix}",
        f"""SELECT * FROM shop_link{suffix} UNION ALL
        SELECT w.stat_date, w.type, w.tenant, w.plat_code, w.uni_shop_id, w.uni_id, w.class, h.card_plan_id, h.member_id, h.grade FROM (SELECT *, {CLASS} AS class FROM {source}) w
        LEFT JOIN held{suffix} h ON h.stat_date = w.stat_date AND h.type = w.type AND h.tenant = w.tenant AND h.uni_id = w.uni_id AND h.plat_code IS NOT DISTINCT FROM w.plat_code
        WHERE w.type < 3""",
        f"shop_link{suffix}", f"held{suffix}", source,
    )

    def counted(keys: str, where: str = "true", s: str = suffix) -> str:
        cols = ", ".join(f"count(DISTINCT uni_id) FILTER (class = '{c}') AS {c}" for c in CLASSES)
        return f"SELECT stat_date, {L}{keys}, {cols}, count(DISTINCT uni_id) AS whole FROM link{s} WHERE {where} GROUP BY ALL"

    cte(f"by_grade{suffix}", counted(", card_plan_id, grade", "grade IS NOT NULL"), f"link{suffix}")
    cte(f"everybody{suffix}", counted(""), f"link{suffix}")
    cte(
        f"of_plan{suffix}",
        f"SELECT stat_date, {L}, card_plan_id, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in (*CLASSES, 'whole'))} FROM by_grade{suffix} GROUP BY ALL",
        f"by_grade{suffix}",
    )
    cols = ", ".join((*CLASSES, "whole"))
    pair = f"""FROM everybody{suffix} a LEFT JOIN of_plan{suffix} m ON {' AND '.join(f'a.{x} IS NOT DISTINCT FROM m.{x}' for x in ('stat_date', 'type', 'tenant', 'plat_code', 'uni_shop_id'))}"""
    akeys = "a.stat_date, a.type, a.tenant, a.plat_code, a.uni_shop_id, m.card_plan_id"
    cte(
        f"totals{suffix}",
        f"""SELECT {akeys}, 99 AS grade, {', '.join(f'a.{c} AS {c}' for c in (*CLASSES, 'whole'))} {pair}
        UNION ALL SELECT {akeys}, -1, {', '.join(f'a.{c} - coalesce(m.{c}, 0)' for c in (*CLASSES, 'whole'))} {pair}
        UNION ALL SELECT stat_date, {L}, card_plan_id, 98, {cols} FROM of_plan{suffix}""",
        f"everybody{suffix}", f"of_plan{suffix}",
    )
SHOWN = ", ".join(big(c, c) for c in (*CLASSES, "whole"))
LINK = f"{KEYS}, uni_id, class, card_plan_id, member_id, grade"
O["m17_customer_member_link"] = sql(f"SELECT {LINK} FROM link", "link")
O["m18_life_cycle_by_grade"] = sql(f"SELECT {KEYS}, card_plan_id, grade, {SHOWN} FROM by_grade", "by_grade")
O["m19_life_cycle_totals"] = sql(f"SELECT {KEYS}, card_plan_id, grade, {SHOWN} FROM totals", "totals")
END = "CAST(last_day(stat_date) = stat_date AS INTEGER) AS end_month"
for suffix, name in (("", "m20_life_cycle_report"), ("_history", "m20_life_cycle_history")):
    O[name] = sql(
        f"""SELECT {KEYS}, card_plan_id, grade, {SHOWN}, {END} FROM (SELECT stat_date, {L}, card_plan_id, grade, {', '.join((*CLASSES, 'whole'))} FROM by_grade{suffix}
        UNION ALL SELECT * FROM totals{suffix})""",
        f"by_grade{suffix}", f"totals{suffix}",
    )
sums = ", ".join(f"count(*) FILTER (class = '{c}') AS {c}" for c in CLASSES) + ", count(*) AS whole"
cte(
    "simple_rows",
    f"""SELECT stat_date, l.type, tenant, CASE WHEN l.type >= 2 THEN plat_code END AS plat_code, CASE WHEN l.type = 3 THEN uni_shop_id END AS uni_shop_id,
    card_plan_id, coalesce(grade, -1) AS grade, class FROM shop_link CROSS JOIN levels l""",
    "shop_link", "levels",
)
SIMPLE = f"stat_date, {L}, card_plan_id"
O["m21_life_cycle_simple"] = sql(
    f"""SELECT {KEYS}, card_plan_id, CAST(grade AS INTEGER) AS grade, {SHOWN} FROM (
    SELECT {SIMPLE}, grade, {sums} FROM simple_rows GROUP BY {SIMPLE}, grade
    UNION ALL SELECT {SIMPLE}, 98, {sums} FROM simple_rows WHERE grade > -1 GROUP BY {SIMPLE}
    UNION ALL SELECT {SIMPLE}, 99, {sums} FROM simple_rows GROUP BY {SIMPLE})""",
    "simple_rows",
)

# Stores

cte(
    "offline",
    f"""SELECT s.card_plan_id, v.plat_code, v.shop_id, v.uni_shop_id, v.uni_id, m.member_id, v.trade_id, v.receive_payment, v.created
    FROM valid v JOIN card_shop s USING (uni_shop_id) LEFT JOIN member m ON m.card_plan_id = s.card_plan_id AND m.member_id = v.uni_id
    WHERE ordered >= DATE '2001-06-01'""",
    "valid", "card_shop", "member",
)
O["o1_offline_trades"] = sql(f"SELECT card_plan_id, uni_shop_id, uni_id, member_id, trade_id, receive_payment, {ts('created')}, {FLAGS} FROM offline", "offline")
cte(
    "any_trades",
    """SELECT o.*, m.grade, m.shop_id AS open_shop_id, m.plat_code AS open_plat FROM offline o JOIN member m ON m.card_plan_id = o.card_plan_id AND m.member_id = o.member_id""",
    "offline", "member",
)
cte("own_trades", "SELECT * FROM any_trades WHERE open_shop_id = shop_id AND open_plat = plat_code", "any_trades")
MT = f"card_plan_id, uni_shop_id, member_id, trade_id, grade, open_shop_id, receive_payment, {ts('created')}"
O["o2_member_trades"] = sql(f"SELECT {MT} FROM own_trades", "own_trades")
O["o2_member_trades_any_shop"] = sql(f"SELECT {MT} FROM any_trades", "any_trades")
cte(
    "spans",
    "SELECT * FROM (VALUES (1, DATE '2001-06-30'), (2, DATE '2001-06-25'), (3, DATE '2001-06-01'), (4, DATE '2001-06-24'), (5, DATE '2001-06-01')) v(date_type, start_)",
)
SPAN = f"JOIN spans ON created >= start_ AND created < {DAY} + 1"
SHOP = "card_plan_id, plat_code, shop_id, uni_shop_id, date_type"
PLAT = "card_plan_id, plat_code, date_type"


def sold(prefix: str) -> str:
    return f"{money('receive_payment')} AS {prefix}total_payment, {big('count(*)', f'{prefix}total_times')}"


for source, prefix, shop, plat in (("offline", "", "o3_sales_by_period", "o3_platform_sales"), ("any_trades", "m", "o4_member_sales_by_period", "o4_member_platform_sales")):
    O[shop] = sql(f"SELECT {SHOP}, {sold(prefix)} FROM {source} {SPAN} GROUP BY {SHOP}", source, "spans")
    O[plat] = sql(f"SELECT {PLAT}, {sold(prefix)} FROM {source} {SPAN} GROUP BY {PLAT}", source, "spans")
for name, source in (("any", "any_trades"), ("own", "own_trades")):
    for level, keys in (("shop", SHOP), ("plat", PLAT)):
        cte(
            f"grade_{level}_{name}",
            f"""SELECT {keys}, grade, {sold('m')} FROM {source} {SPAN} GROUP BY {keys}, grade
            UNION ALL SELECT {keys}, 99, {sold('m')} FROM {source} {SPAN} GROUP BY {keys}""",
            source, "spans",
        )
O["o5_grade_sales_by_period"] = sql("SELECT * FROM grade_shop_any", "grade_shop_any")
O["o6_member_sale_rate"] = sql(
    f"""SELECT {PLAT}, total_payment, mtotal_payment, round(coalesce({div('mtotal_payment', 'total_payment')}, -1), 4) AS sale_rate, total_times, mtotal_times,
    round(coalesce({div('mtotal_times', 'total_times')}, -1), 4) AS times_rate, grade, {STAT}
    FROM (SELECT {PLAT}, {sold('')} FROM offline {SPAN} GROUP BY {PLAT}) JOIN grade_plat_any USING ({PLAT})""",
    "offline", "spans", "grade_plat_any",
)
O["o7_shop_sale_rate"] = sql(
    f"""SELECT a.card_plan_id, a.plat_code, a.uni_shop_id, t.shop_name, a.date_type, coalesce(g.grade, 99) AS grade, total_payment,
    coalesce(mtotal_payment, 0) AS mtotal_payment, coalesce({div('coalesce(mtotal_payment, 0)', 'total_payment')}, -1) AS sale_rate, total_times,
    coalesce(mtotal_times, 0) AS mtotal_times, coalesce({div('coalesce(mtotal_times, 0)', 'total_times')}, -1) AS times_rate, {STAT}
    FROM (SELECT {SHOP}, {sold('')} FROM offline {SPAN} GROUP BY {SHOP}) a JOIN tenant_shop t ON t.uni_shop_id = a.uni_shop_id
    LEFT JOIN grade_shop_own g ON g.card_plan_id = a.card_plan_id AND g.uni_shop_id = a.uni_shop_id AND g.date_type = a.date_type""",
    "offline", "spans", "tenant_shop", "grade_shop_own",
)
growth = ", ".join(
    big(f"count(*) FILTER (created >= DATE '{d}')", name)
    for name, d in (
        ("yesterday", "2001-06-30"), ("this_week", "2001-06-25"), ("this_month", "2001-06-01"), ("this_year", "2001-01-01"),
        ("last_7_days", "2001-06-24"), ("last_30_days", "2001-06-01"), ("last_year", "2000-07-01"),
    )
)
O["o8_member_growth"] = sql(
    f"""SELECT m.card_plan_id, m.plat_code, m.uni_shop_id, shop_name, {big('count(*)', 'members')}, {growth}, {STAT} FROM member m
    JOIN tenant_shop t ON t.uni_shop_id = m.uni_shop_id WHERE created < {DAY} + 1 GROUP BY 1, 2, 3, 4""",
    "member", "tenant_shop",
)


def consumption(source: str, keys: str) -> str:
    cols = f"""count(DISTINCT member_id) AS members, round(sum(receive_payment), 2) AS total_payment,
        count(DISTINCT member_id || '/' || strftime(created, '%Y-%m-%d')) AS total_times"""
    return f"SELECT {keys}, date_type, grade, {cols} FROM {source} {SPAN} GROUP BY ALL UNION ALL SELECT {keys}, date_type, 99, {cols} FROM {source} {SPAN} GROUP BY ALL"


cte("own_spend", consumption("own_trades", "card_plan_id, plat_code, shop_id, uni_shop_id"), "own_trades", "spans")
cte("all_spend", consumption("(SELECT * REPLACE (open_plat AS plat_code) FROM any_trades)", "card_plan_id, plat_code, open_shop_id"), "any_trades", "spans")
AVERAGES = f"{num(div('total_payment', 'members'), 'avg_price')}, {num(div('total_times', 'members'), 'avg_times')}, {num(div('total_payment', 'total_times'), 'single_price')}"
SPEND = f"date_type, grade, {big('members', 'members')}, total_payment, {big('total_times', 'total_times')}, {AVERAGES}"
O["o9_open_shop_consumption"] = sql(f"SELECT card_plan_id, plat_code, shop_id, uni_shop_id, {SPEND} FROM own_spend", "own_spend")
O["o10_all_shop_consumption"] = sql(f"SELECT card_plan_id, plat_code, open_shop_id, {SPEND} FROM all_spend", "all_spend")
cte(
    "member_stock",
    f"""SELECT m.card_plan_id, m.plat_code, m.uni_shop_id, t.shop_id, t.shop_name, g.grade, count(*) AS members FROM member m
    JOIN tenant_shop t ON t.uni_shop_id = m.uni_shop_id CROSS JOIN (VALUES (1), (2), (3), (4), (99)) g(grade)
    WHERE (g.grade = 99 OR g.grade = m.grade) AND created < {DAY} + 1 GROUP BY ALL""",
    "member", "tenant_shop",
)
O["o11_member_stock"] = sql(f"SELECT card_plan_id, plat_code, uni_shop_id, shop_id, shop_name, grade, {big('members', 'members')} FROM member_stock", "member_stock")


def five(alias: str, prefix: str) -> str:
    p, m, t = f"{alias}.total_payment", f"{alias}.members", f"{alias}.total_times"
    return ", ".join(
        [
            big(f"coalesce({m}, 0)", f"{prefix}_members"), num(f"coalesce({p}, 0)", f"{prefix}_payment"), num(f"coalesce({div(p, m)}, 0)", f"{prefix}_avg_price"),
            num(f"coalesce({div(t, m)}, 0)", f"{prefix}_avg_times"), num(f"coalesce({div(p, t)}, 0)", f"{prefix}_single_price"),
        ]
    )


O["o12_consumption_report"] = sql(
    f"""SELECT s.card_plan_id, s.uni_shop_id, s.shop_name, a.date_type, s.grade, {big('s.members', 'store_members')}, {five('o', 'shop')}, {five('a', 'all')},
    CASE WHEN a.total_payment IS NULL THEN -1.0::DOUBLE WHEN o.total_payment IS NULL THEN 0.0::DOUBLE ELSE coalesce({div('o.total_payment', 'a.total_payment')}, -1) END AS payment_rate, {STAT}
    FROM member_stock s LEFT JOIN all_spend a ON a.card_plan_id = s.card_plan_id AND a.plat_code = s.plat_code AND a.open_shop_id = s.shop_id AND a.grade = s.grade
    LEFT JOIN own_spend o ON o.card_plan_id = a.card_plan_id AND o.plat_code = a.plat_code AND o.shop_id = a.open_shop_id AND o.grade = a.grade AND o.date_type = a.date_type""",
    "member_stock", "all_spend", "own_spend",
)
