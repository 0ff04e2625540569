"""Common table expressions over the raw tables, written independently of the Spark code."""

DAY = "DATE '2001-06-30'"
ACTION_DAY = "DATE '2024-01-31'"
LAST_RUN = "DATE '2001-05-31'"

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (body, needs)


def sql(body: str, *needs: str) -> str:
    """A statement with the expressions it needs, each after those it depends on."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for need in CTES[name][1]:
            visit(need)
        order.append(name)

    for need in needs:
        visit(need)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order) + "\n" + body


def ts(col: str, name: str | None = None) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S') AS {name or col.split('.')[-1]}"


def dt(col: str, name: str | None = None) -> str:
    return f"strftime({col}, '%Y-%m-%d') AS {name or col.split('.')[-1]}"


def big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def num(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


def r6(expr: str, name: str) -> str:
    """For values whose last digits depend on the order of additions."""
    return f"round(CAST({expr} AS DOUBLE), 6) AS {name}"


def div(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) <> 0 THEN CAST({a} AS DOUBLE) / ({b}) END)"


def money(expr: str) -> str:
    return f"round(sum({expr}), 2)"


def cents(expr: str, scale: int = 10000) -> str:
    return f"(CAST((({expr}) + {scale // 200}) // {scale // 100} AS DOUBLE) / 100)"


K = "tenant, plat_code, uni_shop_id, uni_id"
L = "type, tenant, plat_code, uni_shop_id"
STAT = "'2001-06-30' AS stat_date"

cte(
    "tenant_shop",
    """SELECT 'T' || n_regionkey AS tenant, n_name AS plat_code, CAST(s_suppkey AS VARCHAR) AS shop_id, s_name AS shop_name,
       n_name || '|' || s_suppkey AS uni_shop_id, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
cte(
    "lines",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INTEGER) AS quantity,
       CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) AS net,
       CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT) AS discount,
       l_returnflag, l_shipdate FROM lineitem""",
)
cte(
    "order_shop",
    """SELECT l_orderkey, l_suppkey, CAST(sum(net) AS BIGINT) AS net, CAST(sum(discount) AS BIGINT) AS discount,
       CAST(sum(net) FILTER (l_returnflag = 'R') AS BIGINT) AS returned, CAST(sum(quantity) AS INTEGER) AS product_num,
       min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lines GROUP BY ALL""",
    "lines",
)
cte(
    "trade",
    f"""SELECT tenant, plat_code, shop_id, uni_shop_id, CAST(o_custkey AS VARCHAR) AS uni_id, o_orderkey AS trade_id,
       {cents('net')} AS payment, {cents('returned', 20000)} AS refund_fee, product_num,
       o_orderpriority = '1-URGENT' AS presale, o_orderdate AS ordered, first_ship AS pay_time,
       o_orderstatus IN ('F', 'O') AS accepted, greatest(o_orderdate, first_ship) AS arrived
       FROM order_shop JOIN orders ON l_orderkey = o_orderkey JOIN tenant_shop ON l_suppkey = s_suppkey""",
    "order_shop",
    "tenant_shop",
)
cte(
    "usable",
    """SELECT tenant, plat_code, shop_id, uni_shop_id, uni_id, trade_id, round(payment - coalesce(refund_fee, 0), 2) AS receive_payment,
       product_num, CASE WHEN presale THEN coalesce(pay_time, ordered) ELSE ordered END AS created, ordered, arrived
       FROM trade WHERE accepted""",
    "trade",
)
cte("valid", f"SELECT * FROM usable WHERE ordered < {DAY} + 1", "usable")


def customers(condition: str) -> str:
    return f"""SELECT u.*, CAST(DATE '1995-01-01' + CAST(CAST(uni_id AS BIGINT) % 1000 AS INTEGER) AS TIMESTAMP) AS modified FROM (
       SELECT DISTINCT tenant, plat_code, uni_shop_id, uni_id FROM trade WHERE {condition}
       UNION SELECT tenant, plat_code, uni_shop_id, CAST(c_custkey AS VARCHAR)
       FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN (SELECT *, row_number() OVER (PARTITION BY plat_code ORDER BY s_suppkey) - 1 AS place, count(*) OVER (PARTITION BY plat_code) AS shops
             FROM tenant_shop) s ON plat_code = n_name AND c_custkey % shops = place) u"""


cte("customers", customers("true"), "trade")
cte("customers_yesterday", customers(f"arrived < {DAY}"), "trade")
cte("customers_today", customers(f"arrived < {DAY} + 1"), "trade")
cte("customers_last_run", customers(f"arrived < {LAST_RUN} + 1"), "trade")

cte("levels", "SELECT * FROM (VALUES (1), (2), (3)) v(type)")


def at_level(cols: str, source: str) -> str:
    return f"""SELECT type, tenant, CASE WHEN type >= 2 THEN plat_code END AS plat_code,
       CASE WHEN type = 3 THEN uni_shop_id END AS uni_shop_id, uni_id, plat_code AS p0, uni_shop_id AS s0, {cols}
       FROM {source} CROSS JOIN levels"""


def months_back(day: str, n: int) -> str:
    """Shift back by months; the last day of a month stays the last day."""
    moved = f"CAST({day} - INTERVAL {n} MONTH AS DATE)"
    return f"(CASE WHEN last_day({day}) = {day} THEN last_day({moved}) ELSE {moved} END)"


def snaps(days: str) -> str:
    return f"""SELECT stat_date, {months_back('stat_date', 12)} + 1 AS year_start, {months_back('stat_date', 24)} + 1 AS tyear_start,
       stat_date + 1 AS end_ FROM ({days}) x"""


cte("snap_today", snaps(f"SELECT {DAY} AS stat_date"))
cte("snap_yesterday", snaps(f"SELECT {DAY} - 1 AS stat_date"))
cte("ends", f"SELECT last_day(CAST({DAY} - INTERVAL (i) MONTH AS DATE)) AS stat_date FROM range(1, 14) r(i)")
cte("snap_ends", snaps("SELECT stat_date FROM ends"), "ends")
cte("snap_ends_today", snaps(f"SELECT stat_date FROM ends UNION ALL SELECT {DAY}"), "ends")

MEASURES = [f"{p}_{u}" for p in ("year", "tyear", "btyear") for u in ("payment", "buy_times", "buy_num")]
WINDOW = {
    "year": "created >= year_start",
    "tyear": "created >= tyear_start AND created < year_start",
    "btyear": "created < tyear_start",
}


def wide_cte(name: str, trades: str, known: str, snap: str) -> None:
    """Wide rows of the three levels straight from the trades of each level."""
    cte(f"{name}_lv", at_level("trade_id, receive_payment, product_num, created", trades), trades, "levels")
    aggs = []
    for p, w in WINDOW.items():
        aggs += [
            f"round(sum(receive_payment) FILTER ({w}), 2) AS {p}_payment",
            f"CAST(count(*) FILTER ({w}) AS BIGINT) AS {p}_buy_times",
            f"CAST(sum(product_num) FILTER ({w}) AS BIGINT) AS {p}_buy_num",
        ]
    cte(
        f"{name}_rank",
        f"""SELECT t.*, s.*, row_number() OVER (PARTITION BY stat_date, {L}, uni_id ORDER BY created, p0, s0, trade_id) AS rn
        FROM {name}_lv t JOIN {snap} s ON created < end_""",
        f"{name}_lv",
        snap,
    )
    cte(
        f"{name}_m",
        f"""SELECT stat_date, {L}, uni_id, max(created) FILTER (rn = 1) AS first_buy_time, max(receive_payment) FILTER (rn = 1) AS first_payment,
        max(trade_id) FILTER (rn = 1) AS first_trade_id, max(created) FILTER (rn = 2) AS second_buy_time, {', '.join(aggs)},
        min(created) FILTER (created >= year_start) AS year_first_time, max(created) FILTER (created >= year_start) AS year_last_time
        FROM {name}_rank GROUP BY stat_date, {L}, uni_id""",
        f"{name}_rank",
    )
    cte(f"{name}_cu", f"SELECT {L}, uni_id, min(modified) AS modified FROM ({at_level('modified', known)}) GROUP BY ALL", known, "levels")
    zero = ", ".join(f"coalesce(m.{c}, 0) AS {c}" for c in MEASURES)
    same = " AND ".join(f"c.{c} IS NOT DISTINCT FROM m.{c}" for c in ("type", "tenant", "plat_code", "uni_shop_id", "uni_id"))
    cte(
        name,
        f"""SELECT c.type, c.tenant, c.plat_code, c.uni_shop_id, c.uni_id, c.stat_date, c.year_start, c.tyear_start,
        least(m.first_buy_time, c.modified) AS earliest_time, m.first_buy_time, coalesce(m.first_payment, 0) AS first_payment,
        m.first_trade_id, m.second_buy_time, {zero}, m.year_first_time, m.year_last_time
        FROM (SELECT * FROM {name}_cu CROSS JOIN {snap}) c LEFT JOIN {name}_m m ON {same} AND c.stat_date = m.stat_date""",
        f"{name}_cu",
        f"{name}_m",
        snap,
    )


wide_cte("wide", "valid", "customers", "snap_today")
wide_cte("history", "valid", "customers", "snap_ends")


def wide_columns(skip: tuple[str, ...] = ()) -> str:
    out = ["tenant", "plat_code", "uni_shop_id", "uni_id", ts("earliest_time"), ts("first_buy_time"), num("first_payment", "first_payment")]
    out += [ts("second_buy_time"), ts("year_first_time"), ts("year_last_time"), dt("stat_date")]
    for m in MEASURES:
        out.append(num(m, m) if m.endswith("payment") else big(m, m))
    return ", ".join(c for c in out if c.split(" AS ")[-1] not in skip)


def snapshot_rows(source: str, with_type: bool) -> str:
    return f"SELECT {'type, ' * with_type}{wide_columns()} FROM {source}"
