"""Schemas of hand-made rows and small helpers that several test modules use."""

from datetime import datetime

TRADE = (
    "tenant string, plat_code string, uni_shop_id string, uni_id string, trade_id long, receive_payment double, "
    "product_num int, created timestamp_ntz"
)
CUSTOMER = "tenant string, plat_code string, uni_shop_id string, uni_id string, modified timestamp_ntz"


def at(text):
    return datetime.fromisoformat(text)


def same(a, b, cols=None):
    """Both have the same rows, in any order."""
    cols = sorted(cols or a.columns)
    rows = [sorted(map(str, (tuple(r) for r in df.select(*cols).collect()))) for df in (a, b)]
    assert rows[0] == rows[1]
