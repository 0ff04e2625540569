"""Fixed values of the data model."""

# Order statuses that count as a purchase.
ACCEPTED_STATUSES = (
    "WAIT_SELLER_SEND_GOODS",
    "SELLER_CONSIGNED_PART",
    "TRADE_BUYER_SIGNED",
    "WAIT_BUYER_CONFIRM_GOODS",
    "TRADE_FINISHED",
    "PAID_FORBID_CONSIGN",
    "ORDER_RECEIVED",
    "TRADE_PAID",
)

# Statuses of the order funnel.
PAID_STATUSES = (
    "SELLER_CONSIGNED_PART",
    "WAIT_SELLER_SEND_GOODS",
    "WAIT_BUYER_CONFIRM_GOODS",
    "TRADE_BUYER_SIGNED",
    "TRADE_FINISHED",
)
SENT_STATUSES = (
    "SELLER_CONSIGNED_PART",
    "WAIT_BUYER_CONFIRM_GOODS",
    "TRADE_BUYER_SIGNED",
    "TRADE_FINISHED",
)
FINISHED_STATUS = "TRADE_FINISHED"

# Type codes of the report levels.
TENANT, PLATFORM, SHOP = 1, 2, 3

# Sentinels in report rows.
TOTAL = 99
ALL_MEMBERS = 98
NON_MEMBER = -1
UNDEFINED_RATE = -1
ALL_MONTHS = "all"

# Bucket widths.
MONETARY_WIDTHS = (50, 100, 200, 500, 1000, 2000)
POINT_WIDTHS = (100, 200, 500)

# Period codes.
YESTERDAY, THIS_WEEK, THIS_MONTH, LAST_7_DAYS, LAST_30_DAYS = 1, 2, 3, 4, 5

MONEY_DIGITS = 2
RATE_DIGITS = 6

# The most selective key comes first: sorts compare the first column by its prefix.
CUSTOMER_KEYS = ["uni_id", "uni_shop_id", "plat_code", "tenant"]
LEVEL_KEYS = ["type", "tenant", "plat_code", "uni_shop_id"]
