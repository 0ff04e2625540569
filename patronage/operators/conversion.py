"""Conversion of recently joined members into buyers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.constants import ALL_MONTHS, LEVEL_KEYS
from patronage.functions.calendar import is_month_end, shift_months_col
from patronage.functions.expressions import count_if, money_sum
from patronage.operators.levels import LEVELED, decoded, per_level
from patronage.session import laid_by

KEYS = ["stat_date", *LEVEL_KEYS, "card_plan_id"]


def member_year_value(shop_wide: DataFrame, members: DataFrame, card_shop: DataFrame, relation: DataFrame, months: int = 14) -> DataFrame:
    """Members who joined in the last months with their year in each shop of the plan they know.

    Starts from the wide rows, so no member is paired with all shops of a plan. A customer's memberships come as a list, so
    that wide rows that lie by customer, as those of month ends can, meet them without being moved or sorted.
    """
    plans = card_shop.select("card_plan_id", "plat_code", F.concat_ws("|", "plat_code", "shop_id").alias("uni_shop_id"))
    links = relation.select("card_plan_id", "member_id", "uni_id")
    joined = members.select("card_plan_id", "member_id", F.to_date("created").alias("joined"))
    cards = joined.join(links, ["card_plan_id", "member_id"]).groupBy("uni_id").agg(F.collect_list(F.struct("card_plan_id", "member_id", "joined")).alias("cards"))
    rows = (
        shop_wide.select("stat_date", "tenant", "plat_code", "uni_shop_id", "uni_id", "year_payment", "year_buy_times")
        .join(plans, ["plat_code", "uni_shop_id"])
        .join(cards.hint("shuffle_hash"), "uni_id")
    )
    first = shift_months_col(F.col("stat_date"), -months)
    wanted = F.filter("cards", lambda c: (c["card_plan_id"] == F.col("card_plan_id")) & (c["joined"] > first) & (c["joined"] <= F.col("stat_date")))
    recent = rows.withColumn("card", F.explode(wanted)).withColumns({"member_id": F.col("card")["member_id"], "joined": F.col("card")["joined"]})
    return recent.select(
        "stat_date",
        "card_plan_id",
        "member_id",
        F.date_format("joined", "yyyy-MM").alias("join_month"),
        "uni_id",
        "tenant",
        "plat_code",
        "uni_shop_id",
        F.coalesce("year_payment", F.lit(0.0)).alias("payment"),
        F.coalesce("year_buy_times", F.lit(0)).alias("orders"),
        F.least(F.coalesce("year_buy_times", F.lit(0)), F.lit(5)).cast("int").alias("frequency"),
    )


def consume_transform(myv: DataFrame) -> DataFrame:
    """Members, payments and members by order frequency per plan and join month, with an all-months row.

    Each member is summed up once per level before counting, so nobody counts twice at upper levels. Rows move once, by member,
    before they are repeated for the levels.
    """
    keys = ["member_id", "card_plan_id", "join_month", "stat_date", *LEVELED]
    per_member = decoded(
        per_level(laid_by(myv, "member_id")).groupBy(*keys).agg(money_sum(F.col("payment")).alias("payment"), F.sum("orders").alias("orders"))
    )
    frequency = F.least(F.col("orders"), F.lit(5))
    cells = per_member.groupBy(*KEYS, "join_month").agg(
        F.count("member_id").alias("members"),
        money_sum(F.col("payment")).alias("payments"),
        *[count_if(frequency == i).alias(f"f{i}") for i in range(6)],
    )
    keys, month = [F.col(k) for k in KEYS], F.col("join_month")
    totals = ["members", *[f"f{i}" for i in range(6)]]
    report = cells.groupingSets([[*keys, month], keys], *keys, month).agg(
        *[F.sum(c).alias(c) for c in totals], money_sum(F.col("payments")).alias("payments"), F.grouping("join_month").alias("all")
    )
    name = F.when(F.col("all") == 1, ALL_MONTHS).otherwise(month)
    return report.withColumns({"join_month": name, "end_month": is_month_end(F.col("stat_date"))}).drop("all")
