"""Customer life cycle per membership plan and grade."""

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.constants import ALL_MEMBERS, LEVEL_KEYS, NON_MEMBER, PLATFORM, SHOP, TOTAL
from patronage.functions.calendar import is_month_end
from patronage.functions.expressions import count_if
from patronage.operators.assets import bought_by, new_in_year
from patronage.operators.levels import LEVELED, coded, decoded, per_level
from patronage.operators.rfm_wide import each_day, month_end_parts

KEYS = ["stat_date", *LEVEL_KEYS]
CLASSES = ("prospective", "active_new", "phurce_new", "active_old", "phurce_old", "silent", "loss")
COUNTS = [*CLASSES, "whole"]
CARD = "struct<card_plan_id: string, member_id: string, grade: int>"


def life_cycle_class() -> Column:
    year, tyear, btyear = F.col("year_buy_times"), F.col("tyear_buy_times"), F.col("btyear_buy_times")
    new = new_in_year()
    return (
        F.when(~bought_by(F.col("stat_date")), "prospective")
        .when((year == 1) & new, "active_new")
        .when((year >= 2) & new, "phurce_new")
        .when((year == 1) & ~new, "active_old")
        .when((year >= 2) & ~new, "phurce_old")
        .when((year == 0) & (tyear >= 1), "silent")
        .when((year == 0) & (tyear == 0) & (btyear >= 1), "loss")
        .otherwise("prospective")
    )


def plan_shops(card_shop: DataFrame) -> DataFrame:
    return card_shop.select("card_plan_id", "plat_code", F.concat_ws("|", "plat_code", "shop_id").alias("uni_shop_id")).distinct()


def member_grades(members: DataFrame, relation: DataFrame) -> DataFrame:
    """Customers with the plan, grade and joining day of their membership."""
    known = members.filter(F.col("card_plan_id").isNotNull() & F.col("member_id").isNotNull() & F.col("grade").isNotNull())
    base = known.select("card_plan_id", "member_id", "grade", F.to_date("created").alias("joined"))
    return base.join(relation.select("card_plan_id", "member_id", "uni_id"), ["card_plan_id", "member_id"])


def memberships(wide: DataFrame, card_shop: DataFrame, members: DataFrame, relation: DataFrame) -> DataFrame:
    """Plan, member and grade of shop customers who joined the shop's plan by the snapshot day."""
    rows = wide.filter(F.col("type") == SHOP).select("stat_date", "tenant", "plat_code", "uni_shop_id", "uni_id")
    grades = member_grades(members, relation)
    joined = rows.join(plan_shops(card_shop), ["uni_shop_id", "plat_code"]).join(grades, ["uni_id", "card_plan_id"])
    return joined.filter(F.col("joined") <= F.col("stat_date")).drop("joined")


def customers_with_cards(wide: DataFrame, card_shop: DataFrame, members: DataFrame, relation: DataFrame) -> DataFrame:
    """One row per customer and level with class and the list of memberships.

    Shop rows are those of shops with a plan. Above the shop level a customer keeps the memberships
    seen in the shops below. A customer has a handful of cards, so the list stays short. The wide rows, one per
    customer, level and snapshot, are read once and stay together by customer: shop rows find their plans, a window hands
    these on to the levels above, and behind it each row picks its cards among the customer's.
    """
    is_shop = F.col("type") == SHOP
    rows = coded(wide.withColumn("class", life_cycle_class()).select(*KEYS, "uni_id", "class"))
    plans = _plans_of_shops(card_shop)
    # Rows above the shop level have no shop to look up; the customer stands in, so that they don't share one empty key.
    shop = F.when(is_shop, F.col("level_shop")).otherwise(F.concat(F.lit("\u0001"), "uni_id"))
    placed = rows.join(plans, shop == F.col("plan_shop"), "left").filter(~is_shop | (F.size("plans") > 0))
    # Plans by platform of all shops where the customer is known; one window, as its groups cost more than their rows.
    place = F.when(is_shop, F.struct("level_plat", "plans"))
    leveled = placed.withColumn("places", F.collect_set(place).over(Window.partitionBy("uni_id", "tenant", "stat_date")))
    held = leveled.drop("plan_shop").join(_own_cards(members, relation), "uni_id", "left")
    below = F.when(F.col("type") == PLATFORM, F.filter("places", lambda p: p["level_plat"] == F.col("level_plat"))).otherwise(F.col("places"))
    seen = F.when(is_shop, F.col("plans")).otherwise(F.flatten(below["plans"]))
    mine = F.filter("own", lambda c: F.array_contains(seen, c["card_plan_id"]))
    return decoded(held.withColumn("cards", _joined_by(mine, F.col("stat_date"))).drop("own", "places", "plans"))


def _plans_of_shops(card_shop: DataFrame) -> DataFrame:
    return plan_shops(card_shop).groupBy(F.col("uni_shop_id").alias("plan_shop")).agg(F.collect_set("card_plan_id").alias("plans"))


def _own_cards(members: DataFrame, relation: DataFrame) -> DataFrame:
    """All cards of a customer with the day of joining."""
    return member_grades(members, relation).groupBy("uni_id").agg(F.collect_set(F.struct("card_plan_id", "member_id", "grade", "joined")).alias("own"))


def _joined_by(cards: Column, day: Column) -> Column:
    """The cards held on the day. A customer can have joined a plan twice with the same card."""
    held = F.filter(cards, lambda c: c["joined"] <= day)
    card = F.transform(held, lambda c: F.struct(c["card_plan_id"].alias("card_plan_id"), c["member_id"].alias("member_id"), c["grade"].alias("grade")))
    # Most customers of a shop have no card of its plan.
    return F.when(F.size(cards) > 0, F.array_distinct(card)).otherwise(F.array().cast(f"array<{CARD}>"))


def month_ends_with_cards(
    customers: DataFrame, trades: DataFrame, days: list[date], card_shop: DataFrame, members: DataFrame, relation: DataFrame
) -> DataFrame:
    """The rows of `customers_with_cards` over the wide rows of several month ends.

    Which cards a customer has, and which of them the shops where the customer is known take, is the same at all month ends.
    So customers carry their cards in each shop up to the levels, before any row is repeated for the days; a day leaves out
    those joined later.
    """
    held = customers.join(_plans_of_shops(card_shop), F.col("uni_shop_id") == F.col("plan_shop"), "left").join(_own_cards(members, relation), "uni_id", "left")
    taken = F.filter("own", lambda c: F.array_contains("plans", c["card_plan_id"]))
    carrying = held.withColumns({"cards": taken, "planned": F.coalesce(F.size("plans") > 0, F.lit(False))}).drop("plan_shop", "plans", "own")
    beside = {"cards": F.array_distinct(F.flatten(F.collect_list("cards"))), "planned": F.max("planned")}
    shop, upper = month_end_parts(carrying, trades, days, beside)
    wide = decoded(each_day(shop.filter("planned"), days).unionByName(each_day(upper, days)))
    return wide.select(*KEYS, "uni_id", life_cycle_class().alias("class"), _joined_by(F.col("cards"), F.col("stat_date")).alias("cards"))


def customer_member_link(wide: DataFrame, card_shop: DataFrame, members: DataFrame, relation: DataFrame) -> DataFrame:
    """Every customer of a level with class, plan and grade; null plan for non-members."""
    rows = customers_with_cards(wide, card_shop, members, relation)
    return rows.select(*KEYS, "uni_id", "class", F.explode_outer("cards").alias("card")).select(*KEYS, "uni_id", "class", "card.*")


def _class_counts() -> list[Column]:
    return [*[count_if(F.col("class") == c).alias(c) for c in CLASSES], F.count("*").alias("whole")]


def _cells(customers: DataFrame) -> DataFrame:
    """Customers per plan and grade, and all customers in the cell without plan and grade."""
    plan = F.array_distinct(F.transform("cards", lambda c: F.struct(c["card_plan_id"].alias("card_plan_id"), c["grade"].alias("grade"))))
    everybody = F.array(F.struct(F.lit(None).cast("string").alias("card_plan_id"), F.lit(None).cast("int").alias("grade")))
    spread = customers.withColumn("cell", F.explode(F.when(F.size("cards") > 0, F.concat(everybody, plan)).otherwise(everybody))).select(*KEYS, "class", "cell.*")
    return spread.groupBy(*KEYS, "card_plan_id", "grade").agg(*_class_counts())


def life_cycle_by_grade(customers: DataFrame) -> DataFrame:
    """Distinct member customers per plan and grade, by class."""
    return _cells(customers).filter(F.col("grade").isNotNull())


def _plans(customers: DataFrame) -> DataFrame:
    """Per plan the rows of its grades, the sums over them and the counts of all customers."""
    cells = _cells(customers)
    entity = Window.partitionBy(*KEYS)
    everybody = F.col("grade").isNull()
    placed = cells.withColumns(
        {
            **{f"all_{c}": F.max(F.when(everybody, F.col(c))).over(entity) for c in COUNTS},
            "grades": F.count("grade").over(entity),
        }
    )
    # All customers stand alone only where there is no member at all.
    kept = placed.filter(~everybody | (F.col("grades") == 0))
    cell = F.struct("grade", *COUNTS)
    return kept.groupBy(*KEYS, "card_plan_id").agg(
        F.collect_list(F.when(F.col("grade").isNotNull(), cell)).alias("rows"),
        *[F.sum(F.when(F.col("grade").isNotNull(), F.col(c))).alias(f"member_{c}") for c in COUNTS],
        *[F.max(f"all_{c}").alias(f"all_{c}") for c in COUNTS],
    )


def _row(grade: int, pick) -> Column:
    return F.struct(F.lit(grade).alias("grade"), *[pick(c).alias(c) for c in COUNTS])


def _total_rows() -> Column:
    member = _row(ALL_MEMBERS, lambda c: F.col(f"member_{c}"))
    everybody = _row(TOTAL, lambda c: F.col(f"all_{c}"))
    others = _row(NON_MEMBER, lambda c: F.col(f"all_{c}") - F.coalesce(f"member_{c}", F.lit(0)))
    return F.when(F.col("member_whole").isNull(), F.array(everybody, others)).otherwise(F.array(member, everybody, others))


def _spread(plans: DataFrame, rows: Column) -> DataFrame:
    return plans.select(*KEYS, "card_plan_id", F.explode(rows).alias("row")).select(*KEYS, "card_plan_id", "row.*")


def life_cycle_totals(customers: DataFrame) -> DataFrame:
    """Rows of all members, all customers and non-members of each plan."""
    return _spread(_plans(customers), _total_rows())


def life_cycle_report(wide: DataFrame, card_shop: DataFrame, members: DataFrame, relation: DataFrame) -> DataFrame:
    """Grade rows and totals of all levels in one pass over the customers."""
    return _report(customers_with_cards(wide, card_shop, members, relation))


def life_cycle_history(
    customers: DataFrame, trades: DataFrame, days: list[date], card_shop: DataFrame, members: DataFrame, relation: DataFrame
) -> DataFrame:
    """The report of several month ends, from customers and trades: the rows of `life_cycle_report` over their wide rows."""
    return _report(month_ends_with_cards(customers, trades, days, card_shop, members, relation))


def _report(customers: DataFrame) -> DataFrame:
    plans = _plans(customers)
    report = _spread(plans, F.concat(F.col("rows"), _total_rows()))
    return report.withColumn("end_month", is_month_end(F.col("stat_date")))


def life_cycle_simple(wide: DataFrame, card_shop: DataFrame, members: DataFrame, relation: DataFrame) -> DataFrame:
    """Older form: grade rows, one non-member row without plan, totals, and shop rows summed upward."""
    rows = wide.filter(F.col("type") == SHOP).withColumn("class", life_cycle_class()).select(*KEYS, "uni_id", "class")
    held = memberships(wide, card_shop, members, relation).select(
        "stat_date", "tenant", "plat_code", "uni_shop_id", "uni_id", "card_plan_id", "grade"
    ).distinct()
    on = ["uni_id", "uni_shop_id", "plat_code", "tenant", "stat_date"]
    marked = rows.join(held, on, "left").withColumn("grade", F.coalesce("grade", F.lit(NON_MEMBER)))
    shop = marked.groupBy(*KEYS, "card_plan_id", "grade").agg(*_class_counts())
    sums = [F.sum(c).alias(c) for c in COUNTS]
    leveled = per_level(shop.drop("type")).groupBy("stat_date", *LEVELED, "card_plan_id", "grade").agg(*sums)
    grade_rows = decoded(leveled)
    by_plan = [*KEYS, "card_plan_id"]
    member_rows = grade_rows.filter(F.col("grade") != NON_MEMBER).groupBy(*by_plan).agg(*sums).withColumn("grade", F.lit(ALL_MEMBERS))
    all_rows = grade_rows.groupBy(*by_plan).agg(*sums).withColumn("grade", F.lit(TOTAL))
    return grade_rows.unionByName(member_rows).unionByName(all_rows)
