"""Member points and grades per membership plan and reporting period.

Weeks start on Monday, or with `anchored_week` on the year-anchored weekday.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.constants import NON_MEMBER, POINT_WIDTHS, TOTAL
from patronage.functions.buckets import point_bucket
from patronage.functions.calendar import explode_periods, in_period, period_starts, until
from patronage.functions.expressions import count_if, rate

CELL = ["card_plan_id", "rangetype"]


def valid_points(points: DataFrame, day: date) -> DataFrame:
    """Points in force on the day."""
    started = until(F.col("effective_date"), day)
    return points.filter(started & ~until(F.col("overdue_date"), day) & (F.col("valid") == 1))


def point_distribution(points: DataFrame, day: date, widths: tuple[int, ...] = POINT_WIDTHS) -> DataFrame:
    """Members per plan, bucket and width, with their share of the plan."""
    marks = [F.struct(F.lit(w).alias("interval_type"), point_bucket(F.col("point"), F.lit(w)).alias("mptype")) for w in widths]
    marked = valid_points(points, day).withColumn("mark", F.explode(F.array(*marks)))
    cells = marked.groupBy("card_plan_id", "mark.mptype", "mark.interval_type").agg(F.count("member_id").alias("members"))
    plan = F.sum("members").over(Window.partitionBy("card_plan_id", "interval_type"))
    return cells.withColumn("member_rate", rate(F.col("members"), plan)).withColumn("stat_date", F.lit(day))


def point_stock(points: DataFrame, day: date) -> DataFrame:
    """Points in force per plan."""
    return valid_points(points, day).groupBy("card_plan_id").agg(F.sum("point").alias("points"))


def point_change_members(changes: DataFrame, day: date, inclusive: bool = True, anchored_week: bool = False) -> DataFrame:
    """Distinct members with a change per plan and period."""
    hits = explode_periods(changes, "change_time", day, inclusive, anchored_week)
    return hits.groupBy(*CELL).agg(F.countDistinct("member_id").alias("members"))


def point_flow(changes: DataFrame, day: date, inclusive: bool = True, anchored_week: bool = False) -> DataFrame:
    """Points issued and consumed per plan and period."""
    value = F.col("change_value")
    return explode_periods(changes, "change_time", day, inclusive, anchored_week).groupBy(*CELL).agg(
        F.coalesce(F.sum(F.when(value >= 0, value)), F.lit(0)).alias("send_points"),
        F.abs(F.coalesce(F.sum(F.when(value < 0, value)), F.lit(0))).alias("consume_points"),
    )


def overdue_points(points: DataFrame, day: date, inclusive: bool = True, anchored_week: bool = False) -> DataFrame:
    """Points that expired per plan and period."""
    expired = points.filter(F.col("valid") == 0)
    return explode_periods(expired, "overdue_date", day, inclusive, anchored_week).groupBy(*CELL).agg(F.sum("point").alias("overdue_points"))


def new_members(members: DataFrame, day: date, inclusive: bool = True, anchored_week: bool = False) -> DataFrame:
    """Members that joined per plan and period."""
    return explode_periods(members, "created", day, inclusive, anchored_week).groupBy(*CELL).agg(F.count("member_id").alias("newmembers"))


def grade_moves(grade_log: DataFrame, day: date, inclusive: bool = True, anchored_week: bool = False) -> DataFrame:
    """Members whose latest move in the period went up or down."""
    moves = explode_periods(grade_log.filter(F.col("change_type").isin("UP", "DOWN")), "change_time", day, inclusive, anchored_week)
    latest = moves.groupBy(*CELL, "member_id").agg(
        F.max_by("change_type", F.struct("change_time", "change_id")).alias("change_type")
    )
    return latest.groupBy(*CELL).agg(
        count_if(F.col("change_type") == "UP").alias("upnums"), count_if(F.col("change_type") == "DOWN").alias("downnums")
    )


def plan_period_scaffold(members: DataFrame) -> DataFrame:
    """Every plan with every period, so that empty cells appear."""
    return members.select("card_plan_id").distinct().withColumn("rangetype", F.explode(F.array(*[F.lit(i) for i in range(1, 6)])))


def point_grade_report(
    members: DataFrame, changes: DataFrame, points: DataFrame, grade_log: DataFrame, day: date, inclusive: bool = True, anchored_week: bool = False
) -> DataFrame:
    stock = point_stock(points, day).withColumnRenamed("points", "effect_points")
    parts = [
        point_change_members(changes, day, inclusive, anchored_week).withColumnRenamed("members", "point_change_nums"),
        point_flow(changes, day, inclusive, anchored_week),
        overdue_points(points, day, inclusive, anchored_week),
        new_members(members, day, inclusive, anchored_week),
        grade_moves(grade_log, day, inclusive, anchored_week),
    ]
    report = plan_period_scaffold(members).join(stock, "card_plan_id", "left")
    for part in parts:
        report = report.join(part, CELL, "left")
    filled = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in report.columns if c not in CELL]
    return report.select(*CELL, *filled, F.lit(day).alias("stat_date"))


def first_grades(grade_log: DataFrame, starts: dict[int, date], day: date) -> DataFrame:
    """Per member, the grade before the first change of each period."""
    order = F.struct("change_time", "change_id")

    def before(start: date) -> Column:
        hit = in_period(F.col("change_time"), start, day)
        return F.min_by(F.when(hit, F.col("grade_before_change")), F.when(hit, order))

    recent = grade_log.filter(in_period(F.col("change_time"), min(starts.values()), day))
    return recent.groupBy("card_plan_id", "member_id").agg(*[before(s).alias(f"before_{p}") for p, s in starts.items()])


def grade_matrix(
    members: DataFrame, grade_log: DataFrame, day: date, inclusive: bool = True, periods: list[int] | None = None, anchored_week: bool = False
) -> DataFrame:
    """Members by grade now and grade before the period, with totals on both axes.

    Members that joined within the period were non-members before it. All periods come from one join.
    """
    starts = {p: s for p, s in period_starts(day, inclusive, anchored_week).items() if not periods or p in periods}
    known = members.filter(until(F.col("created"), day)).select("card_plan_id", "member_id", "grade", "created")
    joined = known.join(first_grades(grade_log, starts, day), ["card_plan_id", "member_id"], "left")

    def old(p: int, start: date) -> Column:
        grade = F.when(F.col("created") >= F.lit(start), F.lit(NON_MEMBER)).otherwise(F.coalesce(f"before_{p}", "grade"))
        return F.struct(F.lit(p).alias("rangetype"), grade.alias("oldgrade"))

    marked = joined.withColumn("mark", F.explode(F.array(*[old(p, s) for p, s in starts.items()])))
    cells = marked.groupBy("card_plan_id", "mark.rangetype", F.col("grade").alias("nowgrade"), "mark.oldgrade").agg(
        F.count("member_id").alias("members")
    )
    keys = [F.col(c) for c in CELL]
    now, before = F.col("nowgrade"), F.col("oldgrade")
    grouped = cells.groupingSets(
        [[*keys, now, before], [*keys, now], [*keys, before], keys], *keys, now, before
    ).agg(F.sum("members").alias("members"), F.grouping("nowgrade").alias("all_now"), F.grouping("oldgrade").alias("all_old"))
    return grouped.select(
        *CELL,
        F.when(F.col("all_now") == 1, TOTAL).otherwise(now).alias("nowgrade"),
        F.when(F.col("all_old") == 1, TOTAL).otherwise(before).alias("oldgrade"),
        "members",
    )


def grade_matrix_report(members: DataFrame, grade_log: DataFrame, day: date, inclusive: bool = True, anchored_week: bool = False) -> DataFrame:
    return grade_matrix(members, grade_log, day, inclusive, anchored_week=anchored_week).withColumn("stat_date", F.lit(day))
