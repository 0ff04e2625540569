"""Labels from the social action log."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions.calendar import in_period
from patronage.functions.expressions import count_if, ratio
from patronage.sources.cleaning import actions_since

USER = ["subject_id", "sub_id", "user_id"]
CONTENT = ["business_id", "business_action"]

# Weights of the scores.
TOTAL_WEIGHT, SPREAD_WEIGHT, MEAN_WEIGHT, PEAK_WEIGHT = 0.4, 0.4, 0.1, 0.1
OPEN_WEIGHT, SHARE_WEIGHT = 0.95, 0.05


def terms(total: Column, spread: Column, mean: Column, peak: Column) -> Column:
    def log(x: Column) -> Column:
        return F.log(x.cast("double") + 1)

    return TOTAL_WEIGHT * log(total) + SPREAD_WEIGHT * log(spread) + MEAN_WEIGHT * log(mean) + PEAK_WEIGHT * log(peak)


def score(weighted: Column) -> Column:
    return F.pow(weighted, F.lit(2.0)) * 10


def communication(actions: DataFrame, day: date) -> DataFrame:
    """Shares, shared contents, mean and largest number of shares per content.

    Contents are grouped first, so counting them needs no distinct set; a content with a missing
    part is shared but not counted as a content.
    """
    shares = actions_since(actions, day, action="SHARE")
    per_content = shares.groupBy(*USER, *CONTENT).agg(F.count("action_time").alias("times"))
    whole = F.col("business_id").isNotNull() & F.col("business_action").isNotNull()
    users = per_content.groupBy(*USER).agg(
        F.sum("times").alias("share_total_times"),
        count_if(whole).alias("share_content_num"),
        F.max("times").alias("max_share_times"),
    )
    total, contents = F.col("share_total_times"), F.col("share_content_num")
    mean = users.withColumn("avg_share_times", ratio(total, contents))
    weighted = terms(total, contents, F.col("avg_share_times"), F.col("max_share_times"))
    return mean.withColumn("communication", score(weighted))


def influence(actions: DataFrame, shared: DataFrame, day: date) -> DataFrame:
    """How others open a user's shares, blended with the user's own sharing."""
    opens = actions_since(actions, day, action="OPEN_SHARE")
    owner = ["subject_id", "sub_id", "relate_userid"]
    base = opens.groupBy(*owner, "user_id", *CONTENT).agg(F.count("action_time").alias("times"))
    people = base.groupBy(*owner, "user_id").agg(F.sum("times").alias("times")).groupBy(*owner).agg(
        F.sum("times").alias("open_times"), F.count("user_id").alias("open_users")
    )
    peaks = base.groupBy(*owner, *CONTENT).agg(F.sum("times").alias("times")).groupBy(*owner).agg(
        F.max("times").alias("max_open_times")
    )
    opened = people.join(peaks, owner).withColumnRenamed("relate_userid", "user_id")
    opened = opened.withColumn("avg_times", ratio(F.col("open_times"), F.col("open_users")))
    both = opened.join(shared.select(*USER, "share_total_times", "share_content_num", "avg_share_times", "max_share_times"), USER, "full")

    def zero(c: str) -> Column:
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0))

    open_part = terms(zero("open_times"), zero("open_users"), zero("avg_times"), zero("max_open_times"))
    share_part = terms(zero("share_total_times"), zero("share_content_num"), zero("avg_share_times"), zero("max_share_times"))
    return both.select(
        *USER,
        "open_times",
        "open_users",
        "avg_times",
        "max_open_times",
        score(OPEN_WEIGHT * open_part + SHARE_WEIGHT * share_part).alias("influence"),
    )


def activity(actions: DataFrame, day: date) -> DataFrame:
    """Active days, actions, mean per day and busiest day."""
    daily = actions_since(actions, day).groupBy(*USER, F.to_date("action_time").alias("action_day")).agg(
        F.count("action_time").alias("times")
    )
    users = daily.groupBy(*USER).agg(
        F.count("action_day").alias("active_days"), F.sum("times").alias("active_times"), F.max("times").alias("max_active_times")
    )
    days, times = F.col("active_days"), F.col("active_times")
    mean = users.withColumn("avg_active_times", ratio(times, days))
    return mean.withColumn("activity", score(terms(days, times, F.col("avg_active_times"), F.col("max_active_times"))))


def interest_type(actions: DataFrame, day: date, days: int = 30) -> DataFrame:
    """1 potential, 2 aware, 3 interested, from reads, visits and shares of the last days."""
    recent = actions.filter(
        in_period(F.col("action_time"), day - timedelta(days=days), day) & F.col("action").isin("READ", "VISIT", "SHARE")
    )
    counts = recent.groupBy(*USER).agg(
        count_if((F.col("source") == "mp") & (F.col("action") == "READ")).alias("reads"),
        count_if((F.col("source") == "mini") & (F.col("action") == "VISIT")).alias("visits"),
        count_if(F.col("action") == "SHARE").alias("shares"),
    )
    reads, visits, shares = F.col("reads"), F.col("visits"), F.col("shares")
    kind = F.when((reads == 1) | (visits == 1), 2).when((reads > 1) | (visits > 1) | (shares >= 1), 3).otherwise(1)
    return counts.select(*USER, kind.alias("customer_type"))


def shop_label(
    members: DataFrame, profile: DataFrame, shared: DataFrame, influenced: DataFrame, active: DataFrame, interest: DataFrame
) -> DataFrame:
    """Labels per shop member; a mobile number, a subscription or an order makes a fan (4)."""
    keys = ["company", "shop_id", "openid"]

    def by_member(df: DataFrame, *cols: str) -> DataFrame:
        names = [F.col(a).alias(b) for a, b in zip(USER, keys)]
        return df.select(*names, *cols)

    joined = members.join(profile, keys, "left")
    for part, col in ((interest, "customer_type"), (influenced, "influence"), (active, "activity"), (shared, "communication")):
        joined = joined.join(by_member(part, col), keys, "left")
    fan = (F.length("auth_mobile") > 0) | (F.col("subscribe") == 1) | (F.col("placed") == 1)
    kind = F.when(fan, 4).otherwise(F.coalesce("customer_type", F.lit(1)))
    return joined.select(
        "company",
        "uni_customer_id",
        "shop_id",
        "appid",
        "openid",
        "first_cognitive_time",
        "first_cognitive_scene",
        "last_active_time",
        "last_active_scene",
        "subscribe",
        "last_subscribe_time",
        "last_subscribe_scene",
        "first_subscribe",
        kind.alias("customer_type"),
        *[F.coalesce(F.round(c, 3), F.lit(0.0)).alias(c) for c in ("influence", "activity", "communication")],
    )


def company_label(union_members: DataFrame, labels: DataFrame, day: date) -> DataFrame:
    """Shop labels of each company-wide customer."""
    cols = ["customer_type", "influence", "activity", "communication", "first_cognitive_time", "first_cognitive_scene", "last_active_time", "last_active_scene"]
    keys = ["company", "uni_customer_id"]
    return union_members.join(labels.select(*keys, *cols), keys, "left").select(
        F.col("company").alias("company_id"),
        "uni_customer_id",
        F.coalesce("sex", F.lit(0)).alias("sex"),
        "province",
        "city",
        *cols,
        F.lit(day).alias("stat_date"),
    )
