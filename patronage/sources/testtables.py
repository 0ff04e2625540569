"""Views over the star-schema test tables in the shape of the retail sources (see FIXTURES.md)."""

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronage.functions.calendar import until

COMMERCE_DAY = date(2001, 6, 30)
LAST_RUN = date(2001, 5, 31)
ACTION_DAY = date(2024, 1, 31)
FIRST_DAYS = date(1995, 1, 2)

EVENT_METRICS = [
    "trade_count",
    "trade_tidcount",
    "trade_amount",
    "trade_item_num",
    "trade_refund_count",
    "trade_refund_amount",
    "trade_last_time",
    "trade_last_amount",
    "trade_last_interval",
    "trade_first_time",
    "trade_first_amount",
    "trade_first_interval",
    "trade_avg_amount",
    "trade_avg_item_num",
    "trade_avg_buy_interval",
    "trade_avg_confirm_interval",
    "trade_max_amount",
    "trade_discount_fee",
    "trade_order_discount_fee",
]

# Days of the six event periods; the last one is open.
EVENT_PERIODS = {1: 30, 2: 60, 3: 90, 4: 180, 5: 365, 6: None}


def text(col: Column | str) -> Column:
    return F.col(col).cast("string") if isinstance(col, str) else col.cast("string")


def cents(units: Column, scale: int = 10000) -> Column:
    """Whole cents out of an integer amount with four decimals, as a double."""
    half, step = scale // 200, scale // 100
    return F.floor((units + half) / F.lit(step)).cast("double") / F.lit(100.0)


class Tables:
    """Lazy source views for one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def nation(self) -> DataFrame:
        return self.read("nation")

    @cached_property
    def tenant_shop(self) -> DataFrame:
        return self.read("supplier").join(self.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.concat(F.lit("T"), text("n_regionkey")).alias("tenant"),
            F.col("n_name").alias("plat_code"),
            text("s_suppkey").alias("shop_id"),
            F.col("s_name").alias("shop_name"),
            F.concat("n_name", F.lit("|"), text("s_suppkey")).alias("uni_shop_id"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with integer net amounts (four decimals)."""
        price = F.round(F.col("l_extendedprice") * 100).cast("long")
        off = F.round(F.col("l_discount") * 100).cast("long")
        return self.read("lineitem").select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            F.col("l_quantity").cast("int").alias("quantity"),
            (price * (100 - off)).alias("net"),
            (price * off).alias("discount"),
            "l_returnflag",
            "l_shipdate",
        )

    @cached_property
    def order_shop(self) -> DataFrame:
        """Lines per order and shop with the order header. Lines move once, by order, for both the sums and the header."""
        returned = F.col("l_returnflag") == "R"
        grouped = self.lines.repartition("l_orderkey").groupBy("l_orderkey", "l_suppkey").agg(
            F.sum("net").alias("net"),
            F.sum("discount").alias("discount"),
            F.sum(F.when(returned, F.col("net"))).alias("returned"),
            F.sum("quantity").cast("int").alias("product_num"),
            F.min("l_shipdate").alias("first_ship"),
            F.max("l_shipdate").alias("last_ship"),
        )
        return grouped.join(self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
            "shop_id", text("l_suppkey")
        )

    @cached_property
    def trade(self) -> DataFrame:
        status = (
            F.when(F.col("o_orderstatus") == "F", "TRADE_FINISHED")
            .when(F.col("o_orderstatus") == "O", "WAIT_BUYER_CONFIRM_GOODS")
            .otherwise("TRADE_CLOSED")
        )
        shops = self.tenant_shop.select("plat_code", "shop_id", "uni_shop_id")
        return self.order_shop.join(shops, "shop_id").select(
            "plat_code",
            "shop_id",
            "uni_shop_id",
            text("o_custkey").alias("uni_id"),
            F.col("o_orderkey").alias("trade_id"),
            cents(F.col("net")).alias("payment"),
            cents(F.col("returned"), 20000).alias("refund_fee"),
            "product_num",
            F.when(F.col("o_orderpriority") == "1-URGENT", "step").otherwise("fixed").alias("trade_type"),
            F.col("o_orderdate").alias("created"),
            F.col("first_ship").alias("pay_time"),
            status.alias("order_status"),
            F.date_format("o_orderdate", "yyyy-MM").alias("part"),
            F.greatest("o_orderdate", "first_ship").alias("arrived"),
        )

    def _customers(self, trades: DataFrame) -> DataFrame:
        shops = self.tenant_shop.select("tenant", "plat_code", "shop_id", "uni_shop_id")
        buyers = trades.select("plat_code", "uni_shop_id", "uni_id").join(shops.drop("shop_id"), ["plat_code", "uni_shop_id"])
        # A prospect of one shop at home: shops of a nation are numbered, and the customer key picks a number.
        numbered = shops.withColumn("place", F.row_number().over(W.partitionBy("plat_code").orderBy(F.col("shop_id").cast("long"))) - 1)
        sizes = shops.groupBy("plat_code").agg(F.count("*").alias("shops"))
        local = self.read("customer").join(self.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        picks = local.join(sizes, F.col("n_name") == F.col("plat_code")).select(
            "plat_code", text("c_custkey").alias("uni_id"), (F.col("c_custkey") % F.col("shops")).alias("place")
        )
        prospects = picks.join(numbered.drop("shop_id"), ["plat_code", "place"])
        keys = ["uni_id", "uni_shop_id", "plat_code", "tenant"]
        pairs = buyers.select(*keys).unionByName(prospects.select(*keys)).distinct()
        return pairs.withColumn(
            "modified", F.date_add(F.lit(date(1995, 1, 1)), (F.col("uni_id").cast("long") % 1000).cast("int")).cast("timestamp_ntz")
        )

    @cached_property
    def shop_customer(self) -> DataFrame:
        return self._customers(self.trade)

    def customers_by(self, day: date) -> DataFrame:
        """The customer table as it stood at the end of the day."""
        return self._customers(self.trade.filter(until(F.col("arrived"), day)))

    @cached_property
    def order_item(self) -> DataFrame:
        shops = self.tenant_shop.select("plat_code", "shop_id", "uni_shop_id")
        return self.lines.withColumn("shop_id", text("l_suppkey")).join(shops, "shop_id").select(
            F.col("l_orderkey").alias("trade_id"),
            "plat_code",
            "shop_id",
            "uni_shop_id",
            F.col("l_partkey").alias("product_id"),
            F.col("quantity").alias("product_num"),
            cents(F.col("net")).alias("payment"),
        )

    @cached_property
    def product(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("product_id"), F.concat_ws("/", "p_type", "p_brand").alias("category_id")
        )

    @cached_property
    def category(self) -> DataFrame:
        pairs = self.read("part").select("p_type", "p_brand").distinct()
        return pairs.select(
            F.concat_ws("/", "p_type", "p_brand").alias("category_id"), F.col("p_type").alias("parent_category_id")
        )

    @cached_property
    def customer_region(self) -> DataFrame:
        """Customers with their home nation and the first shop there."""
        first_shop = self.read("supplier").groupBy("s_nationkey").agg(F.min("s_suppkey").alias("s_suppkey"))
        return (
            self.read("customer")
            .join(self.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(first_shop, F.col("c_nationkey") == F.col("s_nationkey"))
        )

    @cached_property
    def member(self) -> DataFrame:
        return self.customer_region.filter(F.col("c_custkey") % 3 != 0).select(
            F.concat(F.lit("CP"), text("n_regionkey")).alias("card_plan_id"),
            text("c_custkey").alias("member_id"),
            F.col("n_name").alias("plat_code"),
            F.concat("n_name", F.lit("|"), text("s_suppkey")).alias("uni_shop_id"),
            text("s_suppkey").alias("shop_id"),
            (1 + F.col("c_custkey") % 4).cast("int").alias("grade"),
            F.date_add(F.lit(date(2000, 1, 1)), (F.col("c_custkey") % 545).cast("int")).cast("timestamp_ntz").alias("created"),
        )

    @cached_property
    def card_shop(self) -> DataFrame:
        return self.tenant_shop.select(
            F.concat(F.lit("CP"), F.expr("substring(tenant, 2)")).alias("card_plan_id"), "plat_code", "shop_id", "uni_shop_id"
        )

    @cached_property
    def customer_member(self) -> DataFrame:
        return self.member.select("card_plan_id", "member_id", F.col("member_id").alias("uni_id"))

    @cached_property
    def member_orders(self) -> DataFrame:
        members = self.member.select("card_plan_id", "member_id")
        return self.read("orders").withColumn("member_id", text("o_custkey")).join(members, "member_id")

    @cached_property
    def point_change(self) -> DataFrame:
        points = F.round(F.col("o_totalprice") / 1000).cast("long")
        return self.member_orders.select(
            "card_plan_id",
            "member_id",
            F.when(F.col("o_orderstatus") == "P", -points).otherwise(points).alias("change_value"),
            F.col("o_orderdate").alias("change_time"),
        )

    @cached_property
    def grade_change(self) -> DataFrame:
        kind = F.when(F.col("o_orderstatus") == "F", "UP").when(F.col("o_orderstatus") == "O", "DOWN").otherwise("KEEP")
        return self.member_orders.select(
            "card_plan_id",
            "member_id",
            kind.alias("change_type"),
            (1 + F.col("o_orderkey") % 4).cast("int").alias("grade_before_change"),
            F.col("o_orderdate").alias("change_time"),
            F.col("o_orderkey").alias("change_id"),
        )

    @cached_property
    def effective_point(self) -> DataFrame:
        overdue = F.date_add(F.col("o_orderdate").cast("date"), 365)
        return self.member_orders.select(
            "card_plan_id",
            "member_id",
            F.round(F.col("o_totalprice") / 1000).cast("long").alias("point"),
            F.col("o_orderdate").alias("effective_date"),
            overdue.cast("timestamp_ntz").alias("overdue_date"),
            (overdue > F.lit(COMMERCE_DAY)).cast("int").alias("valid"),
        )

    @cached_property
    def action(self) -> DataFrame:
        kind = F.create_map(
            *[F.lit(x) for pair in (("view", "READ"), ("click", "VISIT"), ("purchase", "SHARE"), ("signup", "OPEN_SHARE")) for x in pair]
        )
        return self.read("events").select(
            text("user_id").alias("user_id"),
            text(F.col("user_id") % 3).alias("subject_id"),
            text(F.col("user_id") % 10).alias("sub_id"),
            text(F.col("user_id") - F.col("user_id") % 10).alias("relate_userid"),
            F.coalesce(kind[F.col("event_type")], F.lit("OTHER")).alias("action"),
            F.when(F.col("event_id") % 2 == 0, "mp").otherwise("mini").alias("source"),
            F.get_json_object("props", "$.k").alias("business_id"),
            F.col("event_type").alias("business_action"),
            F.date_trunc("second", "ts").cast("timestamp_ntz").alias("action_time"),
            "event_id",
        )

    @cached_property
    def social_member(self) -> DataFrame:
        user = F.col("user_id").cast("long")
        return self.action.select("user_id", "subject_id", "sub_id").distinct().select(
            F.col("subject_id").alias("company"),
            F.concat(F.lit("U"), "user_id").alias("uni_customer_id"),
            F.col("sub_id").alias("shop_id"),
            F.concat(F.lit("app"), "subject_id").alias("appid"),
            F.col("user_id").alias("openid"),
            F.when(user % 5 == 0, F.concat(F.lit("138"), "user_id")).otherwise("").alias("auth_mobile"),
        )

    @cached_property
    def social_profile(self) -> DataFrame:
        """First and last contact of each user and the subscription state."""
        order = F.struct("action_time", "event_id")
        user = F.col("user_id").cast("long")
        return self.action.groupBy("user_id", "subject_id", "sub_id").agg(
            F.min("action_time").alias("first_cognitive_time"),
            F.min_by("business_action", order).alias("first_cognitive_scene"),
            F.max("action_time").alias("last_active_time"),
            F.max_by("business_action", order).alias("last_active_scene"),
        ).select(
            F.col("subject_id").alias("company"),
            F.col("sub_id").alias("shop_id"),
            F.col("user_id").alias("openid"),
            "first_cognitive_time",
            "first_cognitive_scene",
            "last_active_time",
            "last_active_scene",
            (user % 4 == 0).cast("int").alias("subscribe"),
            F.when(user % 4 == 0, F.col("last_active_time")).alias("last_subscribe_time"),
            F.when(user % 4 == 0, F.col("last_active_scene")).alias("last_subscribe_scene"),
            (user % 8 == 0).cast("int").alias("first_subscribe"),
            (user % 7 == 0).cast("int").alias("placed"),
        )

    @cached_property
    def union_member(self) -> DataFrame:
        user = F.col("openid").cast("long")
        return self.social_member.select(
            "company",
            "uni_customer_id",
            F.when(user % 6 != 0, user % 2).cast("int").alias("sex"),
            F.concat(F.lit("P"), text(user % 11)).alias("province"),
            F.concat(F.lit("C"), text(user % 17)).alias("city"),
        )

    @cached_property
    def top_trade(self) -> DataFrame:
        status = (
            F.when(F.col("o_orderstatus") == "F", "TRADE_FINISHED")
            .when(F.col("o_orderstatus") == "O", "WAIT_BUYER_CONFIRM_GOODS")
            .otherwise("WAIT_BUYER_PAY")
        )
        paid = F.col("o_orderstatus") != "P"
        delay = F.make_dt_interval(mins=(F.floor("o_totalprice") % 2880).cast("int"))
        return self.order_shop.select(
            F.col("shop_id").alias("dp_id"),
            F.concat_ws("-", text("o_orderkey"), text("l_suppkey")).alias("tid"),
            status.alias("status"),
            F.concat(F.lit("nick"), text("o_custkey")).alias("buyer_nick"),
            F.col("o_orderdate").alias("created"),
            F.when(paid, F.col("o_orderdate") + delay).alias("pay_time"),
            cents(F.col("net")).alias("payment"),
            cents(F.col("discount")).alias("discount_fee"),
            F.when(paid, F.col("first_ship")).alias("consign_time"),
            F.when(F.col("o_orderstatus") == "F", F.date_add(F.col("last_ship").cast("date"), 7).cast("timestamp_ntz")).alias("end_time"),
            (F.col("o_orderkey") % 6).cast("int").alias("seller_flag"),
            "product_num",
            F.when(F.col("o_orderstatus") == "P", "active").otherwise(F.date_format("o_orderdate", "yyyy-MM")).alias("part"),
        )

    @cached_property
    def refund(self) -> DataFrame:
        return self.lines.filter(F.col("l_returnflag") == "R").select(
            text("l_suppkey").alias("dp_id"),
            F.when(F.col("l_linenumber") == 1, "CLOSED").otherwise("SUCCESS").alias("status"),
            cents(F.col("net")).alias("refund_fee"),
            F.col("l_shipdate").alias("created"),
        )

    @cached_property
    def top_order(self) -> DataFrame:
        header = self.read("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus")
        product = self.read("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
        paid = F.col("o_orderstatus") != "P"
        delay = F.make_dt_interval(mins=(F.floor("o_totalprice") % 2880).cast("int"))
        return (
            self.lines.join(header, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(product, "l_partkey")
            .select(
                text("l_suppkey").alias("dp_id"),
                F.concat_ws("-", text("l_orderkey"), text("l_suppkey")).alias("tid"),
                F.concat_ws("-", text("l_orderkey"), text("l_linenumber")).alias("oid"),
                F.concat(F.lit("nick"), text("o_custkey")).alias("buyer_nick"),
                F.col("p_type").alias("cid"),
                text("l_partkey").alias("num_iid"),
                text("l_linenumber").alias("sku_id"),
                F.col("quantity").alias("num"),
                F.when(F.col("o_orderstatus") == "F", "TRADE_FINISHED").when(F.col("o_orderstatus") == "O", "WAIT_BUYER_CONFIRM_GOODS").otherwise("WAIT_BUYER_PAY").alias("status"),
                F.col("o_orderdate").alias("created"),
                F.when(paid, F.col("o_orderdate") + delay).alias("pay_time"),
                F.when(F.col("o_orderstatus") == "F", F.date_add(F.col("l_shipdate").cast("date"), 7).cast("timestamp_ntz")).alias("end_time"),
                F.when(F.col("o_orderstatus") == "P", "active").otherwise(F.date_format("o_orderdate", "yyyy-MM")).alias("part"),
            )
        )

    @cached_property
    def top_member(self) -> DataFrame:
        """Loyalty state of each buyer in each shop."""
        customer = F.expr("substring(buyer_nick, 5)").cast("long")
        return self.top_trade.select("dp_id", "buyer_nick").distinct().select(
            "dp_id",
            "buyer_nick",
            F.when(customer % 10 == 0, "frozen").otherwise("normal").alias("status"),
            F.when(customer % 9 != 0, 1 + customer % 4).cast("int").alias("grade"),
        )

    @cached_property
    def item_category(self) -> DataFrame:
        """Shop category tree: parts' types on top, brands below, as shops offer them."""
        sold = self.lines.select("l_suppkey", "l_partkey").join(self.read("part"), F.col("l_partkey") == F.col("p_partkey"))
        top = sold.select(
            text("l_suppkey").alias("dp_id"), F.col("p_type").alias("cid"), F.initcap("p_type").alias("name"),
            F.lit("0").alias("parent_cid"), F.lit("true").alias("is_parent"),
        )
        leaf = sold.select(
            text("l_suppkey").alias("dp_id"), F.col("p_brand").alias("cid"), F.col("p_brand").alias("name"),
            F.col("p_type").alias("parent_cid"), F.lit("false").alias("is_parent"),
        )
        return top.unionByName(leaf).withColumns({"status": F.lit("normal"), "part": F.lit(COMMERCE_DAY)})

    @cached_property
    def care_shop(self) -> DataFrame:
        """Shops that subscribed to care after a purchase, with the days to wait."""
        return self.read("supplier").select(
            text("s_suppkey").alias("shop_id"), (20 + F.col("s_suppkey") % 40).cast("int").alias("care_days")
        )

    @cached_property
    def item_config(self) -> DataFrame:
        """Re-purchase rules of the items shops sell."""
        sold = self.lines.select("l_suppkey", "l_partkey", "l_linenumber").groupBy("l_suppkey", "l_partkey").agg(
            F.max("l_linenumber").alias("line")
        )
        sized = sold.join(self.read("part").select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
        return sized.select(
            text("l_suppkey").alias("shop_id"),
            text("l_partkey").alias("item_id"),
            F.when(F.col("p_size") % 5 == 0, text("line")).otherwise("NULL").alias("sku_id"),
            (1 + F.col("p_size") % 4).cast("int").alias("period"),
            F.when(F.col("p_size") % 3 == 0, F.lit("5")).alias("exclude_flag"),
            text((F.col("l_partkey") + F.col("l_suppkey")) % 4).alias("exclude_customer"),
            text(F.col("l_partkey") % 2).alias("trigger_status"),
        )

    @cached_property
    def rfm_event(self) -> DataFrame:
        """Nineteen trade metrics per shop, buyer and period."""
        day = F.lit(COMMERCE_DAY)
        age = F.datediff(day, F.col("created"))
        codes = F.array_compact(F.array(*[F.when(F.lit(True) if days is None else age < days, F.lit(code)) for code, days in EVENT_PERIODS.items()]))
        base = self.top_trade.filter((F.col("status") != "WAIT_BUYER_PAY") & (age >= 0)).withColumn("period", F.explode(codes))
        order = F.struct("created", "tid")
        confirm = F.datediff("end_time", "created")
        metrics = base.groupBy("dp_id", "buyer_nick", "period").agg(
            F.countDistinct("created").alias("trade_count"),
            F.count("tid").alias("trade_tidcount"),
            F.round(F.sum("payment"), 2).alias("trade_amount"),
            F.sum("product_num").alias("trade_item_num"),
            F.count(F.when(F.col("seller_flag") == 0, 1)).alias("trade_refund_count"),
            F.round(F.sum(F.when(F.col("seller_flag") == 0, F.col("payment")).otherwise(0.0)), 2).alias("trade_refund_amount"),
            F.max("created").alias("trade_last_time"),
            F.max_by("payment", order).alias("trade_last_amount"),
            F.datediff(day, F.max("created")).alias("trade_last_interval"),
            F.min("created").alias("trade_first_time"),
            F.min_by("payment", order).alias("trade_first_amount"),
            F.datediff(day, F.min("created")).alias("trade_first_interval"),
            F.avg(confirm).alias("trade_avg_confirm_interval"),
            F.max("payment").alias("trade_max_amount"),
            F.round(F.sum("discount_fee"), 2).alias("trade_discount_fee"),
            F.round(F.sum(F.when(F.col("status") == "TRADE_FINISHED", F.col("discount_fee")).otherwise(0.0)), 2).alias("trade_order_discount_fee"),
        )
        span = F.col("trade_first_interval") - F.col("trade_last_interval")
        return metrics.withColumns(
            {
                "trade_avg_amount": F.col("trade_amount") / F.col("trade_tidcount"),
                "trade_avg_item_num": F.col("trade_item_num") / F.col("trade_tidcount"),
                "trade_avg_buy_interval": F.try_divide(span.cast("double"), (F.col("trade_count") - 1).cast("double")),
            }
        ).select("dp_id", "buyer_nick", "period", *EVENT_METRICS)

    @cached_property
    def festival_config(self) -> DataFrame:
        shop = F.col("s_suppkey").cast("int")
        return self.read("supplier").select(
            text("s_suppkey").alias("shop_id"),
            F.date_sub(F.lit(COMMERCE_DAY), shop % 30).alias("care_from"),
            F.date_add(F.lit(COMMERCE_DAY), shop % 20 - 5).alias("care_to"),
        )

    @cached_property
    def card_holders(self) -> DataFrame:
        """Members as customers of the shop that opened their card: joining makes them known there, with or without a trade."""
        shops = self.tenant_shop.select("tenant", "uni_shop_id")
        return self.member.join(shops, "uni_shop_id").select("tenant", "plat_code", "uni_shop_id", F.col("member_id").alias("uni_id"))

    @cached_property
    def customer_contact(self) -> DataFrame:
        known = self.shop_customer.select("tenant", "uni_id").union(self.card_holders.select("tenant", "uni_id")).distinct()
        names = self.read("customer").select(text("c_custkey").alias("uni_id"), F.col("c_name").alias("full_name"), "c_custkey")
        return known.join(names, "uni_id").select(
            "tenant",
            "uni_id",
            "full_name",
            F.when(F.col("c_custkey") % 8 != 0, F.concat(F.lit("139"), "uni_id")).alias("mobile"),
        )

    @cached_property
    def customer_account(self) -> DataFrame:
        keys = ["plat_code", "uni_shop_id", "uni_id"]
        known = self.shop_customer.select(*keys).union(self.card_holders.select(*keys)).distinct()
        return known.withColumn("plat_account", F.concat(F.lit("nick"), "uni_id"))

    @cached_property
    def known_tenants(self) -> DataFrame:
        """Tenants that already had an accepted order on the first day."""
        early = self.trade.filter((F.col("created") < F.lit(FIRST_DAYS)) & (F.col("order_status") != "TRADE_CLOSED"))
        return early.join(self.tenant_shop.select("tenant", "uni_shop_id"), "uni_shop_id").select("tenant").distinct()
