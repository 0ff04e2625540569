"""Shop, platform and tenant level as a column.

Inside a job the missing platform or shop of an upper level is coded as empty text, so that
level keys can be joined with plain equality; reports show null.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.constants import PLATFORM, SHOP, TENANT

# The most selective key comes first: sorts compare the first column by its prefix.
LEVELED = ["level_shop", "level_plat", "tenant", "type"]
LEVELED_CUSTOMER = ["uni_id", *LEVELED]
NONE = ""


def _level(code: int, plat: Column, shop: Column) -> Column:
    return F.struct(F.lit(code).alias("type"), plat.alias("level_plat"), shop.alias("level_shop"))


def _levels() -> tuple[Column, Column, Column]:
    plat, shop, none = F.col("plat_code"), F.col("uni_shop_id"), F.lit(NONE)
    return _level(SHOP, plat, shop), _level(PLATFORM, plat, none), _level(TENANT, none, none)


def per_level(df: DataFrame) -> DataFrame:
    """Repeat shop-level rows for the three levels with coded level keys."""
    return df.withColumn("level", F.explode(F.array(*_levels()))).select("*", "level.*").drop("level")


def upper_levels(df: DataFrame) -> DataFrame:
    """Repeat shop-level rows for the levels above the shop."""
    return df.withColumn("level", F.explode(F.array(*_levels()[1:]))).select("*", "level.*").drop("level")


def at_shop(df: DataFrame) -> DataFrame:
    """Shop-level rows with the level keys in place of platform and shop."""
    return df.withColumn("level", _levels()[0]).select("*", "level.*").drop("level", "plat_code", "uni_shop_id")


def coded(df: DataFrame) -> DataFrame:
    """Code the level keys of report rows."""
    return df.withColumns(
        {"level_plat": F.coalesce("plat_code", F.lit(NONE)), "level_shop": F.coalesce("uni_shop_id", F.lit(NONE))}
    ).drop("plat_code", "uni_shop_id")


def decoded(df: DataFrame) -> DataFrame:
    """Show the level keys as platform and shop, null above their level."""
    return df.withColumns(
        {"plat_code": F.nullif("level_plat", F.lit(NONE)), "uni_shop_id": F.nullif("level_shop", F.lit(NONE))}
    ).drop("level_plat", "level_shop")
