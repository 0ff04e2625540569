"""Small column helpers."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.constants import MONEY_DIGITS, RATE_DIGITS, UNDEFINED_RATE


def null_if_token(col: Column) -> Column:
    """Text that stands for a missing value becomes null."""
    return F.when(F.lower(F.trim(col)).isin("null", ""), None).otherwise(col)


def with_tokens_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: null_if_token(F.col(c)) for c in cols})


def number(df: DataFrame, name: str) -> Column:
    """A numeric column, also when it arrives as text with missing-value tokens."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return null_if_token(col).try_cast("double")
    return col


def valid_timestamp(col: Column) -> Column:
    """The text is a usable time."""
    return F.coalesce(
        col.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9:.]*$") & F.try_to_timestamp(col).isNotNull(), F.lit(False)
    )


def with_valid_times(df: DataFrame, cols: list[str]) -> DataFrame:
    """Times that arrive as text, and are null where the text is no usable time."""
    texts = [c for c in cols if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: F.when(valid_timestamp(F.col(c)), F.try_to_timestamp(F.col(c))).cast("timestamp_ntz") for c in texts})


def money_sum(col: Column) -> Column:
    """Sum of amounts in cents precision, so the result does not depend on the order of rows."""
    return F.round(F.sum(col), MONEY_DIGITS)


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def ratio(num: Column, den: Column) -> Column:
    """Quotient, null when the divisor is zero or missing."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def rate(num: Column, den: Column, undefined: float = UNDEFINED_RATE) -> Column:
    """Quotient with a sentinel when the divisor is zero."""
    return F.when(den == 0, F.lit(float(undefined))).otherwise(num.cast("double") / den.cast("double"))


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Six decimals for values whose last digits depend on the order of additions."""
    return df.withColumns({c: F.round(c, RATE_DIGITS) for c in cols})


def present(df: DataFrame) -> DataFrame:
    """Report form: dates and times as text, decimals as doubles."""
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        out.append(col.alias(field.name))
    return df.select(*out)
