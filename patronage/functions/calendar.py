"""Snapshot windows, month ends and reporting periods."""

import calendar
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.constants import LAST_7_DAYS, LAST_30_DAYS, THIS_MONTH, THIS_WEEK, YESTERDAY

PERIOD_NAMES = {
    YESTERDAY: "yesterday",
    THIS_WEEK: "this_week",
    THIS_MONTH: "this_month",
    LAST_7_DAYS: "last_7_days",
    LAST_30_DAYS: "last_30_days",
}


def shift_months(day: date, months: int) -> date:
    """Move a date by months; the last day of a month stays the last day."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    last = calendar.monthrange(year, month + 1)[1]
    if day.day == calendar.monthrange(day.year, day.month)[1]:
        return date(year, month + 1, last)
    return date(year, month + 1, min(day.day, last))


def shift_months_col(day: Column, months: int) -> Column:
    """`shift_months` for a date column."""
    moved = F.add_months(day, months)
    return F.when(F.last_day(day) == day, F.last_day(moved)).otherwise(moved)


@dataclass(frozen=True)
class Windows:
    """Half-open time windows of a snapshot: older < tyear_start <= tyear < year_start <= year < end."""

    stat_date: date
    tyear_start: date
    year_start: date
    end: date


def windows(day: date) -> Windows:
    one = timedelta(days=1)
    return Windows(day, shift_months(day, -24) + one, shift_months(day, -12) + one, day + one)


def month_ends(day: date, n: int = 13) -> list[date]:
    """The n month ends before the month of `day`, latest first."""
    previous = day.replace(day=1) - timedelta(days=1)
    return [shift_months(previous, -i) for i in range(n)]


def month_ends_col(day: Column, n: int = 13) -> Column:
    """`month_ends` for a date column, as an array."""
    return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.last_day(F.add_months(day, -i)))


def is_month_end(day: Column) -> Column:
    return (F.last_day(day) == day).cast("int")


def week_start(day: date, anchored: bool = False) -> date:
    """Monday of the week, or the year-anchored start whose weekday depends on 7 January."""
    if anchored:
        return day - timedelta(days=((day - date(day.year, 1, 1)).days - 6) % 7)
    return day - timedelta(days=day.weekday())


def week_start_col(day: Column, anchored: bool = False) -> Column:
    if anchored:
        return F.date_sub(day, F.pmod(F.datediff(day, F.trunc(day, "year")) - 6, F.lit(7)))
    return F.trunc(day, "week").cast("date")


def period_starts(day: date, inclusive: bool = False, anchored_week: bool = False) -> dict[int, date]:
    """First day of each period that ends on `day`.

    Half-open periods of n days hold n days; `inclusive` ones also hold the day before them.
    """
    extra = 1 if inclusive else 0
    return {
        YESTERDAY: day - timedelta(days=extra),
        THIS_WEEK: week_start(day, anchored_week),
        THIS_MONTH: day.replace(day=1),
        LAST_7_DAYS: day - timedelta(days=6 + extra),
        LAST_30_DAYS: day - timedelta(days=29 + extra),
    }


def period_bounds(df: DataFrame, day_col: str, inclusive: bool = False, anchored_week: bool = False) -> DataFrame:
    """Add the first day of every period that ends on the day of the row."""
    day = F.col(day_col)
    extra = 1 if inclusive else 0
    return df.withColumns(
        {
            "yesterday_start": F.date_sub(day, extra),
            "week_start": week_start_col(day, anchored_week),
            "month_start": F.trunc(day, "month").cast("date"),
            "year_start": F.trunc(day, "year").cast("date"),
            "last_7_days_start": F.date_sub(day, 6 + extra),
            "last_30_days_start": F.date_sub(day, 29 + extra),
            "last_year_start": F.date_add(shift_months_col(day, -12), 1),
        }
    )


def until(time_col: Column, day: date) -> Column:
    """The time lies on or before the day."""
    return time_col < F.lit(day + timedelta(days=1))


def period_flags(
    df: DataFrame, time_col: str, day: date, inclusive: bool = False, anchored_week: bool = False, yearly: bool = False
) -> DataFrame:
    """One 0/1 column per period; `yearly` adds this year and the last twelve months."""
    time = F.col(time_col)
    starts = {PERIOD_NAMES[k]: v for k, v in period_starts(day, inclusive, anchored_week).items()}
    if yearly:
        starts["this_year"] = date(day.year, 1, 1)
        starts["last_year"] = shift_months(day, -12) + timedelta(days=1)
    return df.withColumns({name: F.coalesce(in_period(time, start, day).cast("int"), F.lit(0)) for name, start in starts.items()})


def in_period(time: Column, start: date, day: date) -> Column:
    return (time >= F.lit(start)) & until(time, day)


def explode_periods(
    df: DataFrame, time_col: str, day: date, inclusive: bool = False, anchored_week: bool = False, name: str = "rangetype"
) -> DataFrame:
    """Repeat each row for the periods it falls in, so that all periods come from one scan."""
    time = F.col(time_col)
    starts = period_starts(day, inclusive, anchored_week)
    codes = F.array_compact(F.array(*[F.when(time >= F.lit(s), F.lit(code)) for code, s in starts.items()]))
    recent = df.filter(in_period(time, min(starts.values()), day))
    return recent.withColumn(name, F.explode(codes))
