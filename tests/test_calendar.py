from datetime import date, timedelta

from pyspark.sql import functions as F

from patronage.functions import calendar as cal
from rows import at


def test_month_shift_keeps_the_last_day():
    assert cal.shift_months(date(2019, 2, 28), 1) == date(2019, 3, 31)
    assert cal.shift_months(date(2021, 2, 28), -12) == date(2020, 2, 29)
    assert cal.shift_months(date(2020, 3, 30), -1) == date(2020, 2, 29)
    assert cal.shift_months(date(2019, 1, 15), -13) == date(2017, 12, 15)


def test_month_ends_are_calendar_month_ends():
    ends = cal.month_ends(date(2020, 3, 31))
    assert ends[:3] == [date(2020, 2, 29), date(2020, 1, 31), date(2019, 12, 31)]
    assert len(ends) == 13 and ends[-1] == date(2019, 2, 28)


def test_windows_at_a_leap_day():
    w = cal.windows(date(2020, 2, 29))
    assert (w.tyear_start, w.year_start, w.end) == (date(2018, 3, 1), date(2019, 3, 1), date(2020, 3, 1))


def test_column_forms_agree_with_dates(spark):
    days = [date(2018, 12, 25) + timedelta(days=i) for i in range(500)]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    rows = df.select(
        "day",
        cal.shift_months_col(F.col("day"), -12).alias("back"),
        cal.week_start_col(F.col("day")).alias("iso"),
        cal.week_start_col(F.col("day"), True).alias("anchored"),
        cal.month_ends_col(F.col("day")).alias("ends"),
        cal.is_month_end(F.col("day")).alias("last"),
    ).collect()
    for r in rows:
        assert r.back == cal.shift_months(r.day, -12)
        assert r.iso == cal.week_start(r.day) and r.anchored == cal.week_start(r.day, True)
        assert r.ends == cal.month_ends(r.day)
        assert r.last == int((r.day + timedelta(days=1)).day == 1)


def test_year_anchored_week_changes_its_weekday():
    assert cal.week_start(date(2018, 6, 13), True).strftime("%a") == "Sun"
    assert cal.week_start(date(2019, 6, 12), True).strftime("%a") == "Mon"


def test_periods_half_open_and_inclusive(spark):
    day = date(2019, 7, 31)
    times = ["2019-07-31 23:59:59", "2019-07-30", "2019-07-25", "2019-07-24", "2019-07-02", "2019-07-01", "2019-08-01"]
    df = spark.createDataFrame([(at(t),) for t in times], "t timestamp_ntz")
    flags = cal.period_flags(df, "t", day)
    assert [r.last_7_days for r in flags.collect()] == [1, 1, 1, 0, 0, 0, 0]
    assert [r.last_30_days for r in flags.collect()] == [1, 1, 1, 1, 1, 0, 0]
    assert [r.this_month for r in flags.collect()] == [1, 1, 1, 1, 1, 1, 0]
    counts = {
        inclusive: {r.rangetype: r["count"] for r in cal.explode_periods(df, "t", day, inclusive).groupBy("rangetype").count().collect()}
        for inclusive in (False, True)
    }
    assert counts[False] == {1: 1, 2: 2, 3: 6, 4: 3, 5: 5}
    assert counts[True] == {1: 2, 2: 2, 3: 6, 4: 4, 5: 6}


def test_first_week_of_the_year():
    assert cal.week_start(date(2019, 1, 3), True) <= date(2019, 1, 3)
    assert cal.week_start(date(2019, 1, 1)) == date(2018, 12, 31)
