"""Holiday calendars generated by rule as a Spark date table.

The calendar is a DataFrame ``(holiday_date DATE, name STRING)`` built from a
year range with date arithmetic on the executors; no date list is stored.
It has at most 14 rows a year.  :func:`is_holiday` applies the same rules to a
date column directly, for any year and without a table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The holiday rules that define the two calendars.
# (name, month, rule, argument)
#   rule "fixed"      : day of month given by argument, moved to the nearest
#                       weekday when it falls on a weekend (Sat -> Fri, Sun -> Mon)
#   rule "fixed_raw"  : day of month given by argument, never moved
#   rule "nth"        : argument = (n, weekday); n = -1 means the last one
#   rule "after_first_monday": first Tuesday after the first Monday
FEDERAL_RULES = [
    ("New Year's Day", 1, "fixed", 1),
    ("Martin Luther King Jr. Day", 1, "nth", (3, "Mon")),
    ("Washington's Birthday", 2, "nth", (3, "Mon")),
    ("Memorial Day", 5, "nth", (-1, "Mon")),
    ("Juneteenth", 6, "fixed", 19),          # observed from 2021 on
    ("Independence Day", 7, "fixed", 4),
    ("Labor Day", 9, "nth", (1, "Mon")),
    ("Columbus Day", 10, "nth", (2, "Mon")),
    ("Veterans Day", 11, "fixed", 11),
    ("Thanksgiving Day", 11, "nth", (4, "Thu")),
    ("Christmas Day", 12, "fixed", 25),
]
STATE_EXTRA_RULES = [
    ("Lincoln's Birthday", 2, "fixed_raw", 12),
    ("Flag Day", 6, "nth", (2, "Sun")),
    ("Election Day", 11, "after_first_monday", None),
]
JUNETEENTH_FIRST_YEAR = 2021
CALENDARS = ("federal", "state")


def _observed(d: Column) -> Column:
    wd = F.weekday(d)
    return (F.when(wd == 5, F.date_sub(d, 1))
             .when(wd == 6, F.date_add(d, 1))
             .otherwise(d))


def _nth_weekday(year: Column, month: int, n: int, dow: str) -> Column:
    first_of_month = F.make_date(year, F.lit(month), F.lit(1))
    if n == -1:
        return F.next_day(F.date_sub(F.last_day(first_of_month), 7), dow)
    first = F.next_day(F.date_sub(first_of_month, 1), dow)
    return F.date_add(first, 7 * (n - 1))


def _rule_date(year: Column, month: int, rule: str, arg) -> Column:
    if rule == "fixed":
        return _observed(F.make_date(year, F.lit(month), F.lit(arg)))
    if rule == "fixed_raw":
        return F.make_date(year, F.lit(month), F.lit(arg))
    if rule == "nth":
        return _nth_weekday(year, month, *arg)
    if rule == "after_first_monday":
        return F.date_add(_nth_weekday(year, month, 1, "Mon"), 1)
    raise ValueError(f"unknown holiday rule {rule!r}")


def _rules(calendar: str):
    if calendar not in CALENDARS:
        raise ValueError(f"calendar must be one of {CALENDARS}, got {calendar!r}")
    return FEDERAL_RULES + (STATE_EXTRA_RULES if calendar == "state" else [])


def holidays_from_years(years: DataFrame, calendar: str = "federal", year: str = "year", keep=()) -> DataFrame:
    """Observed holidays for every holiday year in the ``year`` column of ``years``.

    An observed date may fall in the previous calendar year (New Year's Day on
    a Saturday is observed on Dec 31), exactly as a published calendar lists it.
    """
    rules = _rules(calendar)
    y = F.col(year).cast("int")
    entries = []
    for name, month, rule, arg in rules:
        d = _rule_date(y, month, rule, arg)
        if name == "Juneteenth":
            d = F.when(y >= JUNETEENTH_FIRST_YEAR, d)
        entries.append(F.struct(d.alias("holiday_date"), F.lit(name).alias("name")))
    return (years.select(F.explode(F.array(*entries)).alias("h"), *keep)
                 .select("h.holiday_date", "h.name", *keep)
                 .where(F.col("holiday_date").isNotNull()))


def holiday_table(spark: SparkSession, calendar: str, first_year: int, last_year: int) -> DataFrame:
    """Observed holidays of the holiday years ``first_year..last_year``."""
    if first_year > last_year:
        raise ValueError("first_year must not be after last_year")
    years = spark.range(first_year, last_year + 1).withColumnRenamed("id", "year")
    return holidays_from_years(years, calendar)


def holiday_table_for(df: DataFrame, ts: str, calendar: str = "federal") -> DataFrame:
    """Observed holidays within the calendar years that ``df[ts]`` spans (one min/max pass over ``df``).

    The holiday year after the last is looked at too: its New Year's Day may
    be observed on December 31.
    """
    span = df.agg(F.min(F.year(ts)).alias("_lo"), F.max(F.year(ts)).alias("_hi"))
    years = span.select("_lo", "_hi", F.explode(F.sequence(F.col("_lo"), F.col("_hi") + 1)).alias("year"))
    found = holidays_from_years(years, calendar, keep=("_lo", "_hi"))
    return found.where(F.year("holiday_date").between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")


def is_holiday(date: Column, calendar: str = "federal") -> Column:
    """Whether a date is an observed holiday, by the rules themselves: for any year, without a join."""
    year, month = F.year(date), F.month(date)
    by_month: dict[int, list[Column]] = {}
    for name, m, rule, arg in _rules(calendar):
        hit = date == _rule_date(year, m, rule, arg)
        by_month.setdefault(m, []).append(hit & (year >= JUNETEENTH_FIRST_YEAR) if name == "Juneteenth" else hit)
    # New Year's Day of the next year, if that is a Saturday
    by_month.setdefault(12, []).append(date == _rule_date(year + 1, 1, "fixed", 1))
    out = F.lit(False)
    for m, hits in by_month.items():
        any_hit = hits[0]
        for h in hits[1:]:
            any_hit = any_hit | h
        out = F.when(month == m, any_hit).otherwise(out)
    return F.coalesce(out, F.lit(False))


def holiday_dates(spark: SparkSession, holidays=None, first_year: int | None = None,
                  last_year: int | None = None) -> DataFrame:
    """Normalise a holiday argument to a one-column distinct ``holiday_date`` table.

    ``None`` → federal calendar; ``"federal"`` / ``"state"`` → that calendar,
    for the years given, which a built-in calendar needs (:func:`is_holiday`
    holds for any year); a DataFrame → its first date-like column; an iterable
    of date-likes → a small literal table (the caller owns its size).
    """
    if holidays is None:
        holidays = "federal"
    if isinstance(holidays, str):
        # rule-generated dates are unique by construction (no two rules can
        # land on the same day; tested over a wide year range): no distinct
        if first_year is None or last_year is None:
            raise ValueError("a built-in calendar needs first_year and last_year")
        return holiday_table(spark, holidays, first_year, last_year).select("holiday_date")
    if isinstance(holidays, DataFrame):
        col = "holiday_date" if "holiday_date" in holidays.columns else holidays.columns[0]
        df = holidays.select(F.to_date(F.col(col)).alias("holiday_date"))
    elif isinstance(holidays, Iterable):
        import pandas as pd
        vals = [pd.Timestamp(v).date() for v in holidays]
        df = spark.createDataFrame([(v,) for v in vals], "holiday_date date")
    else:
        raise ValueError("holidays must be None, a calendar name, a DataFrame or an iterable of dates")
    return df.where(F.col("holiday_date").isNotNull()).distinct()
