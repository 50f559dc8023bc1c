"""Fiscal calendars and period lookups.

A calendar is bounded by its days, whatever the size of the facts. Period ranges are
expanded to days once, so attaching them to a fact is an equality join on the date
instead of a range join.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PERIOD_LABELS = {"Week": "fiscal_week", "Month": "fiscal_month", "Quarter": "fiscal_quarter", "Year": "fiscal_year"}


def calendar_days(
    spark: SparkSession,
    first: dt.date,
    last: dt.date,
    start_month: int = 7,
    start_day: int = 1,
    named_by_end: bool = True,
) -> DataFrame:
    """One row per day with fiscal year, quarter, month, week and day-of-year numbers."""
    d = F.date_add(F.lit(first), F.col("id").cast("int"))
    shifted = F.date_sub(d, start_day - 1)
    opening = F.year(shifted) - F.when(F.month(shifted) < start_month, 1).otherwise(0)
    month = (F.month(shifted) - start_month + 12) % 12 + 1
    day = F.datediff(d, F.make_date(opening, F.lit(start_month), F.lit(start_day))) + 1
    return spark.range((last - first).days + 1).select(
        d.alias("calendar_date"),
        (opening + int(named_by_end)).alias("fisc_year_num"),
        (F.floor((month - 1) / 3) + 1).cast("int").alias("fisc_quarter_num"),
        month.cast("int").alias("fisc_month_num"),
        (F.floor((day - 1) / 7) + 1).cast("int").alias("fisc_week_of_year_num"),
        day.alias("fisc_year_day_num"),
    )


def calendar_periods(days: DataFrame) -> DataFrame:
    """Period ranges (week, month, quarter, year) with labels such as ``202405``."""
    year = F.col("fisc_year_num").cast("string")
    part = lambda name: F.concat(year, F.lpad(F.col(name).cast("string"), 2, "0"))
    labels = F.array(
        *(
            F.struct(F.lit(code).alias("time_period_code"), label.alias("time_period"))
            for code, label in (
                ("Week", part("fisc_week_of_year_num")),
                ("Month", part("fisc_month_num")),
                ("Quarter", part("fisc_quarter_num")),
                ("Year", year),
            )
        )
    )
    return (
        days.select("calendar_date", F.inline(labels))
        .groupBy("time_period_code", "time_period")
        .agg(F.min("calendar_date").alias("start_date"), F.max("calendar_date").alias("end_date"))
    )


def period_days(periods: DataFrame, code: str, label: str, date: str) -> DataFrame:
    """The days of one period kind: (date, label)."""
    return periods.where(F.col("time_period_code") == code).select(
        F.explode(F.sequence("start_date", "end_date")).alias(date), F.col("time_period").alias(label)
    )


def attach_periods(df: DataFrame, periods: DataFrame, date: str = "msg_date") -> DataFrame:
    """Add fiscal week, month, quarter and year labels; a day outside the calendar gets NULLs.

    Overlapping ranges of one kind repeat the row, as a range join would. The labels meet in one table of the calendar's
    days first, so the rows of ``df`` take part in a single join.
    """
    kinds = [period_days(periods, code, label, date) for code, label in PERIOD_LABELS.items()]
    days = reduce(DataFrame.unionByName, [k.select(date) for k in kinds]).distinct()
    for kind in kinds:
        days = days.join(kind, date, "left")
    return df.join(days, date, "left")


def fiscal_keys(df: DataFrame) -> DataFrame:
    """Composite integer keys such as year*100+week and year*1000+day."""
    year = F.col("fisc_year_num")
    return df.select(
        "*",
        (year * 100 + F.col("fisc_quarter_num")).alias("fisc_year_quarter"),
        (year * 100 + F.col("fisc_month_num")).alias("fisc_year_month"),
        (year * 100 + F.col("fisc_week_of_year_num")).alias("fisc_year_week"),
        (year * 1000 + F.col("fisc_year_day_num")).alias("fisc_year_day"),
    )


def with_shift_flag(df: DataFrame, shifted_years: DataFrame, year: str = "fisc_year_num") -> DataFrame:
    """Flag rows whose fiscal year, or the year before it, is a shifted calendar year."""
    years = shifted_years.select(F.col("fisc_year_num").alias("_shift")).distinct()
    this = years.select(F.col("_shift").alias(year), F.lit(True).alias("_is"))
    prior = years.select((F.col("_shift") + 1).alias(year), F.lit(True).alias("_was"))
    flag: Column = F.coalesce(F.col("_is"), F.lit(False))
    return (
        df.join(this, year, "left")
        .join(prior, year, "left")
        .withColumn("is_shifted_year", flag)
        .withColumn("follows_shifted_year", F.coalesce(F.col("_was"), F.lit(False)))
        .drop("_is", "_was")
    )
