"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadence.functions.columns import week_of_year_sunday

# Fixed values that results depend on: day-of-week numbers of the weekend
# (1 = Sunday, 7 = Saturday).
WEEKEND_DAYS = (1, 7)


def calendar_columns(day: str | Column = "date_day") -> list[Column]:
    """The ten attributes of one calendar day, named as in ``dim_date``."""
    d = F.col(day) if isinstance(day, str) else day
    return [
        F.year(d).cast("bigint").alias("year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.month(d).cast("bigint").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        F.dayofweek(d).cast("bigint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        week_of_year_sunday(d).alias("week_of_year"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.dayofweek(d).isin(*WEEKEND_DAYS).alias("is_weekend"),
    ]
