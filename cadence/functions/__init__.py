from cadence.functions.calendar import calendar_columns
from cadence.functions.columns import (
    MONEY,
    MONEY_TOTAL,
    RATE,
    bool_to_int,
    day_diff,
    flag_is_one,
    full_name,
    line_revenue,
    money_sum,
    null_text,
    ratio,
    safe_date,
    safe_long,
    status_label,
    surrogate_key,
    to_long,
    to_price,
    to_rate,
    week_of_year_sunday,
)

__all__ = [
    "MONEY",
    "MONEY_TOTAL",
    "RATE",
    "bool_to_int",
    "calendar_columns",
    "day_diff",
    "flag_is_one",
    "full_name",
    "line_revenue",
    "money_sum",
    "null_text",
    "ratio",
    "safe_date",
    "safe_long",
    "status_label",
    "surrogate_key",
    "to_long",
    "to_price",
    "to_rate",
    "week_of_year_sunday",
]
