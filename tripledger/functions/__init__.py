"""Column expressions shared by the operators and the questions."""

from tripledger.functions.calendar import day_string, day_type, in_days, weekday_name, weekday_number
from tripledger.functions.numbers import exact, exact_sum, money_text, percent_text, ratio, total, weight, whole_units

__all__ = [
    "day_string",
    "day_type",
    "exact",
    "exact_sum",
    "in_days",
    "money_text",
    "percent_text",
    "ratio",
    "total",
    "weekday_name",
    "weekday_number",
    "weight",
    "whole_units",
]
