"""Column expressions: text, time and number helpers. All stay inside code generation."""

from hydroflow.functions.numbers import clip_nonnegative, null_if_nan, parse_number, pearson
from hydroflow.functions.text import iso_instant, safe_name, series_name, value_name
from hydroflow.functions.times import (
    day_label,
    day_of,
    forecast_index,
    launch_time,
    minute_label,
    parse_german,
    parse_instant,
    step_interval,
    wall_clock,
)

__all__ = [
    "clip_nonnegative",
    "day_label",
    "day_of",
    "forecast_index",
    "iso_instant",
    "launch_time",
    "minute_label",
    "null_if_nan",
    "parse_german",
    "parse_instant",
    "parse_number",
    "pearson",
    "safe_name",
    "series_name",
    "step_interval",
    "value_name",
    "wall_clock",
]
