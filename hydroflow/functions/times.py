"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hydroflow.config import GERMAN_TIMESTAMP
from hydroflow.functions.numbers import column


def parse_instant(c: str | Column) -> Column:
    """ISO-8601 text to an instant, honouring its offset."""
    return column(c).cast("timestamp")


def wall_clock(c: str | Column) -> Column:
    """ISO-8601 text to a time without zone: the offset is dropped, the clock reading kept."""
    return column(c).cast("timestamp_ntz")


def parse_german(c: str | Column, strict: bool = True) -> Column:
    """``dd.MM.yyyy HH:mm:ss`` text to a time without zone. Strict raises on bad input (ANSI mode)."""
    parse = F.to_timestamp if strict else F.try_to_timestamp
    return parse(column(c), F.lit(GERMAN_TIMESTAMP) if not strict else GERMAN_TIMESTAMP).cast("timestamp_ntz")


def clock_in(c: str | Column, zone: str) -> Column:
    """The clock reading of an instant in a zone, as a time without zone."""
    return F.convert_timezone(F.current_timezone(), F.lit(zone), column(c).cast("timestamp_ntz"))


def day_of(c: str | Column) -> Column:
    return F.to_date(column(c))


def launch_time(c: str | Column, hour: int) -> Column:
    """Midnight of the given date or time, plus the launch hour."""
    midnight = day_of(c).cast("timestamp_ntz")
    return midnight + F.make_dt_interval(hours=F.lit(hour))


def step_interval(steps_per_hour: int) -> Column:
    return F.expr(f"interval '1' hour / {int(steps_per_hour)}")


def forecast_index(cutoff: str | Column, horizon_steps: int, steps_per_hour: int) -> Column:
    """Array of the ``horizon_steps`` regular times after the cut-off; the cut-off itself is not included."""
    cutoff, step = column(cutoff), step_interval(steps_per_hour)
    return F.sequence(cutoff + step, cutoff + step * F.lit(horizon_steps), step)


def day_label(c: str | Column) -> Column:
    """``Monday, 01 Jan 2024``."""
    return F.date_format(column(c), "EEEE, dd MMM yyyy")


def minute_label(c: str | Column) -> Column:
    """``2024-01-01 10:00``."""
    return F.date_format(column(c), "yyyy-MM-dd HH:mm")
