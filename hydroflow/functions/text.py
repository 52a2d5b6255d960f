"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hydroflow.functions.numbers import column


def safe_name(c: str | Column) -> Column:
    """A name usable in a path: slash to dash, space to underscore."""
    return F.translate(column(c), "/ ", "-_")


def series_name(param: str | Column, station: str | Column, freq: str | Column) -> Column:
    """``<param>_<safe station>_<freq>``."""
    return F.concat_ws("_", column(param), safe_name(station), column(freq))


def value_name(param: str | Column, unit: str | Column) -> Column:
    """``<param>_<unit>``, the header of a value column."""
    return F.concat_ws("_", column(param), column(unit))


def iso_instant(c: str | Column) -> Column:
    """A bare date becomes its UTC midnight; text that already has a time part is kept."""
    c = column(c)
    return F.when(F.contains(c, F.lit("T")), c).otherwise(F.concat(c, F.lit("T00:00:00Z")))
