"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(c: str | Column) -> Column:
    """A column from a name that may hold any character (``Q_m³/s``), or the column itself."""
    return c if isinstance(c, Column) else F.col("`" + c.replace("`", "``") + "`")


def null_if_nan(c: str | Column) -> Column:
    """NaN becomes NULL, so that means and correlations skip it."""
    return F.nanvl(column(c).cast("double"), F.lit(None).cast("double"))


def clip_nonnegative(c: str | Column) -> Column:
    """Negative values and NaN become zero; NULL stays NULL."""
    c = column(c)
    return F.when(F.isnan(c) | (c < 0), F.lit(0.0)).otherwise(c)


def parse_number(c: str | Column, strict: bool = True) -> Column:
    """Text to double. Strict raises on bad input (ANSI mode), otherwise bad input becomes NULL."""
    c = column(c)
    return c.cast("double") if strict else c.try_cast("double")


def pearson(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over the rows where both sides are present; NULL where it is undefined.

    Written from co-moments because ``corr`` raises on a constant column in ANSI mode.
    """
    x, y = null_if_nan(x), null_if_nan(y)
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))
