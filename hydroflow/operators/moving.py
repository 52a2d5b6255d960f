"""Trailing means over row frames. Frames count rows, not time: gaps are not filled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hydroflow.config import DAY_TREND_ROWS
from hydroflow.functions import day_of, null_if_nan
from hydroflow.operators.positions import global_positions, null_safe_join, row_index
from hydroflow.session import stored

CHUNK_ROWS = 100_000


def trailing_mean(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    rows: int,
    out: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Mean of the present values among the last ``rows`` rows up to this one, over the whole series.

    Computed in chunks of the position, so that one series spreads over many tasks. A row is needed by itself and
    by the ``rows - 1`` rows after it: rows near the end of a chunk are also sent to the next one, where they
    only feed frames.
    """
    chunk = max(rows, chunk_rows)
    placed = global_positions(df, keys, order, "_pos")
    home = F.floor(F.col("_pos") / chunk)
    reach = F.floor((F.col("_pos") + (rows - 1)) / chunk)
    sent = placed.withColumn("_home", home).withColumn("_chunk", F.explode(F.sequence(home, reach)))
    frame = W.partitionBy(*keys, "_chunk").orderBy("_pos").rowsBetween(-(rows - 1), 0)
    return (
        sent.withColumn(out, F.avg(null_if_nan(value)).over(frame))
        .filter(F.col("_chunk") == F.col("_home"))
        .drop("_pos", "_home", "_chunk")
    )


def day_trailing_mean(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    rows: int = DAY_TREND_ROWS,
) -> DataFrame:
    """Trailing mean that starts anew on each calendar day: a plain window, the day bounds its group."""
    by_day = df.withColumn("day", day_of(order[0]))
    frame = W.partitionBy(*keys, "day").orderBy(*order).rowsBetween(-(rows - 1), 0)
    return by_day.withColumn(out, F.avg(null_if_nan(value)).over(frame))


def long_trailing_mean(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    rows: int,
    out: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The same mean as :func:`trailing_mean` for frames of any length, at a cost that does not grow with the frame.

    Sums come in two levels: from the start of a chunk of rows to each row, and of whole chunks before it. A frame's sum is
    the difference of what lies up to its last row and up to the row before its first one, which one equi-join on
    the row number fetches. Sums restart at every chunk, so differences lose few digits; whole numbers are exact. A frame
    does not reach over the start of its series. NULL keys are a series like any other.
    """
    keys = list(keys)
    indexed = row_index(df, keys, order, "_at")
    present = null_if_nan(value)
    chunk = F.floor(F.col("_at") / chunk_rows)
    indexed = stored(indexed.withColumns({"_x": present, "_chunk": chunk}), "prefix-rows")
    inside = W.partitionBy(*keys, "_chunk").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    sums = indexed.select(*keys, "_at", "_chunk", F.coalesce(F.sum("_x").over(inside), F.lit(0.0)).alias("_s"), F.count("_x").over(inside).alias("_n"))
    sums = stored(sums, "prefix-sums")
    # One row per chunk: what lies in the chunks before it.
    totals = indexed.groupBy(*keys, "_chunk").agg(F.coalesce(F.sum("_x"), F.lit(0.0)).alias("_ts"), F.count("_x").alias("_tn"))
    before = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(
        *keys, "_chunk", F.coalesce(F.sum("_ts").over(before), F.lit(0.0)).alias("_bs"), F.coalesce(F.sum("_tn").over(before), F.lit(0)).alias("_bn")
    )
    whole = null_safe_join(sums, totals, [*keys, "_chunk"]).select(*keys, "_at", "_s", "_n", "_bs", "_bn")
    # The row before the frame, numbered like the frame's last row.
    left = whole.select(*keys, (F.col("_at") + rows).alias("_at"), *[F.col(c).alias(f"_0{c}") for c in ("_s", "_n", "_bs", "_bn")])
    met = null_safe_join(whole, left, [*keys, "_at"], "left")

    def over_frame(own: str, chunks: str):
        earlier = [F.coalesce(F.col(f"_0{c}"), F.lit(0)) for c in (own, chunks)]
        return (F.col(chunks) - earlier[1]) + (F.col(own) - earlier[0])

    n = over_frame("_n", "_bn")
    means = met.select(*keys, "_at", F.when(n > 0, over_frame("_s", "_bs") / n).alias(out))
    return null_safe_join(indexed, means, [*keys, "_at"]).select(*df.columns, out)
