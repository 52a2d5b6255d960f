"""Row positions in time order for series of any length.

Rows are range-partitioned on the full sort key, so one series is spread over many tasks and no task gets more than
one range. Positions within a range come from the sorted rows themselves, the start of each range from the counts
of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hydroflow.session import stored

_ROW_BITS = (1 << 33) - 1  # lower bits of monotonically_increasing_id: the row within its partition


def null_safe_join(
    left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner", also: Column | None = None
) -> DataFrame:
    """Join on the named columns, NULL equal to NULL; the columns of the left side stay, as with a join on names."""
    other = {c: f"_right_{c}" for c in names}
    on = F.lit(True) if also is None else also
    for c, r in other.items():
        on = on & F.col(c).eqNullSafe(F.col(r))
    return left.join(right.withColumnsRenamed(other), on, how).drop(*other.values())


def _placed(df: DataFrame, sort_key: Sequence[str]) -> DataFrame:
    """Rows with their range and their row in it. Ranges are sampled anew on each run, so this is a stored table."""
    return stored(
        df.repartitionByRange(*sort_key)
        .sortWithinPartitions(*sort_key)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))),
        "positions",
    )


def global_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], pos: str = "pos") -> DataFrame:
    """Gap-free position of every row in (keys, order). Within a group it grows by one from row to row.

    ``order`` must end in a tie-break that makes the sort key unique.
    """
    placed = _placed(df, [*keys, *order])
    # One row per range: bounded by the partition count, not by the data.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select("_part", (F.sum("_size").over(W.orderBy("_part")) - F.col("_size")).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(pos, F.col("_start") + F.col("_at_row"))
        .drop("_part", "_at_row", "_start")
    )


def row_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "row_index") -> DataFrame:
    """Zero-based row index of each row within its group after the sort; NULL keys are a group like any other.

    Rows are counted per range and group; the sum of a group's counts over the ranges before is where it goes on.
    The join is on range and group, so the rows of a long group meet it range by range.
    """
    if not keys:
        return global_positions(df, keys, order, out)
    placed = _placed(df, [*keys, *order])
    here = placed.groupBy("_part", *keys).agg(F.min("_at_row").alias("_first"), F.count(F.lit(1)).alias("_size"))
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    starts = here.select("_part", *keys, (before - F.col("_first")).alias("_shift"))
    joined = null_safe_join(placed, starts, ["_part", *keys])
    return joined.select(*df.columns, (F.col("_at_row") + F.col("_shift")).alias(out))
